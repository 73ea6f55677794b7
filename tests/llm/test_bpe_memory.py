"""BPE: texts that the splitter takes as a whole, pairs of tokens, and caches that stay bounded."""

import random

from tokenizers import Tokenizer

from sparkmart.llm import bpe
from sparkmart.llm.queries import BYTE_BPE

ALPHABET = [" ", "  ", "\n", "\r\n", " \n", "\t", "　", "\x1c", "\xa0", "a", "b", "é", "ß", "中", "the", "ing", "1", "!", "'s", "don't", "<|endoftext|>", "x" * 70]


def library():
    found = Tokenizer.from_file(BYTE_BPE)
    found.no_truncation()
    found.no_padding()
    return found


def check(coder, texts):
    got = [ids.tolist() for ids in coder.encode(texts)]
    assert got == [e.ids for e in library().encode_batch(texts, add_special_tokens=False)]
    assert [coder.decode(coder.encode([t])[0]).decode() for t in texts[:20]] == texts[:20]


def test_random_texts():
    rng = random.Random(3)
    check(bpe.Bpe(BYTE_BPE), ["".join(rng.choice(ALPHABET) for _ in range(rng.randrange(25))) for _ in range(4000)])


def test_whole_texts_are_not_remembered(monkeypatch):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(1, 12)))
    texts = [" ".join(word() for _ in range(200)) + rng.choice(["\n", "  ", " \n end", ""]) for _ in range(60)]
    coder = bpe.Bpe(BYTE_BPE)
    check(coder, texts)
    assert max(map(len, coder.chunks)) <= 64 and max(map(len, coder.words)) <= 64
    monkeypatch.setattr(bpe, "CACHED_BYTES", 100_000)
    monkeypatch.setattr(bpe, "CACHED_PAIRS", 300)
    for start in range(0, 60, 6):
        check(coder, texts[start : start + 6])
        assert max(coder.bytes_held) <= 100_000
    coder.encode([""])
    assert len(coder.pairs) <= 150


def test_pairs_fit_as_the_merges_say():
    coder, rng = bpe.Bpe(BYTE_BPE), random.Random(5)
    coder.load()
    tokens = sorted(coder.ids.values())

    def merged(data):
        ids = [coder.ids[data[i : i + 1]] for i in range(len(data))]
        while len(ids) > 1:
            rank, at = min((coder.ranks.get(pair, (1 << 30,))[0], i) for i, pair in enumerate(zip(ids, ids[1:])))
            if rank == 1 << 30:
                break
            ids[at : at + 2] = [coder.ranks[(ids[at], ids[at + 1])][1]]
        return ids

    for _ in range(20000):
        left, right = rng.choice(tokens), rng.choice(tokens)
        assert coder.fits(left, right) == (merged(coder.token[left] + coder.token[right]) == [left, right])
