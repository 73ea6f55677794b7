"""BPE encoding over a trie of distinct words, and decoding.

Of a BPE encoding, everything but the last token is again the encoding of the text it covers. So a
prefix of a word is described by one token, its last: the state of a trie node. The state of a node is the token that ends there,
and can stand behind the state of the node where it begins: two tokens can stand next to each other exactly
when their joined bytes encode to just these two. That is tested by taking the two tokens apart again, merge by merge, the last one first: a
pair across the border that would have been merged earlier than what is still whole rules them out.

Words are split from the texts by the tokenizer's own rule. The distinct new words of a batch are sorted, which is the depth-first order of
their trie: the states of the prefix shared with the word before are kept on a stack and only the rest is computed. An automaton
lists the tokens that end at a place, the longest first. Short words, and pairs that were compared, are remembered in the worker, up to a
bound in bytes; beyond it the older half goes.

Defined results: null text is empty and has no tokens. Special strings become their special token, as the library does by
default. Rows with null or repeated ids are encoded like all others. An empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.common import Shared, give_back, prepare, released, sha256

CACHED_BYTES = 48 << 20  # of words and their tokens, each kind
_ENTRY = 180  # bytes of an entry besides its content
_LONG = 64  # characters from which on a piece of text is not remembered
CACHED_PAIRS = 1_000_000
_BEFORE_BLANK = re.compile(r"\s(?= )|\s\Z")
_AT_BLANK = re.compile(r"(?<=\S)(?= )")
#: Latin letters, and signs that are neither letters, digits, blanks nor the apostrophe of contractions.
_LETTER, _SIGN = "[A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u02af]", r"[!-&(-/:-@\[-`{-~]"
_PLAIN_WORD = rf" ?{_LETTER}++| ?[0-9]++| ?{_SIGN}++|\n(?=[!-~])"  # possessive: nothing is tried twice
_PLAIN, _PLAIN_WORDS = re.compile(rf"(?:{_PLAIN_WORD})++"), re.compile(_PLAIN_WORD)


def byte_signs() -> dict[str, int]:
    """The printable sign that stands for each byte in the vocabulary file: itself, or the next above 255."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    signs = {chr(b): b for b in printable}
    for b in range(256):
        if b not in printable:
            signs[chr(256 + len(signs) - len(printable))] = b
    return signs


class Bpe:
    """Vocabulary, caches and the library's word splitter. Broadcast empty; each worker loads the file."""

    def __init__(self, path: str):
        self.path, self.ready = path, False

    def load(self) -> None:
        import ahocorasick
        from tokenizers import Tokenizer

        if self.ready:
            return
        with open(self.path, encoding="utf-8") as file:
            content = json.load(file)
        model, signs = content["model"], byte_signs()
        self.signs = signs
        to_bytes = lambda token: bytes(signs[c] for c in token)
        self.ids = {to_bytes(token): i for token, i in model["vocab"].items() if all(c in signs for c in token)}
        self.special = {t["content"]: t["id"] for t in content["added_tokens"]}
        self.ids = {token: i for token, i in self.ids.items() if i not in self.special.values()}
        self.ranks = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.ranks[(self.ids[to_bytes(left)], self.ids[to_bytes(right)])] = (rank, self.ids[to_bytes(left + right)])
        self.token = {i: token for token, i in self.ids.items()} | {i: s.encode() for s, i in self.special.items()}
        size = max(self.token) + 1
        lengths = np.array([len(self.token.get(i, b"")) for i in range(size)], dtype=np.int64)
        self.length_list = lengths.tolist()
        self.lengths, self.begins = lengths, np.concatenate([[0], np.cumsum(lengths)[:-1]])
        self.bytes = np.frombuffer(b"".join(self.token.get(i, b"") for i in range(size)), dtype=np.uint8)
        # Tokens that their own bytes do not encode to never occur; the others are known by the merge that makes them last.
        self.order, self.halves = {}, {}
        for token, i in sorted(self.ids.items(), key=lambda item: item[1]):
            rank, halves = self.last_merge(token)
            if rank is not None:
                self.order[i], self.halves[i] = rank, halves
        self.ids = {token: i for token, i in self.ids.items() if i in self.order}
        self.found = ahocorasick.Automaton()
        for token, i in self.ids.items():
            self.found.add_word(token.decode("latin-1"), (i, len(token)))
        self.found.make_automaton()
        self.at_special = re.compile("|".join(map(re.escape, self.special))) if self.special else None
        rule = content["pre_tokenizer"]
        self.plain_rule = rule["type"] == "ByteLevel" and rule.get("use_regex", True) and not rule["add_prefix_space"]
        self.split = Tokenizer.from_file(self.path).pre_tokenizer.pre_tokenize_str
        self.words, self.chunks, self.pairs, self.ready = {b"": b""}, {"": b""}, {}, True
        self.bytes_held = [0, 0]
        del content, model
        give_back()

    def last_merge(self, data: bytes) -> tuple[int | None, tuple[int, int] | None]:
        """Rank and sides of the merge that makes a token of its bytes; -1 for a single byte, None where they stay more than one."""
        ids = [self.ids[data[i : i + 1]] for i in range(len(data))]
        rank, halves = -1, None
        while len(ids) > 1:
            rank, at = min((self.ranks.get(pair, (1 << 30,))[0], i) for i, pair in enumerate(zip(ids, ids[1:])))
            if rank == 1 << 30:
                return None, None
            halves = (ids[at], ids[at + 1])
            ids[at : at + 2] = [self.ranks[halves][1]]
        return (rank, halves) if ids == [self.ids[data]] else (None, None)

    def fits(self, left: int, right: int) -> bool:
        """Whether two tokens can stand next to each other: taken apart from the last merge on, no earlier one crosses the border."""
        ranks, order, halves = self.ranks, self.order, self.halves
        of_left, of_right = order[left], order[right]  # ranks of the merges that made the two
        limit = 1 << 30  # merges from here on are undone already
        while True:
            crossing = ranks.get((left, right))
            # On the left border a merge of equal rank stands before; it is made first.
            if crossing is not None and crossing[0] < limit:
                return False
            if of_left < 0 and of_right < 0:
                return True
            if of_left > of_right:
                limit, left = of_left, halves[left][1]
                of_left = order[left]
            else:
                limit, right = of_right + 1, halves[right][0]
                of_right = order[right]

    def encode_sorted(self, words: list[bytes]) -> dict[bytes, bytes]:
        """Tokens of distinct sorted words: a depth-first walk through their trie."""
        pairs, fits, found, length_of = self.pairs, self.fits, self.found.iter, self.length_list
        out: dict[bytes, bytes] = {}
        state: list[int] = [-1]  # the last token of each prefix of the word before
        before = b""
        for word in words:
            done = 0
            for ours, theirs in zip(word, before):
                if ours != theirs:
                    break
                done += 1
            del state[done + 1 :]
            for last, (token, length) in found(word.decode("latin-1")):
                if last < done:
                    continue  # a prefix that is known
                begin = last + 1 - length
                if begin:
                    pair = state[begin] << 32 | token
                    fit = pairs.get(pair)
                    if fit is None:
                        fit = pairs[pair] = fits(state[begin], token)
                    if not fit:
                        continue
                state.append(token)
                done = last + 1
            ids, end = [], len(word)
            while end:
                ids.append(state[end])
                end -= length_of[state[end]]
            out[word] = array("i", ids[::-1]).tobytes()
            before = word
        return out

    def split_words(self, text: str) -> list[bytes]:
        if self.plain_rule and text[1:].isalpha() and text.isascii() and (text[0] == " " or text[0].isalpha()):
            return [text.encode()]
        if self.plain_rule and _PLAIN.fullmatch(text):
            return [word.encode() for word in _PLAIN_WORDS.findall(text)]
        signs = self.signs
        return [bytes([signs[c] for c in word]) for word, _ in self.split(text)]

    def trim(self, cache: dict, kind: int, new: dict) -> None:
        """After their use, forget the long ones of the new entries, and the older half of all when there are too many."""
        for key in [key for key in new if len(key) > _LONG]:
            del new[key], cache[key]
        self.bytes_held[kind] += sum(map(len, new)) + sum(map(len, new.values())) + _ENTRY * len(new)
        if self.bytes_held[kind] > CACHED_BYTES:
            for key in list(islice(cache, len(cache) // 2)):
                if key:
                    self.bytes_held[kind] -= len(key) + len(cache.pop(key)) + _ENTRY

    def encode_chunks(self, chunks: set[str]) -> dict[str, bytes]:
        """Tokens of chunks: pieces of text that the splitter treats on their own."""
        split = {chunk: self.split_words(chunk) for chunk in chunks}
        words = self.words
        new = self.encode_sorted(sorted({word for own in split.values() for word in own if word not in words}))
        words.update(new)
        found = {chunk: b"".join([words[word] for word in own]) for chunk, own in split.items()}
        self.trim(words, 0, new)
        return found

    def chunked(self, text: str) -> list[str]:
        """Chunks of a text: one begins at each blank behind another character, as words do. Other white space is left to the splitter."""
        if _BEFORE_BLANK.search(text):
            return _AT_BLANK.split(text)
        first, *rest = text.split(" ")
        return [first, *[" " + chunk for chunk in rest]]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        self.load()
        if len(self.pairs) > CACHED_PAIRS:
            for pair in list(islice(self.pairs, len(self.pairs) - CACHED_PAIRS // 2)):
                del self.pairs[pair]
        special = {text: array("i", [i]).tobytes() for text, i in self.special.items()}
        parts, wanted = [], set()
        for text in texts:
            row, at = [], 0
            for found in self.at_special.finditer(text) if self.at_special else ():
                row += [(False, self.chunked(text[at : found.start()])), (True, found[0])]
                at = found.end()
            row.append((False, self.chunked(text[at:])))
            wanted.update(*(own for is_special, own in row if not is_special))
            parts.append(row)
        chunks = self.chunks
        new = self.encode_chunks({chunk for chunk in wanted if chunk not in chunks})
        chunks.update(new)
        tokens = lambda row: b"".join([special[own] if is_special else b"".join([chunks[chunk] for chunk in own]) for is_special, own in row])
        out = [np.frombuffer(tokens(row), dtype=np.int32) for row in parts]
        self.trim(chunks, 1, new)
        return out

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of the tokens, which are text where the tokens are whole characters."""
        self.load()
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        at = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - lengths, lengths) + np.repeat(self.begins[ids], lengths)
        return self.bytes[at].tobytes()


def _lists(rows: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, rows)]).astype(np.int32)
    values = np.concatenate(rows) if rows else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values, pa.int32()))


def encode_decode(docs: DataFrame, tokenizer_path: str, decode: bool = True) -> DataFrame:
    """``docs`` (doc_id, text) to doc_id, ids and, with ``decode``, the text that these ids stand for."""
    spark = prepare(docs.sparkSession)
    shared = Shared(spark, Bpe(tokenizer_path))

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = shared.value
        for batch in batches:
            ids = bpe.encode([text or "" for text in batch.column("text").to_pylist()])
            columns, names = [batch.column("doc_id"), _lists(ids)], ["doc_id", "ids"]
            if decode:
                columns.append(pa.array([bpe.decode(row).decode("utf-8", "replace") for row in ids], pa.string()))
                names.append("decoded")
            yield pa.RecordBatch.from_arrays(columns, names)

    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, ids array<int>" + (", decoded string" if decode else "")
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def encoding_digests(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256."""
    return encode_decode(docs, tokenizer_path).select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        sha256(F.array_join(F.col("ids").cast("array<string>"), ",")).alias("ids_sha256"),
        sha256(F.col("decoded")).alias("decoded_sha256"),
    )
