"""Words of many texts at once: cut and hashed by array operations over their UTF-8 bytes.

All separators are ASCII, so cutting bytes is the same as cutting code points.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes handled at once; a longer text is cut at a separator.
PIECE = 1 << 21
_BASE = np.uint64(0x9E3779B97F4A7C15)


def byte_set(*ranges: tuple[int, int]) -> np.ndarray:
    """True for the bytes in the (inclusive) ranges."""
    found = np.zeros(256, dtype=bool)
    for first, last in ranges:
        found[first : last + 1] = True
    return found


#: The separators of the three ways of cutting words.
BLANKS = byte_set((0x20, 0x20), (0x09, 0x0D))
NOT_ALPHANUMERIC = byte_set((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))


def folding() -> np.ndarray:
    """Bytes with A-Z in lower case."""
    table = np.arange(256, dtype=np.uint8)
    table[0x41:0x5B] += 0x20
    return table


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of a 64-bit hash (splitmix)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def spread(keys: np.ndarray) -> np.ndarray:
    return mix(keys.astype(np.uint64) * _BASE + np.uint64(1))


@dataclass
class Words:
    """Words of a batch of texts, in order."""

    data: np.ndarray  # the bytes, folded where asked for
    start: np.ndarray  # byte positions in data
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray  # of text i the words first[i] to first[i + 1] - 1

    @property
    def owner(self) -> np.ndarray:
        """Number of the text of each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def text(self, i: int) -> str:
        return self.data[self.start[i] : self.end[i]].tobytes().decode()


def cut(texts: pa.Array, separators: np.ndarray, fold: bool = False) -> Words:
    """The words of each text; null has none."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts, "")
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    offsets = np.frombuffer(texts.buffers()[1], dtype=kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8)[offsets[0] : offsets[-1]] if raw is not None else np.zeros(0, np.uint8)
    bounds = offsets - offsets[0]
    if fold:
        data = folding()[data]
    inside = ~separators[data]
    before = np.empty_like(inside)
    before[:1], before[1:] = False, inside[:-1]
    before[bounds[:-1][bounds[:-1] < len(data)]] = False
    start = np.flatnonzero(inside & ~before)
    after = np.empty_like(inside)
    after[-1:], after[:-1] = False, inside[1:]
    after[bounds[1:][bounds[1:] > 0] - 1] = False
    end = np.flatnonzero(inside & ~after) + 1
    return Words(data, start, end, _hashes(data, start, end), np.searchsorted(start, bounds))


def _hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each word: its lanes of 8 bytes, each mixed with its place, are summed up and mixed with the length."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    lane_at = np.ndarray(len(data) + 1, "<u8", padded, 0, (1,))  # the 8 bytes from each byte on
    out = np.empty(len(start), dtype=np.uint64)
    done = 0
    while done < len(start):
        stop = max(done + 1, int(np.searchsorted(end, start[done] + PIECE, side="right")))
        size = end[done:stop] - start[done:stop]
        lanes = (size + 7) >> 3
        until = np.cumsum(lanes)
        place = np.arange(until[-1]) - np.repeat(until - lanes, lanes)
        at = np.repeat(start[done:stop], lanes) + 8 * place
        spare = 8 * np.maximum(8 + at - np.repeat(end[done:stop], lanes), 0).astype(np.uint64)  # bits behind the word
        value = lane_at[at] & (np.uint64(0xFFFFFFFFFFFFFFFF) >> spare)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(value ^ spread(place)))])
        out[done:stop] = mix(sums[until] - sums[until - lanes] + size.astype(np.uint64) * _BASE)
        done = stop
    return out


def runs(hashes: np.ndarray, length: int) -> np.ndarray:
    """Hash of the ``length`` values from each position on; there are length - 1 fewer than values."""
    count = max(0, len(hashes) - length + 1)
    out = np.zeros(count, dtype=np.uint64)
    for i in range(length):
        out = mix(out * _BASE + hashes[i : i + count])
    return out


def inside_one(first: np.ndarray, length: int, count: int) -> np.ndarray:
    """Whether the run of ``length`` words from each of ``count`` positions on lies in one text."""
    last = np.repeat(first[1:], np.diff(first))[:count]
    return np.arange(count) + length <= last


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` successive values, by doubling."""
    span, out = 1, values
    while span * 2 <= width:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    rest = width - span
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out
