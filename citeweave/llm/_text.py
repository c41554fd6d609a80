"""Vectorised word tables over Arrow string columns.

The corpus operators see a text as UTF-8 bytes.  A chunk of consecutive texts (about half a megabyte, or one longer
text) is cut into words with numpy, every word gets a 64-bit hash, and n-gram hashes are built from word hashes by
doubling, so no Python object is made per word.  A null text has no words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 19
_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
_INVERSE = _U(pow(int(_BASE), -1, 1 << 64))


def byte_set(*ranges: tuple[int, int]) -> np.ndarray:
    """A table of 256 booleans that is true in the given inclusive ranges."""
    table = np.zeros(256, bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


#: Bytes that separate the words ``[^\x20\x09-\x0D]+``.
SPACES = byte_set((0x20, 0x20), (0x09, 0x0D))
#: Bytes that separate the words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` of lower-cased text.
NON_ALNUM = byte_set((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))
#: Lower-cases the letters A-Z and nothing else.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> _U(32))
    x *= _U(0xD6E8FEB86659FD93)
    x ^= x >> _U(32)
    x *= _U(0xD6E8FEB86659FD93)
    x ^= x >> _U(32)
    return x


_BYTE_CODES = mix(np.arange(1, 257, dtype=np.uint64) * _BASE)
_POWERS = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if n > CHUNK_BYTES + 4096:  # a text longer than a chunk; its table is not kept
        return _powers_of(_BASE, n), _powers_of(_INVERSE, n)
    if len(_POWERS["up"]) < n:
        _POWERS["up"], _POWERS["down"] = _powers_of(_BASE, CHUNK_BYTES + 4096), _powers_of(_INVERSE, CHUNK_BYTES + 4096)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def _powers_of(base: np.uint64, n: int) -> np.ndarray:
    steps = np.full(n, base)
    steps[0] = 1
    return np.multiply.accumulate(steps)


@dataclass
class Words:
    """The words of consecutive texts ``first .. first + n_docs - 1`` of a batch."""

    first: int
    data: np.ndarray  # bytes of the chunk, lower-cased if asked for
    doc_at: np.ndarray  # byte offset of each text, and the end
    start: np.ndarray  # byte offset of each word
    end: np.ndarray
    word_at: np.ndarray  # index of each text's first word, and the end
    code: np.ndarray  # 64-bit hash of each word
    running: np.ndarray  # running hash over all bytes, for hashes of other spans

    @property
    def n_docs(self) -> int:
        return len(self.doc_at) - 1

    @property
    def count(self) -> np.ndarray:
        return np.diff(self.word_at)

    def doc_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(self.n_docs), self.count)

    def room(self) -> np.ndarray:
        """For each word, how many words its text has from there on."""
        return np.repeat(self.word_at[1:], self.count) - np.arange(len(self.code))

    def span_hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return span_hash(self.running, start, end)

    def grams(self, n: int) -> np.ndarray:
        """The hash of the n words from each word on; the last n-1 values of a text reach beyond it."""
        return grams(self.code, n)


def span_hash(running: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    _, down = _powers(len(running))
    return mix((running[end] - running[start]) * down[start] + (end - start).astype(np.uint64))


def grams(code: np.ndarray, n: int) -> np.ndarray:
    size = len(code)
    done, width, power, at = None, 0, code, 1
    while True:
        if n & at:
            if done is None:
                done = power.copy()
            else:
                done = _joined(done, power, width)
            width += at
        at *= 2
        if at > n:
            return done if size else code
        power = _joined(power, power, at // 2)


def _joined(left: np.ndarray, right: np.ndarray, shift: int) -> np.ndarray:
    out = left * _BASE
    out ^= out >> _U(29)
    if shift < len(right):
        out[: len(right) - shift] += right[shift:]
    return mix(out)


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (one more than rows) and bytes of a string column; nulls get no bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type):
        width = np.int64
    else:
        width = np.int32
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    at = np.frombuffer(offsets, width)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return at, np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)


def chunks(at: np.ndarray, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges of about ``size`` bytes; a longer text is a range of its own."""
    i, n = 0, len(at) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(at, at[i] + size, side="right")) - 1)
        j = min(j, i + 20_000, n)
        yield i, j
        i = j


def word_tables(column: pa.Array, separators: np.ndarray = SPACES, lower: bool = False, size: int = CHUNK_BYTES) -> Iterator[Words]:
    at, data = text_buffers(column)
    for i, j in chunks(at, size):
        part = data[at[i] : at[j]]
        yield words_of(LOWER[part] if lower else part, at[i : j + 1] - at[i], i, separators)


def words_of(data: np.ndarray, doc_at: np.ndarray, first: int, separators: np.ndarray) -> Words:
    n = len(data)
    inside = np.zeros(n + 2, bool)
    inside[1:-1] = ~separators[data]
    starts = inside[1:-1] & ~inside[:-2]
    ends = inside[1:-1] & ~inside[2:]
    edges = doc_at[1:-1][(doc_at[1:-1] > 0) & (doc_at[1:-1] < n)]
    starts[edges] = inside[1:-1][edges]
    ends[edges - 1] = inside[1:-1][edges - 1]
    start, end = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    up, down = _powers(n + 1)
    running = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE_CODES[data] * up[:n], out=running[1:])
    code = mix((running[end] - running[start]) * down[start] + (end - start).astype(np.uint64))
    return Words(first, data, doc_at, start, end, np.searchsorted(start, doc_at), code, running)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` consecutive values; as many results as there are full windows."""
    done, have = values, 1
    while have * 2 <= width:
        done = np.minimum(done[: len(done) - have], done[have:])
        have *= 2
    if have < width:
        done = np.minimum(done[: len(done) - (width - have)], done[width - have :])
    return done


def sums_by_doc(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The sum of ``flags`` within each range of ``at``."""
    running = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=running[1:])
    return np.diff(running[at])
