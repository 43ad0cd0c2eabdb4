"""Whole Arrow batches of texts as flat numpy arrays.

Helpers of the operators that read words, shingles or byte strings: a batch's
texts lie back to back in one byte array, words are (start, end) pairs into
it, and a string's 64-bit hash comes from polynomial prefix sums (mod 2^64),
so no Python object is made per word. Chunks of a batch are bounded by bytes
(one text is never split, so a single longer text makes a larger chunk).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text worked on at once.
CHUNK = 512 << 10

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_U64 = np.uint64

#: Bytes that separate words: space and 0x09-0x0D.
_SPACE = np.zeros(256, np.bool_)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True

#: A-Z to a-z, every other byte as it is.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser, elementwise."""
    x = x.astype(_U64, copy=True)
    x ^= x >> _U64(30)
    x *= _U64(0xBF58476D1CE4E5B9)
    x ^= x >> _U64(27)
    x *= _U64(0x94D049BB133111EB)
    x ^= x >> _U64(31)
    return x


#: A fixed 64-bit value for each byte.
_VALUE = mix(np.arange(1, 257, dtype=_U64) * _U64(0xD1342543DE82EF95))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i for i < n at least."""
    if not _powers or len(_powers["up"]) < n:
        size = max(n, CHUNK + 64)
        for name, step in (("up", _BASE), ("down", _INVERSE)):
            x = np.full(size, step, _U64)
            x[0] = 1
            _powers[name] = np.multiply.accumulate(x)
    return _powers["up"], _powers["down"]


def texts_of(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts back to back and the n + 1 offsets; a null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()) if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_large_binary(column.type) else "")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if len(column) == 0 or offsets[-1] == offsets[0]:
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def chunks(offsets: np.ndarray, most: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Row ranges whose texts hold at most ``most`` bytes (or one row)."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def prefix(data: np.ndarray) -> np.ndarray:
    """Polynomial prefix sums of a byte array, one longer than it."""
    up, _ = _power(len(data) + 1)
    out = np.zeros(len(data) + 1, _U64)
    np.cumsum(_VALUE[data] * up[: len(data)], out=out[1:])
    return out


def hashes(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte string [start, end)."""
    _, down = _power(len(sums))
    return mix((sums[end] - sums[start]) * down[start] + (end - start).astype(_U64) * _U64(0x2545F4914F6CDD1D))


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and each text's first word (n + 1 long).

    A word is a run of bytes other than 0x20 and 0x09-0x0D inside one text.
    """
    solid = ~_SPACE[data]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    last = solid.copy()
    last[:-1] &= ~solid[1:]
    inner = offsets[1:-1]
    inner = inner[(inner > 0) & (inner < len(data))]
    first[inner] = solid[inner]  # a text's end also ends a word
    last[inner - 1] = solid[inner - 1]
    start = np.flatnonzero(first)
    return start, np.flatnonzero(last) + 1, np.searchsorted(start, offsets)


def shingles(word: np.ndarray, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every run of ``size`` words, and each text's first (n + 1).

    A text with fewer words, but at least one, has its whole word sequence as
    its only shingle; a text without words has none.
    """
    count = np.diff(at)
    many = np.where(count >= size, count - size + 1, (count > 0).astype(count.dtype))
    first = np.concatenate(([0], np.cumsum(many)))
    owner = np.repeat(np.arange(len(count)), many)
    begin = at[owner] + (np.arange(first[-1]) - first[owner])
    length = np.minimum(count[owner], size)
    out = length.astype(_U64) * _U64(0xA0761D6478BD642F)
    for k in range(size):
        here = k < length
        x = np.zeros(len(begin), _U64)
        x[here] = word[begin[here] + k]
        out = mix(out * _U64(0xE7037ED1A0B428DB) + x) if k else mix(out + x)
    return out, first


def ragged(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """start[0], start[0]+1, ... (count[0] of them), start[1], ... as one array."""
    total = int(count.sum())
    if total == 0:
        return np.empty(0, np.int64)
    ends = np.cumsum(count)
    return np.repeat(start - (ends - count), count) + np.arange(total)
