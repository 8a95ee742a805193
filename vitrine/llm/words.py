"""Whole texts as arrays of 64-bit word hashes, one vectorised pass over the bytes of an Arrow column.

Words are maximal runs of bytes other than space and 0x09-0x0D, with A-Z lower-cased; every other byte counts as it
is, so the rule is safe for UTF-8.  Words and shingles are compared by 64-bit hashes (chance of any collision among
10^9 distinct shingles in one comparison set: about 3 %, among 10^6: 3e-8).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
#: Bytes handled at once; a longer text is handled alone.
CHUNK_BYTES = 1 << 21
#: Words longer than this many bytes are hashed by BLAKE2b instead of eight bytes at a time.
LONG_WORD = 1024

_SEPARATOR = np.zeros(256, dtype=bool)
_SEPARATOR[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_MASKS = np.array([(1 << (8 * k)) - 1 for k in range(9)], dtype=U64)
_SEED = U64(0x9E3779B97F4A7C15)


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (two xor-shift-multiply rounds)."""
    h = h ^ (h >> U64(33))
    h = h * U64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> U64(33))
    h = h * U64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> U64(33))


def string_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column without copying the texts; a null text is empty."""
    column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return raw, off


def chunks(column: pa.Array, limit: int = CHUNK_BYTES,
           max_rows: int = 1 << 16) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of whole texts of about ``limit`` bytes, ``max_rows`` at most."""
    raw, off = string_buffers(column)
    row, n = 0, len(off) - 1
    while row < n:
        end = max(row + 1, int(np.searchsorted(off, off[row] + limit, side="right")) - 1)
        end = min(end, n, row + max_rows)
        yield row, end, raw[off[row]:off[end]], off[row:end + 1] - off[row]
        row = end


def _hash_ranges(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    padded = np.zeros(len(data) + 8, dtype=np.uint8)
    padded[:len(data)] = data
    eight = np.ndarray(shape=(len(data) + 1,), dtype="<u8", buffer=padded, strides=(1,))
    h = lengths.astype(U64) * _SEED
    h = mix(h ^ (eight[starts] & _MASKS[np.minimum(lengths, 8)]))
    giant = np.flatnonzero(lengths > LONG_WORD)
    live = np.flatnonzero((lengths > 8) & (lengths <= LONG_WORD))
    at = 8
    while live.size:
        left = lengths[live] - at
        h[live] = mix(h[live] * _SEED ^ (eight[starts[live] + at] & _MASKS[np.minimum(left, 8)]))
        at += 8
        live = live[left > 8]
    for i in giant:
        word = data[starts[i]:starts[i] + lengths[i]].tobytes()
        h[i] = U64(int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little"))
    return h


def separators(data: np.ndarray) -> np.ndarray:
    """Which bytes are space or 0x09-0x0D."""
    return _SEPARATOR[data]


def range_hashes(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Hashes of stretches of bytes, which count as they are."""
    return _hash_ranges(data, starts, lengths)


def word_edges(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start bytes, end bytes) of the words of consecutive texts."""
    if len(data) == 0:
        empty = np.zeros(0, dtype=np.int64)
        return empty, empty
    inside = ~_SEPARATOR[data]
    begin = inside.copy()
    begin[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    full = offsets[1:] > offsets[:-1]
    first_byte, last_byte = offsets[:-1][full], offsets[1:][full] - 1
    begin[first_byte] = inside[first_byte]
    last[last_byte] = inside[last_byte]
    return np.flatnonzero(begin), np.flatnonzero(last) + 1


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, start bytes, end bytes, word offsets per text) of consecutive texts."""
    starts, ends = word_edges(data, offsets)
    return _hash_ranges(_LOWER[data], starts, ends - starts), starts, ends, np.searchsorted(starts, offsets)


def exact_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, word offsets per text) of consecutive texts, where A-Z count as they are."""
    starts, ends = word_edges(data, offsets)
    return range_hashes(data, starts, ends - starts), np.searchsorted(starts, offsets)


def shingle_hashes(hashes: np.ndarray, word_offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes of all runs of ``size`` words inside one text, index of their first word, offsets per text)."""
    counts = np.maximum(np.diff(word_offsets) - size + 1, 0)
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
    m = len(hashes) - size + 1
    if m <= 0 or offsets[-1] == 0:
        return np.zeros(0, dtype=U64), np.zeros(0, dtype=np.int64), offsets
    h = np.full(m, U64(size * int(_SEED) & 0xFFFFFFFFFFFFFFFF))
    for j in range(size):
        h = (h ^ hashes[j:m + j]) * U64(0xFF51AFD7ED558CCD)
        h ^= h >> U64(32)
    first = np.repeat(word_offsets[:-1] - offsets[:-1], counts) + np.arange(offsets[-1])
    return mix(h[first]), first, offsets


def text_shingle_sets(column: pa.Array, size: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes per text; a shorter text's whole word sequence is one shingle, no words: empty."""
    for first, end, data, offsets in chunks(column):
        hashes, _, _, word_offsets = words(data, offsets)
        shingles, _, at = shingle_hashes(hashes, word_offsets, size)
        for i in range(end - first):
            if at[i + 1] > at[i]:
                yield np.unique(shingles[at[i]:at[i + 1]])
            elif word_offsets[i + 1] > word_offsets[i]:
                own = hashes[word_offsets[i]:word_offsets[i + 1]]
                yield shingle_hashes(own, np.array([0, len(own)]), len(own))[0]
            else:
                yield np.zeros(0, dtype=U64)
