"""Words of whole texts as numpy arrays, read from Arrow buffers without a Python object a word.

A word is a maximal run of bytes other than ``\\x20`` and ``\\x09-\\x0D``. In UTF-8 those bytes never
occur inside another character, so bytes and characters give the same words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

WHITE = np.zeros(256, bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
BLOCK_BYTES = 1 << 18
LONG_WORD = 64
_TABLE = np.random.default_rng(20240229).integers(0, 2**64, LONG_WORD * 256, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit integers."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def bounds(
    data: np.ndarray, cuts: np.ndarray | None = None, white: np.ndarray = WHITE
) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end of every word; ``cuts`` are positions where another text begins."""
    return edges(~white[data], cuts)


def edges(inside: np.ndarray, cuts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end of every run of marked bytes; ``cuts`` are positions where another text begins."""
    if not len(inside):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    if cuts is not None:
        cuts = cuts[cuts < len(inside)]
        first[cuts] = inside[cuts]
        last[cuts[cuts > 0] - 1] = inside[cuts[cuts > 0] - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of every word; it depends on the word's bytes alone."""
    out = np.zeros(len(starts), np.uint64)
    lengths = ends - starts
    filled = np.cumsum(lengths)
    at = 0
    while at < len(starts):
        base = filled[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(filled, base + BLOCK_BYTES, "right")))
        out[at:stop] = _hash_block(data, starts[at:stop], lengths[at:stop])
        at = stop
    return out


def _hash_block(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    long = np.flatnonzero(lengths > LONG_WORD)
    size = np.minimum(lengths, LONG_WORD)
    begin = np.cumsum(size) - size
    place = np.arange(int(size.sum())) - np.repeat(begin, size)
    letters = data[np.repeat(starts, size) + place]
    out = np.add.reduceat(_TABLE[place * 256 + letters], begin)
    out = mix(out + size.astype(np.uint64))
    for i in long:
        word = data[starts[i]:starts[i] + lengths[i]].tobytes()
        out[i] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
    return out


def pairs(h: np.ndarray) -> np.ndarray:
    """Hash of every two neighbouring words."""
    return run_hashes(h, 2)


def run_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of every ``n`` consecutive words; empty if there are fewer."""
    if len(h) < n:
        return np.zeros(0, np.uint64)
    out = mix(h[:len(h) - n + 1] + np.uint64(n))
    for i in range(1, n):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + h[i:len(h) - n + 1 + i])
    return out


def coded(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """A number for every word, the same for equal words alone, and the word of each number.

    The stretches between words have numbers too.
    """
    cuts = np.empty(2 * len(starts) + 1, np.int64)
    cuts[:-1:2], cuts[1::2], cuts[-1] = starts, ends, len(data)
    spans = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), 2 * len(starts), [None, pa.py_buffer(cuts), pa.py_buffer(np.ascontiguousarray(data))])
    codes = spans.dictionary_encode()
    return codes.indices.to_numpy()[::2].astype(np.int64), codes.dictionary


def identities(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A number for every word, the same for equal words alone."""
    return coded(data, starts, ends)[0]


def joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> bytes:
    """The given words with single spaces between."""
    if not len(starts):
        return b""
    if (starts[1:] - ends[:-1] == 1).all() and (data[ends[:-1]] == 32).all():
        return data[starts[0]:ends[-1]].tobytes()
    text = data.tobytes()
    return b" ".join([text[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)])


def record(names: list[str], columns: list[list], types: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and where each row begins; a null has no bytes."""
    column = column.fill_null("")
    large = pa.types.is_large_string(column.type)
    kind = np.int64 if large else np.int32
    _, where, text = column.buffers()
    offsets = np.frombuffer(where, kind, len(column) + 1, column.offset * kind().itemsize)
    data = np.frombuffer(text, np.uint8) if text is not None else np.zeros(0, np.uint8)
    return data, offsets.astype(np.int64)


def blocks(column: pa.Array, size: int = BLOCK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Consecutive rows of about ``size`` bytes: number of the first row, their bytes, row offsets."""
    if not len(column):
        return
    data, offsets = buffers(column)
    row = 0
    while row < len(offsets) - 1:
        stop = int(np.searchsorted(offsets, offsets[row] + size, "right")) - 1
        stop = min(max(stop, row + 1), len(offsets) - 1)
        yield row, data[offsets[row]:offsets[stop]], offsets[row:stop + 1] - offsets[row]
        row = stop


def word_rows(
    column: pa.Array, lower: bool = False, white: np.ndarray = WHITE
) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Of each text: row, its bytes, word starts and ends in them, word hashes.

    ``lower`` turns A-Z into a-z first and leaves every other character as it is. ``white`` marks
    the bytes between words, where other words than those of the module are asked for.
    """
    for first, data, offsets in blocks(column):
        data = LOWER[data] if lower else data
        starts, ends = bounds(data, offsets[:-1], white)
        h = hashes(data, starts, ends)
        owner = np.searchsorted(starts, offsets)
        for i in range(len(offsets) - 1):
            a, b = owner[i], owner[i + 1]
            base = offsets[i]
            yield first + i, data[base:offsets[i + 1]], starts[a:b] - base, ends[a:b] - base, h[a:b]
