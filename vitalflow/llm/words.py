"""Hashes of words and shingles, computed on whole buffers of text.

A word's hash is a difference of prefix sums of bytes times powers of an odd number, modulo 2**64;
dividing by the power at the word's start (which has an inverse) makes it the same at any place.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_BASE = 0x9E3779B97F4A7C15 | 1
_STEP = 0xD1B54A32D192ED03 | 1
_POWERS: dict[str, np.ndarray] = {}
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_WORD = np.ones(256, dtype=bool)
_IS_WORD[[32, 9, 10, 11, 12, 13]] = False
#: Bytes of text worked on at once; a longer document is worked on alone.
CHUNK = 1 << 19


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) < n:
        size = max(n, CHUNK + 1)
        for name, factor in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, factor, dtype=np.uint64)
            steps[0] = 1
            _POWERS[name] = np.cumprod(steps, dtype=np.uint64)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def scrambled(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers after which all bits depend on all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column without nulls, and the offsets of its rows."""
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=kind)[column.offset : column.offset + len(column) + 1]
    if data is None:
        return np.zeros(0, dtype=np.uint8), at.astype(np.int64)
    return np.frombuffer(data, dtype=np.uint8), at.astype(np.int64)


def chunks(
    column: pa.Array, size: int = CHUNK
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, offsets from 0) of stretches of about `size` bytes."""
    data, offsets = buffers(column)
    row, rows = 0, len(column)
    while row < rows:
        end = int(np.searchsorted(offsets, offsets[row] + size, side="right")) - 1
        end = min(max(end, row + 1), rows)
        yield row, end, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def _runs(
    data: np.ndarray, offsets: np.ndarray, inside: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of marked bytes start and end; no run crosses a document's bounds."""
    n = len(data)
    before = np.zeros(n + 1, dtype=bool)
    before[1:] = inside
    starts = inside & ~before[:-1]
    begins = offsets[:-1][offsets[:-1] < n]
    starts[begins] = inside[begins]
    ends = inside.copy()
    ends[: n - 1] &= ~inside[1:]
    closes = offsets[1:][offsets[1:] > 0] - 1
    ends[closes] = inside[closes]
    return np.flatnonzero(starts), np.flatnonzero(ends) + 1


def _sums(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums of bytes times powers, and the inverse powers."""
    up, down = _power_tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    return sums, down


def words(data: np.ndarray, offsets: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all words, first word of each document and the end) of one chunk."""
    if lower:
        data = _LOWER[data]
    starts, ends = _runs(data, offsets, _IS_WORD[data])
    sums, down = _sums(data)
    hashes = scrambled((sums[ends] - sums[starts]) * down[starts])
    return hashes, np.searchsorted(starts, offsets)


def word_beginnings(
    data: np.ndarray, offsets: np.ndarray, marked: np.ndarray, lengths: tuple[int, ...]
) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, as runs of `marked` bytes in lower case, and of their first bytes.

    A word longer than one of `lengths` also has the hash of so many bytes, told apart from a whole
    word's. With the first of each document and the end.
    """
    data = _LOWER[data]
    starts, ends = _runs(data, offsets, marked[data])
    sums, down = _sums(data)
    hashes = [scrambled((sums[ends] - sums[starts]) * down[starts])]
    of = [starts]
    for k in lengths:
        long = starts[ends - starts > k]
        cut = scrambled((sums[long + k] - sums[long]) * down[long] + np.uint64(k))
        hashes.append(scrambled(cut))
        of.append(long)
    place = np.concatenate(of)
    order = np.argsort(place, kind="stable")
    return np.concatenate(hashes)[order], np.searchsorted(place[order], offsets)


def shingles(hashes: np.ndarray, bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(distinct shingle hashes, sorted per document; first one of each document and the end).

    A document with fewer words than `size` has all its words as its one shingle.
    """
    if not len(hashes):
        return hashes, np.zeros(len(bounds), dtype=np.int64)
    counts = np.diff(bounds)
    padded = np.concatenate([hashes, np.zeros(size, dtype=np.uint64)])
    mixed = np.zeros(len(hashes), dtype=np.uint64)
    for k in range(size):
        mixed = mixed * np.uint64(_STEP) + padded[k : k + len(hashes)]
    mixed = scrambled(mixed)
    out, sizes = [], np.zeros(len(counts), dtype=np.int64)
    for i, (at, count) in enumerate(zip(bounds[:-1].tolist(), counts.tolist(), strict=True)):
        if count >= size:
            own = np.unique(mixed[at : at + count - size + 1])
        elif count:
            whole = np.uint64(count)
            for h in hashes[at : at + count]:
                whole = np.uint64((int(whole) * _STEP + int(h)) & 0xFFFFFFFFFFFFFFFF)
            own = scrambled(np.array([whole], dtype=np.uint64))
        else:
            continue
        out.append(own)
        sizes[i] = len(own)
    return np.concatenate(out), np.concatenate([[0], np.cumsum(sizes)])
