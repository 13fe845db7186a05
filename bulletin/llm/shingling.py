"""Word shingle multisets of whole batches of texts, as arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
_RANDOM = np.random.default_rng(20240607)
#: A random 64-bit value per byte; A-Z share those of a-z.
BYTES = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) * U64(2) + U64(1)
BYTES[65:91] = BYTES[97:123]
SPACES = np.zeros(256, bool)
SPACES[[9, 10, 11, 12, 13, 32]] = True
MIX1, MIX2, BASE = U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB), U64(0x9E3779B97F4A7C15)
#: One factor per place in a shingle.
PLACES = _RANDOM.integers(1, 2**63, 64, dtype=np.uint64) * U64(2) + U64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scramble of 64-bit numbers."""
    x = (x ^ (x >> U64(30))) * MIX1
    x = (x ^ (x >> U64(27))) * MIX2
    return x ^ (x >> U64(31))


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the offsets of its values; nulls are empty."""
    column = column.cast(pa.large_string()).fill_null("")
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.large_string())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def parts(offsets: np.ndarray, weight: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of values of about `weight` bytes, one value at least."""
    lo = 0
    while lo < len(offsets) - 1:
        hi = max(int(np.searchsorted(offsets, offsets[lo] + weight, "right")) - 1, lo + 1)
        yield lo, hi
        lo = hi


def word_hashes(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order and the text that each belongs to."""
    inside = ~SPACES[raw]
    begin = inside.copy()
    begin[1:] &= ~inside[:-1]
    firsts = offsets[:-1][offsets[:-1] < offsets[1:]]
    begin[firsts] = inside[firsts]
    starts = np.flatnonzero(begin)
    end = inside.copy()
    end[:-1] &= ~inside[1:]
    end[firsts[firsts > 0] - 1] = inside[firsts[firsts > 0] - 1]
    ends = np.flatnonzero(end) + 1
    powers = np.cumprod(np.full(len(raw) + 1, BASE, np.uint64)) if len(raw) else np.ones(1, np.uint64)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(BYTES[raw] * powers[:-1], out=sums[1:])
    # The difference of prefix sums, taken back to the word's start by the inverse power.
    inverse = np.cumprod(np.full(len(raw) + 1, U64(pow(int(BASE), -1, 2**64)), np.uint64)) if len(raw) else powers
    hashes = mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))
    return hashes, np.searchsorted(offsets, starts, "right") - 1


def shingle_bags(column: pa.Array, size: int = 5) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """For ranges of texts: (first, last, text of each distinct shingle counted from first, hash, times), in order.

    Words are separated by ASCII white space and A-Z equal a-z. A text of fewer words than
    `size` is one shingle of all its words, one without words has none.
    """
    raw, offsets = buffers(column)
    for lo, hi in parts(offsets):
        own = offsets[lo : hi + 1] - offsets[lo]
        words, text = word_hashes(raw[offsets[lo] : offsets[hi]], own)
        counts = np.bincount(text, minlength=hi - lo)
        n = len(words) - size + 1
        if n > 0:
            keep = text[:n] == text[size - 1 :]
            value = sum(words[k : n + k] * PLACES[k] for k in range(size))[keep]
            owner = text[:n][keep]
        else:
            value, owner = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        short = np.flatnonzero((counts > 0) & (counts < size))
        if len(short):
            first = (np.cumsum(counts) - counts)[short]
            extra = [sum(int(words[f + k]) * int(PLACES[k]) for k in range(c)) + c for f, c in zip(first.tolist(), counts[short].tolist(), strict=True)]
            value = np.concatenate([value, np.array([x & (2**64 - 1) for x in extra], np.uint64)])
            owner = np.concatenate([owner, short])
        value = mix(value)
        # Equal values are alike, so only the second sort has to keep the order of the first; numpy sorts small numbers by radix.
        order = np.argsort(value)
        order = order[np.argsort(owner[order].astype(np.min_scalar_type(hi - lo)), kind="stable")]
        value, owner = value[order], owner[order]
        new = np.ones(len(value), bool)
        new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
        at = np.flatnonzero(new)
        yield lo, hi, owner[at], value[at], np.diff(np.append(at, len(value)))
