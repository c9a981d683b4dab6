"""Words and shingles of whole texts as 64-bit hashes, many texts at once.

A word is a run of bytes other than space and the five control characters from tab to carriage
return; A-Z count as a-z. All work is on the bytes of an Arrow column.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20
FACTOR = np.uint64(0x9E3779B97F4A7C15 | 1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def powers(count: int) -> np.ndarray:
    out = np.full(max(count, 1), FACTOR, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out)


def buffers(texts: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and the offsets of each, without a copy."""
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    if len(texts) == 0:
        return raw[:0], np.zeros(1, np.int64)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def spaces(raw: np.ndarray) -> np.ndarray:
    return (raw == 32) | ((raw >= 9) & (raw <= 13))


def blocks(raw: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Borders of blocks that cut no word; a block has one megabyte unless a word is longer."""
    start, end = 0, len(raw)
    while start < end:
        stop = min(start + BLOCK_BYTES, end)
        while stop < end:
            # the next place from which a word cannot be running on: a space, or the first byte of a text
            found = np.flatnonzero(spaces(raw[stop : stop + BLOCK_BYTES]))
            border = offsets[np.searchsorted(offsets, stop)]
            at = stop + found[0] if len(found) else min(stop + BLOCK_BYTES, end)
            if border <= at:
                stop = int(border)
                break
            stop = int(at)
            if len(found):
                break
        yield start, stop
        start = stop


class Words(NamedTuple):
    hashes: np.ndarray  # of each word
    first: np.ndarray  # of each text and one more: the number of words before it
    starts: np.ndarray  # of each word: its first byte, from the first byte of the first text
    ends: np.ndarray


def words(texts: pa.LargeStringArray) -> Words:
    raw, offsets = buffers(texts)
    hashes, starts, ends = [], [], []
    for low, high in blocks(raw, offsets):
        part = raw[low:high]
        inside = ~spaces(part)
        begins = np.zeros(len(part), bool)
        inner = offsets[np.searchsorted(offsets, low) : np.searchsorted(offsets, high)] - low
        begins[inner] = True
        begins[0] = True
        before = np.concatenate(([False], inside[:-1]))
        s = np.flatnonzero(inside & (begins | ~before))
        after = np.concatenate((~inside[1:] | begins[1:], [True]))
        e = np.flatnonzero(inside & after) + 1
        if not len(s):
            continue
        lower = part.astype(np.uint64)
        lower += np.where((part >= 65) & (part <= 90), np.uint64(33), np.uint64(1))
        place = np.arange(len(part))
        last = np.zeros(len(part), np.int64)
        last[s] = s
        place -= np.maximum.accumulate(last)
        lower *= powers(int((e - s).max()) + 1)[np.minimum(place, (e - s).max())]
        lower[~inside] = 0
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(lower, dtype=np.uint64)))
        hashes.append(mix(total[e] - total[s] + (e - s).astype(np.uint64)))
        starts.append(s + low)
        ends.append(e + low)
    h = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    s = np.concatenate(starts) if starts else np.zeros(0, np.int64)
    e = np.concatenate(ends) if ends else np.zeros(0, np.int64)
    return Words(h, np.searchsorted(s, offsets), s, e)


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """One hash per run of ``size`` words of one text; of fewer words, one for all of them."""
    if len(hashes) == 0:
        return hashes
    short = len(hashes) < size
    width = len(hashes) if short else size
    out = np.zeros(len(hashes) - width + 1, np.uint64)
    for k in range(width):
        out = (out + hashes[k : k + len(out)]) * np.uint64(0xC2B2AE3D27D4EB4F)
    return mix(out + np.uint64(width if short else 0))
