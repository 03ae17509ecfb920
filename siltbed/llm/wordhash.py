"""Hashes of the words of a batch of texts, computed on whole byte buffers."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

# Odd multipliers of the hashes.
BASE = 0x9E3779B97F4A7C15 | 1
MIX_1, MIX_2 = 0xBF58476D1CE4E5B9, 0x94D049BB133111EB
# Bytes of text that are looked at together.
CHUNK = 1 << 19

# Letters and digits of ASCII and every byte of other letters.
_IN_WORD = np.zeros(256, bool)
_IN_WORD[128:] = True
for _c in b"0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ":
    _IN_WORD[_c] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit integers over all bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(MIX_1)
    x ^= x >> np.uint64(27)
    x *= np.uint64(MIX_2)
    x ^= x >> np.uint64(31)
    return x


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of BASE and of its inverse modulo 2**64."""
    inverse = pow(BASE, -1, 1 << 64)

    def run(base: int) -> np.ndarray:
        out = np.full(n, base, np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)

    return run(BASE), run(inverse)


class Chunk:
    """Words of a stretch of bytes that begins and ends between words."""

    def __init__(self, data: np.ndarray, breaks: np.ndarray):
        """``breaks``: places in ``data`` where a text begins."""
        inside = _IN_WORD[data]
        edge = np.empty(len(data) + 1, bool)
        edge[0], edge[-1] = inside[0], inside[-1]
        np.not_equal(inside[1:], inside[:-1], out=edge[1:-1])
        at = np.unique(breaks[(breaks > 0) & (breaks < len(data))])
        cut = at[inside[at] & inside[at - 1]]  # a word ends where its text ends
        places = np.flatnonzero(edge)
        if len(cut):
            places = np.sort(np.concatenate([places, cut, cut]))
        self.starts, self.ends = places[::2], places[1::2]
        power, self._inverse = _powers(max(CHUNK, 1 << (len(data) - 1).bit_length()))
        self._sums = np.empty(len(data) + 1, np.uint64)
        self._sums[0] = 0
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:len(data)], out=self._sums[1:])

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hashes of stretches of bytes; equal stretches have equal ones."""
        raw = (self._sums[ends] - self._sums[starts]) * self._inverse[starts]
        return mix(raw + (ends - starts).astype(np.uint64) * np.uint64(MIX_2))

    def words(self) -> np.ndarray:
        return self.hashes(self.starts, self.ends)


def buffer_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of an array of strings, and where each begins and the last ends."""
    texts = texts.cast(pa.large_string()) if not pa.types.is_large_string(texts.type) else texts
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    whole = np.frombuffer(data, np.uint8)[at[0]:at[-1]] if data is not None and len(at) else np.empty(0, np.uint8)
    return whole, at - at[0] if len(at) else np.zeros(1, np.int64)


def slices(batch: pa.RecordBatch, column: str, size: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of about ``size`` bytes of text (a longer text by itself)."""
    _, bounds = buffer_of(batch.column(column))
    at = 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(bounds, bounds[at] + size, side="right")) - 1)
        yield batch.slice(at, end - at)
        at = end


def chunks(data: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, Chunk]]:
    """The buffer in stretches that no word crosses, each with its place."""
    at, n = 0, len(data)
    while at < n:
        end = min(at + CHUNK, n)
        while end < n:
            # Back to the last byte outside a word, or on to the next.
            outside = np.flatnonzero(~_IN_WORD[data[max(at, end - 4096):end]])
            if len(outside):
                end = max(at, end - 4096) + int(outside[-1]) + 1
                break
            more = np.searchsorted(bounds, end)
            if bounds[more] == end:
                break
            end = min(end + 4096, n)
        first, last = np.searchsorted(bounds, [at, end])
        yield at, Chunk(data[at:end], bounds[first:last] - at)
        at = end


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word in order, and where each text's words begin (and the last end)."""
    data, bounds = buffer_of(texts)
    hashes, starts = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
    for at, chunk in chunks(data, bounds):
        hashes.append(chunk.words())
        starts.append(chunk.starts + at)
    return np.concatenate(hashes), np.searchsorted(np.concatenate(starts), bounds)


def combined(parts: list[np.ndarray]) -> np.ndarray:
    """One hash of several in their order."""
    out = np.zeros(len(parts[0]), np.uint64)
    for part in parts:
        out = mix(out * np.uint64(BASE) + part)
    return out


def shingles(words: np.ndarray, bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``size`` consecutive words and where each text's begin.

    A text of fewer words has one shingle of them all; a text without words has none.
    """
    counts = np.diff(bounds)
    made = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    out_bounds = np.concatenate([[0], np.cumsum(made)])
    padded = np.concatenate([words, np.zeros(size, np.uint64)])
    first = np.repeat(bounds[:-1] - out_bounds[:-1], made) + np.arange(out_bounds[-1])
    out = combined([padded[first + j] for j in range(size)])
    for k in np.flatnonzero((counts > 0) & (counts < size)):
        own = np.zeros((size, 1), np.uint64)
        own[:counts[k], 0] = words[bounds[k]:bounds[k + 1]]
        out[out_bounds[k]] = combined(list(own))[0]
    return out, out_bounds
