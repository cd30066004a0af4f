"""Word and shingle hashes of many texts at once, on UTF-8 bytes in numpy.

A word is a run of ASCII letters and digits and of bytes beyond ASCII; ASCII letters count in lower
case, all other ASCII characters separate.  A shingle is ``SIZE`` successive words of one text; a text with fewer
words (but one at least) has one shingle of all of them.  Hashes depend on the words alone, so they agree
between workers and runs.  Bytes are worked on in slabs, so scratch memory does not grow with a batch or a text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

SIZE = 5
SLAB = 1 << 17
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))

REDUCE = np.zeros(256, np.uint8)
REDUCE[48:58] = np.arange(48, 58)
REDUCE[97:123] = np.arange(97, 123)
REDUCE[65:91] = np.arange(97, 123)
REDUCE[128:] = np.arange(128, 256)
BYTE = np.random.default_rng(11).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
PLACE = np.random.default_rng(12).integers(0, 1 << 63, SIZE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

_POWERS: list[np.ndarray] = []


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit scrambling (multiply and shift)."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def powers(n: int) -> list[np.ndarray]:
    """Powers of BASE and of its inverse modulo 2**64, at least n of them."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, 2 * SLAB)
        _POWERS[:] = [np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(size - 1, b, np.uint64)]))
                      for b in (BASE, INVERSE)]
    return _POWERS


def word_hashes(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word in ``data`` (uint8) and the first word of each text, with the end appended.

    Text k is data[bounds[k]:bounds[k + 1]].
    """
    hashes, firsts, done = [], np.zeros(len(bounds), np.int64), 0
    lo, end = int(bounds[0]), int(bounds[-1])
    while lo < end:
        hi = min(lo + SLAB, end)
        while hi < end and REDUCE[data[hi]]:          # a slab ends where no word goes on
            hi += 1
        norm = REDUCE[data[lo:hi]]
        inside = norm != 0
        k0, k1 = np.searchsorted(bounds, lo, "left"), np.searchsorted(bounds, hi, "left")
        cuts = bounds[k0:k1] - lo                     # texts that begin in this slab
        cuts = cuts[cuts < len(norm)]
        begin, stop = inside.copy(), inside.copy()
        begin[1:] &= ~inside[:-1]
        stop[:-1] &= ~inside[1:]
        begin[cuts] = inside[cuts]
        inner = cuts[cuts > 0] - 1
        stop[inner] = inside[inner]
        starts, stops = np.flatnonzero(begin), np.flatnonzero(stop)
        up, down = powers(len(norm) + 1)
        sums = np.cumsum(BYTE[norm] * up[:len(norm)], dtype=np.uint64)
        before = np.where(starts > 0, sums[starts - 1], np.uint64(0))
        hashes.append(mix64((sums[stops] - before) * down[starts]))
        firsts[k0:k1] = done + np.searchsorted(starts, bounds[k0:k1] - lo, "left")
        done += len(starts)
        lo = hi
    firsts[np.searchsorted(bounds, end, "left"):] = done
    firsts[-1] = done
    return (np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)), firsts


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column without copying them, and each text's bounds; null is empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    wide = pa.types.is_large_string(col.type)
    _, offsets, data = col.buffers()
    if len(col) == 0 or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    bounds = np.frombuffer(offsets, np.int64 if wide else np.int32)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    if col.null_count:                                # a null may still span bytes
        return text_bytes(col.fill_null(""))
    return np.frombuffer(data, np.uint8), bounds


def slices(col: pa.Array, most: int = 4 * SLAB):
    """(first, last) row ranges of about ``most`` bytes, for bounded scratch arrays."""
    _, bounds = text_bytes(col)
    first = 0
    while first < len(col):
        last = int(np.searchsorted(bounds, bounds[first] + most, "right")) - 1
        last = min(max(last, first + 1), len(col))
        yield first, last
        first = last


def shingle_hashes(col: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shingle hashes of all texts in order, the first shingle of each text with the end
    appended, and the number of words per text."""
    data, bounds = text_bytes(col)
    words, firsts = word_hashes(data, bounds)
    n_words = np.diff(firsts)
    n = np.where(n_words >= SIZE, n_words - SIZE + 1, np.minimum(n_words, 1))
    starts = np.concatenate([[0], np.cumsum(n)])
    # the window of SIZE words that begins at each word of the column; a text's windows are its first n
    total = np.zeros(len(words), np.uint64)
    for j in range(min(SIZE, len(words))):
        total[:len(words) - j] += words[j:] * PLACE[j]
    short = np.flatnonzero((n_words > 0) & (n_words < SIZE))
    total[firsts[short]] = 0
    for j in range(SIZE - 1):
        short = short[n_words[short] > j]
        total[firsts[short]] += words[firsts[short] + j] * PLACE[j]
    begins = np.zeros(len(words) + 1, np.int64)      # +1 where windows of a text begin, -1 behind its last
    np.add.at(begins, firsts[:-1][n > 0], 1)
    np.add.at(begins, (firsts[:-1] + n)[n > 0], -1)
    return mix64(total[np.cumsum(begins[:-1]) > 0]), starts, n_words
