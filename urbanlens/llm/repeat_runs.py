"""Windows of a text, told apart by the smallest gram inside them.

A window is ``min_bytes`` consecutive bytes.  It is represented by its anchor:
of the ``span`` grams inside it (of ``gram`` bytes each) the one with the
smallest hash, the leftmost of equals.  That depends on the window's bytes
alone, so equal windows have equal anchors at equal places.  Consecutive
windows with one anchor are a run; the bytes that a run's windows cover are its
context.  Runs of a text are about ``span`` / 2 windows long.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash

PIECE = 1 << 21                 # window starts taken at once
_PLACE = np.uint64((1 << 22) - 1)
_BASE = 0x9E3779B97F4A7C15      # odd, so it has an inverse modulo 2^64


def shape(min_bytes: int) -> tuple[int, int]:
    """(span, gram): the grams of a window, a power of two, and their bytes."""
    span = 1 << max((2 * min_bytes // 3).bit_length() - 1, 0)
    return span, min_bytes - span + 1


_TABLES: dict = {}              # kept by a worker; no decorator, so that it is pickled by value


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    def table(base: int) -> np.ndarray:
        out = np.full(n, base, np.uint64)
        out[0] = 1
        return np.cumprod(out)

    if n not in _TABLES:
        _TABLES[n] = table(_BASE), table(pow(_BASE, -1, 1 << 64))
    return _TABLES[n]


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A 64-bit hash of every run of ``gram`` bytes."""
    up, down = _powers(PIECE + (1 << 16))
    if len(data) > len(up):
        raise ValueError("a piece is longer than its tables")
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=sums[1:])
    h = (sums[gram:] - sums[:-gram]) * down[:len(data) - gram + 1]
    for shift, odd in ((32, 0xD6E8FEB86659FD93), (29, 0xBF58476D1CE4E5B9)):
        h ^= h >> np.uint64(shift)
        h *= np.uint64(odd)
    return h ^ (h >> np.uint64(32))


def piece_runs(data: np.ndarray, first: np.ndarray, last: np.ndarray, min_bytes: int):
    """Runs of a piece; windows start at first[i]..last[i] inclusive (ascending, disjoint ranges).

    (start, windows, place of the anchor in the run, anchor hash) per run.
    """
    span, gram = shape(min_bytes)
    hashes = gram_hashes(data, gram)
    best = (hashes & ~_PLACE) | np.arange(len(hashes), dtype=np.uint64)
    step = 1
    while step < span:
        best = np.minimum(best[:-step], best[step:])
        step *= 2
    where = (best & _PLACE).astype(np.int64)
    change = np.zeros(len(where) + 1, np.int32)
    np.add.at(change, first, 1)
    np.add.at(change, last + 1, -1)
    valid = np.flatnonzero(np.cumsum(change[:-1]))
    breaks = np.empty(len(where), bool)
    breaks[0] = True
    np.not_equal(where[1:], where[:-1], out=breaks[1:])
    breaks[first] = True
    at = np.flatnonzero(breaks[valid])
    start = valid[at]
    return start, np.diff(np.append(at, len(valid))), where[start] - start, hashes[where[start]].view(np.int64)


def pieces(texts: pa.Array, min_bytes: int):
    """(row of each range, base of each range in its text, bytes, first, last) per piece of a column of bytes."""
    if not len(texts):
        return
    offsets = np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, texts.offset * 4).astype(np.int64)
    whole = np.frombuffer(texts.buffers()[2], np.uint8) if texts.buffers()[2] else np.empty(0, np.uint8)
    rows = np.flatnonzero(np.diff(offsets) >= min_bytes)
    begin, end = offsets[rows], offsets[rows + 1] - min_bytes
    for low in range(int(offsets[0]), int(offsets[-1]), PIECE):
        here = np.flatnonzero((begin < low + PIECE) & (end >= low))
        if len(here):
            first, last = np.maximum(begin[here], low), np.minimum(end[here], low + PIECE - 1)
            yield rows[here], first - begin[here], whole[low:low + PIECE + min_bytes - 1], first - low, last - low


def text_runs(texts: pa.Array, min_bytes: int, wanted=None):
    """(row, start in the text, windows, place, anchor, context hash) of all runs, as arrays per piece.

    ``wanted(anchors)`` gives a mask; other runs are left out before their contexts are hashed.
    """
    for rows, base, data, first, last in pieces(texts, min_bytes):
        start, windows, place, anchor = piece_runs(data, first, last, min_bytes)
        if wanted is not None:
            some = wanted(anchor)
            start, windows, place, anchor = start[some], windows[some], place[some], anchor[some]
        view = memoryview(data)
        size = windows + (min_bytes - 1)
        context = np.fromiter((xxhash.xxh3_64_intdigest(view[s:e]) for s, e in zip(start.tolist(), (start + size).tolist())),
                              np.uint64, len(start)).view(np.int64)
        at = np.searchsorted(first, start, "right") - 1
        yield rows[at], start - first[at] + base[at], windows, place, anchor, context
