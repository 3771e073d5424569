"""Anchors: places in a text that equal byte windows share.

Every window of ``size`` bytes is assigned to the place of the smallest hash of ``SEED`` consecutive bytes in it (the leftmost of equals).
Equal windows have their anchor at the same offset, so windows are equal only where the anchors' hashes are. Consecutive windows with one
anchor form a *stretch*.
"""

from __future__ import annotations

import numpy as np

SEED = 32  # bytes hashed at an anchor
CHUNK = 1 << 20  # window starts looked at together
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_PLACE = np.uint64((1 << 21) - 1)  # low bits that hold a place; the rest of a hash chooses the smallest


def _powers(base: int, n: int) -> np.ndarray:
    """base^0 ... base^(n-1) modulo 2^64."""
    out = np.ones(n, np.uint64)
    done = 1
    while done < n:
        more = min(done, n - done)
        out[done : done + more] = out[:more] * np.uint64(pow(base, done, 1 << 64))
        done += more
    return out


_BYTE = np.random.default_rng(11).integers(1 << 63, size=256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _spread(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def _smallest(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive entries: doubled runs, two of which cover the width."""
    run = 1
    while run * 2 <= width:
        x = np.minimum(x[:-run], x[run:])
        run *= 2
    rest = width - run
    return np.minimum(x[:-rest], x[rest:]) if rest else x


def stretches(data: np.ndarray, ends: np.ndarray, size: int):
    """Yields (place, low, high, seed hash, hash of the stretch) arrays, in order of place, for all windows of the texts in ``data``.

    ``data`` holds the bytes of consecutive texts, ``ends`` where each ends; no window crosses an end. A stretch's windows start at low ... high and
    cover the bytes low ... high + size - 1. Work is done on ``CHUNK`` window starts at a time; a stretch over such an edge comes in two parts.
    """
    ends = np.asarray(ends, np.int64)
    width = size - SEED + 1
    up, down = (_powers(b, min(len(data), CHUNK + size) + 1) for b in (_BASE, _INVERSE))
    for start in range(0, max(len(data) - size + 1, 0), CHUNK):
        stop = min(start + CHUNK, len(data) - size + 1)
        part = data[start : stop + size - 1]
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(_BYTE[part] * down[: len(part)], out=sums[1:])
        n = len(part) - SEED + 1
        seeds = _spread((sums[SEED:] - sums[:n]) * up[:n])
        place = (_smallest((seeds & ~_PLACE) | np.arange(n, dtype=np.uint64), width) & _PLACE).astype(np.int64)
        starts = np.arange(start, stop)
        inside = ends[np.searchsorted(ends, starts, "right")] >= starts + size
        first = np.ones(len(place), bool)
        first[1:] = (place[1:] != place[:-1]) | ~inside[:-1]
        low = np.flatnonzero(first & inside)
        if not len(low):
            continue
        last = np.ones(len(place), bool)
        last[:-1] = first[1:] | ~inside[1:]
        high = np.flatnonzero(last & inside)
        at = place[low]
        whole = (sums[high + size] - sums[low]) * up[low] + (at - low).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        yield at + start, low + start, high + start, seeds[at], _spread(whole ^ ((high - low).astype(np.uint64) << np.uint64(40)))
