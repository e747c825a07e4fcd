"""Signatures for weighted Jaccard similarity of multisets, by hierarchical Poisson processes."""

from __future__ import annotations

import math

import numpy as np

from tabwright.llm.base import lowered, mix, row_index, uniform, word_hashes, word_starts

_U = np.uint64
_GOLD, _LABEL, _PLACE = _U(0x9E3779B97F4A7C15), _U(0xA0761D6478BD642F), _U(0xE7037ED1A0B428DB)
_LEVEL = _U(0x8EBC6AF09C88C6E3)
#: Times the expected last arrival that points are drawn for at first, in units of the mean.
REACH = 5.0


def shingles(data: np.ndarray, offsets: np.ndarray, words: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``words`` words (A-Z lower-cased) and their rows; a shorter text is one run."""
    data = lowered(data)
    starts, counts = word_starts(data, offsets)
    w = word_hashes(data, starts)
    first = np.cumsum(counts) - counts
    n = np.where(counts > 0, np.maximum(counts - words + 1, 1), 0)
    rows = row_index(n)
    at = first[rows] + np.arange(len(rows)) - np.repeat(np.cumsum(n) - n, n)
    out = np.full(len(rows), _GOLD)
    stop = (first + counts)[rows]
    for k in range(words):
        here = at + k < stop
        part = w[np.minimum(at + k, max(len(w) - 1, 0))] if len(w) else np.zeros(0, _U)
        out = mix(out * _LEVEL + np.where(here, part, _U(k + 1)))
    return out, rows


def elements(hashes: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (hash, row) pairs and how often each occurs."""
    _, first, counts = np.unique(mix(hashes ^ mix(rows.astype(_U) * _GOLD)), return_index=True, return_counts=True)
    return hashes[first], rows[first], counts


def signatures(hashes: np.ndarray, rows: np.ndarray, n_rows: int, size: int) -> np.ndarray:
    """A row of ``size`` 64-bit components per row; two rows agree in each with probability of their weighted Jaccard similarity.

    An element of weight w stands for the weight interval (0, w], whose discrete
    values are the whole numbers. The weight axis is divided into (0, 1], (1, 2], (2, 4], (4, 8] and so on; each part
    carries a Poisson process of points in time, with the part's length as rate, that depends on element and part alone.
    A point has a label, the component it competes for, and a place in its part: points beyond w
    do not count. A component is the identity of the earliest point of its label. Points are drawn
    in order of time only as far as they can matter, so most elements of a long text cost
    one draw. Rows without elements get zeros.
    """
    out = np.zeros((n_rows, size), _U)
    h, r, w = elements(hashes, rows)
    total = np.bincount(r, w, n_rows)
    limit = np.where(total > 0, size * (math.log(size) + REACH) / np.maximum(total, 1), 0.0)
    open_rows = total > 0
    while open_rows.any():
        some = open_rows[r]
        found, ids = _earliest(h[some], r[some], w[some], limit, n_rows, size)
        done = open_rows & np.isfinite(found).all(axis=1)
        out[done] = ids[done]
        open_rows &= ~done
        limit = limit * 2
    return out


def _earliest(h, r, w, limit, n_rows, size):
    levels = np.where(w > 1, np.ceil(np.log2(np.maximum(w, 1))).astype(np.int64), 0) + 1
    el = row_index(levels)
    level = np.arange(len(el)) - np.repeat(np.cumsum(levels) - levels, levels)
    low = np.where(level > 0, 2.0 ** (level - 1), 0.0)
    length = np.where(level > 0, low, 1.0)
    seed = mix(h[el] + level.astype(_U) * _LEVEL)
    row, weight = r[el], w[el].astype(np.float64)
    time = np.zeros(len(el))
    best = np.full(n_rows * size, np.inf)
    ids = np.zeros(n_rows * size, _U)
    i = 0
    while len(seed):
        i += 1
        point = mix(seed + _U((i * int(_GOLD)) & (2**64 - 1)))
        time = time - np.log(uniform(point)) / length
        go = time <= limit[row]
        seed, row, weight, time, point, low, length = (x[go] for x in (seed, row, weight, time, point, low, length))
        label = (mix(point ^ _LABEL) % _U(size)).astype(np.int64)
        inside = low + uniform(mix(point ^ _PLACE)) * length <= weight
        slot, t, p = (row * size + label)[inside], time[inside], point[inside]
        np.minimum.at(best, slot, t)
        first = t == best[slot]
        ids[slot[first]] = p[first]
    return best.reshape(n_rows, size), ids.reshape(n_rows, size)


def bands(sigs: np.ndarray, rows_per_band: int) -> np.ndarray:
    """A key per band of neighbouring components."""
    n, size = sigs.shape
    parts = sigs.reshape(n, size // rows_per_band, rows_per_band)
    key = np.broadcast_to(mix(np.arange(parts.shape[1], dtype=_U) * _GOLD + _U(1)), parts.shape[:2]).copy()
    for j in range(rows_per_band):
        key = mix(key * _LEVEL + parts[:, :, j])
    return key


def occurrences(hashes: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The multisets as sets: the k-th occurrence of a hash in a row becomes an element of its own."""
    order = np.lexsort((hashes, rows))
    h, r = hashes[order], rows[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (r[1:] != r[:-1])
    start = np.maximum.accumulate(np.where(new, np.arange(len(h)), 0))
    return mix(h + (np.arange(len(h)) - start).astype(_U) * _GOLD), r
