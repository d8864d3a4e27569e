"""Index arithmetic for comparing spans of sorted rows in numpy, a bounded number of pairs at a time."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

PAIRS_AT_ONCE = 1 << 20


def runs_of(group: np.ndarray, longest: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of the runs of equal values in a sorted array, cut every ``longest`` rows."""
    n = len(group)
    heads = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if n else np.empty(0, np.int64)
    if longest is not None and n:
        begun = np.repeat(heads, np.diff(np.r_[heads, n]))
        heads = np.flatnonzero((np.arange(n) - begun) % longest == 0)
    return heads, np.diff(np.r_[heads, n])


def spans_product(
    a_at: np.ndarray, a_n: np.ndarray, b_at: np.ndarray, b_n: np.ndarray
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All index pairs of span ``a[k]`` and span ``b[k]``, for every ``k``."""
    counts = a_n.astype(np.int64) * b_n
    ends = np.cumsum(counts)
    total, at = int(ends[-1]) if len(ends) else 0, 0
    while at < total:
        which = np.arange(at, min(at + PAIRS_AT_ONCE, total))
        k = np.searchsorted(ends, which, "right")
        offset = which - (ends[k] - counts[k])
        yield a_at[k] + offset // b_n[k], b_at[k] + offset % b_n[k]
        at += PAIRS_AT_ONCE


def merged_links(found: Sequence[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """A star for every component of the links: fewer links, the same components."""
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    a = np.concatenate([x for x, _ in found])
    b = np.concatenate([x for _, x in found])
    nodes, places = np.unique(np.r_[a, b], return_inverse=True)
    u, v = places[: len(a)], places[len(a) :]
    label = np.arange(len(nodes))
    while len(u):
        low, high = np.minimum(label[u], label[v]), np.maximum(label[u], label[v])
        np.minimum.at(label, high, low)
        while (label[label] != label).any():
            label = label[label]
        apart = label[u] != label[v]
        u, v = u[apart], v[apart]
    others = label != np.arange(len(nodes))
    return nodes[label[others]], nodes[others]
