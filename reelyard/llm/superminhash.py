"""SuperMinHash signatures, vectorised over the elements of many sets.

For each element a random permutation of the ``m`` components is drawn step by step (Fisher-Yates).  Step ``j`` of an
element offers the value ``j + r`` (``r`` uniform in [0, 1)) to the component its permutation puts at rank ``j``; a
component keeps the smallest offer of all elements.  The ranks of one element are correlated (each component gets a
different rank), which lowers the variance below that of independent minima.  All offers of step ``j`` are below all
later ones, so what step ``j`` fills is final and a set stops as soon as its components are full: large sets after one
or two steps.
"""

from __future__ import annotations

import numpy as np

from reelyard.llm.textscan import mix

#: Elements whose permutation states are held at once.
_BLOCK = 50_000
_STEP = 0x9E3779B97F4A7C15


def signatures(elements: np.ndarray, owner: np.ndarray, sets: int, m: int) -> np.ndarray:
    """``(sets, m)`` uint64 signatures; ``elements`` are distinct hashes within each owner, ``owner`` ascending.

    An empty set keeps the largest value in every component.
    """
    out = np.full((sets, m), np.iinfo(np.uint64).max, dtype=np.uint64)
    bounds = np.searchsorted(owner, np.arange(sets + 1))
    lo = 0
    while lo < sets:
        hi = int(np.searchsorted(bounds, bounds[lo] + _BLOCK, "right")) - 1
        hi = min(max(hi, lo + 1), sets)
        part = slice(bounds[lo], bounds[hi])
        _fill(elements[part], owner[part] - lo, out[lo:hi], m)
        lo = hi
    return out


def _fill(elements: np.ndarray, owner: np.ndarray, out: np.ndarray, m: int) -> None:
    flat = out.reshape(-1)
    empty = np.iinfo(np.uint64).max
    perm: np.ndarray | None = None
    seed = elements
    for j in range(m):
        if not len(seed):
            return
        draw = mix(seed + np.uint64((j + 1) * _STEP % 2**64))
        k = j + ((draw >> np.uint64(32)) % np.uint64(m - j)).astype(np.int64)
        rows = np.arange(len(seed))
        if j == 0:
            slot = k
        else:
            if perm is None:  # the first step, replayed for the elements that go on
                perm = np.tile(np.arange(m, dtype=np.uint8), (len(seed), 1))
                first = (mix(seed + np.uint64(_STEP)) >> np.uint64(32)) % np.uint64(m)
                perm[rows, 0], perm[rows, first] = first.astype(np.uint8), 0
            slot = perm[rows, k].astype(np.int64)
            perm[rows, k] = perm[rows, j]
        at = owner * m + slot
        offer = np.uint64(j << 32) | (draw & np.uint64(0xFFFFFFFF))
        open_ = flat[at] >= np.uint64(j) << np.uint64(32)
        np.minimum.at(flat, at[open_], offer[open_])
        full = (out != empty).all(axis=1)
        going = ~full[owner]
        if not going.all():
            seed, owner = seed[going], owner[going]
            perm = perm[going] if perm is not None else None
