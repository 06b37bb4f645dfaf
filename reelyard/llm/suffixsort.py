"""Two-stage suffix sorting of a byte array, to a bounded depth, vectorised.

Stage one sorts directly only the suffixes that are smaller than their successors.  Stage two induces all others: a
suffix that is larger than its successor has a first byte at least as large as the successor's, so a scan over the
buckets of first bytes in ascending order meets the successor before the suffix itself and can append the suffix to its
own bucket.  Within a bucket the scan goes in layers, one for each repetition of the bucket's byte.
"""

from __future__ import annotations

import numpy as np


def smaller_than_next(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the one that starts a byte later (the last one is not)."""
    n = len(text)
    change = np.append(np.flatnonzero(text[1:] != text[:-1]), n - 1)  # last byte of each run of equal bytes
    rises = np.append(text[change[:-1]] < text[change[:-1] + 1], False)
    return np.repeat(rises, np.diff(np.append(-1, change)))


def _words(text: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The eight bytes from each position as one big-endian number; zeros past the end."""
    out = np.zeros(len(at), dtype=np.uint64)
    for k in range(8):
        out = (out << np.uint64(8)) | text[at + k].astype(np.uint64)
    return out


def _direct(padded: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """``at`` sorted by their suffixes' first ``depth`` bytes, eight at a time; only ties are sorted on."""
    order = np.argsort(_words(padded, at), kind="stable")
    at = at[order]
    key = _words(padded, at)
    tied = np.append(False, key[1:] == key[:-1])
    done = 8
    while tied.any() and done < depth:
        group = np.cumsum(~tied)
        own = tied.copy()
        own[:-1] |= tied[1:]
        open_ = np.flatnonzero(own)
        key = _words(padded, at[open_] + done)
        order = np.lexsort((key, group[open_]))
        at[open_] = at[open_[order]]
        key = key[order]
        still = np.append(False, (key[1:] == key[:-1]) & (group[open_][1:] == group[open_][:-1]))
        tied[:] = False
        tied[open_] = still
        done += 8
    return at


def suffix_order(text: np.ndarray, wanted: np.ndarray, depth: int) -> np.ndarray:
    """The ``wanted`` suffixes (a mask) and those they are induced from, in the order of their first ``depth`` bytes."""
    n = len(text)
    if not n:
        return np.empty(0, dtype=np.int64)
    small = smaller_than_next(text)
    # A larger suffix needs its successors up to the first directly sorted one, or to the last.
    direct = np.append(np.flatnonzero(small), n - 1)
    need = np.zeros(n + 1, dtype=np.int64)
    ends = np.flatnonzero(wanted)
    np.add.at(need, ends, 1)
    np.add.at(need, direct[np.searchsorted(direct, ends)] + 1, -1)
    needed = np.cumsum(need)[:-1] > 0
    padded = np.append(text, np.zeros(depth + 16, dtype=np.uint8))
    first = _direct(padded, np.flatnonzero(needed & small), depth)
    bucket = np.searchsorted(text[first], np.arange(257))
    induced: list[list[np.ndarray]] = [[] for _ in range(256)]
    if needed[-1]:  # the last suffix has no successor; it is the smallest of its bucket
        induced[text[-1]].append(np.array([n - 1]))
    out = []
    large = needed & ~small
    for byte in range(256):
        # The induced suffixes of a bucket come before the directly sorted: their next different byte is smaller.
        own = list(induced[byte])
        layer = np.concatenate(own) if own else np.empty(0, dtype=np.int64)
        while len(layer):
            before = layer - 1
            before = before[before >= 0]
            layer = before[large[before] & (text[before] == byte)]
            own.append(layer)
        head = np.concatenate(own) if own else np.empty(0, dtype=np.int64)
        whole = np.concatenate([head, first[bucket[byte] : bucket[byte + 1]]])
        out.append(whole)
        before = whole - 1
        before = before[before >= 0]
        before = before[large[before] & (text[before] > byte)]
        if len(before):
            order = np.argsort(text[before], kind="stable")
            before = before[order]
            at = np.flatnonzero(np.append(True, np.diff(text[before].astype(np.int16)) != 0))
            for part in np.split(before, at[1:]):
                induced[text[part[0]]].append(part)
    return np.concatenate(out)


def common_prefix(text: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """Common prefix of each suffix in ``order`` with the one before it, counted up to ``depth`` (first: 0)."""
    padded = np.append(text, np.zeros(depth + 16, dtype=np.uint8))
    out = np.zeros(len(order), dtype=np.int64)
    open_ = np.arange(1, len(order))
    for done in range(0, depth, 8):
        a, b = _words(padded, order[open_] + done), _words(padded, order[open_ - 1] + done)
        differ = a ^ b
        # Whole bytes before the first difference.
        same = np.full(len(open_), 8)
        at = np.flatnonzero(differ)
        same[at] = (63 - np.floor(np.log2(differ[at].astype(np.float64))).astype(np.int64)) // 8
        out[open_] += same
        open_ = open_[same == 8]
        if not len(open_):
            break
    room = len(text) - np.maximum(order, np.append(order[:1], order[:-1]))
    return np.minimum(np.minimum(out, room), depth)
