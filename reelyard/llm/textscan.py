"""Vectorised text scanning shared by the operators: Arrow text columns to word, shingle and line hashes.

Tasks get Arrow batches (``mapInArrow``).  A batch is walked in chunks of whole documents of about ``CHUNK`` bytes, so
working memory follows the chunk (or the longest single document), never the partition.  A null text is read as empty.

Two kinds of 64-bit hashes.  ``SpanHasher`` takes a polynomial modulo 2**64 of any spans of a chunk from one prefix sum:
equal strings agree, but unequal strings that agree can be made up, so it only finds candidates, which are then compared.
``word_keys`` stands for the words themselves: a word of up to eight bytes is its own key, mixed with its length, and a
longer one has its BLAKE2b digest, so results that rest on equal words rest on these.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK = 500_000
_RNG = np.random.default_rng(20240229)
_RAW = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_LOWER = _RAW[_FOLD]
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
#: Bytes that end a word when punctuation does not count: all ASCII but letters and digits.
PUNCTUATED = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
_R = np.uint64(0x9E3779B97F4A7C15)
_R_INV = np.uint64(pow(int(_R), -1, 2**64))
_GRAM = _RNG.integers(1, 2**63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (every input bit reaches every output bit)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def fold(data: np.ndarray) -> np.ndarray:
    """Bytes with A-Z lower-cased."""
    return _FOLD[data]


def powers(n: int, base: np.uint64 = _R) -> np.ndarray:
    out = np.empty(n + 1, dtype=np.uint64)
    out[0] = 1
    np.cumprod(np.full(n, base, dtype=np.uint64), out=out[1:])
    return out


_POW: list[np.ndarray] = []


def _pow_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POW or len(_POW[0]) <= n:
        size = max(n, CHUNK + CHUNK // 4)
        tables = [powers(size), powers(size, _R_INV)]
        if n > 4 * CHUNK:  # one huge document: not kept
            return tables[0], tables[1]
        _POW[:] = tables
    return _POW[0], _POW[1]


class SpanHasher:
    """Hash of any byte span of ``data`` from one prefix sum."""

    def __init__(self, data: np.ndarray, lower: bool = False):
        p, self.inv = _pow_tables(len(data))
        self.sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum((_LOWER if lower else _RAW)[data] * p[: len(data)], out=self.sums[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.inv[start])


_BLOCK_MASKS = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [2**64 - 1], dtype=np.uint64)
#: Digests of distinct longer words that a task remembers.
MAX_WORDS = 300_000
_DIGESTS: dict[bytes, int] = {}


def first_bytes(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The first eight bytes of each span as one number (shorter spans: theirs, filled with zeros)."""
    padded = np.concatenate([data, np.zeros(8, dtype=np.uint8)])
    blocks = np.ndarray((len(data) + 1,), dtype="<u8", buffer=padded, strides=(1,))
    return blocks[start] & _BLOCK_MASKS[np.minimum(size, 8)]


def word_keys(data: np.ndarray, start: np.ndarray, end: np.ndarray, lower: bool = False) -> np.ndarray:
    """64-bit keys of the words at ``start`` to ``end``, with A-Z lower-cased if ``lower``."""
    if lower:
        data = fold(data)
    size = end - start
    keys = mix(first_bytes(data, start, size) + size.astype(np.uint64) * _R)
    long = np.flatnonzero(size > 8)
    if len(long):
        raw = data.tobytes()
        words = [raw[a:b] for a, b in zip(start[long].tolist(), end[long].tolist(), strict=True)]
        if len(_DIGESTS) > MAX_WORDS:
            _DIGESTS.clear()
        known = _DIGESTS.get
        found = [known(w) for w in words]
        for i, key in enumerate(found):
            if key is None:
                word = words[i]
                found[i] = _DIGESTS[word] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        keys[long] = np.array(found, dtype=np.uint64)
    return keys


@dataclass
class Chunk:
    """Some whole documents of a batch: ``rows`` index the batch, ``data`` their bytes, ``offsets`` their bounds."""

    rows: range
    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.rows)

    def text(self, i: int) -> bytes:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes()

    def per_doc(self, flags: np.ndarray) -> np.ndarray:
        """Sum of a per-byte array for each document."""
        sums = np.zeros(len(flags) + 1, dtype=np.int64)
        np.cumsum(flags, out=sums[1:])
        return np.diff(sums[self.offsets])

    def words(self, between: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end and document of each word ``[^\\x20\\x09-\\x0D]+`` (or run outside ``between``); documents end words."""
        inside = np.zeros(len(self.data) + 2, dtype=bool)
        np.logical_not(between[self.data], out=inside[1:-1])
        first, last = inside[1:-1] & ~inside[:-2], inside[1:-1] & ~inside[2:]
        cut = self.offsets[1:-1]
        cut = cut[(cut > 0) & (cut < len(self.data))]
        first[cut] = inside[1:-1][cut]
        last[cut - 1] = inside[1:-1][cut - 1]
        start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
        return start, end, np.searchsorted(self.offsets, start, "right") - 1

    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end and document of each line; an empty document has one empty line."""
        breaks = np.flatnonzero(self.data == 10)
        start = np.concatenate([self.offsets[:-1], breaks + 1])
        doc = np.concatenate([np.arange(len(self)), np.searchsorted(self.offsets, breaks, "right") - 1])
        order = np.lexsort((start, doc))
        start, doc = start[order], doc[order]
        end = np.append(start[1:] - 1, 0)
        final = np.append(doc[1:] != doc[:-1], True)
        end[final] = self.offsets[1:][doc[final]]
        return start, end, doc


def text_chunks(column: pa.Array, chunk: int = CHUNK) -> Iterator[Chunk]:
    """Whole documents in order, about ``chunk`` bytes at a time (one longer document makes a chunk of its own)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if not len(column):
        return
    _, bounds, values = column.buffers()
    offsets = np.frombuffer(bounds, dtype=np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(values, dtype=np.uint8) if values is not None and values.size else np.empty(0, dtype=np.uint8)
    lo = 0
    while lo < len(column):
        hi = int(np.searchsorted(offsets, offsets[lo] + chunk, "right")) - 1
        hi = min(max(hi, lo + 1), len(column))
        yield Chunk(range(lo, hi), data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
        lo = hi


def grams(words: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first word of each run of ``n`` words inside one document."""
    if len(words) < n:
        return np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64)
    size = len(words) - n + 1
    at = np.flatnonzero(doc[:size] == doc[n - 1 :])
    h = np.zeros(len(at), dtype=np.uint64)
    for k in range(n):
        h += words[at + k] * _GRAM[k]
    return mix(h), at


def strings(column: pa.Array) -> pa.Array:
    """A text column with nulls as empty strings."""
    return column.fill_null("") if column.null_count else column
