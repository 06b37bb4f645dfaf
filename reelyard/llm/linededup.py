"""Line dedup: once-seen and twice-seen Bloom filters, exact confirmation of the suspected repeats.

1. One scan gives every document's distinct line keys (stripped, lower-cased, hashed) and folds them into a pair of
   Bloom filters per task: ``once`` holds what was seen, ``twice`` what was seen when ``once`` already had it.  Pairs
   combine by ``twice = twice1 | twice2 | (once1 & once2)``; filters are cut into fixed blocks, and blocks combine in a
   reduction by Spark, so no task holds more than one filter and a few blocks.
2. A second scan sends only keys that ``twice`` knows (a key of two or more documents always is) to the exact count of
   documents per key.  A false positive costs a shuffled row, never a wrong result.
3. Keys found in at least ``min_docs`` documents are joined back to the documents that hold them, and those documents
   drop the lines.  With ``keep_first`` the first occurrence of a key stays (first line with it, smallest doc_id).

The filter's bits are a parameter, by default ``BITS_A_DOC`` for each document up to ``MAX_BITS`` (16 MB a filter):
beyond that more keys are suspected and shuffled, with the same result.

Defined results: a null or empty text is one empty line; keys shorter than ``min_chars`` code points never count;
documents are counted by doc_id, so rows that repeat an id count once and rows without one not at all, but all of them
lose the repeated lines; an empty table gives an empty result; other columns pass through unread, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelyard.llm.common import map_arrow, spare_name, store
from reelyard.llm.textscan import strings

STRIP = b" \t\n\x0b\x0c\r"
MIN_DOCS = 10
MIN_CHARS = 1
HASHES = 4
MIN_BITS, MAX_BITS = 1 << 20, 1 << 27
#: Bytes of a filter block, the unit in which filters are combined.
BLOCK = 1 << 16
BITS_A_DOC = 64
#: Bytes of a key's BLAKE2b digest: different keys of even 10**15 lines stay apart.
DIGEST = 16
_ZSTD = "zstd"


def line_key(line: bytes, min_chars: int = MIN_CHARS) -> bytes | None:
    """The 16-byte key of a line, or None if the line is too short to count."""
    key = line.strip(STRIP).lower()
    if len(key) < min_chars or (min_chars > 1 and len(key.decode("utf-8", "replace")) < min_chars):
        return None
    return hashlib.blake2b(key, digest_size=DIGEST).digest()


def _keys(column: pa.Array, min_chars: int) -> Iterator[set[bytes]]:
    """The distinct keys of each text; digests of the batch's repeated lines are taken once."""
    known: dict[bytes, bytes | None] = {}
    for text in strings(column).cast(pa.binary()):
        found = set()
        for line in text.as_py().split(b"\n"):
            if line not in known:
                known[line] = line_key(line, min_chars)
            found.add(known[line])
        found.discard(None)
        yield found


def _positions(digests: list[bytes], bits: int) -> np.ndarray:
    """``HASHES`` bit positions of each digest, by double hashing."""
    halves = np.frombuffer(b"".join(digests), dtype=np.uint64).reshape(-1, 2)
    step = halves[:, 1] | np.uint64(1)
    return np.stack([(halves[:, 0] + np.uint64(k) * step) % np.uint64(bits) for k in range(HASHES)], axis=1).astype(np.int64)


class BloomPair:
    """The filters of what was seen once and twice; bit arrays held as one byte per bit while being filled."""

    def __init__(self, bits: int):
        self.bits = bits
        self.once = np.zeros(bits // 8, dtype=np.uint8)
        self.twice = np.zeros(bits // 8, dtype=np.uint8)

    def add(self, digests: list[bytes]) -> None:
        """Add sightings in batches; equal digests of one batch count as seen twice."""
        if not digests:
            return
        at = _positions(digests, self.bits)
        seen = self._has(self.once, at)
        order = np.lexsort(at.T)
        same = (at[order][1:] == at[order][:-1]).all(axis=1)
        seen[order[1:][same]] = True
        self._set(self.once, at)
        self._set(self.twice, at[seen])

    @staticmethod
    def _set(bits: np.ndarray, at: np.ndarray) -> None:
        np.bitwise_or.at(bits, at.reshape(-1) >> 3, (1 << (at.reshape(-1) & 7)).astype(np.uint8))

    @staticmethod
    def _has(bits: np.ndarray, at: np.ndarray) -> np.ndarray:
        return ((bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1).all(axis=1)

    def known_twice(self, digests: list[bytes]) -> np.ndarray:
        return self._has(self.twice, _positions(digests, self.bits)) if digests else np.zeros(0, dtype=bool)

    def blocks(self) -> pa.RecordBatch:
        n = max(1, len(self.once) // BLOCK)
        once, twice = self.once.reshape(n, -1), self.twice.reshape(n, -1)
        used = np.flatnonzero(once.any(axis=1))
        return pa.RecordBatch.from_arrays(
            [pa.array(used), _pressed([once[i] for i in used]), _pressed([twice[i] for i in used])],
            ["block", "once", "twice"],
        )


def _pressed(blocks: list[np.ndarray]) -> pa.Array:
    """Blocks of sparse bits, compressed."""
    return pa.array([pa.compress(b.tobytes(), _ZSTD, asbytes=True) for b in blocks], pa.binary())


def _filters(docs: DataFrame, bits: int, min_chars: int) -> bytes:
    """The twice-seen filter of the whole input."""

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = BloomPair(bits)
        for batch in batches:
            pair.add([k for keys in _keys(batch.column("text"), min_chars) for k in keys])
        yield pair.blocks()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        size = min(BLOCK, bits // 8)
        for batch in batches:
            for block, once, twice in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                once, twice = (np.frombuffer(pa.decompress(x, size, _ZSTD, asbytes=True), np.uint8) for x in (once, twice))
                if block in held:
                    o, t = held[block]
                    twice, once = t | twice | (o & once), o | once
                held[block] = once, twice
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(held), pa.int64()), _pressed([o for o, _ in held.values()]), _pressed([t for _, t in held.values()])],
            ["block", "once", "twice"],
        )

    schema = "block long, once binary, twice binary"
    parts = map_arrow(docs.select("text"), fill, schema)
    merged = map_arrow(parts.repartition(F.col("block")), merge, schema)
    size = min(BLOCK, bits // 8)
    out = bytearray(bits // 8)
    for row in merged.select("block", "twice").toLocalIterator():  # bits / 8 bytes in all, at most 16 MB
        out[row.block * size : (row.block + 1) * size] = pa.decompress(row.twice, size, _ZSTD, asbytes=True)
    return bytes(out)


def filter_bits(docs: DataFrame) -> int:
    """``BITS_A_DOC`` for each document, rounded up to a power of two, within ``MIN_BITS`` and ``MAX_BITS``."""
    return min(MAX_BITS, max(MIN_BITS, 1 << (docs.count() * BITS_A_DOC).bit_length()))


def repeated_keys(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS, bits: int | None = None) -> DataFrame:
    """``line_row, doc_id, key, first_id`` for each document with a key found in at least ``min_docs`` documents.

    ``line_row`` is a hash of the row's id and text; ``first_id`` the smallest doc_id with the key.
    """
    rows = docs.select(_row().alias("line_row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    bits = bits or filter_bits(docs)
    twice = docs.sparkSession.sparkContext.broadcast(_filters(rows, bits, min_chars))

    def suspects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = BloomPair(8)
        pair.bits, pair.twice = bits, np.frombuffer(twice.value, np.uint8)
        for batch in batches:
            owners, digests = [], []
            for i, keys in enumerate(_keys(batch.column("text"), min_chars)):
                digests += keys
                owners += [i] * len(keys)
            hit = np.flatnonzero(pair.known_twice(digests))
            at = pa.array(np.array(owners, dtype=np.int64)[hit])
            yield pa.RecordBatch.from_arrays([batch.column("line_row").take(at), batch.column("doc_id").take(at), pa.array([digests[i] for i in hit], pa.binary())], ["line_row", "doc_id", "key"])

    seen = store(map_arrow(rows, suspects, "line_row long, doc_id long, key binary"))
    often = seen.groupBy("key").agg(F.count_distinct("doc_id").alias("n"), F.min("doc_id").alias("first_id")).where(F.col("n") >= min_docs)
    # Stored, so that the join has two shuffled sides and a very common line can be split over tasks.
    return seen.join(store(often.select("key", "first_id")), "key")


def _row() -> F.Column:
    return F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string"))


def _with_keys(docs: DataFrame, min_docs: int, min_chars: int, bits: int | None) -> DataFrame:
    """``docs`` with a last column ``dropped_line_keys``: its repeated keys, and whether the row holds the first one."""
    pair = F.struct("key", F.coalesce(F.col("doc_id") == F.col("first_id"), F.lit(False)).alias("first"))
    lists = repeated_keys(docs, min_docs, min_chars, bits).groupBy("line_row").agg(F.collect_set(pair).alias("dropped_line_keys"))
    row, keys = spare_name(docs, "line_row"), spare_name(docs, "dropped_line_keys")
    lists = lists.select(F.col("line_row").alias(row), F.col("dropped_line_keys").alias(keys))
    return docs.withColumn(row, _row()).join(lists, row, "left").select(*docs.columns, keys)


def _rest(text: bytes, keys: list[dict] | None, min_chars: int, keep_first: bool) -> tuple[bytes, int, int]:
    """The remaining lines joined, how many lines there were, and how many went."""
    lines = text.split(b"\n")
    if not keys:
        return text, len(lines), 0
    drop = {k["key"]: keep_first and k["first"] for k in keys}
    kept = []
    for line in lines:
        key = line_key(line, min_chars)
        if key not in drop:
            kept.append(line)
        elif drop[key]:
            drop[key] = False
            kept.append(line)
    return b"\n".join(kept), len(lines), len(lines) - len(kept)


def report(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS, bits: int | None = None) -> DataFrame:
    """``doc_id, n_lines, n_dropped, kept_sha256`` of every document."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = strings(batch.column("text")).cast(pa.binary()).to_pylist()
            rests = [_rest(t, k, min_chars, False) for t, k in zip(texts, batch.column("dropped_line_keys").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([r[1] for r in rests], pa.int64()), pa.array([r[2] for r in rests], pa.int64()), pa.array([hashlib.sha256(r[0]).hexdigest() for r in rests], pa.string())],
                ["doc_id", "n_lines", "n_dropped", "kept_sha256"],
            )

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_arrow(_with_keys(texts, min_docs, min_chars, bits), apply, "doc_id long, n_lines long, n_dropped long, kept_sha256 string")


def drop_repeated_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS, bits: int | None = None, keep_first: bool = False) -> DataFrame:
    """``docs`` with its repeated lines gone from ``text``; all columns keep their names; a text without repeats is untouched."""
    schema = docs.schema
    where = schema.fieldNames().index("text")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(where).cast(pa.binary()).to_pylist()
            keys = batch.column(batch.num_columns - 1).to_pylist()
            rests = [t if t is None or not k else _rest(t, k, min_chars, keep_first)[0] for t, k in zip(texts, keys, strict=True)]
            columns = [pa.array(rests, pa.binary()).cast(pa.string()) if i == where else c for i, c in enumerate(batch.columns[:-1])]
            yield pa.RecordBatch.from_arrays(columns, schema.fieldNames())

    return map_arrow(_with_keys(docs, min_docs, min_chars, bits), apply, schema)
