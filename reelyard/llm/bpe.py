"""Byte-level BPE encoding and decoding with a global distinct-word shuffle.

1. One scan splits texts into pre-tokens.  A block of documents (about ``BLOCK_BYTES`` of text) lists its distinct
   pre-tokens once, dealt into shards by hash, and keeps for every document the positions as indexes into that list.
2. The word lists are shuffled by shard: all occurrences of a pre-token meet in one partition, which encodes it once and
   answers every block.  A frequent word is one entry in each block's list, so no partition is hot.
3. The answers are joined back to the positions by block, and each document's ids are put together in order.
4. Decoding joins ids with the token-byte table (the vocabulary, a fixed 50,256 rows) and concatenates the bytes.

Moving packed lists instead of one row for each position keeps the shuffles below the size of the text.  A partition of
step 2 holds the distinct words of its shards: the shard count (``spark.sql.shuffle.partitions`` by default) sets it.

Defined results: null and empty texts have no ids and decode to no bytes; repeated rows are encoded alike; an empty
table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelyard.llm.common import map_arrow, store
from reelyard.llm.packing import pack, pack_ranks, press, unpack, unpack_ranks, unpress
from reelyard.llm.textscan import SpanHasher, strings

BLOCK_BYTES = 24_000_000
#: Pre-tokens whose ids are put together at once.
STEP = 200_000
PARTS = "kind int, block long, shard int, items binary, sizes binary, doc_ids array<long>, counts array<int>"
_PART_TYPES = [pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int32())]
POSITIONS, WORDS = 0, 1


class Vocabulary:
    """Ranks of a byte-level BPE and the pattern that splits text before merging; each part is made when first used."""

    def __init__(self, ranks: bytes, pattern: str):
        self.ranks = ranks
        self.split = regex.compile(pattern).findall

    def _tokens(self) -> dict[bytes, int]:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in self.ranks.splitlines() if line)}

    @cached_property
    def merge(self):
        """Ids of one pre-token: it arrives alone, so the merges' own pattern takes all of it."""
        return tiktoken.Encoding("pre-token", pat_str=r"(?s:.+)", mergeable_ranks=self._tokens(), special_tokens={}).encode_ordinary

    @cached_property
    def table(self) -> list[bytes]:
        """Bytes of each id."""
        tokens = self._tokens()
        out = [b""] * (max(tokens.values()) + 1)
        for token, rank in tokens.items():
            out[rank] = token
        return out

    @cached_property
    def decimal(self) -> list[bytes]:
        return [str(i).encode() for i in range(len(self.table))]


@lru_cache(maxsize=2)
def _vocabulary(ranks: bytes, pattern: str) -> Vocabulary:
    return Vocabulary(ranks, pattern)


def read_ranks(path: str) -> bytes:
    """The rank file's bytes, read by the driver (under 1 MB) and sent to the tasks."""
    with open(path, "rb") as file:
        return file.read()


def _parts(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in _PART_TYPES]
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, _PART_TYPES, strict=True)], [f.split()[0] for f in PARTS.split(", ")])


def _split(batches: Iterator[pa.RecordBatch], vocabulary: Vocabulary, shards: int) -> Iterator[pa.RecordBatch]:
    """Blocks of documents: a row of positions and one row of distinct pre-tokens for each shard."""
    block = TaskContext.get().partitionId() << 32
    pieces, counts, ids, size = [], [], [], 0
    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), strings(batch.column("text")), strict=True):
            found = vocabulary.split(text.as_py())
            pieces.append(pa.array(found, pa.string()).dictionary_encode())
            counts.append(len(found))
            ids.append(doc_id)
            size += text.as_buffer().size
            if size >= BLOCK_BYTES:
                yield _block_rows(block, pieces, counts, ids, shards)
                pieces, counts, ids, size = [], [], [], 0
                block += 1
    if ids:
        yield _block_rows(block, pieces, counts, ids, shards)


def _block_rows(block: int, pieces: list[pa.DictionaryArray], counts: list[int], ids: list[int], shards: int) -> pa.RecordBatch:
    """Positions as frequency ranks of the block's distinct words, with each rank's shard; then the words by shard."""
    unified = pa.chunked_array(pieces).unify_dictionaries()
    pieces.clear()
    index = np.concatenate([c.indices.to_numpy(zero_copy_only=False) for c in unified.chunks])
    words = unified.chunk(0).dictionary
    del unified
    # By falling count, then by the word itself: the many words seen once lie in order, which packs well.
    both = pa.table({"n": np.bincount(index, minlength=len(words)), "word": words})
    order = pc.sort_indices(both, sort_keys=[("n", "descending"), ("word", "ascending")]).to_numpy()
    words = words.cast(pa.binary())
    rank = np.empty(len(order), dtype=np.int32)
    rank[order] = np.arange(len(order), dtype=np.int32)
    words = words.take(pa.array(order))
    _, bounds, data = words.buffers()
    bounds = np.frombuffer(bounds, np.int32)[: len(words) + 1].astype(np.int64)
    hashes = SpanHasher(np.frombuffer(data or b"", np.uint8))(bounds[:-1], bounds[1:])
    shard = (hashes % np.uint64(shards)).astype(np.int64)
    rows: list[tuple] = [(POSITIONS, block, -1, pack_ranks(rank[index]), pack(shard), ids, counts)]
    dealt = np.argsort(shard, kind="stable")
    listed = words.take(pa.array(dealt))
    at = np.searchsorted(shard[dealt], np.arange(shards + 1))
    for s in np.flatnonzero(np.diff(at)):
        part = listed.slice(at[s], at[s + 1] - at[s]).to_pylist()
        rows.append((WORDS, block, int(s), press(b"".join(part), level=9), pack(np.array([len(w) for w in part])), None, None))
    pa.default_memory_pool().release_unused()
    return _parts(rows)


def _unlist(items: bytes, sizes: bytes) -> list[bytes]:
    ends = np.cumsum(unpack(sizes))
    data = unpress(items, int(ends[-1]))
    return [data[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]


def _encode_shards(batches: Iterator[pa.RecordBatch], vocabulary: Vocabulary) -> Iterator[pa.RecordBatch]:
    """Each distinct pre-token of the partition's shards is encoded once, for all blocks."""
    known: dict[bytes, list[int]] = {}
    merge = vocabulary.merge
    for batch in batches:
        for row in batch.to_pylist():
            answers = []
            for word in _unlist(row["items"], row["sizes"]):
                ids = known.get(word)
                if ids is None:
                    ids = known[word] = merge(word.decode())
                answers.append(ids)
            flat = np.array([i for ids in answers for i in ids], dtype=np.int64)
            yield _parts([(WORDS, row["block"], row["shard"], pack(flat), pack(np.array([len(a) for a in answers])), None, None)])


def _assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by block, its positions first, then its shards in order: the documents' ids."""
    head: dict | None = None
    ids: list[np.ndarray] = []
    sizes: list[np.ndarray] = []
    for batch in batches:
        for row in batch.to_pylist():
            if row["kind"] == POSITIONS:
                if head:
                    yield from _documents(head, ids, sizes)
                head, ids, sizes = row, [], []
            else:
                ids.append(unpack(row["items"]).astype(np.int32))
                sizes.append(unpack(row["sizes"]))
    if head:
        yield from _documents(head, ids, sizes)


def _documents(head: dict, ids: list[np.ndarray], sizes: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    flat = np.concatenate([np.empty(0, np.int32), *ids])
    size = np.concatenate([np.empty(0, np.int64), *sizes])
    # The answers come by shard; within a shard they keep the order of the ranks.
    dealt = np.argsort(unpack(head["sizes"]), kind="stable")
    size, start = _at(dealt, size), _at(dealt, np.cumsum(size) - size)
    index = unpack_ranks(head["items"])
    ends = np.concatenate([[0], np.cumsum(head["counts"])]).astype(np.int64)
    lo = 0
    while lo < len(ends) - 1:  # some documents at a time
        hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + STEP, "right")) - 1)
        own = index[ends[lo] : ends[hi]]
        many = size[own]
        at = np.concatenate([[0], np.cumsum(many)])
        out = flat[np.repeat(start[own] - at[:-1], many) + np.arange(at[-1])]
        listed = pa.ListArray.from_arrays(pa.array(at[ends[lo : hi + 1] - ends[lo]].astype(np.int32)), pa.array(out))
        yield pa.RecordBatch.from_arrays([pa.array(head["doc_ids"][lo:hi], pa.int64()), listed], ["doc_id", "ids"])
        lo = hi


def _at(places: np.ndarray, values: np.ndarray) -> np.ndarray:
    out = np.empty_like(values)
    out[places] = values
    return out


def _shard_count(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _answered_blocks(docs: DataFrame, ranks_path: str, pattern: str, shards: int | None) -> DataFrame:
    """Each block's positions and the ids of its words, together and in order."""
    spark = docs.sparkSession
    shards = shards or _shard_count(spark)
    ranks = spark.sparkContext.broadcast(read_ranks(ranks_path))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    parts = store(map_arrow(texts, lambda batches: _split(batches, _vocabulary(ranks.value, pattern), shards), PARTS))
    words = parts.where(F.col("kind") == WORDS).repartition(shards, "shard")
    encoded = map_arrow(words, lambda batches: _encode_shards(batches, _vocabulary(ranks.value, pattern)), PARTS)
    both = parts.where(F.col("kind") == POSITIONS).unionByName(encoded)
    return both.repartition(shards, "block").sortWithinPartitions("block", "kind", "shard")


def encode(docs: DataFrame, ranks_path: str, pattern: str, shards: int | None = None) -> DataFrame:
    """``doc_id, ids`` of every document: the ranks' byte-level BPE of each match of ``pattern``, no special tokens."""
    return map_arrow(_answered_blocks(docs, ranks_path, pattern, shards), _assemble, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """``doc_id, bytes`` of ``encoded(doc_id, ids)`` through the token-byte table."""
    ranks = encoded.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _vocabulary(ranks.value, pattern).table.__getitem__
        for batch in batches:
            data = [b"".join(map(table, ids or ())) for ids in _id_lists(batch)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(data, pa.binary())], ["doc_id", "bytes"])

    return map_arrow(encoded.select("doc_id", "ids"), join, "doc_id long, bytes binary")


def _id_lists(batch: pa.RecordBatch) -> Iterator[list[int]]:
    column = batch.column("ids")
    values, bounds = column.values.to_numpy(), column.offsets.to_numpy()
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        yield values[a:b].tolist()


def digests(docs: DataFrame, ranks_path: str, pattern: str, shards: int | None = None) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every document.

    The ids that ``encode`` gives are hashed in decimal, and so are the bytes that they decode to, in the task that puts
    them together: they need not leave it.
    """
    ranks = docs.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(ranks.value, pattern)
        decimal, table = vocabulary.decimal.__getitem__, vocabulary.table.__getitem__
        for batch in _assemble(batches):
            n, told, decoded = [], [], []
            for ids in _id_lists(batch):
                n.append(len(ids))
                told.append(hashlib.sha256(b",".join(map(decimal, ids))).hexdigest())
                decoded.append(hashlib.sha256(b"".join(map(table, ids))).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(told, pa.string()), pa.array(decoded, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return map_arrow(_answered_blocks(docs, ranks_path, pattern, shards), hashes, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
