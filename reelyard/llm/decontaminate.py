"""Benchmark decontamination by greedy string tiling.

Test items and documents are token sequences (lower-cased, punctuation ignored).  A document's ``MIN_MATCH``-token
windows are joined with those of the items (shared-token seeds).  Pairs whose seeds could reach the threshold are
tiled: windows of the current search length are matched by running Karp-Rabin hashes and extended, the longest matches
that do not overlap are marked, and the length falls until ``MIN_MATCH``.  Tiles may come in any order, so an item
whose passages were moved around is still caught.  ``coverage`` is the share of the item's tokens under tiles; a document
is contaminated by an item at ``THRESHOLD`` or more.

Documents are scanned in place.  The items are the stated query set: they go to the tasks in blocks of about
``BLOCK_BYTES`` of text, one scan a block.  With several blocks the verdicts of the contaminated texts are stored under
their SHA-256 block by block, so driver and tasks hold one block at a time, and then joined back to every row.

Defined results: null or empty documents and items match nothing; an item shorter than ``MIN_MATCH`` tokens is matched
as a whole sequence; of equally covered items the smallest item_id is reported; repeated rows are judged alike; empty
tables give empty or all-clean results; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelyard.llm.common import map_arrow, spare_name, store
from reelyard.llm.textscan import PUNCTUATED, Chunk, grams, powers, text_chunks, word_keys

MIN_MATCH = 4
THRESHOLD = 0.6
BLOCK_BYTES = 16_000_000
#: Places of items that are counted at once.
PAIRS = 1_000_000
_BASE = np.uint64(0x2545F4914F6CDD1D)
_BASE_INV = np.uint64(pow(int(_BASE), -1, 2**64))


def tokens(chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
    start, end, doc = chunk.words(PUNCTUATED)
    return word_keys(chunk.data, start, end, lower=True), doc


def _windows(seq: np.ndarray, size: int) -> np.ndarray:
    """Karp-Rabin hashes of all windows of ``size`` tokens, from one running sum."""
    if len(seq) < size:
        return np.empty(0, dtype=np.uint64)
    sums = np.zeros(len(seq) + 1, dtype=np.uint64)
    np.cumsum(seq * powers(len(seq), _BASE)[:-1], out=sums[1:])
    return (sums[size:] - sums[:-size]) * powers(len(seq) - size, _BASE_INV)


def tile(item: np.ndarray, text: np.ndarray, least: int = MIN_MATCH) -> list[tuple[int, int, int]]:
    """Greedy string tiling: ``(item position, text position, length)`` of the tiles, longest first in each round."""
    free_item, free_text = np.ones(len(item), dtype=bool), np.ones(len(text), dtype=bool)
    tiles: list[tuple[int, int, int]] = []
    size = min(len(item), len(text), 4 * least)
    while size >= least:
        found = _matches(item, text, free_item, free_text, size)
        longest = max((n for _, _, n in found), default=0)
        if longest > 2 * size:  # look for the very long matches first
            size = longest
            continue
        blocked = False
        for i, t, n in sorted(found, key=lambda m: (-m[2], m[0], m[1])):
            if free_item[i : i + n].all() and free_text[t : t + n].all():
                free_item[i : i + n] = False
                free_text[t : t + n] = False
                tiles.append((i, t, n))
            else:
                blocked = True
        if blocked and found:  # what an overlap cut off may still hold matches of this length
            again = _matches(item, text, free_item, free_text, size)
            if again:
                continue
        if size == least:
            break
        size = max(least, size // 2)
    return tiles


def _matches(item: np.ndarray, text: np.ndarray, free_item: np.ndarray, free_text: np.ndarray, size: int) -> list[tuple[int, int, int]]:
    """Maximal common runs of free tokens, at least ``size`` long, one for each seed pair that starts one."""
    sums_item, sums_text = np.append(0, np.cumsum(free_item)), np.append(0, np.cumsum(free_text))
    open_item = np.flatnonzero(sums_item[size:] - sums_item[:-size] == size)
    open_text = np.flatnonzero(sums_text[size:] - sums_text[:-size] == size)
    if not len(open_item) or not len(open_text):
        return []
    h_item, h_text = _windows(item, size)[open_item], _windows(text, size)[open_text]
    at: dict[int, list[int]] = {}
    for h, i in zip(h_item.tolist(), open_item.tolist(), strict=True):
        at.setdefault(h, []).append(i)
    out = []
    near = np.isin(h_text, h_item)
    for h, t in zip(h_text[near].tolist(), open_text[near].tolist(), strict=True):
        for i in at[h]:
            if i and t and free_item[i - 1] and free_text[t - 1] and item[i - 1] == text[t - 1]:
                continue  # part of a run that started earlier
            n = 0
            while i + n < len(item) and t + n < len(text) and free_item[i + n] and free_text[t + n] and item[i + n] == text[t + n]:
                n += 1
            if n >= size:
                out.append((i, t, n))
    return out


class Seeds:
    """Seeds of a block's items, sorted by hash, and their order by item."""

    def __init__(self, seed: np.ndarray, item: np.ndarray, pos: np.ndarray):
        self.seed, self.item, self.pos = seed, item, pos
        self.order = np.argsort(item, kind="stable")
        self.by_item = item[self.order]


class Items:
    """A block of test items: their tokens and a sorted seed table (hash, item, position)."""

    def __init__(self, ids: list, texts: list[str | None]):
        self.ids, self.tokens = [], []
        for chunk in text_chunks(pa.array(texts, pa.string())):
            h, doc = tokens(chunk)
            at = np.searchsorted(doc, np.arange(len(chunk) + 1))
            for i in range(len(chunk)):
                if at[i + 1] > at[i]:
                    self.ids.append(ids[chunk.rows.start + i])
                    self.tokens.append(h[at[i] : at[i + 1]])
        self.lengths = np.array([len(t) for t in self.tokens], dtype=np.int64)
        seeds = {}
        for n in range(1, MIN_MATCH + 1):  # short items are seeds as a whole
            own = [k for k, t in enumerate(self.tokens) if (len(t) >= n if n == MIN_MATCH else len(t) == n)]
            if own:
                flat = np.concatenate([self.tokens[k] for k in own])
                item = np.repeat(own, [len(self.tokens[k]) for k in own])
                h, at = grams(flat, item, n)
                first = np.concatenate([[0], np.cumsum([len(self.tokens[k]) for k in own])[:-1]])
                pos = at - np.repeat(first, [len(self.tokens[k]) for k in own])[at]
                order = np.argsort(h, kind="stable")
                seeds[n] = Seeds(h[order], item[at][order], pos[order])
        self.seeds = seeds

    def covered(self, h: np.ndarray, doc: np.ndarray, docs: int) -> list[tuple[int, int, int]]:
        """``(document, item, covered tokens)`` of the pairs that reach the threshold.

        Items are first counted by how many of their places a document's distinct seeds reach, ``PAIRS`` at a time, so
        seeds that many items and places share cost time in proportion to the items, and no memory; the few items
        reached often enough are tiled one by one.
        """
        first = np.searchsorted(doc, np.arange(docs + 1))
        out = []
        for n, table in self.seeds.items():
            g, at = grams(h, doc, n)
            near = np.searchsorted(table.seed, g, "right") > np.searchsorted(table.seed, g, "left")
            g, at = g[near], at[near]
            for d in np.unique(doc[at]).tolist():
                own = slice(*np.searchsorted(at, first[d : d + 2]))
                seeds, places = g[own], at[own] - first[d]
                for k in self._reached(table, np.unique(seeds), n):
                    mine = slice(*np.searchsorted(table.by_item, [k, k + 1]))
                    hashes, pos = table.seed[table.order[mine]], table.pos[table.order[mine]]
                    item = self.tokens[k]
                    reach = np.zeros(len(item), dtype=bool)
                    for j in range(n):
                        reach[pos[np.isin(hashes, seeds)] + j] = True
                    if reach.sum() < THRESHOLD * len(item):
                        continue
                    text = h[first[d] : first[d + 1]]
                    found = places[np.isin(seeds, hashes)]
                    seeded = np.zeros(len(text) + 1, dtype=np.int64)  # only runs of seeds can hold tiles
                    np.add.at(seeded, found, 1)
                    np.add.at(seeded, found + n, -1)
                    inside = np.cumsum(seeded)[:-1] > 0
                    text = np.where(inside, text, np.uint64(0))[inside | np.append(inside[1:], False)]  # a gap stays one empty token
                    marked = sum(x for _, _, x in tile(item, text, n))
                    if marked >= THRESHOLD * len(item):
                        out.append((d, k, marked))
        return out

    def _reached(self, table: Seeds, seeds: np.ndarray, n: int) -> list[int]:
        """Items of whose tokens enough can lie under the places of some distinct seeds."""
        lo, hi = np.searchsorted(table.seed, seeds, "left"), np.searchsorted(table.seed, seeds, "right")
        many = hi - lo
        total = np.cumsum(many)
        counts = np.zeros(len(self.tokens), dtype=np.int64)
        begin = 0
        while begin < len(seeds):
            done = total[begin - 1] if begin else 0
            end = max(int(np.searchsorted(total, done + PAIRS, "right")), begin + 1)
            part = many[begin:end]
            rows = np.repeat(lo[begin:end], part) + np.arange(part.sum()) - np.repeat(np.cumsum(part) - part, part)
            counts += np.bincount(table.item[rows], minlength=len(counts))
            begin = end
        return np.flatnonzero((counts > 0) & (counts * n >= THRESHOLD * self.lengths)).tolist()  # a place covers n tokens at most


def _blocks(items: DataFrame) -> int:
    return -(-(items.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // BLOCK_BYTES) or 1


def _item_block(items: DataFrame, k: int, blocks: int) -> Items:
    part = items.where("text IS NOT NULL")
    if blocks > 1:
        part = part.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k)
    rows = part.orderBy("item_id", "text").collect()  # one block of the stated query set
    return Items([r.item_id for r in rows], [r.text for r in rows])


def _items(benchmark: DataFrame) -> DataFrame:
    return benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))


def _before(a: int | None, b: int | None) -> bool:
    """Whether id ``a`` is reported rather than ``b``: the smaller one, null last."""
    return a is not None and (b is None or a < b)


def _judge(batches: Iterator[pa.RecordBatch], items: Items, kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    """The batch's columns, then: how many items reach the threshold, the most covered one, and its coverage."""
    for batch in batches:
        n = np.zeros(batch.num_rows, dtype=np.int64)
        best: list = [None] * batch.num_rows
        cover = np.zeros(batch.num_rows)
        for chunk in text_chunks(batch.column("text")):
            h, doc = tokens(chunk)
            for d, k, marked in items.covered(h, doc, len(chunk)):
                row, share = chunk.rows.start + d, marked / len(items.tokens[k])
                n[row] += 1
                if share > cover[row] or (share == cover[row] and _before(items.ids[k], best[row])):
                    best[row], cover[row] = items.ids[k], share
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n), pa.array(best, kind), pa.array(cover)], ["doc_id", "n_items", "item_id", "coverage"])


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, n_items, item_id, coverage, contaminated`` of every document (``benchmark``: item_id, text)."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    items = _items(benchmark)
    blocks = _blocks(items)
    if blocks == 1:
        block = _item_block(items, 0, 1)
        judged = map_arrow(texts, lambda batches: _judge(batches, block, pa.int64()), "doc_id long, n_items long, item_id long, coverage double")
    else:
        every = store(texts.select("doc_id", F.sha2("text", 256).alias("digest")))
        judged = every.join(_contaminated(texts, items, blocks), "digest", "left")
        judged = judged.select("doc_id", F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"), "item_id", F.coalesce("coverage", F.lit(0.0)).alias("coverage"))
    return judged.withColumn("contaminated", F.col("n_items") > 0)


def _contaminated(texts: DataFrame, items: DataFrame, blocks: int) -> DataFrame:
    """``digest, n_items, item_id, coverage`` of the contaminated texts, by their SHA-256; one scan a block."""
    marked = texts.select(F.sha2("text", 256).alias("doc_id"), "text")
    parts = []
    for k in range(blocks):
        block = _item_block(items, k, blocks)
        judged = map_arrow(marked, lambda batches, block=block: _judge(batches, block, pa.int64()), "doc_id string, n_items long, item_id long, coverage double")
        parts.append(store(judged.where("n_items > 0").dropDuplicates(["doc_id"])))
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    best = F.max(F.struct("coverage", (-F.col("item_id")).alias("item"))).alias("best")
    found = every.groupBy(F.col("doc_id").alias("digest")).agg(F.sum("n_items").alias("n_items"), best)
    return store(found.select("digest", "n_items", (-F.col("best.item")).alias("item_id"), F.col("best.coverage").alias("coverage")))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that no test item contaminates, with their own columns."""
    items = _items(benchmark)
    blocks = _blocks(items)
    if blocks > 1:
        digest = spare_name(docs, "digest")
        text = F.col("text").cast("string")
        found = _contaminated(docs.select(text.alias("text")), items, blocks).select(F.col("digest").alias(digest))
        return docs.withColumn(digest, F.sha2(text, 256)).join(found, digest, "left_anti").select(*docs.columns)
    block = _item_block(items, 0, 1)

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pair = pa.RecordBatch.from_arrays([pa.nulls(batch.num_rows, pa.int64()), batch.column("text")], ["doc_id", "text"])
            for verdict in _judge(iter([pair]), block, pa.int64()):
                yield batch.filter(pa.array(verdict.column("n_items").to_numpy() == 0))

    return map_arrow(docs, clean, docs.schema)
