"""Filter interaction audit: what five document filters remove, in every order, with duplicates found by radix text tries.

The filters fail a document when it has (A) too few words, (B) too few distinct words, (C) too many capitals, (D) a symbol
of a list, (E) the same text as a document of a smaller id anywhere in the table.  A to D follow from the text alone; E
comes from the tries:

1. One scan takes A-D of each document and inserts its whole text into a compressed trie of the task, whose terminals
   hold the smallest id.  A document that meets a smaller id there is decided at once and goes on without its text; the
   trie is written out and begun anew after ``WINDOW`` bytes.  So a text that a third of all rows share leaves a task
   once per window, not once per row.
2. Adaptive prefixes: a prefix whose remaining texts hold more than a quarter of a partition's share is heavy, and its
   texts are told apart by a prefix of twice the length, until no heavy one is left or its texts are all the same.  Only
   hashes of heavy prefixes are kept (8 bytes each, at most four a partition in each round).
3. The remaining texts are range-partitioned by their adaptive prefixes and sorted by them; a task builds one trie per
   prefix, so it holds a quarter of a partition at a time, and a partition holds ``PARTITION`` bytes at most.  Traversing
   a finished trie gives the undecided documents and whether a smaller id had their text.
4. Each document is now a bit mask.  Masks are counted by part, quality and toxicity (at most 128 rows a part); every
   filter order and step is read off these counts.

Defined results: a null text is empty; a null id is never a smaller one, nor has it one; rows that repeat an id and text
are counted each and no duplicates of each other; a null language is the part ``""``; an id with several label rows is of
quality 1 (toxic 1) if one of them says so; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from itertools import permutations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelyard.llm.common import map_arrow, store

FILTERS = "ABCDE"
DUPLICATE = 1 << FILTERS.index("E")
MIN_WORDS = 100
MIN_DISTINCT_PERCENT = 80
MAX_CAPITAL_PERCENT = 10
SYMBOLS = b"#$%&*|"
_CAPITALS = bytes(range(65, 91))
_CONTINUED = bytes(range(0x80, 0xC0))

#: Bytes of text in a task's trie before it is written out, and of texts in a range partition.
WINDOW = 32 << 20
PARTITION = 64 << 20
#: Adaptive prefixes of a range partition, at least.
LEAVES = 4
#: Characters of the first adaptive prefix; each round doubles them.
FIRST_PREFIX = 4
ROW_BYTES = 100


def text_mask(text: bytes) -> int:
    """Bits of the filters A to D that a text fails."""
    words = text.split()
    n = len(words)
    mask = 1 if n < MIN_WORDS else 0
    if 100 * len(set(words)) < MIN_DISTINCT_PERCENT * n:
        mask |= 2
    capitals = len(text) - len(text.translate(None, _CAPITALS))
    if 100 * capitals > MAX_CAPITAL_PERCENT * len(text.translate(None, _CONTINUED)):
        mask |= 4
    if len(text.translate(None, SYMBOLS)) < len(text):
        mask |= 8
    return mask


def _shared(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    lo, hi = 0, n  # a[:lo] == b[:lo], a[:hi] != b[:hi]
    while hi - lo > 1:
        mid = (lo + hi) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid
    return lo


class RadixTrie:
    """A compressed trie over bytes.  A node is ``[label, children by first byte, terminal]``."""

    def __init__(self):
        self.root: list = [b"", {}, None]

    def terminal(self, text: bytes, new):
        """The terminal of ``text``, made by ``new()`` if the text is not there yet."""
        node, at = self.root, 0
        while at < len(text):
            child = node[1].get(text[at])
            if child is None:
                child = [text[at:], {}, None]
                node[1][text[at]] = child
                node = child
                break
            label = child[0]
            if text.startswith(label, at):
                node, at = child, at + len(label)
                continue
            k = _shared(label, text[at : at + len(label)])
            upper = [label[:k], {label[k]: child}, None]
            child[0] = label[k:]
            node[1][text[at]] = upper
            node, at = upper, at + k
        if node[2] is None:
            node[2] = new()
        return node[2]

    def __iter__(self) -> Iterator[tuple[bytes, object]]:
        """Texts in byte order with their terminals."""
        todo = [(self.root, b"")]
        while todo:
            node, before = todo.pop()
            text = before + node[0]
            if node[2] is not None:
                yield text, node[2]
            todo += [(node[1][b], text) for b in sorted(node[1], reverse=True)]

    def terminals(self) -> Iterator[object]:
        """Terminals in the texts' byte order."""
        todo = [self.root]
        while todo:
            _, children, end = todo.pop()
            if end is not None:
                yield end
            todo += [children[b] for b in sorted(children, reverse=True)]


class _Terminal:
    """The smallest id of one text and the rows that have it: their count by part."""

    __slots__ = ("least", "mask", "rows")

    def __init__(self):
        self.least, self.mask, self.rows = None, 0, {}

    def add(self, doc_id: int, mask: int, part: str, n: int):
        """Take a row in; rows known to have a smaller id's text are returned as ``(id, part, mask, n)``."""
        if self.least is None or doc_id < self.least:
            lost = [(self.least, p, self.mask | DUPLICATE, k) for p, k in self.rows.items()]
            self.least, self.mask, self.rows = doc_id, mask, {part: n}
            return lost
        if doc_id > self.least:
            return [(doc_id, part, mask | DUPLICATE, n)]
        self.rows[part] = self.rows.get(part, 0) + n
        return []


_ROWS = "doc_id long, part string, mask int, n long"


def _undecided(trie: RadixTrie) -> list[tuple]:
    """Rows that no smaller id was found for, once the trie is complete."""
    return [(end.least, part, end.mask, n) for end in trie.terminals() for part, n in end.rows.items()]


def _batch(rows: list[tuple], texts: list | None = None) -> pa.RecordBatch:
    ids, parts, masks, counts = zip(*rows, strict=True) if rows else ((), (), (), ())
    columns = [pa.array(ids, pa.int64()), pa.array(parts, pa.string()), pa.array(masks, pa.int32()), pa.array(counts, pa.int64())]
    names = ["doc_id", "part", "mask", "n"]
    if texts is not None:
        columns.append(pa.array(texts, pa.binary()).cast(pa.string()))
        names.append("text")
    return pa.RecordBatch.from_arrays(columns, names)


#: Rows and bytes of a batch that a task hands on.
_OUT_ROWS, _OUT_BYTES = 20_000, 4 << 20


def _window_rows(trie: RadixTrie) -> Iterator[pa.RecordBatch]:
    """The undecided rows of a window's trie, with their texts."""
    rows, texts, size = [], [], 0
    for text, end in trie:
        for part, n in end.rows.items():
            rows.append((end.least, part, end.mask, n))
            texts.append(text)
            size += len(text)
        if size > _OUT_BYTES or len(rows) > _OUT_ROWS:
            yield _batch(rows, texts)
            rows, texts, size = [], [], 0
    if rows:
        yield _batch(rows, texts)


def _scan(docs: DataFrame, window: int) -> DataFrame:
    """Stored rows ``doc_id, part, mask, n, text``: decided ones without a text, the others with it."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, held = RadixTrie(), 0
        for batch in batches:
            decided = []
            for doc_id, part, text in zip(batch.column("doc_id").to_pylist(), batch.column("part").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist(), strict=True):
                mask = text_mask(text)
                if doc_id is None:
                    decided.append((None, part, mask, 1))
                    continue
                end = trie.terminal(text, _Terminal)
                if end.least is None:
                    held += len(text) + ROW_BYTES
                decided += end.add(doc_id, mask, part, 1)
            yield _batch(decided, [None] * len(decided))
            if held > window:
                yield from _window_rows(trie)
                trie, held = RadixTrie(), 0
        yield from _window_rows(trie)

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return store(map_arrow(texts, scan, f"{_ROWS}, text string"))


def _leaves(rows: DataFrame, leaf: int) -> DataFrame:
    """``rows`` with a last column ``leaf``: the shortest adaptive prefix of the text that is not heavy."""
    size = F.octet_length("text").cast("long") + ROW_BYTES
    out, left, length = rows.withColumn("leaf", F.lit(None).cast("string")), rows, FIRST_PREFIX
    while True:
        prefix = F.substring("text", 1, length)
        sums = left.groupBy(F.xxhash64(prefix).alias("heavy")).agg(F.sum(size).alias("bytes"), F.min(F.xxhash64("text")).alias("a"), F.max(F.xxhash64("text")).alias("b"))
        heavy = store(sums.where((F.col("bytes") > leaf) & (F.col("a") != F.col("b"))).select("heavy"))
        if heavy.isEmpty():
            break
        # At most total / leaf numbers, LEAVES for each partition.
        hot = out.join(F.broadcast(heavy), F.col("leaf").isNull() & (F.xxhash64(prefix) == F.col("heavy")), "left")
        out = hot.withColumn("leaf", F.coalesce("leaf", F.when(F.col("heavy").isNull(), prefix))).drop("heavy")
        left = out.where(F.col("leaf").isNull()).drop("leaf")
        length *= 2
    return out.withColumn("leaf", F.coalesce("leaf", F.substring("text", 1, length)))


def masks(docs: DataFrame, window: int = WINDOW, leaf: int | None = None) -> DataFrame:
    """``doc_id, part, mask, n``: the failed filters' bits of every row of ``docs`` (``n`` equal rows as one)."""
    rows = _scan(docs, window)
    open_rows = rows.where(F.col("text").isNotNull())
    spark = docs.sparkSession
    total = open_rows.agg(F.sum(F.octet_length("text").cast("long") + ROW_BYTES)).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // PARTITION))

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, here, ready = RadixTrie(), None, []
        for batch in batches:
            columns = [batch.column(c) for c in ("leaf", "doc_id", "part", "mask", "n")]
            for at, doc_id, part, mask, n, text in zip(*(c.to_pylist() for c in columns), batch.column("text").cast(pa.binary()).to_pylist(), strict=True):
                if at != here:
                    ready += _undecided(trie)
                    trie, here = RadixTrie(), at
                ready += trie.terminal(text, _Terminal).add(doc_id, mask, part, n)
                if len(ready) > _OUT_ROWS:
                    yield _batch(ready)
                    ready = []
        ready += _undecided(trie)
        yield _batch(ready)

    placed = _leaves(open_rows, total // (LEAVES * parts) if leaf is None else leaf).repartitionByRange(parts, "leaf").sortWithinPartitions("leaf")
    return rows.where(F.col("text").isNull()).drop("text").unionByName(map_arrow(placed, decide, _ROWS))


def _bit(letter: str) -> int:
    return 1 << FILTERS.index(letter)


_STEPS = "filter_order string, step int, letter string, bit int, before int"


def orders() -> list[tuple]:
    """Every order of the filters and step in it: order, step, its filter, the filter's bit, the bits before it."""
    out = []
    for p in permutations(FILTERS):
        before = 0
        for k, letter in enumerate(p, 1):
            out.append(("".join(p), k, letter, _bit(letter), before))
            before |= _bit(letter)
    return out


def audit(masked: DataFrame, labels: DataFrame) -> DataFrame:
    """What each step of each filter order keeps and removes, by part."""
    said = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("quality") == 1, F.lit(False)).alias("good"), F.coalesce(F.col("toxic") == 1, F.lit(False)).alias("bad"))
    said = said.where("good OR bad").groupBy("doc_id").agg(F.max("good").alias("good"), F.max("bad").alias("bad"))
    # Documents of one mask and part are counted before anything is fanned out.
    counts = store(masked.join(said, "doc_id", "left").groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"), F.sum(F.when(F.col("bad"), F.col("n")).otherwise(0)).alias("bad")))
    steps = F.from_json(F.lit(_as_json(orders())), f"array<struct<{_STEPS.replace(' ', ':')}>>".replace(",:", ","))
    each = counts.select("*", F.inline(steps))
    fails = F.col("mask").bitwiseAND(F.col("bit")) != 0
    passed = F.col("mask").bitwiseAND(F.col("before")) == 0
    shares = F.lit(len(set(permutations(FILTERS)))) / F.bit_count("mask")  # orders in which one of the failed filters comes first

    def total(when, what="n"):
        return F.sum(F.when(when, F.col(what)).otherwise(0)).cast("long")

    return each.groupBy("part", "filter_order", "step").agg(
        total(passed & ~fails).alias("kept"),
        total(passed & fails).alias("removed"),
        total(~passed & fails).alias("redundant"),
        total(F.col("mask") == F.col("bit")).alias("unique_fails"),
        total(passed & fails, "good").alias("good_lost"),
        total(passed & fails, "bad").alias("toxic_lost"),
        F.sum(F.when(fails, F.col("n") * shares.cast("long")).otherwise(0)).cast("long").alias("shapley"),
    )


def _as_json(rows: list[tuple]) -> str:
    names = [f.split()[0] for f in _STEPS.split(", ")]
    return json.dumps([dict(zip(names, r, strict=True)) for r in rows])


def report(docs: DataFrame, labels: DataFrame, window: int = WINDOW, leaf: int | None = None) -> DataFrame:
    """``part, filter_order, step`` and the document counts of that step, zeros included."""
    return audit(masks(docs, window, leaf), labels)
