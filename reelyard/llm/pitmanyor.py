"""LM scoring: a hierarchical Pitman-Yor bigram model.

Every context word has a restaurant whose customers are the training tokens that follow it; the tables of all these
restaurants are the customers of one shared parent restaurant, whose tables are the known words: a new table there is a
word never seen, so the parent's new-table probability is that of "an unknown word".  Seating (how many tables a
context's customers of one word share) is sampled by Gibbs sweeps, and the predictive probabilities of ``SAMPLES``
seatings are averaged.  Discounts come from the counts of ones and twos.

How it runs (a token is a word or the end of a document; the end also stands before the first word):

1. Blocks.  One scan turns documents into blocks of about ``BLOCK_TOKENS`` tokens: the distinct words once, and every
   token as an index into them.
2. Words.  The blocks' word lists are dealt by hash; each word gets its training count and a number, sent back.
3. Bigrams.  The blocks' distinct bigrams are dealt by context.  A context with more than 1/``HEAVY`` of all tokens
   is dealt over all shards by the word that follows, so no shard is hot.  A shard counts its bigrams, samples their
   seating (with a parent restaurant of its own tables, scaled), and answers every block.
4. Parents.  The tables of each word are summed over the shards and sent back, too.
5. Scores.  Blocks meet their answers and score their documents.

Words are known by 64-bit hashes.  Steps 2 to 4 are shuffles of packed lists (a row for each block and shard), so a very
common word or bigram is one entry of each block.  What moves, and the model, grow with the corpus.

Defined results: null and empty texts are one end token; repeated rows are documents of their own; an empty table gives
an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelyard.llm.common import crc_fold, discard, map_arrow, shared_folder, store
from reelyard.llm.packing import pack, pack_sorted, unpack, unpack_sorted
from reelyard.llm.textscan import mix, text_chunks, word_keys

BLOCK_TOKENS = 1_000_000
HEAVY = 1000
#: Strength of a context's and of the parent restaurant.
THETA, PARENT_THETA = 1.0, 1.0
BURN_IN, SAMPLES = 4, 3
#: Customers seated one by one; more are seated in groups that grow by a quarter.
ONE_BY_ONE = 32
END = np.uint64(0)

BLOCKS = "block long, words binary, counts binary, tokens binary, doc_ids array<long>, held array<boolean>, sizes array<int>"
#: Rows that go between blocks and shards; what ``a`` to ``d`` hold depends on the kind.
ROWS = "kind int, block long, shard int, a binary, b binary, c binary, d binary"
ROW_TYPES = [pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary()]
WORD, BIGRAM, PARENT, TABLES, SHARD = 1, 2, 3, 4, 5


def _batch(rows: list[tuple], types: list, names: str) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(types)
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], [f.split()[0] for f in names.split(", ")])


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    return _batch([r + (None,) * (7 - len(r)) for r in rows], ROW_TYPES, ROWS)


# --- 1. blocks


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    types = [pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int32())]
    block = TaskContext.get().partitionId() << 32
    tokens: list[np.ndarray] = []
    ids, held, sizes = [], [], []

    def finish() -> pa.RecordBatch:
        words, index = np.unique(np.concatenate(tokens), return_inverse=True)
        training = np.repeat(~np.array(held), sizes)
        counts = np.bincount(index[training], minlength=len(words))
        return _batch([(block, pack_sorted(words), pack(counts), pack(index), ids, held, sizes)], types, BLOCKS)

    for batch in batches:
        flags = batch.column("held").to_pylist()
        doc_ids = batch.column("doc_id").to_pylist()
        for chunk in text_chunks(batch.column("text")):
            start, end, doc = chunk.words()
            words = np.maximum(word_keys(chunk.data, start, end, lower=True), np.uint64(1))
            last = np.searchsorted(doc, np.arange(1, len(chunk) + 1))
            tokens.append(np.insert(words, last, END))
            sizes += (np.bincount(doc, minlength=len(chunk)) + 1).tolist()
            ids += doc_ids[chunk.rows.start : chunk.rows.stop]
            held += flags[chunk.rows.start : chunk.rows.stop]
            if sum(map(len, tokens)) >= BLOCK_TOKENS:
                yield finish()
                block += 1
                tokens, ids, held, sizes = [], [], [], []
    if tokens:
        yield finish()


# --- 2. words


def _word_rows(batches: Iterator[pa.RecordBatch], shards: int) -> Iterator[pa.RecordBatch]:
    """Each shard gets a range of hashes of every block's words."""
    bounds = np.array([min(-(-(k << 64) // shards), 2**64 - 1) for k in range(1, shards)], dtype=np.uint64)
    for batch in batches:
        for row in batch.select(["block", "words", "counts"]).to_pylist():
            words, counts = unpack_sorted(row["words"]).astype(np.uint64), unpack(row["counts"])
            cut = [0, *np.searchsorted(words, bounds).tolist(), len(words)]
            yield _rows([(WORD, row["block"], s, pack_sorted(words[a:b]), pack(counts[a:b])) for s, (a, b) in enumerate(zip(cut[:-1], cut[1:], strict=True)) if b > a])


def _by_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """All rows of a shard at a time, from rows sorted by shard."""
    rows: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if rows and row["shard"] != rows[0]["shard"]:
                yield rows
                rows = []
            rows.append(row)
    if rows:
        yield rows


def _number_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Training counts and numbers (0: most frequent of the shard) of the words, back to each block."""
    for rows in _by_shard(batches):
        lists = [unpack_sorted(r["a"]).astype(np.uint64) for r in rows]
        _, which = np.unique(np.concatenate(lists), return_inverse=True)
        total = np.bincount(which, weights=np.concatenate([unpack(r["b"]) for r in rows])).astype(np.int64)
        order = np.argsort(-total, kind="stable")
        rank = np.empty(len(order), dtype=np.int64)
        rank[order] = np.arange(len(order))
        ends = np.cumsum([len(x) for x in lists])
        out = [(WORD, r["block"], r["shard"], pack(rank[w]), pack(total[w])) for r, w in zip(rows, np.split(which, ends[:-1]), strict=True)]
        head = total[order[:HEAVY]]
        # The shard's own row: how many words and training tokens it has, and its most frequent words.
        out.append((SHARD, int(total.sum()), rows[0]["shard"], pack(head), pack(np.array([(total > 0).sum()]))))
        yield _rows(out)


def _join_words(batches: Iterator[pa.RecordBatch], shards: int, n: int, v: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by block, its own row first: numbers and counts of its words, and the base score of its documents."""
    for head, answers in _by_block(batches):
        numbers = np.concatenate([unpack(r["a"]) * shards + r["shard"] for r in answers])
        counts = np.concatenate([unpack(r["b"]) for r in answers])
        index, sizes = unpack(head["tokens"]), np.array(head["sizes"])
        at = np.cumsum(sizes) - sizes
        log = np.log10((counts + 0.5) / (n + 0.5 * (v + 1)))
        base = np.add.reduceat(log[index], at)
        known = np.add.reduceat((counts > 0).astype(np.int64)[index], at)
        yield _batch(
            [(head["block"], pack(numbers), pack(counts), head["tokens"], head["doc_ids"], head["held"], head["sizes"], base.tolist(), known.tolist())],
            [pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int32()), pa.list_(pa.float64()), pa.list_(pa.int64())],
            NUMBERED,
        )


NUMBERED = BLOCKS.replace("words binary", "numbers binary") + ", base array<double>, known array<long>"


def _by_block(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, list[dict]]]:
    """A block's own row (kind 0) and its answers, from rows sorted by block, kind and shard."""
    head, answers = None, []
    for batch in batches:
        for row in batch.to_pylist():
            if row["kind"] == 0:
                if head:
                    yield head, answers
                head, answers = row, []
            else:
                answers.append(row)
    if head:
        yield head, answers


# --- 3. bigrams


class _Bigrams:
    """The distinct bigrams of a block with known words on both sides, in the order in which shards get them."""

    def __init__(self, row: dict, shards: int, heavy: np.ndarray):
        numbers, counts, index = unpack(row["numbers"]), unpack(row["counts"]), unpack(row["tokens"])
        sizes = np.array(row["sizes"])
        first = np.cumsum(sizes) - sizes
        before = np.empty_like(index)
        before[1:] = index[:-1]
        before[first] = index[first[-1] + sizes[-1] - 1]  # the end token stands before every first word
        self.counts, self.index, self.before, self.first = counts, index, before, first
        seen = (counts[index] > 0) & (counts[before] > 0)
        key = (numbers[before].astype(np.uint64) << np.uint64(32)) | numbers[index].astype(np.uint64)
        keys, which = np.unique(key[seen], return_inverse=True)
        training = np.repeat(~np.array(row["held"]), sizes)[seen]
        tokens = np.bincount(which[training], minlength=len(keys))
        u, w = keys >> np.uint64(32), keys & np.uint64(0xFFFFFFFF)
        salt = np.where(np.isin(u, heavy), mix(w + np.uint64(1)), np.uint64(0))
        shard = ((mix(u + np.uint64(1)) + salt) % np.uint64(shards)).astype(np.int64)
        order = np.argsort(shard, kind="stable")
        self.keys, self.tokens, self.shard = keys[order], tokens[order], shard[order]
        rank = np.empty(len(order), dtype=np.int64)
        rank[order] = np.arange(len(order))
        self.seen, self.which = seen, rank[which]
        self.cut = np.searchsorted(self.shard, np.arange(shards + 1))


def _bigram_rows(batches: Iterator[pa.RecordBatch], shards: int, heavy: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            b = _Bigrams(row, shards, heavy)
            out = []
            for s in np.flatnonzero(np.diff(b.cut)):
                part = slice(b.cut[s], b.cut[s + 1])
                u, n = np.unique(b.keys[part] >> np.uint64(32), return_counts=True)
                out.append((BIGRAM, row["block"], int(s), pack_sorted(u), pack(n), pack(b.keys[part] & np.uint64(0xFFFFFFFF)), pack(b.tokens[part])))
            # The same block asks for the tables of its words.
            numbers = np.sort(unpack(row["numbers"]))
            of = numbers % shards
            order = np.argsort(of, kind="stable")
            cut = np.searchsorted(of[order], np.arange(shards + 1))
            out += [(PARENT, row["block"], int(s), pack_sorted(numbers[order][cut[s] : cut[s + 1]] // shards)) for s in np.flatnonzero(np.diff(cut))]
            yield _rows(out)


def discount(ones: float, twos: float) -> float:
    return float(np.clip((ones + 1) / (ones + 2 * twos + 2), 0.05, 0.95))


def seat(customers: np.ndarray, new: np.ndarray, d: float, rng: np.random.Generator) -> np.ndarray:
    """Tables of ``customers`` seated one after the other; ``new`` is each dish's weight of a new table."""
    tables = np.ones(len(customers), dtype=np.int64)
    open_ = np.flatnonzero(customers > 1)
    seated = 1
    while len(open_):
        group = 1 if seated < ONE_BY_ONE else max(1, seated // 4)
        t = tables[open_]
        p = new[open_] / (new[open_] + seated - d * t)
        arriving = np.minimum(group, customers[open_] - seated)
        if group == 1:
            tables[open_] += rng.random(len(open_)) < p
        else:
            tables[open_] += rng.binomial(arriving, np.clip(p, 0.0, 1.0))
        seated += group
        open_ = open_[customers[open_] > seated]
    return np.minimum(tables, customers)


def gibbs(u: np.ndarray, w: np.ndarray, c: np.ndarray, scale: np.ndarray, d: float, rng: np.random.Generator) -> np.ndarray:
    """``SAMPLES`` seatings: tables of each bigram (context ``u``, word ``w``, ``c`` customers; indexes from 0).

    ``scale`` is how many times more tables a context has elsewhere, as for contexts dealt over several shards.
    """
    tables = np.ones(len(c), dtype=np.int64)
    many = np.flatnonzero(c > 1)
    out = np.ones((SAMPLES, len(c)), dtype=np.int64)
    if not len(many):
        return out
    for sweep in range(BURN_IN + SAMPLES):
        context = np.bincount(u, weights=tables)[u[many]] * scale[many]
        parent = np.bincount(w, weights=tables)[w[many]]
        # Without the tables of the bigram itself.
        own = tables[many]
        p = np.maximum(parent - own, 0.5) / (tables.sum() + PARENT_THETA)
        tables[many] = seat(c[many], (THETA + d * np.maximum(context - own, 0.0)) * p, d, rng)
        if sweep >= BURN_IN:
            out[sweep - BURN_IN] = tables
    return out


def _seat_shards(batches: Iterator[pa.RecordBatch], shards: int, heavy: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Count and seat a shard's bigrams; answer the blocks; tell the words' shards how many tables they have."""
    for rows in _by_shard(batches):
        shard = rows[0]["shard"]
        keys = [np.repeat(unpack_sorted(r["a"]).astype(np.uint64), unpack(r["b"])) << np.uint64(32) | unpack(r["c"]).astype(np.uint64) for r in rows]
        ends = np.cumsum([len(k) for k in keys])
        distinct, which = np.unique(np.concatenate(keys), return_inverse=True)
        del keys
        c = np.bincount(which, weights=np.concatenate([unpack(r["d"]) for r in rows])).astype(np.int64)
        trained = np.flatnonzero(c)
        contexts, u = np.unique(distinct[trained] >> np.uint64(32), return_inverse=True)
        words, w = np.unique(distinct[trained] & np.uint64(0xFFFFFFFF), return_inverse=True)
        ones, twos = (c == 1).sum(), (c == 2).sum()
        spread = np.where(np.isin(contexts, heavy), float(shards), 1.0)
        tables = np.zeros((SAMPLES, len(c)), dtype=np.int64)
        if len(trained):
            tables[:, trained] = gibbs(u, w, c[trained], spread[u], discount(ones, twos), np.random.default_rng(shard))
        by_context = np.stack([np.bincount(u, weights=t[trained], minlength=len(contexts)).astype(np.int64) for t in tables])
        by_word = np.stack([np.bincount(w, weights=t[trained], minlength=len(words)).astype(np.int64) for t in tables])
        out = []
        for r, own in zip(rows, np.split(which, ends[:-1]), strict=True):
            asked = unpack_sorted(r["a"]).astype(np.uint64)
            at = np.minimum(np.searchsorted(contexts, asked), max(len(contexts) - 1, 0))
            there = (contexts[at] == asked) if len(contexts) else np.zeros(len(asked), dtype=bool)
            told = np.where(there, by_context[:, at] if len(contexts) else np.zeros((SAMPLES, 1), dtype=np.int64), 0)
            out.append((BIGRAM, r["block"], shard, pack(c[own]), pack(tables[:, own].reshape(-1)), r["a"], pack(told.reshape(-1))))
        order = np.argsort(words % np.uint64(shards), kind="stable")
        cut = np.searchsorted((words % np.uint64(shards))[order], np.arange(shards + 1, dtype=np.uint64))
        for s in np.flatnonzero(np.diff(cut)):
            part = order[cut[s] : cut[s + 1]]
            out.append((TABLES, -1, int(s), pack_sorted(words[part] // np.uint64(shards)), pack(by_word[:, part].reshape(-1))))
        hot = np.flatnonzero(np.isin(contexts, heavy))
        out.append((SHARD, -1, shard, pack(np.array([ones, twos])), pack(contexts[hot]), pack(by_context[:, hot].reshape(-1))))
        yield _rows(out)


# --- 4. parents


def _sum_tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sum each word's tables over the shards and answer the blocks."""
    for rows in _by_shard(batches):
        told = [r for r in rows if r["kind"] == TABLES]
        asked = [r for r in rows if r["kind"] == PARENT]
        ranks = [unpack_sorted(r["a"]).astype(np.int64) for r in told]
        size = max([int(x[-1]) + 1 for x in ranks] + [int(unpack_sorted(r["a"])[-1]) + 1 for r in asked] + [0])
        total = np.zeros((SAMPLES, size), dtype=np.int64)
        for rank, r in zip(ranks, told, strict=True):
            total[:, rank] += unpack(r["b"]).astype(np.int64).reshape(SAMPLES, -1)
        out = []
        for r in asked:
            rank = unpack_sorted(r["a"]).astype(np.int64)
            out.append((PARENT, r["block"], r["shard"], r["a"], pack(total[:, rank].reshape(-1))))
        some = total.astype(float).mean(axis=0)
        out.append((SHARD, -2, rows[0]["shard"], pack(np.array([(total[0] == 1).sum(), (total[0] == 2).sum()])), pack(total.sum(axis=1)), pack(np.array([(some > 0).sum()]))))
        yield _rows(out)


# --- 5. scores

SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def _score(batches: Iterator[pa.RecordBatch], shards: int, model: dict) -> Iterator[pa.RecordBatch]:
    heavy, heavy_tables = model["heavy"], model["heavy_tables"]
    d, parent_d = model["discount"], model["parent_discount"]
    for head, answers in _by_block(batches):
        b = _Bigrams(head, shards, heavy)
        numbers = unpack(head["numbers"])
        position = np.argsort(numbers)
        ordered = numbers[position]
        bigrams = [r for r in answers if r["kind"] == BIGRAM]
        c = np.concatenate([np.zeros(0, np.int64), *[unpack(r["a"]) for r in bigrams]])
        tables = np.concatenate([np.zeros((SAMPLES, 0), np.int64), *[unpack(r["b"]).reshape(SAMPLES, -1) for r in bigrams]], axis=1)
        in_context, in_parent = np.zeros((SAMPLES, len(numbers))), np.zeros((SAMPLES, len(numbers)))
        for r in answers:
            if r["kind"] == BIGRAM:
                who, told = unpack_sorted(r["c"]).astype(np.int64), unpack(r["d"]).reshape(SAMPLES, -1)
            else:
                who, told = unpack_sorted(r["a"]).astype(np.int64) * shards + r["shard"], unpack(r["b"]).reshape(SAMPLES, -1)
            at = position[np.searchsorted(ordered, who)]
            (in_context if r["kind"] == BIGRAM else in_parent)[:, at] = told
        hot = np.isin(numbers, heavy)
        in_context[:, hot] = heavy_tables[:, np.searchsorted(heavy, numbers[hot].astype(np.uint64))]
        known = b.counts > 0
        p = np.zeros(len(b.index))
        for s in range(SAMPLES):
            everyone = model["customers"][s]
            new_word = (PARENT_THETA + parent_d * model["words"]) / (PARENT_THETA + everyone)
            parent = np.where(known, (in_parent[s] - parent_d) / (PARENT_THETA + everyone), new_word)
            left = np.where(known, (THETA + d * in_context[s]) / (THETA + b.counts), 1.0)
            one = left[b.before] * parent[b.index]
            own = np.maximum(c - d * tables[s], 0.0)
            one[b.seen] += own[b.which] / (THETA + b.counts[b.before[b.seen]])
            p += one
        log = np.log10(p / SAMPLES)
        score = np.add.reduceat(log, b.first)
        yield _batch(list(zip(head["doc_ids"], head["held"], head["sizes"], head["known"], head["base"], score.tolist(), strict=True)), [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64()], SCORES)


def _union(own: DataFrame, answers: DataFrame, shards: int) -> DataFrame:
    """Blocks and their answers, together and in order."""
    both = own.withColumn("kind", F.lit(0)).unionByName(answers.where("block >= 0 AND kind <> 5"), allowMissingColumns=True)
    return both.repartition(shards, "block").sortWithinPartitions("block", "kind", "shard")


def _dealt(rows: DataFrame, shards: int) -> DataFrame:
    return rows.repartition(shards, "shard").sortWithinPartitions("shard", "kind", "block")


def score(docs: DataFrame, shards: int | None = None) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every document."""
    spark: SparkSession = docs.sparkSession
    shards = shards or 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(crc_fold() == 1, F.lit(False)).alias("held"), F.col("text").cast("string").alias("text"))
    used = [shared_folder(spark), shared_folder(spark)]
    blocks = store(map_arrow(texts, _blocks, BLOCKS), used[0])
    words = store(map_arrow(_dealt(map_arrow(blocks, lambda b: _word_rows(b, shards), ROWS), shards), _number_words, ROWS), used[1])
    heads = words.where(F.col("kind") == SHARD).select("block", "shard", "a", "b").toPandas()  # a row for each shard
    n, v = int(heads["block"].sum()), int(sum(unpack(x)[0] for x in heads["b"]))
    heavy = np.sort(np.array([r * shards + s for s, a in zip(heads["shard"], heads["a"], strict=True) for r, c in enumerate(unpack(a)) if c * HEAVY > n], dtype=np.uint64))
    numbered = store(map_arrow(_union(blocks, words, shards), lambda b: _join_words(b, shards, n, v), NUMBERED))
    discard(spark, *used)  # all that follows reads ``numbered``

    asked = map_arrow(numbered, lambda b: _bigram_rows(b, shards, heavy), ROWS)
    seated = store(map_arrow(_dealt(asked.where(F.col("kind") == BIGRAM), shards), lambda b: _seat_shards(b, shards, heavy), ROWS))
    parents = store(map_arrow(_dealt(seated.where(F.col("kind") == TABLES).unionByName(asked.where(F.col("kind") == PARENT)), shards), _sum_tables, ROWS))

    model = _summary(seated, parents, heavy, v)
    answers = seated.where(F.col("kind") == BIGRAM).unionByName(parents.where(F.col("kind") == PARENT))
    scored = map_arrow(_union(numbered, answers, shards), lambda b: _score(b, shards, model), SCORES)
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score", "score")


def _summary(seated: DataFrame, parents: DataFrame, heavy: np.ndarray, v: int) -> dict:
    """Discounts, totals and the tables of the heavy contexts (at most ``HEAVY``): a few numbers from each shard."""
    ones = np.zeros(2)
    heavy_tables = np.zeros((SAMPLES, len(heavy)))
    for r in seated.where(F.col("kind") == SHARD).select("a", "b", "c").toLocalIterator():
        ones += unpack(r.a)
        at = np.searchsorted(heavy, unpack(r.b).astype(np.uint64))
        heavy_tables[:, at] += unpack(r.c).reshape(SAMPLES, -1)
    parent_ones, customers = np.zeros(2), np.zeros(SAMPLES)
    for r in parents.where(F.col("kind") == SHARD).select("a", "b").toLocalIterator():
        parent_ones += unpack(r.a)
        customers += unpack(r.b)
    return {"heavy": heavy, "heavy_tables": heavy_tables, "discount": discount(*ones), "parent_discount": discount(*parent_ones), "customers": customers, "words": v}
