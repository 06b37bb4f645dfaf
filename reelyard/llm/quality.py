"""Quality rules: hashed n-gram log-likelihood ratio between a trusted target and the raw corpus.

Both multinomials are over hashed byte n-grams.  The raw one counts every document; the trusted one counts the
documents labelled good in three quarters of all labelled rows.  A document's score is the mean over its n-grams of
``log(p_target / p_raw)``.  The threshold is a number fitted on the last quarter of them; every document is compared with it,
without random draws.  Rule counts (symbols, repeated lines, repeated word windows) come from the same scan.

Both statistics are vectors of ``buckets`` numbers, whatever the corpus: each task sends one such vector, Spark sums
them, and the finished ratio (512 KB) goes to the tasks.  The labels' ids are broadcast while they are small, else joined
by shuffles; the threshold is found by sums over bins of the scores, so no list of scores is gathered.

Defined results: null or empty text has no words, fails the base rule and scores 0; repeated rows are judged one by
one and alike; an empty table gives an empty result; without labelled rows no target exists, so the ratio is 0 and
only the base rules decide.  Columns other than ``doc_id`` and ``text`` are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelyard.functions.joins import bounded_broadcast
from reelyard.llm.common import map_arrow, store
from reelyard.llm.textscan import Chunk, SpanHasher, grams, mix, text_chunks, word_keys

#: Hash buckets of the two multinomials.
BUCKETS = 1 << 16
#: Bytes of an n-gram.
GRAM = 4
#: Share of trusted documents that the threshold may cost at most.
MAX_LOSS = 0.002
#: How much more a lost trusted document counts than a found bad one (both as shares of their kind).
LOSS_WEIGHT = 50
#: Steps of a log ratio.
STEPS = 1 << 20
#: Bins of a unit of the score, which is between -8 and 8.
BINS = 1 << 10
_SYMBOLS = np.zeros(256, dtype=bool)
_SYMBOLS[list(b"#*$%&|<>")] = True


@dataclass(frozen=True)
class QualityModel:
    ratio: np.ndarray
    threshold: float


def _buckets(chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of the n-gram at each byte of the chunk, and whether the n-gram stays inside its document."""
    data = chunk.data
    if len(data) < GRAM:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=bool)
    n = len(data) - GRAM + 1
    h = np.zeros(n, dtype=np.uint32)
    for k in range(GRAM):
        h = h * np.uint32(256) + data[k : k + n]
    h = (h * np.uint32(2654435761)) >> np.uint32(16)
    inside = np.ones(n, dtype=bool)
    for k in range(1, GRAM):
        cut = chunk.offsets[1:-1] - k
        inside[cut[(cut >= 0) & (cut < n)]] = False
    return h.astype(np.int64), inside


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros((2, BUCKETS), dtype=np.int64)
    for batch in batches:
        trusted = batch.column("trusted").to_numpy(zero_copy_only=False).astype(bool)
        for chunk in text_chunks(batch.column("text")):
            h, inside = _buckets(chunk)
            total[0] += np.bincount(h[inside], minlength=BUCKETS)
            good = trusted[chunk.rows.start : chunk.rows.stop]
            if good.any() and len(h):
                of = np.repeat(good, np.diff(chunk.offsets))[: len(h)]
                total[1] += np.bincount(h[inside & of], minlength=BUCKETS)
    used = np.flatnonzero(total[0])
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[0][used]), pa.array(total[1][used])], ["bucket", "raw", "target"])


def _scores(chunk: Chunk, ratio: np.ndarray) -> np.ndarray:
    h, inside = _buckets(chunk)
    # In whole steps, so that a text's sum does not depend on what stands before it in the chunk.
    value = np.zeros(len(chunk.data), dtype=np.int64)
    value[: len(h)] = np.where(inside, np.rint(ratio * STEPS).astype(np.int64)[h], 0)
    n = np.maximum(np.diff(chunk.offsets) - GRAM + 1, 0)
    return np.where(n > 0, chunk.per_doc(value) / (np.maximum(n, 1) * STEPS), 0.0)


def _repeated_words(words: np.ndarray, doc: np.ndarray, docs: int) -> np.ndarray:
    """Words that lie in a 3-word window found twice or more in their document."""
    h, at = grams(words, doc, 3)
    if not len(h):
        return np.zeros(docs, dtype=np.int64)
    key = mix(h + doc[at].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    order = np.argsort(key)
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(len(h), dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(words), dtype=bool)
    for k in range(3):
        covered[at[twice] + k] = True
    return np.bincount(doc[covered], minlength=docs)


def _duplicate_lines(chunk: Chunk, start: np.ndarray) -> np.ndarray:
    """Lines with a word that equal an earlier line of their document; ``start``: where words start."""
    lo, hi, doc = chunk.lines()
    filled = np.searchsorted(start, hi) > np.searchsorted(start, lo)
    lo, hi, doc = lo[filled], hi[filled], doc[filled]
    key = np.stack([doc.astype(np.uint64), SpanHasher(chunk.data)(lo, hi)])
    distinct = np.unique(key, axis=1)[0].astype(np.int64)
    out = np.bincount(doc, minlength=len(chunk)) - np.bincount(distinct, minlength=len(chunk))
    for i in np.flatnonzero(out):  # few documents: lines with equal hashes are compared
        own = slice(*np.searchsorted(doc, [i, i + 1]))
        lines = [chunk.data[a:b].tobytes() for a, b in zip(lo[own].tolist(), hi[own].tolist(), strict=True)]
        out[i] = len(lines) - len(set(lines))
    return out


def _judge(batches: Iterator[pa.RecordBatch], model: QualityModel) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns: list[list[np.ndarray]] = [[] for _ in range(6)]
        for chunk in text_chunks(batch.column("text")):
            start, end, doc = chunk.words()
            lead = np.zeros(len(chunk.data) + 1, dtype=np.int64)
            np.cumsum((chunk.data & 0xC0) != 0x80, out=lead[1:])
            chars = np.bincount(doc, weights=lead[end] - lead[start], minlength=len(chunk)).astype(np.int64)
            for out, value in zip(
                columns,
                (
                    np.bincount(doc, minlength=len(chunk)),
                    chars,
                    chunk.per_doc(_SYMBOLS[chunk.data]),
                    _duplicate_lines(chunk, start),
                    _repeated_words(word_keys(chunk.data, start, end), doc, len(chunk)),
                    _scores(chunk, model.ratio),
                ),
                strict=True,
            ):
                out.append(value)
        if not batch.num_rows:
            continue
        n_words, chars, symbols, dup, repeat, llr = (np.concatenate(x) for x in columns)
        failed = (n_words < 50) | (100 * repeat > 50 * n_words)
        kept = ~failed & (llr >= model.threshold)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *map(pa.array, (n_words, chars, symbols, dup, repeat, failed, kept, llr))],
            ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "llr"],
        )


REPORT = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, llr double"


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def fit(docs: DataFrame, labels: DataFrame) -> QualityModel:
    """Count both multinomials and fit the threshold on all labelled rows (``labels``: doc_id, quality)."""
    known = labels.select("doc_id", "quality").where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    known, _ = bounded_broadcast(store(known).withColumnRenamed("doc_id", "label_id"))
    marked = _texts(docs).join(known, F.col("doc_id") == F.col("label_id"), "left")
    # A quarter stays out of the target: a document that was counted in it looks better than others like it.
    aside = F.pmod(F.xxhash64(F.lit("part"), "label_id"), F.lit(4)) == 0
    trusted = F.coalesce((F.col("quality") == 1) & ~aside, F.lit(False)).alias("trusted")
    counts = map_arrow(marked.select("text", trusted), _count, "bucket long, raw long, target long")
    vectors = counts.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).toPandas()  # at most BUCKETS rows
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    raw[vectors["bucket"]], target[vectors["bucket"]] = vectors["raw"], vectors["target"]
    if not target.sum():
        return QualityModel(np.zeros(BUCKETS), -np.inf)
    # The target is smoothed by the raw frequencies of its buckets: a bucket that it never saw keeps a small share.
    share = raw / raw.sum()
    ratio = np.log((target + 0.5 * share * BUCKETS / 1000 + 1e-9) / (target.sum() + 0.5 * BUCKETS / 1000)) - np.log(np.maximum(share, 1e-15))
    ratio[raw == 0] = 0.0
    first = QualityModel(np.clip(ratio, -8.0, 8.0), -np.inf)
    judged = report(marked.where(F.col("label_id").isNotNull() & aside).select("doc_id", "text"), first)
    told = judged.where("NOT base_failed").join(known, F.col("doc_id") == F.col("label_id")).select("llr", (F.col("quality") == 1).alias("good"))
    return QualityModel(first.ratio, _threshold(store(told)))


def _threshold(told: DataFrame) -> float:
    """The cut that finds most bad documents against ``LOSS_WEIGHT`` times the good ones lost, at most ``MAX_LOSS``.

    ``told``: ``llr, good`` of the documents.  A cut is a good document's score or lies just above a bad one's.
    """
    fine, bad = told.agg(F.count_if("good"), F.count_if(~F.col("good"))).first()
    if not fine or not bad:
        return -np.inf
    values = told.select("llr", F.col("good").cast("long").alias("fine"), (~F.col("good")).cast("long").alias("bad"), F.col("good").alias("cut"))
    above = told.where(~F.col("good")).select(F.col("llr") + 1e-9, F.lit(0), F.lit(0), F.lit(True))
    points = values.union(above).groupBy("llr").agg(F.sum("fine").alias("fine"), F.sum("bad").alias("bad"), F.bool_or("cut").alias("cut"))
    points = store(points.withColumn("bin", F.floor(F.col("llr") * BINS)))
    below = Window.rowsBetween(Window.unboundedPreceding, -1)
    order, inner = below.orderBy("bin"), below.partitionBy("bin").orderBy("llr")
    bins = points.groupBy("bin").agg(F.sum("fine").alias("fine"), F.sum("bad").alias("bad"))  # at most 16 * BINS rows
    bins = bins.select("bin", *[F.coalesce(F.sum(c).over(order), F.lit(0)).alias(f"{c}_below") for c in ("fine", "bad")])
    sums = [(F.col(f"{c}_below") + F.coalesce(F.sum(c).over(inner), F.lit(0))).alias(c) for c in ("fine", "bad")]
    cuts = points.join(F.broadcast(bins), "bin").select("llr", "cut", *sums).where("cut")
    cuts = cuts.select("llr", (F.col("fine") / fine).alias("lost"), (F.col("bad") / bad).alias("found")).where(F.col("lost") <= MAX_LOSS)
    gains = cuts.groupBy((F.col("found") - LOSS_WEIGHT * F.col("lost")).alias("gain")).agg(F.min("llr").alias("least"), F.max("llr").alias("most"))
    best = gains.orderBy(F.desc("gain")).first()
    return (best["least"] + best["most"]) / 2  # the middle of the gap between bad and good


def report(docs: DataFrame, model: QualityModel) -> DataFrame:
    """One row per document: rule counts, verdict and score."""
    return map_arrow(_texts(docs), lambda batches: _judge(batches, model), REPORT)


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that pass, with their own columns."""
    model = fit(docs, labels)
    # The verdict is taken beside the row itself, so no join is needed and repeated ids stay apart.
    schema = docs.schema

    def passing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pair = pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text")], ["doc_id", "text"])
            for verdict in _judge(iter([pair]), model):
                yield batch.filter(verdict.column("kept"))

    return map_arrow(docs, passing, schema)
