"""Toxicity: class-conditional Kneser-Ney models compared by length-normalised log-likelihood.

A word is a sequence of bytes (A-Z lower-cased) after a start mark.  For each class, toxic and ordinary, an
interpolated Kneser-Ney model of order ``ORDER`` gives each byte's probability in its context; the discounted mass of
both goes to one shared backoff model.  That is Kneser-Ney again, order by order down to single bytes and then to all
256 alike: a shorter n-gram counts the different symbols seen before it in either class, and every order has a discount
of its own, from its counts of ones and twos.  So an expression that neither class has seen gets the same probability
from both, but for how much mass each has left in its context, and a rare one weighs little.

The models compare as ``log p_toxic - log p_ordinary``.  A document gives two length-normalised values: the mean over its
bytes, and the largest mean over the bytes of one word (totals would favour long words, such as random keys).  A logistic scale fitted on labelled documents that the models have
not seen turns them into the score; empty texts get the value of "no evidence".

The labelled rows used are a bounded sample (``LABELLED_ROWS``, smallest id hashes, never a held-out row), so the
model's size is bounded too and it goes to the tasks whole; every document is scored from its whole text, in place.

Defined results: null, empty or wordless texts score the "no evidence" value; repeated rows score alike; without
labelled rows of both classes every score is 0; an empty table gives an empty result; columns other than ``doc_id``
and ``text`` are never read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelyard.llm.common import bounded_sample, crc_fold, map_arrow, store
from reelyard.llm.textscan import Chunk, SpanHasher, text_chunks

#: Bytes of an n-gram, the last of which is predicted.
ORDER = 6
#: Bound on the labelled rows; three quarters train the models, one quarter the logistic scale.
LABELLED_ROWS = 16_000
_START = np.uint64(0xA0761D6478BD642F)
#: An n-gram, its context, and its shorter n-grams with their contexts (one symbol less at the front each time).
GRAMS = "gram long, context long, lows array<long>, low_contexts array<long>, toxic long, plain long"


@dataclass(frozen=True)
class ToxicityModel:
    grams: np.ndarray
    gram_values: np.ndarray
    contexts: np.ndarray
    context_values: np.ndarray
    weights: np.ndarray


def _distinct_words(chunk: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, SpanHasher]:
    """Start and end of the distinct words, the word of each occurrence, the document of each occurrence."""
    start, end, doc = chunk.words()
    span = SpanHasher(chunk.data, lower=True)
    _, first, which = np.unique(span(start, end), return_index=True, return_inverse=True)
    return start[first], end[first], which, doc, span


def _grams(start: np.ndarray, end: np.ndarray, span: SpanHasher) -> tuple[np.ndarray, ...]:
    """For every byte of the words: its word, n-gram, context, place, and where the n-gram without its first symbol starts."""
    size = end - start
    word = np.repeat(np.arange(len(start)), size)
    at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + start[word]
    lo = np.maximum(start[word], at - (ORDER - 1))
    # The start mark is a symbol of its own: with it, the n-gram reaches back to the word's start.
    anchored = at - start[word] < ORDER - 1
    mark = np.where(anchored, _START, np.uint64(0))
    return word, span(lo, at + 1) ^ mark, span(lo, at) ^ mark, at, np.where(anchored, lo, lo + 1)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        toxic = batch.column("toxic").to_numpy(zero_copy_only=False)
        for chunk in text_chunks(batch.column("text")):
            start, end, which, doc, span = _distinct_words(chunk)
            if not len(start):
                continue
            of = toxic[chunk.rows.start + doc] == 1
            n_toxic = np.bincount(which[of], minlength=len(start))
            n_plain = np.bincount(which[~of], minlength=len(start))
            word, gram, context, at, low = _grams(start, end, span)
            _, first, same = np.unique(gram, return_index=True, return_inverse=True)
            counts = [np.bincount(same, weights=n[word]).astype(np.int64) for n in (n_toxic, n_plain)]
            at, low = at[first], low[first]
            many = at - low + 1  # shorter n-grams: down to the byte itself
            of = np.repeat(np.arange(len(at)), many)
            lo = low[of] + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            bounds = pa.array(np.append(0, np.cumsum(many)), pa.int32())
            lists = [pa.ListArray.from_arrays(bounds, pa.array(span(lo, hi).view(np.int64))) for hi in (at[of] + 1, at[of])]
            yield pa.RecordBatch.from_arrays([pa.array(x[first].view(np.int64)) for x in (gram, context)] + lists + [pa.array(c) for c in counts], [f.split()[0] for f in GRAMS.split(", ")])


def _evidence(chunk: Chunk, model: ToxicityModel) -> np.ndarray:
    """The two length-normalised values of each document."""
    out = np.zeros((len(chunk), 2))
    start, end, which, doc, span = _distinct_words(chunk)
    if not len(start):
        return out
    word, gram, context, *_ = _grams(start, end, span)
    value = _look_up(context, model.contexts, model.context_values, 0.0)
    value = _look_up(gram, model.grams, model.gram_values, value)
    total = np.bincount(word, weights=value, minlength=len(start))
    size = (end - start).astype(float)
    at = np.flatnonzero(np.append(True, doc[1:] != doc[:-1]))
    own = doc[at]
    out[own, 0] = np.add.reduceat(total[which], at) / np.add.reduceat(size[which], at)
    out[own, 1] = np.maximum.reduceat((total / (size + 1))[which], at)
    return out


def _look_up(keys: np.ndarray, known: np.ndarray, values: np.ndarray, default: np.ndarray | float) -> np.ndarray:
    if not len(known):
        return np.broadcast_to(np.asarray(default, dtype=float), keys.shape)
    at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    return np.where(known[at] == keys, values[at], default)


def discount(ones: int, twos: int) -> float:
    return (ones + 1) / (ones + 2 * twos + 2)


def _backoff(grams: DataFrame) -> DataFrame:
    """``low, backoff``: the shared probability of every shorter n-gram, all orders, down to the byte itself.

    An n-gram's count is the number of different n-grams, one symbol longer, that end with it.
    """
    parent = F.concat(F.array("gram"), F.slice("lows", 1, F.size("lows") - 1))
    rest = F.concat(F.slice("lows", 2, F.size("lows")), F.array(F.lit(None).cast("long")))
    steps = F.arrays_zip(F.col("lows").alias("low"), F.col("low_contexts").alias("low_context"), parent.alias("parent"), rest.alias("next"))
    each = grams.select(F.posexplode(steps).alias("k", "s"), F.size("lows").alias("n")).select((F.col("n") - F.col("k") - 1).alias("order"), "s.*")
    counted = store(each.groupBy("order", "low", "low_context", "next").agg(F.count_distinct("parent").alias("n")))
    sums = counted.groupBy("order").agg(F.count_if(F.col("n") == 1).alias("ones"), F.count_if(F.col("n") == 2).alias("twos"))
    discounts = {r["order"]: discount(r["ones"], r["twos"]) for r in sums.collect()}  # ORDER rows at most
    contexts = counted.groupBy("order", "low_context").agg(F.sum("n").alias("all"), F.count(F.lit(1)).alias("types"))
    below = None
    done = []
    for order in sorted(discounts):
        d = discounts[order]
        here = counted.where(F.col("order") == order).join(contexts.where(F.col("order") == order).drop("order"), "low_context")
        if below is None:
            here = here.withColumn("p", F.lit(1 / 256))
        else:
            here = here.join(below.select(F.col("low").alias("next"), F.col("backoff").alias("p")), "next", "left").withColumn("p", F.coalesce("p", F.lit(1 / 256)))
        p = F.greatest(F.col("n") - d, F.lit(0.0)) / F.col("all") + d * F.col("types") / F.col("all") * F.col("p")
        below = store(here.select("low", p.alias("backoff")))
        done.append(below)
    out = grams.select(F.lit(0).cast("long").alias("low"), F.lit(0.0).alias("backoff")).limit(0)
    for part in done:
        out = out.unionByName(part)
    return out


def _ratios(counts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The log ratio of the two models for each n-gram, and for each context's unseen continuations."""
    grams = store(counts.groupBy("gram", "context").agg(F.first("lows").alias("lows"), F.first("low_contexts").alias("low_contexts"), F.sum("toxic").alias("toxic"), F.sum("plain").alias("plain")))
    singles = grams.agg(*[F.count_if(F.col(c) == n).alias(f"{c}{n}") for c in ("toxic", "plain") for n in (1, 2)]).first()
    discounts = {c: discount(singles[f"{c}1"], singles[f"{c}2"]) for c in ("toxic", "plain")}
    contexts = grams.groupBy("context").agg(
        *[F.sum(c).alias(f"{c}_all") for c in discounts],
        *[F.count_if(F.col(c) > 0).alias(f"{c}_types") for c in discounts],
    )
    for c, d in discounts.items():
        contexts = contexts.withColumn(f"{c}_left", F.when(F.col(f"{c}_all") > 0, d * F.col(f"{c}_types") / F.col(f"{c}_all")).otherwise(1.0))
    contexts = contexts.withColumn("unseen", F.log("toxic_left") - F.log("plain_left"))
    both = grams.select("gram", "context", F.element_at("lows", 1).alias("low"), "toxic", "plain").join(_backoff(grams), "low").join(contexts, "context")
    for c, d in discounts.items():
        seen = F.when(F.col(f"{c}_all") > 0, F.greatest(F.col(c) - d, F.lit(0.0)) / F.col(f"{c}_all")).otherwise(0.0)
        both = both.withColumn(f"p_{c}", seen + F.col(f"{c}_left") * F.col("backoff"))
    return both.select("gram", (F.log("p_toxic") - F.log("p_plain")).alias("value")), contexts.select("context", "unseen")


def _table(df: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """A model table, bounded by the labelled sample, sorted by key."""
    rows = df.toArrow()
    keys, values = rows.column(0).to_numpy().view(np.uint64), rows.column(1).to_numpy().astype(np.float32)
    order = np.argsort(keys)
    return keys[order], values[order]


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights of a ridge logistic regression by Newton steps (last weight: intercept).

    The rarer class counts more, by the square root of how much rarer it is.
    """
    x = np.hstack([x, np.ones((len(x), 1))])
    share = np.where(y == 1, np.sqrt((1 - y).sum() / max(y.sum(), 1)), 1.0)
    w = np.zeros(x.shape[1])
    ridge = np.diag([0.1, 0.1, 1e-3])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x.T * (share * p * (1 - p))) @ x + ridge, x.T @ (share * (y - p)) - ridge @ w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, rows: int = LABELLED_ROWS) -> ToxicityModel:
    """Train on a bounded sample of ``labels(doc_id, toxic)`` outside the held-out fold."""
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sample = bounded_sample(known.where(crc_fold() != 0), rows).withColumnRenamed("doc_id", "label_id")
    part = F.pmod(F.xxhash64(F.lit("part"), "label_id"), F.lit(4))
    marked = store(_texts(docs).join(F.broadcast(sample), F.col("doc_id") == F.col("label_id")).select("doc_id", "text", F.col("toxic").cast("long").alias("toxic"), (part != 0).alias("train")))
    values, unseen = _ratios(map_arrow(marked.where("train").select("text", "toxic"), _count, GRAMS))
    model = ToxicityModel(*_table(values), *_table(unseen), np.array([0.0, 0.0, -30.0]))
    judged = _evidences(marked.where("NOT train").select("doc_id", "text", "toxic"), model).toPandas()
    x, y = judged[["mean", "word"]].to_numpy(dtype=float), (judged["toxic"] == 1).to_numpy(dtype=float)
    if not len(y) or y.min() == y.max():
        return model
    return ToxicityModel(model.grams, model.gram_values, model.contexts, model.context_values, _logistic(x, y))


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def _evidences(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """``docs(doc_id, text, toxic)`` with the two values in place of the text."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.concatenate([np.zeros((0, 2)), *[_evidence(c, model) for c in text_chunks(batch.column("text"))]])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("toxic"), *map(pa.array, x.T.copy())], ["doc_id", "toxic", "mean", "word"])

    return map_arrow(docs, judge, "doc_id long, toxic long, mean double, word double")


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """``doc_id, held_out, score, predicted`` and the two values of every document."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            x = np.concatenate([np.zeros((0, 2)), *[_evidence(c, model) for c in text_chunks(batch.column("text"))]])
            p = 1 / (1 + np.exp(-np.clip(x @ model.weights[:-1] + model.weights[-1], -30, 30)))
            p = np.where(model.weights[-1] == -30.0, 0.0, p)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(p), *map(pa.array, x.T.copy())], ["doc_id", "score", "mean", "word"])

    judged = map_arrow(_texts(docs), judge, "doc_id long, score double, mean double, word double")
    return judged.select("doc_id", F.coalesce(crc_fold() == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "mean", "word")
