"""Substring dedup: collinear chaining of shared k-mer seeds finds fuzzy passages.

1. Seeds.  Of every ``WINDOW`` consecutive ``K``-word shingles of a document the one with the smallest hash is a seed,
   so two documents that share ``K + WINDOW - 1`` words in a row share a seed.
2. Matches.  The occurrences of a seed are joined with the first one of the smallest doc_id: one match for each
   occurrence, also when thousands share it, never all pairs.  The n-th occurrence also matches that document's n-th.
3. Chains.  A document's matches with one partner are chained in order: a match's best predecessor starts before it in
   both documents and costs ``GAP`` for each skipped word; a Fenwick tree over the positions in the second document keeps
   the best chain that ends before a position.  A lone match is a chain, too.
4. Alignment.  Chains are aligned word by word between their seeds and extended at both ends, as far as a passage of
   ``MIN_WORDS`` reaches from a seed; an alignment with enough equal words is a passage, in both documents.  The tables
   of many pairs are filled at once, a row of each at a time.
5. A document's passages are united, whoever shares them; unions of ``MIN_WORDS`` words or more are reported.

Defined results: null, empty and shorter texts have no passage; rows with one doc_id are one document (the same text),
and repeats inside a document do not count; a null doc_id is reported without passages; an empty table gives an empty result; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelyard.llm.common import map_arrow, store
from reelyard.llm.textscan import Chunk, grams, mix, text_chunks, word_keys

K, WINDOW = 5, 12
MIN_WORDS = 50
#: Cost of a skipped word (a match is worth K), and the gap that always ends a chain.
GAP, MAX_GAP = 0.15, 40
#: Share of equal words in an alignment, and words that an end may be extended by.
IDENTITY, REACH = 0.7, 48
#: Words of the shortest alignment that counts; unions are longer.
MIN_CHAIN = 12
#: Equal words, place by place, within reach of a lone seed that let its alignment be searched without a closer look.
NEAR = 4
#: Equal words of the shortest passage.
NEED = math.ceil(IDENTITY * MIN_WORDS - 1e-9)
#: Pairs that are aligned at once.
BLOCK = 2048
_NTH = np.uint64(0xD6E8FEB86659FD93)


def _word_hashes(chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
    start, end, doc = chunk.words()
    return word_keys(chunk.data, start, end, lower=True), doc


def seeds_of(words: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first word of the seeds (documents of ``K + WINDOW - 1`` words or more)."""
    h, at = grams(words, doc, K)
    if len(h) < WINDOW:
        return h[:0], at[:0]
    windows = np.lib.stride_tricks.sliding_window_view(h, WINDOW)
    inside = doc[at[: len(windows)]] == doc[at[WINDOW - 1 :]]
    first = np.flatnonzero(inside)
    least = np.empty(len(first), dtype=np.int64)
    for lo in range(0, len(first), 65536):  # the leftmost smallest hash of each window
        part = first[lo : lo + 65536]
        least[lo : lo + 65536] = windows[part].argmin(axis=1) + part
    chosen = np.unique(least)
    return h[chosen], at[chosen]


def _seed_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for chunk in text_chunks(batch.column("text")):
            words, doc = _word_hashes(chunk)
            first_word = np.searchsorted(doc, np.arange(len(chunk)))
            long = np.bincount(doc, minlength=len(chunk)) >= MIN_WORDS
            h, at = seeds_of(words, doc)
            own = long[doc[at]]
            h, at = h[own], at[own]
            order = np.lexsort((at, h, doc[at]))
            h, at = h[order], at[order]
            first = np.append(True, (h[1:] != h[:-1]) | (doc[at][1:] != doc[at][:-1]))[: len(h)]
            # A seed's second, third, ... occurrence in a document is also a seed of its own, so repetitive copies match.
            run = np.arange(len(h)) - np.flatnonzero(first)[np.cumsum(first) - 1] if len(h) else at
            h, at, first = np.append(h, mix(h + run.astype(np.uint64) * _NTH)[run > 0]), np.append(at, at[run > 0]), np.append(first, np.ones((run > 0).sum(), dtype=bool))
            ids = batch.column("doc_id").slice(chunk.rows.start, len(chunk)).take(pa.array(doc[at]))
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), ids, pa.array((at - first_word[doc[at]]).astype(np.int32)), pa.array(first)], ["seed", "doc", "pos", "first"])


class Fenwick:
    """Largest value (and its index) among the keys below a bound."""

    def __init__(self, n: int):
        self.best: list[tuple[float, int]] = [(-np.inf, -1)] * (n + 1)

    def raise_to(self, key: int, value: float, index: int) -> None:
        key += 1
        best = self.best
        while key < len(best):
            if value > best[key][0]:
                best[key] = (value, index)
            key += key & -key

    def below(self, key: int) -> tuple[float, int]:
        out, best = (-np.inf, -1), self.best
        while key > 0:
            if best[key][0] > out[0]:
                out = best[key]
            key -= key & -key
        return out


def chain(x: list[int], y: list[int]) -> list[list[int]]:
    """Chains of match indexes, best first; matches ``(x, y)`` are sorted, and each is in one chain at most."""
    keys = {v: i for i, v in enumerate(sorted(set(y)))}
    tree = Fenwick(len(keys))
    score, back = [0.0] * len(x), [-1] * len(x)
    i = 0
    while i < len(x):
        j = i
        while j < len(x) and x[j] == x[i]:  # equal x: none of them precedes another
            value, before = tree.below(keys[y[j]])
            value -= GAP * (x[j] + y[j])
            if before >= 0 and value > 0 and x[j] - x[before] <= MAX_GAP + K and y[j] - y[before] <= MAX_GAP + K:
                near = min(K, x[j] - x[before], y[j] - y[before])  # overlapping seeds count their new words
                score[j], back[j] = value + near, before
            else:
                score[j] = float(K)
            j += 1
        for m in range(i, j):
            tree.raise_to(keys[y[m]], score[m] + GAP * (x[m] + y[m]), m)
        i = j
    used = [False] * len(x)
    out = []
    for end in sorted(range(len(x)), key=lambda m: (-score[m], m)):
        links, m = [], end
        while m >= 0 and not used[m]:
            used[m] = True
            links.append(m)
            m = back[m]
        if links:
            out.append(links[::-1])
    return out


CHAINS = "doc long, hub long, lo int, hi int, hub_lo int, hub_hi int, anchors binary"


def _chain_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by doc, hub, pos: the chains of each document with each of its hubs."""
    doc, matches = None, []
    rows: list[tuple] = []
    for batch in batches:
        for own, *match in zip(*(batch.column(c).to_pylist() for c in ("doc", "hub", "pos", "hub_pos")), strict=True):
            if own != doc:
                rows += _chains_of(doc, matches)
                doc, matches = own, []
            matches.append(match)
        if len(rows) > 2000:
            yield _chain_batch(rows)
            rows = []
    yield _chain_batch([*rows, *_chains_of(doc, matches)])


def _chains_of(doc: int | None, matches: list[list[int]]) -> Iterator[tuple]:
    if not matches:
        return
    found = np.array(matches, dtype=np.int64)
    for part in np.split(found, np.flatnonzero(np.diff(found[:, 0])) + 1):
        if len(part):
            hub, x, y = int(part[0, 0]), part[:, 1].tolist(), part[:, 2].tolist()
            first = x[0]
            reached = bytearray(x[-1] - first + K + 2 * REACH)  # where a better chain's alignment may extend to
            matched = set()
            for links in chain(x, y):
                at = part[links, 1:].astype(np.int32)
                lo, hi = at[0], at[-1] + K
                if len(links) == 1 and y[links[0]] in matched and all(reached[lo[0] - first + REACH : hi[0] - first + REACH]):
                    continue  # one more way to match repetitive text with the same seed
                matched.update(y[m] for m in links)
                a, b = lo[0] - first, hi[0] - first + 2 * REACH
                reached[a:b] = b"\1" * (b - a)
                yield doc, hub, max(int(lo[0]) - REACH, 0), int(hi[0]) + REACH, max(int(lo[1]) - REACH, 0), int(hi[1]) + REACH, at.tobytes()


def _chain_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * 7
    types = [pa.int64(), pa.int64(), *[pa.int32()] * 4, pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], [f.split()[0] for f in CHAINS.split(", ")])


def _segment_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The asked ranges of words of each text as 32-bit hashes."""
    for batch in batches:
        asked, docs = batch.column("asked").to_pylist(), batch.column("doc").to_pylist()
        for chunk in text_chunks(batch.column("text")):
            h, doc = _word_hashes(chunk)
            h = (h >> np.uint64(32)).astype(np.uint32)
            at = np.searchsorted(doc, np.arange(len(chunk) + 1))
            rows = [(docs[row], r["lo"], r["hi"], h[at[i] : at[i + 1]][r["lo"] : r["hi"]].tobytes()) for i, row in enumerate(chunk.rows) for r in asked[row]]
            columns = list(zip(*rows, strict=True)) if rows else [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [pa.int64(), pa.int32(), pa.int32(), pa.binary()], strict=True)], ["doc", "lo", "hi", "words"])


@dataclass
class Runs:
    """Runs of ``words``, forwards (``step`` 1) or backwards (-1) from ``start``, one for each pair to compare."""

    words: np.ndarray
    start: np.ndarray
    size: np.ndarray
    step: int = 1

    def __getitem__(self, rows: np.ndarray) -> Runs:
        return Runs(self.words, self.start[rows], self.size[rows], self.step)

    def after(self, skipped: np.ndarray) -> Runs:
        return Runs(self.words, self.start + self.step * skipped, self.size - skipped, self.step)

    def first(self, size: np.ndarray) -> Runs:
        return Runs(self.words, self.start, size, self.step)

    def columns(self, longest: int, filler: int) -> np.ndarray:
        """A column for each run: its words, then ``filler`` (negative: no word)."""
        k = np.arange(longest)[:, None]
        inside = k < self.size
        return np.where(inside, self.words[np.where(inside, self.start + self.step * k, 0)].astype(np.int64), filler)


def _blocks(a: Runs, b: Runs) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pairs where neither run is empty, in blocks of like length: their numbers, and the columns of both runs."""
    longest = np.maximum(a.size, b.size)
    rows = np.flatnonzero(np.minimum(a.size, b.size) > 0)
    rows = rows[np.argsort(longest[rows], kind="stable")]
    for lo in range(0, len(rows), BLOCK):
        part = rows[lo : lo + BLOCK]
        size = int(longest[part[-1]])
        yield part, a[part].columns(size, -1), b[part].columns(size, -2)


def _running_max(rows: np.ndarray) -> None:
    for j in range(1, len(rows)):
        np.maximum(rows[j], rows[j - 1], out=rows[j])


def _gap_matches(a: Runs, b: Runs) -> np.ndarray:
    """Equal words in the best alignment of two short runs (longest common subsequence, row by row), for each pair."""
    out = np.zeros(len(a.size), dtype=np.int64)
    for part, u, v in _blocks(a, b):
        out[part] = (u == v).sum(axis=0)
        search = (a.size[part] != b.size[part]) | (2 * out[part] <= a.size[part])
        part, u, v = part[search], u[:, search], v[:, search]
        row = np.zeros((len(v) + 1, len(part)), dtype=np.int16)
        for word in u:
            row[1:] = np.maximum(row[1:], row[:-1] + (v == word))
            _running_max(row)
        out[part] = row[-1]
    return out


def _extend(a: Runs, b: Runs) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """How many words of each run an alignment is extended by, and the equal ones, for each pair.

    The prefixes that align best: +1 for equal words, -1 for each other, left out or put in.
    """
    a, b = a.first(np.minimum(a.size, REACH)), b.first(np.minimum(b.size, REACH))
    run, i, j = np.zeros((3, len(a.size)), dtype=np.int64)
    for part, u, v in _blocks(a, b):
        other = u != v
        run[part] = np.where(other.any(axis=0), other.argmax(axis=0), len(u))  # equal words need no search
    a, b = a.after(run), b.after(run)
    for part, u, v in _blocks(a, b):
        i[part], j[part] = _extend_beyond(u, v, a.size[part])
    return run + i, run + j, run + _gap_matches(a.first(i), b.first(j))


def _extend_beyond(u: np.ndarray, v: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.zeros((2, len(size)), dtype=np.int64)
    pair, best = np.arange(len(size)), np.zeros(len(size), dtype=np.int16)
    steps = np.arange(len(v) + 1, dtype=np.int16)[:, None]
    raised = np.zeros((len(v) + 1, len(size)), dtype=np.int16)  # the row of scores, plus the words of v that are passed
    for i in range(len(u)):
        above = raised - np.int16(1)
        above[1:] = np.maximum(above[1:], raised[:-1] + np.int16(2) * (v == u[i]))
        _running_max(above)
        raised = above
        row = raised - steps
        top = row.max(axis=0)
        better = np.flatnonzero(top > best)
        ended = (top < best - 8) | (size <= i + 1)
        best[better] = top[better]
        at[0, pair[better]], at[1, pair[better]] = i + 1, row[:, better].argmax(axis=0)
        best[ended] = np.iinfo(np.int16).max  # no better one follows
        if 4 * np.count_nonzero(ended) > len(ended):
            going = ~ended
            pair, best, size, u, v, raised = pair[going], best[going], size[going], u[:, going], v[:, going], raised[:, going]
            if not len(pair):
                break
    return at[0], at[1]


def _lonely(sides: list[tuple[Runs, Runs]]) -> np.ndarray:
    """Whether a lone seed is a phrase met by chance, for each pair.

    Hardly any words around it are equal, place by place, and too few are in both for a passage in any other alignment.
    """
    equal = np.zeros(len(sides[0][0].size), dtype=np.int64)
    for a, b in sides:
        for part, u, v in _blocks(a, b):
            equal[part] += (u == v).sum(axis=0)
    rows = np.flatnonzero(equal < NEAR)
    beside = np.zeros(len(rows), dtype=np.int64)
    for a, b in sides:
        for part, u, v in _blocks(a[rows], b[rows]):
            for word in u:
                beside[part] += (v == word).any(axis=0)
    out = np.zeros(len(equal), dtype=bool)
    out[rows] = beside + K < NEED
    return out


def align_pairs(a: np.ndarray, a_at: np.ndarray, b: np.ndarray, b_at: np.ndarray, anchors: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, ...]:
    """Bounds in both runs, and equal words, of the alignment of each pair through its ``anchors``.

    Pair ``i`` has the words ``a_at[i]`` to ``a_at[i + 1]`` of ``a``, those of ``b`` alike, and the anchors ``at[i]`` to
    ``at[i + 1]``, positions in its words where K words are equal.
    """
    (x0, y0), (x, y) = anchors[at[:-1]].T, anchors[at[1:] - 1].T + K
    pair = np.repeat(np.arange(len(at) - 1), np.diff(at))
    before = np.flatnonzero(pair[1:] == pair[:-1])
    gap = anchors[before + 1] - anchors[before] - K
    step = gap.min(axis=1)
    new = np.where(step < 0, np.maximum(K + step, 0), K)  # overlapping seeds count their new words
    between = np.flatnonzero(step > 0)
    left, owner = anchors[before[between]] + K, pair[before[between]]
    new[between] += _gap_matches(Runs(a, a_at[owner] + left[:, 0], gap[between, 0]), Runs(b, b_at[owner] + left[:, 1], gap[between, 1]))
    same = K + np.bincount(pair[before], new, minlength=len(x0)).astype(np.int64)
    a_to, b_to = a_at[:-1], b_at[:-1]
    ends = [
        (Runs(a, a_to + x0 - 1, np.minimum(x0, REACH), -1), Runs(b, b_to + y0 - 1, np.minimum(y0, REACH), -1)),
        (Runs(a, a_to + x, np.minimum(np.diff(a_at) - x, REACH)), Runs(b, b_to + y, np.minimum(np.diff(b_at) - y, REACH))),
    ]
    searched = np.ones(len(x0), dtype=bool)
    lone = np.flatnonzero(np.diff(at) == 1)
    searched[lone] = ~_lonely([(u[lone], v[lone]) for u, v in ends])
    rows = np.flatnonzero(searched)
    (left_x, left_y, left_same), (right_x, right_y, right_same) = (_extend(u[rows], v[rows]) for u, v in ends)
    x0[rows] -= left_x
    y0[rows] -= left_y
    x[rows] += right_x
    y[rows] += right_y
    same[rows] += left_same + right_same
    return x0, x, y0, y, same


def align(a: np.ndarray, b: np.ndarray, anchors: np.ndarray) -> tuple[int, int, int, int, int]:
    """Bounds in both runs, and equal words, of the alignment through ``anchors`` (positions of K equal words)."""
    found = align_pairs(a, np.array([0, len(a)]), b, np.array([0, len(b)]), anchors, np.array([0, len(anchors)]))
    return tuple(int(v[0]) for v in found)


def _joined(column: pa.Array, kind: type, width: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """The arrays of a binary column one after the other, and the bounds of each in items of ``width`` numbers."""
    values = column.to_pylist()
    sizes = np.fromiter(map(len, values), np.int64, len(values)) // (np.dtype(kind).itemsize * width)
    return np.frombuffer(b"".join(values), kind), np.append(0, np.cumsum(sizes))


def _align_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        doc, hub, lo, hub_lo = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("doc", "hub", "lo", "hub_lo"))
        (a, a_at), (b, b_at) = _joined(batch.column("words"), np.uint32), _joined(batch.column("hub_words"), np.uint32)
        anchors, at = _joined(batch.column("anchors"), np.int32, 2)
        anchors = anchors.reshape(-1, 2) - np.repeat(np.stack([lo, hub_lo], axis=1), np.diff(at), axis=0)
        x0, x1, y0, y1, same = align_pairs(a, a_at, b, b_at, anchors, at)
        kept = (np.minimum(x1 - x0, y1 - y0) >= MIN_CHAIN) & (same >= IDENTITY * np.maximum(x1 - x0, y1 - y0))
        columns = [np.concatenate([u[kept], v[kept]]) for u, v in ((doc, hub), (x0 + lo, y0 + hub_lo), (x1 + lo, y1 + hub_lo), (hub, doc))]
        yield pa.RecordBatch.from_arrays([pa.array(c.astype(t)) for c, t in zip(columns, [np.int64, np.int32, np.int32, np.int64], strict=True)], ["doc", "lo", "hi", "partner"])


def passages(docs: DataFrame) -> DataFrame:
    """``doc, lo, hi, partner``: aligned passages (words) of each document and the smallest document that shares each."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("doc_id IS NOT NULL AND text IS NOT NULL")
    seeds = store(map_arrow(texts, _seed_rows, "seed long, doc long, pos int, first boolean"))
    hubs = seeds.where("first").groupBy("seed").agg(F.min("doc").alias("hub"), F.max("doc").alias("last"), F.min_by("pos", "doc").alias("hub_pos")).where("last > hub")
    hubs = store(hubs.select("seed", "hub", "hub_pos"))
    matches = seeds.select("seed", "doc", "pos").join(hubs, "seed").where("doc <> hub").select("doc", "hub", "pos", "hub_pos").distinct()
    chains = store(map_arrow(matches.repartition("doc").sortWithinPartitions("doc", "hub", "pos", "hub_pos"), _chain_rows, CHAINS))
    asked = chains.select("doc", "lo", "hi").unionByName(chains.select(F.col("hub").alias("doc"), F.col("hub_lo").alias("lo"), F.col("hub_hi").alias("hi")))
    # A text is read once for all its ranges (in parts of 4,096 words, so that no list of ranges grows without bound).
    asked = asked.groupBy("doc", F.floor(F.col("lo") / 4096).alias("part")).agg(F.collect_set(F.struct("lo", "hi")).alias("asked"))
    segments = store(map_arrow(asked.join(texts.withColumnRenamed("doc_id", "doc"), "doc").select("doc", "asked", "text"), _segment_rows, "doc long, lo int, hi int, words binary").groupBy("doc", "lo", "hi").agg(F.max("words").alias("words")))
    hub_segments = segments.select(F.col("doc").alias("hub"), F.col("lo").alias("hub_lo"), F.col("hi").alias("hub_hi"), F.col("words").alias("hub_words"))
    both = chains.join(segments, ["doc", "lo", "hi"]).join(hub_segments, ["hub", "hub_lo", "hub_hi"])
    aligned = map_arrow(both.select("doc", "hub", "lo", "hub_lo", "anchors", "words", "hub_words"), _align_rows, "doc long, lo int, hi int, partner long")
    return store(aligned.groupBy("doc", "lo", "hi").agg(F.min("partner").alias("partner")))


def _united(spans: list[dict]) -> list[dict]:
    """Spans that touch or overlap joined; those of ``MIN_WORDS`` or more."""
    out: list[dict] = []
    for s in sorted(spans, key=lambda s: (s["lo"], s["hi"])):
        if out and s["lo"] <= out[-1]["hi"]:
            out[-1]["hi"] = max(out[-1]["hi"], s["hi"])
            out[-1]["partner"] = min(out[-1]["partner"], s["partner"])
        else:
            out.append(dict(s))
    return [s for s in out if s["hi"] - s["lo"] >= MIN_WORDS]


SPANS = "array<struct<lo:int,hi:int,partner:long>>"


def report(docs: DataFrame) -> DataFrame:
    """``doc_id, n_passages, n_repeated_words, passages, partners`` of every document; passages as word positions."""
    listed = passages(docs).groupBy("doc").agg(F.collect_list(F.struct("lo", "hi", "partner")).alias("spans"))

    def unite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("lo", pa.int32()), ("hi", pa.int32()), ("partner", pa.int64())]))
        for batch in batches:
            found = [_united(s) for s in batch.column("spans").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(found, kind)], ["doc", "passages"])

    united = map_arrow(listed, unite, f"doc long, passages {SPANS}")
    out = docs.select(F.col("doc_id").cast("long").alias("doc_id")).join(united.withColumnRenamed("doc", "doc_id"), "doc_id", "left")
    none = F.coalesce("passages", F.array().cast(SPANS))
    words = F.aggregate(none, F.lit(0).cast("long"), lambda n, s: n + s["hi"] - s["lo"])
    return out.select("doc_id", F.size(none).cast("long").alias("n_passages"), words.alias("n_repeated_words"), none.alias("passages"), F.array_distinct(F.transform(none, lambda s: s["partner"])).alias("partners"))
