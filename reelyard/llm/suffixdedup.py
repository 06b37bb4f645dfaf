"""Suffix-array dedup: remove bytes covered by a ``LENGTH``-byte string that also starts elsewhere.

1. Anchors.  Of every ``LENGTH``-byte string the ``GRAM``-byte window with the smallest hash is its anchor, so equal
   strings have equal anchors at equal places.  Only strings whose anchor occurs twice or more can repeat.
2. Segments.  The consecutive strings of one anchor form a segment of the text.  Equal segments are told by a 128-bit
   digest and counted, not compared: all strings of a segment found twice repeat.  Up to here only narrow rows move: the
   texts that hold such an anchor were stored once, bucketed by row, and are not shuffled again.
3. Suffix arrays.  One copy of each distinct segment is cut out, if its anchor has others.  They are joined into one text,
   whose suffixes are put in order by
   two-stage sorting: those smaller than their successors directly, the others induced by bucket scans.  Neighbours
   with a common prefix of ``LENGTH`` bytes are repeated strings.  Segments are dealt by anchor.  An anchor with more
   than ``SALTED`` distinct segments is not gathered: each of its strings is one row, dealt and counted by its 128-bit
   digest, so rows grow with the strings and no task holds more of the anchor than its share.
4. Repeated strings are mapped back to their documents, their spans united and removed.

Whole segments, and the strings of the anchors that are too common to gather, are compared by 128-bit digest; all others
byte by byte in the suffix array.  Anchors only find candidates.

Defined results: null and empty texts have nothing to remove; repeated rows repeat each other's strings like any other
documents; texts shorter than ``LENGTH`` bytes keep all; an empty table gives an empty result; other columns are
ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelyard.llm.common import discard, map_arrow, shared_folder, store, store_bucketed
from reelyard.llm.suffixsort import common_prefix, suffix_order
from reelyard.llm.textscan import SpanHasher, strings

LENGTH = 200
GRAM = 64
#: Bytes of text that are hashed at once; longer documents are walked in pieces that overlap.
PIECE = 400_000
#: Distinct segments of one anchor that are sorted together, at most.
SALTED = 2048
#: Bytes of segments whose suffixes are sorted together.
SORTED_BYTES = 400_000
_PLACE = np.uint64((1 << 24) - 1)


def _anchors(data: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor hash, first and one past the last start of each run of strings with one anchor, in ``data``."""
    span = SpanHasher(data)
    n = len(data) - gram + 1
    at = np.arange(n)
    h = span(at, at + gram)
    # Smallest hash of each window of places, the leftmost of equal ones: the place is the low part of the key.
    key = (h & ~_PLACE) | at.astype(np.uint64)
    width = length - gram + 1
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[:n] = key
    grid = padded.reshape(blocks, width)
    left = np.minimum.accumulate(grid, axis=1).reshape(-1)
    right = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    starts = len(data) - length + 1
    least = np.minimum(right[:starts], left[width - 1 : width - 1 + starts]) & _PLACE
    first = np.flatnonzero(np.append(True, least[1:] != least[:-1]))
    return h[least[first].astype(np.int64)], first, np.append(first[1:], starts)


def _pieces(text: bytes, length: int) -> Iterator[tuple[int, np.ndarray]]:
    """Pieces of a text that share no start of a string, with their place."""
    data = np.frombuffer(text, dtype=np.uint8)
    for lo in range(0, len(data) - length + 1, PIECE):
        yield lo, data[lo : lo + PIECE + length - 1]


def _texts(docs: DataFrame) -> DataFrame:
    """``doc_id, mark, text``; doc_id and mark (a hash of id and text) name a row, or rows that are the same."""
    doc_id, text = F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(doc_id.alias("doc_id"), F.xxhash64(doc_id, text).alias("mark"), text.alias("text"))


def _anchor_rows(batches: Iterator[pa.RecordBatch], length: int, gram: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        owner, found = [], []
        for i, text in enumerate(strings(batch.column("text")).cast(pa.binary())):
            for _, data in _pieces(text.as_py(), length):
                h, _, _ = _anchors(data, length, gram)
                found.append(h)
                owner.append(np.full(len(h), i))
        if found:
            at = pa.array(np.concatenate(owner))
            yield pa.RecordBatch.from_arrays([batch.column("mark").take(at), pa.array(np.concatenate(found).view(np.int64))], ["mark", "anchor"])


SEGMENTS = "mark long, anchor long, segment binary, starts int, place long"


def _segment_rows(batches: Iterator[pa.RecordBatch], length: int, gram: int) -> Iterator[pa.RecordBatch]:
    """The segments of the anchors listed with each document, by digest."""
    for batch in batches:
        rows: list[list] = [[] for _ in range(5)]
        for mark, text, listed in zip(batch.column("mark").to_pylist(), batch.column("text").cast(pa.binary()), batch.column("anchors"), strict=True):
            wanted = np.sort(listed.values.to_numpy().view(np.uint64))
            raw = text.as_py()
            for place, data in _pieces(raw, length):
                h, first, last = _anchors(data, length, gram)
                own = wanted[np.minimum(np.searchsorted(wanted, h), len(wanted) - 1)] == h
                h, first, last = h[own], first[own] + place, last[own] + place
                rows[0].append(np.full(len(h), mark))
                rows[1].append(h.view(np.int64))
                rows[2] += [_digest(raw[a:b]) for a, b in zip(first.tolist(), (last + length - 1).tolist(), strict=True)]
                rows[3].append(last - first)
                rows[4].append(first)
        if rows[2]:
            mark, anchor, starts, place = (np.concatenate(rows[k]) for k in (0, 1, 3, 4))
            yield pa.RecordBatch.from_arrays([pa.array(mark, pa.int64()), pa.array(anchor), pa.array(rows[2], pa.binary()), pa.array(starts).cast(pa.int32()), pa.array(place)], [f.split()[0] for f in SEGMENTS.split(", ")])


def _digest(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


CUTS = "anchor long, segment binary, starts int, bytes binary"


def _cut_rows(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """The bytes of the segments listed with each document."""
    names = [f.split()[0] for f in CUTS.split(", ")]
    for batch in batches:
        rows, held = [], 0
        for text, cuts in zip(batch.column("text").cast(pa.binary()), batch.column("cuts"), strict=True):
            raw = text.as_py()
            for cut in cuts.as_py():
                rows.append((cut["anchor"], cut["segment"], cut["starts"], raw[cut["place"] : cut["place"] + cut["starts"] + length - 1]))
                held += cut["starts"] + length
                if held > SORTED_BYTES:
                    yield _cut_batch(rows, names)
                    rows, held = [], 0
        if rows:
            yield _cut_batch(rows, names)


def _cut_batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.binary(), pa.int32(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)


REPEATS = "anchor long, segment binary, starts int, lo int, hi int"


def _sort_groups(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by anchor: whole groups are gathered up to ``SORTED_BYTES`` and sorted together."""
    rows: list[tuple] = []
    size, last = 0, None
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("anchor", "segment", "starts", "bytes")), strict=True):
            if row[0] != last and size >= SORTED_BYTES:
                yield _repeats(rows, length)
                rows, size = [], 0
            last = row[0]
            rows.append(row)
            size += len(row[3])
    if rows:
        yield _repeats(rows, length)


def _repeats(rows: list[tuple], length: int) -> pa.RecordBatch:
    """Runs of starts, within each segment, of strings that also start in another segment or elsewhere in it."""
    text = np.frombuffer(b"\0".join(r[3] for r in rows) + b"\0", dtype=np.uint8)
    begin = np.cumsum([0] + [len(r[3]) + 1 for r in rows[:-1]])
    starts = np.array([r[2] for r in rows])
    of = np.repeat(np.arange(len(rows)), starts)
    at = np.arange(starts.sum()) - np.repeat(np.cumsum(starts) - starts, starts) + begin[of]
    wanted = np.zeros(len(text), dtype=bool)
    wanted[at] = True
    order = suffix_order(text, wanted, length)
    order = order[wanted[order]]
    same = common_prefix(text, order, length) >= length
    same[:-1] |= same[1:]
    repeated = np.zeros(len(text), dtype=bool)
    repeated[order[same]] = True
    hit = repeated[at]
    of, at = of[hit], at[hit]
    first = np.flatnonzero(np.append(True, (at[1:] != at[:-1] + 1) | (of[1:] != of[:-1])))[: len(at)]
    final = np.append(first[1:] - 1, len(at) - 1)[: len(first)]
    lo, hi = at[first] - begin[of[first]], at[final] - begin[of[first]] + 1
    pick = [rows[i] for i in of[first].tolist()]
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in pick], pa.int64()), pa.array([r[1] for r in pick], pa.binary()), pa.array([r[2] for r in pick], pa.int32()), pa.array(lo, pa.int32()), pa.array(hi, pa.int32())],
        [f.split()[0] for f in REPEATS.split(", ")],
    )


STRINGS = "anchor long, segment binary, starts int, at int, string binary"


def _string_rows(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Each string of the segments, by place and digest."""
    for batch in batches:
        starts = batch.column("starts").to_numpy()
        for lo in range(0, batch.num_rows, 256):
            n = starts[lo : lo + 256]
            texts = batch.column("bytes").slice(lo, 256).to_pylist()
            told = [_digest(t[i : i + length]) for t, k in zip(texts, n.tolist(), strict=True) for i in range(k)]
            of = pa.array(np.repeat(np.arange(len(n)), n) + lo)
            at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            yield pa.RecordBatch.from_arrays([*(batch.column(c).take(of) for c in ("anchor", "segment", "starts")), pa.array(at, pa.int32()), pa.array(told, pa.binary())], [f.split()[0] for f in STRINGS.split(", ")])


def _run_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of starts from the places listed with each segment."""
    for batch in batches:
        runs = [_united([{"lo": a, "hi": a + 1} for a in places]) for places in batch.column("places").to_pylist()]
        of = pa.array(np.repeat(np.arange(len(runs)), [len(r) for r in runs]))
        lo, hi = ([r[k] for own in runs for r in own] for k in (0, 1))
        yield pa.RecordBatch.from_arrays([*(batch.column(c).take(of) for c in ("anchor", "segment", "starts")), pa.array(lo, pa.int32()), pa.array(hi, pa.int32())], [f.split()[0] for f in REPEATS.split(", ")])


def _united(spans: list[dict]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for lo, hi in sorted((s["lo"], s["hi"]) for s in spans):
        if out and lo <= out[-1][1]:
            out[-1] = out[-1][0], max(hi, out[-1][1])
        else:
            out.append((lo, hi))
    return out


def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``mark, text, spans`` of the documents with a removable byte; spans may touch or overlap."""
    texts = _texts(docs)
    spark = docs.sparkSession
    used = [shared_folder(spark) for _ in range(5)]
    anchors = store(map_arrow(texts.select("mark", "text"), lambda b: _anchor_rows(b, length, gram), "mark long, anchor long"), used[0])
    # Stored, so that the join has two shuffled sides and a very common anchor can be split over tasks.
    twice = store(anchors.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("anchor"), used[1])
    listed = anchors.join(twice, "anchor", "left_semi").groupBy("mark").agg(F.collect_set("anchor").alias("anchors"))
    # Bucketed by row: what is joined to it below moves, the texts do not.
    rich = store_bucketed(texts.select("mark", "text").join(listed, "mark"), "mark")
    discard(spark, *used[:2])  # from here on all comes from ``rich``
    segments = map_arrow(rich, lambda b: _segment_rows(b, length, gram), SEGMENTS)
    distinct = store(segments.groupBy("anchor", "segment", "starts").agg(F.count(F.lit(1)).alias("copies"), F.min("mark").alias("mark"), F.min_by("place", "mark").alias("place")), used[2])
    groups = store(distinct.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), used[3])

    def cut(which: DataFrame) -> DataFrame:
        """One copy of the distinct segments of some anchors, with its bytes."""
        one = distinct.join(which, "anchor", "left_semi")
        lists = one.groupBy("mark").agg(F.collect_list(F.struct("anchor", "segment", "starts", "place")).alias("cuts"))
        return map_arrow(rich.select("mark", "text").join(lists, "mark").select("text", "cuts"), lambda b: _cut_rows(b, length), CUTS)

    gathered = cut(groups.where(F.col("n") <= SALTED)).repartition("anchor").sortWithinPartitions("anchor")
    found = map_arrow(gathered, lambda b: _sort_groups(b, length), REPEATS)
    strings_ = map_arrow(cut(groups.where(F.col("n") > SALTED)), lambda b: _string_rows(b, length), STRINGS)
    # Stored like the anchors above: a very common string is split over tasks.
    common = store(strings_.groupBy("string").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("string"), used[4])
    held = strings_.join(common, "string", "left_semi").groupBy("anchor", "segment", "starts").agg(F.collect_set("at").alias("places"))
    found = found.unionByName(map_arrow(held, _run_rows, REPEATS))
    whole = distinct.where("copies > 1").select("anchor", "segment", "starts", F.lit(0).alias("lo"), F.col("starts").alias("hi"))
    runs = store(whole.unionByName(found))
    discard(spark, *used[2:])
    places = segments.join(runs, ["anchor", "segment", "starts"])
    span = F.struct((F.col("place") + F.col("lo")).alias("lo"), (F.col("place") + F.col("hi") + length - 1).alias("hi"))
    spans = places.groupBy("mark").agg(F.collect_set(span).alias("spans"))
    return rich.select("mark", "text").join(spans, "mark")


def _removed(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    at = 0
    kept = []
    for lo, hi in spans:
        kept.append(text[at:lo])
        at = hi
    return b"".join([*kept, text[at:]])


def report(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of every document."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, n, told = [], [], []
            for text, spans in zip(batch.column("text").cast(pa.binary()).to_pylist(), batch.column("spans").to_pylist(), strict=True):
                joined = _united(spans)
                removed.append(sum(hi - lo for lo, hi in joined))
                n.append(len(joined))
                told.append(hashlib.sha256(_removed(text, joined)).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column("mark"), pa.array(removed, pa.int64()), pa.array(n, pa.int64()), pa.array(told, pa.string())], ["mark", "n_removed", "n_spans", "cut_sha256"])

    done = store(map_arrow(repeated_spans(docs, length, gram), cut, "mark long, n_removed long, n_spans long, cut_sha256 string").dropDuplicates(["mark"]))
    every = _texts(docs).select("doc_id", "mark", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("whole_sha256"))
    joined = every.join(done, "mark", "left")
    zero = F.lit(0).cast("long")
    return joined.select("doc_id", "n_bytes", F.coalesce("n_removed", zero).alias("n_removed"), F.coalesce("n_spans", zero).alias("n_spans"), F.coalesce("cut_sha256", "whole_sha256").alias("kept_sha256"))


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``doc_id, kept``: every document's remaining bytes (a cut may fall inside a character, so they are bytes)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [_removed(t, _united(s or [])) for t, s in zip(batch.column("text").cast(pa.binary()).to_pylist(), batch.column("spans").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(kept, pa.binary())], ["doc_id", "kept"])

    spans = repeated_spans(docs, length, gram).select("mark", "spans").dropDuplicates(["mark"])
    return map_arrow(_texts(docs).join(spans, "mark", "left").select("doc_id", "text", "spans"), cut, "doc_id long, kept binary")
