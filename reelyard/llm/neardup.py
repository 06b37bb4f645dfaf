"""MinHash near-dedup: SuperMinHash signatures, banding, verification on full shingle sets, union-find grouping.

1. One scan makes each document's set of 5-word shingles, its SuperMinHash signature and, from it, ``BANDS`` band keys.
2. Documents with equal sets are one class; its smallest doc_id represents it from here on.
3. Representatives that share a band key are candidates.  Each is compared with the smallest member of its bucket (the
   hub) on the full sets; confirmed links are joined into components.
4. A bucket whose members still lie in several components may hide links between members other than the hub.  The
   documents that such buckets connect are compared too, in blocks of bounded size, until every pair of one bucket is
   linked, in one component, or known to be below the threshold.  No cap: many documents become many block pairs in
   many tasks; a family beyond ``FAMILY`` documents is compared bucket by bucket, so that chains of buckets stay cheap.

Odds that two sets of similarity 0.8 share no band: (1 - 0.8**5)**30, below 1e-5 (at 0.85 below 1e-7).

Defined results: null, empty or wordless texts have an empty set and stand alone; a null doc_id stays; fewer than five words make one
shingle of the whole sequence; repeated rows with one doc_id are one document (their links join it); an empty table
gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelyard.llm.common import map_arrow, spare_name, store
from reelyard.llm.graph import components
from reelyard.llm.superminhash import signatures
from reelyard.llm.textscan import Chunk, grams, mix, text_chunks, word_keys

WORDS = 5
ROWS, BANDS = 5, 30
#: Similarity at which documents are linked, by default: 100 * intersection >= PERCENT * union.
PERCENT = 80


def shingle_sets(chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of the chunk's documents, sorted by document and hash."""
    start, end, doc = chunk.words()
    words = word_keys(chunk.data, start, end, lower=True)
    n = np.bincount(doc, minlength=len(chunk))
    h, at = grams(words, doc, WORDS)
    hashes, owners = [h], [doc[at]]
    for k in range(1, WORDS):
        short = n[doc] == k
        if short.any():
            h, at = grams(words[short], doc[short], k)
            hashes.append(h)
            owners.append(doc[short][at])
    h, owner = np.concatenate(hashes), np.concatenate(owners)
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    first = np.ones(len(h), dtype=bool)
    first[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    return h[first], owner[first]


def _band_keys(sets: np.ndarray) -> np.ndarray:
    keys = np.empty((len(sets), BANDS), dtype=np.uint64)
    for b in range(BANDS):
        key = np.full(len(sets), b + 1, dtype=np.uint64)
        for r in range(ROWS):
            key = mix(key * np.uint64(0x9E3779B97F4A7C15) + sets[:, b * ROWS + r])
        keys[:, b] = key
    return keys


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for chunk in text_chunks(batch.column("text")):
            h, owner = shingle_sets(chunk)
            size = np.bincount(owner, minlength=len(chunk))
            keys = []
            for salt in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F):  # order-free fingerprints of the set
                sums = np.zeros(len(h) + 1, dtype=np.uint64)
                np.cumsum(mix(h ^ np.uint64(salt)), out=sums[1:])
                at = np.concatenate([[0], np.cumsum(size)])
                keys.append((sums[at[1:]] - sums[at[:-1]]).view(np.int64))
            bands = _band_keys(signatures(h, owner, len(chunk), ROWS * BANDS)).view(np.int64)
            listed = pa.ListArray.from_arrays(pa.array(np.arange(len(chunk) + 1, dtype=np.int32) * BANDS), pa.array(bands.reshape(-1)))
            ids = batch.column("doc_id").slice(chunk.rows.start, len(chunk))
            yield pa.RecordBatch.from_arrays([ids, pa.array(size), pa.array(keys[0]), pa.array(keys[1]), listed], ["doc_id", "n_shingles", "k1", "k2", "bands"])


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The full set of each document: its sorted hashes, 8 bytes each."""
    for batch in batches:
        for chunk in text_chunks(batch.column("text")):
            h, owner = shingle_sets(chunk)
            at = np.searchsorted(owner, np.arange(len(chunk) + 1))
            ids = batch.column("doc_id").slice(chunk.rows.start, len(chunk))
            sets = [h[at[i] : at[i + 1]].tobytes() for i in range(len(chunk))]
            yield pa.RecordBatch.from_arrays([ids, pa.array(sets, pa.binary())], ["id", "grams"])


def linked(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    """Whether two sorted distinct hash arrays reach the threshold."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)) or not len(a):
        return False
    both = np.concatenate([a, b])
    both.sort()
    same = int((both[1:] == both[:-1]).sum())
    return 100 * same >= percent * (len(a) + len(b) - same)


def _confirm(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b = batch.column("grams").to_pylist(), batch.column("hub_grams").to_pylist()
        yield batch.filter(pa.array([linked(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), percent) for x, y in zip(a, b, strict=True)], pa.bool_())).select(["a", "b"])


#: Members of a family or bucket that one side of a block pair holds.
BLOCK = 256
#: Families up to this size are compared as a whole, larger ones bucket by bucket (the links found are the same).
FAMILY = 20_000


def _overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Intersection sizes of all pairs: a product of 0/1 matrices, taken over slices of the shared vocabulary."""
    n = len(sets)
    owner = np.repeat(np.arange(n), [len(x) for x in sets])
    _, column = np.unique(np.concatenate(sets), return_inverse=True)
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    out = np.zeros((n, n), dtype=np.float32)
    width = 4096
    for lo in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        part = slice(*np.searchsorted(column, [lo, lo + width]))
        matrix = np.zeros((n, width), dtype=np.float32)
        matrix[owner[part], column[part] - lo] = 1
        out += matrix @ matrix.T
    return np.rint(out).astype(np.int64)


def _block_links(members: pa.Table, percent: int) -> pa.Table:
    """Links that join components among the members of one block pair (of buckets, each pair in its first shared one)."""
    ids = members.column("id").to_numpy()
    order = np.argsort(ids)
    members, ids = members.take(pa.array(order)), ids[order]
    comp = members.column("component").to_numpy()
    size = members.column("n_shingles").to_numpy()
    test = (comp[:, None] != comp[None, :]) & (100 * np.minimum.outer(size, size) >= percent * np.maximum.outer(size, size))
    if members.column("bucket")[0].as_py():
        band = members.column("bands").combine_chunks().flatten().to_numpy().reshape(len(ids), BANDS)
        for b in range(int(np.flatnonzero(band[0] == members.column("key")[0].as_py())[0])):
            test &= band[:, None, b] != band[None, :, b]
    test &= np.tri(len(ids), k=-1, dtype=bool)
    if not test.any():
        return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
    used = np.flatnonzero(test.any(axis=0) | test.any(axis=1))
    packed = members.column("grams").take(pa.array(used)).to_pylist()
    same = _overlaps([np.frombuffer(x, np.uint64) for x in packed])
    union = size[used][:, None] + size[used][None, :] - same
    found = np.argwhere((100 * same >= percent * union) & test[np.ix_(used, used)])
    root = {int(c): int(c) for c in comp[used]}
    links = []
    for i, j in found:  # a spanning forest of the components is enough
        x, y = int(comp[used[i]]), int(comp[used[j]])
        while root[x] != x:
            x = root[x]
        while root[y] != y:
            y = root[y]
        if x != y:
            root[max(x, y)] = min(x, y)
            links.append((int(ids[used[i]]), int(ids[used[j]])))
    return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([y for _, y in links], pa.int64())})


def _with_component(ids: DataFrame, found: DataFrame) -> DataFrame:
    """``ids(id, ...)`` with the component of ``found`` or, without a link, the id itself."""
    return ids.join(found, "id", "left").withColumn("component", F.coalesce("component", "id"))


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every document (see the module for the method)."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    signed = store(map_arrow(texts, _signed, "doc_id long, n_shingles long, k1 long, k2 long, bands array<long>"))
    filled = signed.where("n_shingles > 0")
    classes = store(filled.groupBy("k1", "k2", "n_shingles").agg(F.min("doc_id").alias("rep")))
    reps = filled.join(classes.select("k1", "k2", "n_shingles", F.col("rep").alias("doc_id")), ["k1", "k2", "n_shingles", "doc_id"], "left_semi")
    reps = store(reps.dropDuplicates(["doc_id"]).select(F.col("doc_id").alias("id"), "n_shingles", "bands"))

    banded = reps.select("id", "n_shingles", F.explode("bands").alias("key"))
    hubs = banded.groupBy("key").agg(F.min("id").alias("hub"), F.count(F.lit(1)).alias("members")).where("members > 1")
    shared = store(banded.join(hubs, "key"))  # only buckets of two or more
    pairs = store(shared.where("id <> hub").select(F.col("id").alias("a"), F.col("hub").alias("b")).distinct())

    needed = shared.select("id").distinct()
    sets = store(map_arrow(texts.join(needed.select(F.col("id").alias("doc_id")), "doc_id").dropDuplicates(["doc_id"]), _packed, "id long, grams binary"))
    both = pairs.join(sets.withColumnRenamed("id", "a"), "a").join(sets.select(F.col("id").alias("b"), F.col("grams").alias("hub_grams")), "b")
    links = store(map_arrow(both.select("a", "b", "grams", "hub_grams"), lambda b: _confirm(b, percent), "a long, b long"))

    found = components(links)
    members = store(_with_component(shared.where("members > 2").drop("hub"), found))
    mixed = store(members.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi").select("key"))
    # Documents that such buckets connect form a family; each lies in one family, but in many buckets.
    tied = store(shared.join(mixed, "key").where("members > 2").select("id", "key", "hub", "members"))
    family = components(tied.where("id <> hub").select(F.col("id").alias("a"), F.col("hub").alias("b")))
    sizes = family.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    family = store(family.join(sizes, "component").select("id", F.col("component").alias("family"), "size"))
    whole = family.where(F.col("size") <= FAMILY).select("id", F.lit(False).alias("bucket"), F.col("family").alias("key"), F.col("size").alias("members"))
    large = family.where(F.col("size") > FAMILY).select("id")
    parts = tied.join(large, "id", "left_semi").select("id", F.lit(True).alias("bucket"), "key", "members")
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    spread = (
        whole.unionByName(parts)
        .withColumn("own", F.pmod(F.xxhash64("id"), blocks.cast("long")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        .select("id", "bucket", "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    )
    details = _with_component(reps, found).join(sets, "id")
    full = spread.join(details, "id")
    more = store(full.groupBy("bucket", "key", "i", "j").applyInArrow(lambda members: _block_links(members, percent), "a long, b long"))

    grouped = components(links.unionByName(more))
    grouped = _with_component(classes.select("k1", "k2", "n_shingles", F.col("rep").alias("id")), grouped)
    out = signed.join(grouped.select("k1", "k2", "n_shingles", "component"), ["k1", "k2", "n_shingles"], "left")
    component = F.coalesce("component", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def keep_one(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One document of each group (the smallest doc_id) and every document that stands alone, with their own columns.

    Of repeated rows with one doc_id all stay or all go; a null doc_id stays.
    """
    name = spare_name(docs, "dropped_id")
    dropped = near_duplicates(docs, percent).where("NOT kept").select(F.col("doc_id").alias(name)).distinct()
    return docs.join(dropped, F.col("doc_id") == F.col(name), "left_anti")
