"""The pipeline's rows against a brute-force version of its stages."""

from __future__ import annotations

import base64
import re
from collections import Counter

import public_tokenizers as P
import tiktoken

import corpus_pipeline
from reelyard.llm import quality
from reelyard.llm.linededup import STRIP
from tests.conftest import SMOKE
from tests.llm.test_operators import RANKS, brute_components


def test_run_equals_brute_force(spark):
    frame = spark.read.parquet(f"{SMOKE}/documents.parquet")
    labels = spark.read.parquet(f"{SMOKE}/labels.parquet")
    good = {r.doc_id for r in quality.report(frame, quality.fit(frame, labels)).where("kept").collect()}
    texts = {r.doc_id: (r.text or "").encode() for r in frame.collect() if r.doc_id in good}

    key = lambda line: line.strip(STRIP).lower()
    seen = Counter(k for t in texts.values() for k in {key(line) for line in t.split(b"\n")} if k)
    texts = {d: b"\n".join(line for line in t.split(b"\n") if seen[key(line)] < 10) for d, t in texts.items()}

    kept = {d for d, (_, c) in brute_components(texts).items() if d == c}

    plain = lambda t: " ".join(re.findall(r"[a-z0-9\u0080-\U0010ffff]+", t.lower()))
    items = [plain(r.text) for r in spark.read.parquet(f"{SMOKE}/benchmark.parquet").collect()]
    clean = {d for d in kept if not any(i in plain(texts[d].decode()) for i in items)}

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = {d: library.encode_ordinary(texts[d].decode()) for d in clean}
    got = {r.doc_id: r.ids for r in corpus_pipeline.run(spark, SMOKE).collect()}
    assert got == want and 0 < len(want) < len(good) < frame.count()


def test_stages_are_in_order_and_each_takes_effect(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "near_dedup", "decontamination", "byte_bpe"]
    assert corpus_pipeline.ORACLE_SQL is None
