"""Words, lines and segments whose polynomial hashes agree (Thue-Morse strings) are told apart."""

from __future__ import annotations

import hashlib

import numpy as np
import pytest

from reelyard.llm import decontaminate, fuzzydedup, neardup, pitmanyor, quality, suffixdedup
from reelyard.llm.textscan import SpanHasher, word_keys
from tests.llm import cases


def thue_morse(bits: int) -> tuple[str, str]:
    bit = [bin(i).count("1") % 2 for i in range(1 << bits)]
    return "".join("ab"[b] for b in bit), "".join("ba"[b] for b in bit)


PAIRS = [thue_morse(10), thue_morse(11)]


def docs(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


@pytest.mark.parametrize("a,b", PAIRS, ids=["1024", "2048"])
def test_the_pair_collides_in_the_polynomial_only(a, b):
    data = np.frombuffer((a + b).encode(), np.uint8)
    start, end = np.array([0, len(a)]), np.array([len(a), 2 * len(a)])
    assert len(set(SpanHasher(data)(start, end).tolist())) == 1
    assert len(set(word_keys(data, start, end).tolist())) == 2


def test_word_keys_of_all_lengths():
    words = [b"a" * n for n in range(1, 40)] + [b"a\0", b"a\0\0", b"\0", b"abcdefgh", b"abcdefghi", b"ABCDEFGHI"]
    data = np.frombuffer(b"".join(words), np.uint8)
    end = np.cumsum([len(w) for w in words])
    start = end - [len(w) for w in words]
    assert len(set(word_keys(data, start, end).tolist())) == len(words)
    low = word_keys(data, start, end, lower=True)
    assert low[-1] == low[-2] and len(set(low.tolist())) == len(words) - 1


@pytest.mark.parametrize("a,b", PAIRS, ids=["1024", "2048"])
def test_operators_tell_them_apart(spark, a, b):
    prose = cases.prose(9, 70)
    one, two = f"{prose}\n{a}\n{a} x\n{a}", f"{prose}\n{a}\n{b} x\n{b}"
    frame = docs(spark, [one, two])
    said = {r.doc_id: r for r in quality.report(frame, quality.fit(frame, cases.labels(spark))).collect()}
    assert [said[i].n_dup_lines for i in (0, 1)] == [1, 1 - 1]
    near = {r.doc_id: r for r in neardup.near_duplicates(docs(spark, [" ".join([a] * 9), " ".join([b] * 9)])).collect()}
    assert near[1].component_id == 1
    scored = {r.doc_id: r for r in pitmanyor.score(docs(spark, [a, b, "c", "c", "c", "c"])).collect()}
    held = [i for i in range(6) if scored[i].held_out]
    assert all(scored[i].n_known == 1 for i in (0, 1) if i in held) and all(scored[i].n_known == 2 for i in (0, 1) if i not in held)
    items = spark.createDataFrame([(1, " ".join(f"{a} w{i}" for i in range(6)))], "item_id long, text string")
    hit = {r.doc_id: r.n_items for r in decontaminate.report(docs(spark, [" ".join(f"{x} w{i}" for i in range(6)) for x in (a, b)]), items).collect()}
    assert hit == {0: 1, 1: 0}
    fuzzy = {r.doc_id: r.n_passages for r in fuzzydedup.report(docs(spark, [" ".join([a] * 60), " ".join([b] * 60)])).collect()}
    assert fuzzy == {0: 0, 1: 0}
    cut = {r.doc_id: r for r in suffixdedup.report(docs(spark, ["x" + a + "y", "z" + b + "w", "z" + b + "w"])).collect()}
    assert cut[0].n_bytes == len(a) + 2 and cut[1].n_removed == cut[2].n_removed == len(a) + 2
    want = _removed_by_brute_force(["x" + a + "y", "z" + b + "w", "z" + b + "w"])
    assert [(cut[i].n_removed, cut[i].kept_sha256) for i in range(3)] == want


def _removed_by_brute_force(texts, length=200):
    seen: dict[str, int] = {}
    for t in texts:
        for i in range(len(t) - length + 1):
            seen[t[i : i + length]] = seen.get(t[i : i + length], 0) + 1
    out = []
    for t in texts:
        gone = set()
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone.update(range(i, i + length))
        kept = "".join(c for i, c in enumerate(t) if i not in gone)
        out.append((len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out
