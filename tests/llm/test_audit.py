"""Filter audit against its SQL and a brute-force replay; tries with small windows and leaves."""

from __future__ import annotations

import random
import re
from collections import Counter
from itertools import permutations

import duckdb
import pytest

from reelyard.llm import filteraudit as A
from reelyard.llm.oracle import AUDIT
from tests.llm import cases


def rows_of(seed=3):
    draw = random.Random(seed)
    out = []
    for i in range(400):
        text = cases.prose(draw.randrange(60), draw.choice([3, 120, 130]), draw.choice([60, 5000]))
        if draw.random() < 0.2:
            text = text.upper()
        if draw.random() < 0.2:
            text += " $"
        if draw.random() < 0.3:
            text = "stock text that a third of all rows share " * 3
        if draw.random() < 0.3:  # one long beginning for many texts
            text = "the same long beginning " * 4 + text
        out.append((draw.choice([i, i, i // 3]), draw.choice([None, "", text, text, text, text]), draw.choice([None, "", "en", "de"])))
    out += out[:20] + [(None, out[30][1], "en"), (None, "only here", None)]
    out += [(500, "a", "en"), (501, "ab", "en"), (502, "abc", "en"), (503, "ab", "de"), (504, "é\u0080", "x"), (505, "x" * 300_000, "en"), (506, "x" * 300_000, "en"), (507, "x" * 300_000 + "y", "en")]
    return out


LABELS = [(i, i % 2, i % 3 == 0) for i in range(0, 400, 2)] + [(4, 1, 0), (6, None, 1), (None, 1, 1)]


def frames(spark, rows):
    docs = spark.createDataFrame([(i, t, p, 1, 2, "k") for i, t, p in rows], "doc_id long, text string, lang string, mask int, n long, leaf string").repartition(4)
    return docs, cases.labels(spark, [(i, q, None if t is None else int(t)) for i, q, t in LABELS])


def brute(rows):
    least, masks = {}, []
    for i, t, _ in rows:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    good, bad = {i for i, q, _ in LABELS if q == 1}, {i for i, _, t in LABELS if t}
    for i, t, p in rows:
        t = t or ""
        w = [x for x in re.split(r"[ \t-\r]+", t) if x]
        mask = (len(w) < 100) + 2 * (100 * len(set(w)) < 80 * len(w)) + 4 * (100 * sum("A" <= c <= "Z" for c in t) > 10 * len(t))
        mask += 8 * any(c in t for c in "#$%&*|") + 16 * (i is not None and least[t] < i)
        masks.append((p or "", mask, i is not None and i in good, i is not None and i in bad))
    out = {}
    for part in {m[0] for m in masks}:
        mine = [m for m in masks if m[0] == part]
        shapley = Counter()
        for order in permutations("ABCDE"):
            left, gone = list(mine), []
            for step, letter in enumerate(order, 1):
                bit = A._bit(letter)
                here = [m for m in left if m[1] & bit]
                out[part, "".join(order), step] = [len(left) - len(here), len(here), sum(bool(m[1] & bit) for m in gone), sum(m[1] == bit for m in mine), sum(m[2] for m in here), sum(m[3] for m in here), letter]
                shapley[letter] += len(here)
                left, gone = [m for m in left if not m[1] & bit], gone + here
        for k in out:
            if k[0] == part:
                out[k][6] = shapley[out[k][6]]
    return {k: tuple(v) for k, v in out.items()}


@pytest.mark.parametrize("window,leaf", [(A.WINDOW, None), (2000, 300)])
def test_equal_to_brute_force(spark, window, leaf):
    rows = rows_of()
    got = A.report(*frames(spark, rows), window=window, leaf=leaf).collect()
    want = brute(rows)
    assert len(got) == len(want) == 120 * 5 * len({r[2] or "" for r in rows})
    assert {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in got} == want


def test_equal_to_its_sql(spark):
    rows = rows_of(5)
    docs, labels = frames(spark, rows)
    con = duckdb.connect()
    con.register("documents", docs.toPandas())
    con.register("labels", labels.toPandas().astype("Int64"))
    out = A.report(docs, labels)
    want = con.execute(f"SELECT {', '.join(out.columns)} FROM ({AUDIT})").fetchall()
    assert sorted(map(tuple, out.collect())) == sorted(want)


def test_empty_tables_and_messy_rows(spark):
    assert A.report(cases.empty(spark), cases.labels(spark)).collect() == []
    rows = A.report(cases.messy(spark), cases.labels(spark)).collect()
    assert {r.part for r in rows} == {"", "en"} and {r.kept + r.removed for r in rows if r.step == 1} == {7, 14}


def test_trie():
    draw = random.Random(2)
    texts = [bytes(draw.choice(b"ab\xff") for _ in range(draw.randrange(9))) for _ in range(600)]
    trie = A.RadixTrie()
    for t in texts:
        trie.terminal(t, list).append(t)
    assert [(t, e) for t, e in trie] == [(t, [t] * n) for t, n in sorted(Counter(texts).items())]
    assert [e[0] for e in trie.terminals()] == sorted(set(texts))
