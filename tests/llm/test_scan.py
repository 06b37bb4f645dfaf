"""Word, line and gram scanning, packing and suffix sorting against plain Python."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from reelyard.llm import packing, suffixsort, textscan
from reelyard.llm.superminhash import signatures

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aAbé \t\n\x0b\x0c\r\x00🙂", max_size=30)), max_size=8)


@settings(max_examples=200, deadline=None)
@given(TEXTS, st.integers(1, 40))
def test_words_and_lines(texts, chunk):
    words, lines = [], []
    for c in textscan.text_chunks(pa.array(texts, pa.string()), chunk):
        start, end, doc = c.words()
        words += [(c.rows.start + int(d), c.data[a:b].tobytes()) for a, b, d in zip(start, end, doc, strict=True)]
        start, end, doc = c.lines()
        lines += [(c.rows.start + int(d), c.data[a:b].tobytes()) for a, b, d in zip(start, end, doc, strict=True)]
    plain = [(t or "").encode() for t in texts]
    assert words == [(i, w) for i, t in enumerate(plain) for w in t.split()]
    assert lines == [(i, w) for i, t in enumerate(plain) for w in t.split(b"\n")]


@settings(max_examples=100, deadline=None)
@given(TEXTS)
def test_equal_words_have_equal_hashes(texts):
    seen: dict[bytes, int] = {}
    for c in textscan.text_chunks(pa.array(texts, pa.string())):
        start, end, _ = c.words()
        for a, b, h in zip(start, end, textscan.SpanHasher(c.data, lower=True)(start, end), strict=True):
            assert seen.setdefault(c.data[a:b].tobytes().lower(), int(h)) == int(h)
    assert len(set(seen.values())) == len(seen)


def test_grams_stay_inside_documents():
    h, at = textscan.grams(np.arange(10, dtype=np.uint64), np.array([0] * 4 + [1] * 6), 3)
    assert at.tolist() == [0, 1, 4, 5, 6, 7] and len(set(h.tolist())) == 6


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 2**40), max_size=300))
def test_packed_integers_come_back(values):
    x = np.array(values, dtype=np.int64)
    assert (packing.unpack(packing.pack(x)) == x).all()
    assert (packing.unpack_sorted(packing.pack_sorted(np.sort(x))) == np.sort(x)).all()
    assert (packing.unpack_ranks(packing.pack_ranks(x % 5_000_000)) == x % 5_000_000).all()
    assert (packing.unpack_ranks(packing.pack_ranks(x % 4_000_000)) == x % 4_000_000).all()


@settings(max_examples=300, deadline=None)
@given(st.binary(max_size=60).map(lambda b: bytes(97 + x % 3 for x in b)), st.integers(0, 3))
def test_suffix_order_and_common_prefixes(body, copies):
    text = body * (copies + 1)
    data = np.frombuffer(text, np.uint8)
    order = suffixsort.suffix_order(data, np.ones(len(data), dtype=bool), len(data) + 8)
    assert order.tolist() == sorted(range(len(text)), key=lambda i: text[i:])
    common = suffixsort.common_prefix(data, order, len(data) + 8)
    for k in range(1, len(order)):
        a, b = text[order[k - 1] :], text[order[k] :]
        assert common[k] == next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))


@settings(max_examples=100, deadline=None)
@given(st.binary(min_size=1, max_size=80).map(lambda b: bytes(97 + x % 2 for x in b)), st.data())
def test_only_wanted_suffixes_are_ordered(text, data):
    wanted = np.array(data.draw(st.lists(st.booleans(), min_size=len(text), max_size=len(text))))
    order = suffixsort.suffix_order(np.frombuffer(text, np.uint8), wanted, len(text) + 8)
    assert order[wanted[order]].tolist() == sorted(np.flatnonzero(wanted).tolist(), key=lambda i: text[i:])


def test_superminhash_estimates_similarity_with_less_variance_than_minhash():
    rng = np.random.default_rng(5)
    m, n, pairs = 120, 60, 300
    elements, owner, true = [], [], []
    for i in range(pairs):
        pool = rng.integers(0, 2**63, 2 * n, dtype=np.uint64)
        a, b = pool[: n + 40], pool[40:]
        true.append(len(np.intersect1d(a, b)) / len(np.union1d(a, b)))
        elements += [a, b]
        owner += [np.full(len(a), 2 * i), np.full(len(b), 2 * i + 1)]
    found = signatures(np.concatenate(elements), np.concatenate(owner), 2 * pairs, m)
    error = (found[::2] == found[1::2]).mean(axis=1) - np.array(true)
    assert abs(error.mean()) < 0.01
    assert error.var() < np.mean([t * (1 - t) / m for t in true])  # the variance of independent minima


def test_signatures_do_not_depend_on_order_or_company():
    rng = np.random.default_rng(6)
    a, b = rng.integers(0, 2**63, 50, dtype=np.uint64), rng.integers(0, 2**63, 3, dtype=np.uint64)
    both = signatures(np.concatenate([a, b]), np.repeat([0, 1], [50, 3]), 3, 40)
    assert (both[0] == signatures(a[::-1].copy(), np.zeros(50, dtype=int), 1, 40)[0]).all()
    assert (both[1] == signatures(b, np.zeros(3, dtype=int), 1, 40)[0]).all()
    assert (both[2] == np.iinfo(np.uint64).max).all()
