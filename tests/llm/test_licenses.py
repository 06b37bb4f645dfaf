"""Licence scan against a brute-force phrase count and hand-made template texts."""

from __future__ import annotations

import re

import pytest

from reelyard.llm import licensescan as L
from reelyard.llm.licensetemplates import PHRASES, TEMPLATES
from tests.llm import cases

MIT = next(m for label, m in TEMPLATES if label == "mit" and len(m) > 500)


def fill(markup: str, optional: bool, words: str = "some holder") -> str:
    """A text that follows the template."""
    text = re.sub(r"<<var;(\d+)-\d+>>", lambda m: "" if m[1] == "0" else " ".join((words.split() * 9)[: int(m[1])]), markup)
    if optional:
        return re.sub(r"<<\w+>>", " ", text)
    return re.sub(r"<<beginOptional>>.*?<<endOptional>>", " ", text)


def run(spark, texts, **kw):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(2)
    return [r for _, r in sorted((r.doc_id, r) for r in L.report(docs, **kw).collect())]


def brute(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    at = [(i, label) for phrase, label in PHRASES.items() for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
    return len(words), len(at), min((i for i, _ in at), default=None), max((i for i, _ in at), default=None), ",".join(sorted({label for _, label in at}))


AWKWARD = [
    None, "", "MIT License", "mit-LICENSE mit license", "the mit\nlicense.", "mitlicense", "mit licenses", "émit license", "MIT Licénse", "mit",
    "cc by cc by", "CC BY-NC 4.0", "GNU General Public License " * 30, "gnu general public", "apache \x7f license", "İMİT license", "mit license 漢字 cc  by",
    "x " * 40_000 + "Apache License", cases.prose(3, 5000) + " cc by", "redistributed redistribution", "permission is " * 3000,
]


def test_phrases_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(L, "PHRASE_SCORE", 0.5)
    for text, r in zip(AWKWARD, run(spark, AWKWARD), strict=True):
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute(text), text and text[:60]
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1
        assert r.score >= (0.5 if r.n_base else 0)


@pytest.mark.parametrize("k", range(len(TEMPLATES)), ids=lambda k: f"{k}-{TEMPLATES[k][0]}")
def test_every_template_takes_its_own_wording_only(spark, k):
    label, markup = TEMPLATES[k]
    scanner = L.Scanner({}, [TEMPLATES[k]])

    def labels(text):
        import pyarrow as pa

        chunk = next(L.text_chunks(pa.array([text])))
        ids, _, _, doc = scanner.word_ids(chunk)
        return {x for _, found, _ in scanner.walks(ids, doc) for x in found}

    for optional in (False, True):
        text = fill(markup, optional)
        assert labels(text) == labels("before, it " + text.upper() + "\nafter it") == {label}
    words = fill(markup, False).split()
    missing = len(words) - 1  # a mandatory word; before it no region has room
    assert labels(" ".join(words[:missing] + ["otherwords"] + words[missing:])) == set()
    assert labels(" ".join(words[:missing] + words[missing + 1 :])) == set()


def test_regions_scores_and_spans(spark):
    toy = [("toy", "alpha beta <<var;1-3>> gamma <<beginOptional>>delta <<var;0-1>> eps<<endOptional>> zeta")]
    texts = ["Alpha beta x gamma zeta", "alpha beta x y z gamma delta eps zeta", "alpha beta gamma zeta", "alpha beta w x y z gamma zeta",
             "alpha beta x gamma delta q eps zeta!", "alpha beta x gamma eps zeta", "alpha beta x gamma", "beta gamma zeta", "alpha alpha beta alpha beta gamma zeta"]
    got = run(spark, texts, phrases={}, templates=toy)
    assert [r.labels for r in got] == ["toy", "toy", "", "", "toy", "", "", "", "toy"]
    assert [round(r.score, 2) for r in got] == [1, 1, 0.5, 0.5, 1, 0.75, 0.75, 0, 1]
    docs = spark.createDataFrame([(5, "é mit license, Alpha beta x gamma zeta.")], "doc_id long, text string")
    spans = {r.kind: r for r in L.matches(docs, {"mit license": "mit"}, toy).collect()}
    raw = "é mit license, Alpha beta x gamma zeta.".encode()
    assert raw[spans["template"].first_byte : spans["template"].end_byte] == b"Alpha beta x gamma zeta" and spans["template"].first_word == 3
    assert raw[spans["phrase"].first_byte : spans["phrase"].end_byte] == b"mit license" and spans["phrase"].n_words == 2


def test_long_text_small_state_table_and_bad_markup(spark, monkeypatch):
    monkeypatch.setattr(L, "MAX_STATES", 3)
    text = cases.prose(8, 200_000) + "\n" + fill(MIT, True)
    (r,) = run(spark, [text])
    assert r.labels.split(",") == ["mit"] and r.n_words == brute(text)[0] and r.score == 1
    for markup in ("a <<beginOptional>> b", "a <<var;3-1>> b", "a <<what>> b"):
        with pytest.raises(ValueError):
            L.parse_template(markup)
    with pytest.raises(ValueError):
        L.Scanner({}, [("one", "word <<var;0-3>>")])
