"""Licence scan: template markup compiled into token automata, run over the words of every text.

A template's optional and replaceable regions become branches of one automaton over words (``compile_templates``); a text
is accepted where some stretch of its words follows a template from start to end, so that the mandatory wording matches
exactly, in order and without a gap, while optional regions may be missing and replaceable ones hold any words up to
their bound.  A plain phrase list (``phrases``) is counted beside the templates: every place where a phrase's words stand
consecutively.

The work is one ``mapInArrow`` pass without a shuffle.  Words get their vocabulary number by numpy, exactly: up to eight
bytes a word is its own key, and longer words that share a vocabulary word's first eight bytes are looked up by their
bytes.  The automaton is only walked from places where two consecutive words can begin a template (a replaceable region at
a template's front is left out of that test), and a walk is never longer than the longest template, so time is linear in
the text, long texts and repeated stock phrases included.  Walks share a table of determinised states that is filled as
needed and emptied at ``MAX_STATES``; templates (a few kilobytes, a parameter) are the only thing that goes to the tasks.

Defined results: a null text is read as empty and has no words; an empty table gives an empty result; repeated rows and
null ids get a row each; other columns are not read, whatever their names.  ``score`` is 1 for a text that a template
accepts, otherwise the largest share of a template's mandatory words that a walk of at least two of them followed, and at
least ``PHRASE_SCORE`` if a phrase occurs.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelyard.llm.common import map_arrow
from reelyard.llm.licensetemplates import PHRASES, TEMPLATES
from reelyard.llm.textscan import PUNCTUATED, Chunk, fold, text_chunks

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
PHRASE_SCORE = 0.5
#: Determinised states kept by a task at once.
MAX_STATES = 50_000
_MARK = re.compile(r"<<([^<>]*)>>")
_BLOCK = 8
_MASKS = np.array([(1 << (8 * k)) - 1 for k in range(_BLOCK)] + [2**64 - 1], dtype=np.uint64)


def words_of(text: str) -> list[bytes]:
    """The words of a text as the scan sees them."""
    return WORD.findall(text.encode().lower())


# --------------------------------------------------------------------------- templates

def parse_template(markup: str) -> list:
    """Markup as a nested list: words, ``("any", least, most)``, ``("optional", [...])``."""
    stack: list[list] = [[]]
    at = 0
    for mark in _MARK.finditer(markup):
        stack[-1] += words_of(markup[at : mark.start()])
        at = mark.end()
        kind = mark.group(1)
        if kind == "beginOptional":
            stack.append([])
        elif kind == "endOptional" and len(stack) > 1:
            part = stack.pop()
            stack[-1].append(("optional", part))
        elif bounds := re.fullmatch(r"var;(\d+)-(\d+)", kind):
            least, most = int(bounds[1]), int(bounds[2])
            if least > most:
                raise ValueError(f"region {mark.group(0)}: {least} is more than {most}")
            stack[-1].append(("any", least, most))
        else:
            raise ValueError(f"unknown mark {mark.group(0)}")
    if len(stack) > 1:
        raise ValueError("an optional region has no end")
    return stack[0] + words_of(markup[at:])


class Automaton:
    """All templates as one automaton over vocabulary numbers (0: a word of no template), determinised while it runs.

    A state of the undetermined automaton is one place in one template.  ``done`` holds its share of the template's
    mandatory words, ``ends`` the labels of places where a template is complete.
    """

    def __init__(self, templates: list[tuple[str, str]], vocabulary: dict[bytes, int]):
        self.step: list[dict[int, int]] = []
        self.wild: list[int] = []
        self.skip: list[list[int]] = []
        self.done: list[float] = []
        self.words: list[int] = []
        self.ends: dict[int, str] = {}
        self.vocabulary = vocabulary
        starts = [self._build(label, parse_template(markup)) for label, markup in templates]
        self.begin = self._closed(starts)
        self.pairs = self._first_pairs(starts)
        self.longest = len(self.step)
        self._sets: dict[frozenset, tuple[dict, tuple[str, ...], float]] = {}

    def _new(self, words: int) -> int:
        self.step.append({})
        self.wild.append(-1)
        self.skip.append([])
        self.words.append(words)
        self.done.append(0.0)
        return len(self.step) - 1

    def _build(self, label: str, parts: list) -> int:
        first = self._new(0)
        last = self._chain(first, parts)
        total = self.words[last]
        if total < 2:
            raise ValueError(f"template {label!r} needs two mandatory words at least")
        for s in range(first, len(self.step)):
            self.done[s] = self.words[s] / total if self.words[s] >= 2 else 0.0
        self.ends[last] = label
        return first

    def _chain(self, at: int, parts: list, counted: bool = True) -> int:
        for part in parts:
            if isinstance(part, bytes):
                to = self._new(self.words[at] + counted)
                self.step[at][self.vocabulary[part]] = to
                at = to
            elif part[0] == "any":
                lasts = []
                for k in range(part[2]):
                    if k >= part[1]:
                        lasts.append(at)
                    to = self._new(self.words[at])
                    self.wild[at] = to
                    at = to
                after = self._new(self.words[at])
                for s in [*lasts, at]:
                    self.skip[s].append(after)
                at = after
            else:
                inner = self._new(self.words[at])
                out = self._chain(inner, part[1], False)
                after = self._new(self.words[at])
                self.skip[at] += [inner, after]
                self.skip[out].append(after)
                at = after
        return at

    def _closed(self, states) -> frozenset:
        seen, todo = set(), list(states)
        while todo:
            s = todo.pop()
            if s not in seen:
                seen.add(s)
                todo += self.skip[s]
        return frozenset(seen)

    def _first_pairs(self, starts: list[int]) -> dict[int, set[int] | None]:
        """For each word that can begin a walk, the words that can follow (None: any).

        A walk may also begin after a replaceable region at a template's front: its words are any words.
        """
        front = set(self.begin)
        todo = list(front)
        while todo:
            to = self.wild[todo.pop()]
            if to >= 0 and to not in front:
                new = self._closed([to]) - front
                front |= new
                todo += new
        self.fronts = frozenset(front)
        pairs: dict[int, set[int] | None] = {}
        for s in front:
            for word, to in self.step[s].items():
                after = self._closed([to])
                if any(self.wild[t] >= 0 for t in after):
                    pairs[word] = None
                elif pairs.setdefault(word, set()) is not None:
                    pairs[word] |= {w for t in after for w in self.step[t]}
        return pairs

    def _known(self, states: frozenset) -> tuple[dict, tuple[str, ...], float]:
        if states not in self._sets:
            if len(self._sets) >= MAX_STATES:
                self._sets.clear()
            self._sets[states] = ({}, tuple(sorted({self.ends[s] for s in states if s in self.ends})), max((self.done[s] for s in states), default=0.0))
        return self._sets[states]

    def walk(self, ids: list[int], at: int, end: int) -> tuple[dict[str, int], float]:
        """From word ``at``: the labels accepted, each with the end of its longest match, and the best share followed."""
        found: dict[str, int] = {}
        best = 0.0
        states = self.fronts
        while True:
            moves, labels, share = self._known(states)
            best = max(best, share)
            for label in labels:
                found[label] = at
            if at == end:
                return found, best
            word = ids[at]
            to = moves.get(word)
            if to is None:
                to = moves[word] = self._closed([*(self.step[s][word] for s in states if word in self.step[s]), *(self.wild[s] for s in states if self.wild[s] >= 0 and states is not self.fronts)])
            if not to:
                return found, best
            states = to
            at += 1


class Scanner:
    """Phrases and templates ready to run over chunks of documents."""

    def __init__(self, phrases: dict[str, str], templates: list[tuple[str, str]]):
        spelled = {p: words_of(p) for p in phrases}
        if any(not w for w in spelled.values()):
            raise ValueError("a phrase needs a word")

        def all_words(parts):
            for part in parts:
                if isinstance(part, bytes):
                    yield part
                elif part[0] == "optional":
                    yield from all_words(part[1])

        known = sorted({w for ws in spelled.values() for w in ws} | {w for _, m in templates for w in all_words(parse_template(m))})
        self.vocabulary = {w: i + 1 for i, w in enumerate(known)}
        self.phrases = [(phrases[p], [self.vocabulary[w] for w in spelled[p]]) for p in phrases]
        self.automaton = Automaton(templates, self.vocabulary)
        short = {int.from_bytes(w.ljust(_BLOCK, b"\0"), "little"): i for w, i in self.vocabulary.items() if len(w) <= _BLOCK}
        self.short = np.array(sorted(short), dtype=np.uint64)
        self.short_id = np.array([short[int(k)] for k in self.short], dtype=np.int64)
        self.long = np.array(sorted({int.from_bytes(w[:_BLOCK], "little") for w in self.vocabulary if len(w) > _BLOCK}), dtype=np.uint64)
        pairs = self.automaton.pairs
        self.opens = np.zeros(len(known) + 1, dtype=bool)  # words that begin a walk whatever follows
        self.opens[[w for w, after in pairs.items() if after is None]] = True
        self.first_two = np.array(sorted(w << 32 | b for w, after in pairs.items() if after is not None for b in after), dtype=np.int64)

    def word_ids(self, chunk: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Vocabulary number (0: none), start, end and document of each word."""
        start, end, doc = chunk.words(PUNCTUATED)
        lower = fold(chunk.data)
        padded = np.concatenate([lower, np.zeros(_BLOCK, dtype=np.uint8)])
        blocks = np.ndarray((len(lower) + 1,), dtype="<u8", buffer=padded, strides=(1,))
        size = end - start
        key = blocks[start] & _MASKS[np.minimum(size, _BLOCK)]
        ids = np.zeros(len(start), dtype=np.int64)
        if len(self.short):
            at = np.minimum(np.searchsorted(self.short, key), len(self.short) - 1)
            hit = (self.short[at] == key) & (size <= _BLOCK)
            ids[hit] = self.short_id[at[hit]]
        if len(self.long):
            at = np.minimum(np.searchsorted(self.long, key), len(self.long) - 1)
            raw = lower.tobytes()
            for k in np.flatnonzero((self.long[at] == key) & (size > _BLOCK)).tolist():
                ids[k] = self.vocabulary.get(raw[start[k] : end[k]], 0)
        return ids, start, end, doc

    def places(self, ids: np.ndarray, doc: np.ndarray) -> Iterator[tuple[str, np.ndarray, int]]:
        """Label, places and length of each phrase."""
        for label, spelled in self.phrases:
            n = len(ids) - len(spelled) + 1
            if n <= 0:
                continue
            hit = doc[:n] == doc[len(spelled) - 1 :]
            for k, word in enumerate(spelled):
                hit &= ids[k : n + k] == word
            yield label, np.flatnonzero(hit), len(spelled)

    def walks(self, ids: np.ndarray, doc: np.ndarray) -> Iterator[tuple[int, dict[str, int], float]]:
        """Start, accepted labels with their ends, and best share, of each walk."""
        if len(ids) < 2 or not len(self.automaton.begin):
            return
        same = doc[:-1] == doc[1:]
        start = (self.opens[ids[:-1]] | np.isin(ids[:-1] << 32 | ids[1:], self.first_two)) & same & (ids[:-1] > 0)
        at = np.flatnonzero(start)
        if not len(at):
            return
        bounds = np.searchsorted(doc, doc[at], "right")
        listed = None
        for k, end in zip(at.tolist(), bounds.tolist(), strict=True):
            listed = listed or ids.tolist()
            yield k, *self.automaton.walk(listed, k, end)


def _scanner(phrases, templates):
    return Scanner(PHRASES if phrases is None else phrases, TEMPLATES if templates is None else templates)


REPORT = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"


def report(docs: DataFrame, phrases: dict[str, str] | None = None, templates: list[tuple[str, str]] | None = None) -> DataFrame:
    """``doc_id``, word count, phrase places, labels and score of every row of ``docs``."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = _scanner(phrases, templates)
        for batch in batches:
            n = batch.num_rows
            n_words, n_base = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
            first: list[int | None] = [None] * n
            last: list[int | None] = [None] * n
            base: list[set[str]] = [set() for _ in range(n)]
            more: list[set[str]] = [set() for _ in range(n)]
            score = np.zeros(n)
            for chunk in text_chunks(batch.column("text")):
                ids, _, _, doc = scanner.word_ids(chunk)
                row0 = chunk.rows.start
                n_words[row0 : row0 + len(chunk)] = np.bincount(doc, minlength=len(chunk))
                word0 = np.searchsorted(doc, np.arange(len(chunk)))
                for label, places, _ in scanner.places(ids, doc):
                    for at, d in zip(places.tolist(), doc[places].tolist(), strict=True):
                        row, k = row0 + d, at - int(word0[d])
                        n_base[row] += 1
                        base[row].add(label)
                        first[row] = k if first[row] is None else min(first[row], k)
                        last[row] = k if last[row] is None else max(last[row], k)
                        score[row] = max(score[row], PHRASE_SCORE)
                for at, labels, share in scanner.walks(ids, doc):
                    row = row0 + int(doc[at])
                    more[row] |= labels.keys()
                    score[row] = max(score[row], share)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n_words), pa.array(n_base), pa.array(first, pa.int64()), pa.array(last, pa.int64()),
                 pa.array([",".join(sorted(b)) for b in base], pa.string()),
                 pa.array([",".join(sorted(b | m)) for b, m in zip(base, more, strict=True)], pa.string()), pa.array(score)],
                ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"],
            )

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_arrow(texts, scan, REPORT)


MATCHES = "doc_id long, label string, kind string, first_word long, n_words long, first_byte long, end_byte long"


def matches(docs: DataFrame, phrases: dict[str, str] | None = None, templates: list[tuple[str, str]] | None = None) -> DataFrame:
    """One row for each phrase place and each stretch that a template accepts (``kind``: phrase or template).

    Of one template's label only the longest match from a start is given.  Bytes count in the text's UTF-8 form.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = _scanner(phrases, templates)
        for batch in batches:
            found = []
            rows = batch.column("doc_id").to_pylist()
            for chunk in text_chunks(batch.column("text")):
                ids, start, end, doc = scanner.word_ids(chunk)
                word0 = np.searchsorted(doc, np.arange(len(chunk)))

                def add(label, kind, at, to):
                    d = int(doc[at])
                    zero = int(chunk.offsets[d])
                    found.append((rows[chunk.rows.start + d], label, kind, at - int(word0[d]), to - at, int(start[at]) - zero, int(end[to - 1]) - zero))

                for label, places, size in scanner.places(ids, doc):
                    for at in places.tolist():
                        add(label, "phrase", at, at + size)
                for at, labels, _ in scanner.walks(ids, doc):
                    for label, to in sorted(labels.items()):
                        add(label, "template", at, to)
            columns = list(zip(*found, strict=True)) or [()] * 7
            kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], [f.split()[0] for f in MATCHES.split(", ")])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_arrow(texts, scan, MATCHES)
