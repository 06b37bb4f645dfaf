"""PII: surrogate generation.  Detected entities get keyed, type-consistent replacements.

1. One scan detects entities (see ``KINDS``) and normalises them, so that all spellings of one entity agree.  Patterns are
   tried only where an entity can start (``Starts``), with the same result as everywhere.  A phone number with and one
   without a country code are two entities; a name that stands after a title is replaced without one, too, in that text.
2. The distinct entities get surrogates from a keyed hash (HMAC-SHA256 of kind, entity and attempt): the same entity gets
   the same surrogate in every document (coreference), and nobody without the key can tell which.
3. Collision check: a surrogate that two entities share, or that is itself an entity of the corpus, is drawn again with
   the next attempt, until all differ (all parts of names together).  Only these rare entities are remembered, as
   (entity, attempt) pairs.
4. A second scan replaces the entities in place.  Documents that hold a remembered entity get its attempt by a join.

Surrogates keep the format: digits, letters, case, punctuation and grouping stay where they were; card numbers keep
their first digit and their check digit's validity, IBANs their country and check digits, addresses their private
ranges, phone numbers their country code, e-mail addresses move to a reserved domain.  Personal names (after a title) keep script, case and gender: given
names come from the list of the title's or the name's gender (several, joined, where one is taken), family names from
the script's syllables; a family name keeps its surrogate also where it stands with another title.

Defined results: a null text stays null without entities, an empty one stays empty; repeated rows are replaced alike; an
empty table gives an empty result; other columns pass through unread, whatever their names.
"""

from __future__ import annotations

import hashlib
import hmac
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelyard.llm.common import map_arrow, spare_name, store
from reelyard.llm.textscan import Chunk, SpanHasher, strings, text_chunks

#: Attempts after which a surrogate may grow by a letter or digit, for kinds whose format has too few values.
GROW_AFTER = 16

# Titles before personal names, by gender, and given names by gender and script.
TITLES = {"m": ("mr", "mister", "sir", "herr", "herrn", "monsieur", "señor", "sr", "don", "господин", "г-н", "κύριος"), "f": ("mrs", "ms", "miss", "madam", "frau", "madame", "mme", "mlle", "señora", "señorita", "sra", "srta", "doña", "госпожа", "г-жа", "κυρία"), "x": ("dr", "prof", "professor", "doctor", "dra")}
GIVEN = {
    ("m", "latin"): ("adam", "bruno", "carl", "daniel", "emil", "felix", "george", "henry", "ivan", "jonas", "kevin", "liam", "martin", "noah", "oscar", "paul", "robert", "simon", "thomas", "victor"),
    ("f", "latin"): ("alice", "bella", "clara", "diana", "emma", "flora", "grace", "helen", "irene", "julia", "karin", "laura", "maria", "nina", "olivia", "paula", "rosa", "sofia", "teresa", "vera"),
    ("m", "cyrillic"): ("алексей", "борис", "виктор", "глеб", "дмитрий", "егор", "иван", "максим", "олег", "павел"),
    ("f", "cyrillic"): ("анна", "вера", "галина", "дарья", "елена", "ирина", "мария", "нина", "ольга", "софья"),
    ("m", "greek"): ("αλέξης", "γιώργος", "δημήτρης", "κώστας", "νίκος", "πέτρος"),
    ("f", "greek"): ("άννα", "ελένη", "ιωάννα", "κατερίνα", "μαρία", "σοφία"),
}
SYLLABLES = {
    "latin": ("ba", "cor", "del", "fen", "gar", "hol", "kem", "lor", "mar", "nev", "pol", "ran", "sel", "tor", "vin", "wes"),
    "cyrillic": ("ба", "вор", "гал", "дер", "зим", "кол", "лаз", "мор", "нов", "пет", "рог", "сав", "тим", "фед", "хар", "чер"),
    "greek": ("βα", "γεω", "δημ", "ζαχ", "θεο", "καρ", "λαμ", "μαν", "νικ", "παπ", "ραλ", "σαβ", "τσι", "φωτ", "χαρ", "ψαρ"),
}

_NAME = r"\p{Lu}[\p{L}’'-]+"
_TITLE = "|".join(sorted({t for ts in TITLES.values() for t in ts}, key=len, reverse=True))
#: Kinds of entities and their patterns, tried in this order at each place.
KINDS = {
    "pem": r"-----BEGIN [A-Z ]*PRIVATE KEY-----[^-]*-----END [A-Z ]*PRIVATE KEY-----",
    "email": r"[\p{L}\p{N}._%+-]+@[\p{L}\p{N}-]+(?:\.[\p{L}\p{N}-]+)*\.\p{L}{2,}",
    "secret": r"""(?i:\b(?:api[_-]?key|secret|token|passw(?:or)?d|pwd)["']?\s*[:=]\s*["']?)(?P<v>[^\s"',;]{6,})""",
    "key": r"\b(?:(?:AKIA|ASIA)[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{20,}|sk-[A-Za-z0-9_-]{20,}|xox[abprs]-[A-Za-z0-9-]{10,}|AIza[A-Za-z0-9_-]{35})(?![A-Za-z0-9])",
    "iban": r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b",
    "ip": r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d]|\.\d)",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "card": r"(?<![\d.-])\d(?:[ -]?\d){12,18}(?![\d-]|\.\d)",
    "phone": r"(?<![\d.])(?:\+\d{1,3}[ .-]?)?\(?\d{2,4}\)?[ .-]\d{3,4}[ .-]\d{3,4}(?![\d]|\.\d)|(?<![\d.])\+\d{8,14}(?!\d)",
    "person": rf"(?i:\b(?P<title>{_TITLE}))\.?\s+(?P<name>{_NAME}(?:\s+{_NAME}){{0,2}})",
}
FIND = regex.compile("|".join(f"(?P<{kind}>{pattern})" for kind, pattern in KINDS.items()))
#: Where entities can start, kind by kind: keywords of secrets, prefixes of keys, titles.
_SECRET_WORD = regex.compile(r"(?i)\b(?:api[_-]?key|secret|token|passw(?:or)?d|pwd)")
_KEY_PREFIX = regex.compile(r"AKIA|ASIA|gh[pousr]_|sk-|xox[abprs]-|AIza|-----BEGIN ")
_KEY_MARKS = ("AKIA", "ASIA", "gh", "sk-", "xox", "AIza", "-----BEGIN ")
_TITLE_WORD = regex.compile(rf"(?i)(?:{_TITLE}|г(?!\p{{L}}))")
_MAIL_CHAR = regex.compile(r"[\p{L}\p{N}._%+-]")
_NO_LETTER = np.array([not chr(b).isalpha() for b in range(128)] + [False] * 128)
#: Distinct words with bytes beyond ASCII that a task remembers.
MAX_WORDS = 200_000


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def _iban_rest(text: str) -> int:
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97


def script(text: str) -> str:
    """``latin``, ``cyrillic`` or ``greek``, by the first letter."""
    for c in text:
        if c.isalpha():
            name = unicodedata.name(c, "")
            return "cyrillic" if name.startswith("CYRILLIC") else "greek" if name.startswith("GREEK") else "latin"
    return "latin"


def find(text: str, starts: Iterable[int] | None = None) -> list[tuple[int, int, str, str]]:
    """``(start, end, kind, entity)`` of the entities of a text, in order; entities are normalised.

    ``starts`` are the places where an entity can start, ascending (every place where one does must be among them);
    without, all places are tried.  A name that stands after a title is found without one, too, in the same text.
    """
    out = []
    people: dict[str, tuple[str, str]] = {}
    for m in FIND.finditer(text) if starts is None else _matches(text, starts):
        lo, hi = m.span()
        kind = next(k for k in KINDS if m.group(k) is not None)
        value = m.group()
        if kind == "secret":
            lo, hi = m.span("v")
            out.append((lo, hi, "secret", text[lo:hi]))
        elif kind == "person":
            title = m.group("title").casefold()
            gender = next((g for g, ts in TITLES.items() if title in map(str.casefold, ts)), "x")
            parts = [(p.start() + m.start("name"), p.group()) for p in regex.finditer(_NAME, m.group("name"))]
            for i, (at, part) in enumerate(parts):
                last = i == len(parts) - 1
                out.append((at, at + len(part), "family" if last else f"given-{_gender(part, gender)}", part.casefold()))
                people.setdefault(part, out[-1][2:])
        elif kind == "card":
            digits = regex.sub(r"\D", "", value)
            if luhn(digits) or (len(digits) == 16 and value.isdigit()):
                out.append((lo, hi, "card", digits))
        elif kind == "phone":
            digits = regex.sub(r"\D", "", value)
            if 7 <= len(digits) <= 15:
                out.append((lo, hi, "phone", "+" * value.startswith("+") + digits))
        elif kind == "iban":
            flat = value.replace(" ", "")
            if _iban_rest(flat) == 1:
                out.append((lo, hi, "iban", flat))
        else:
            out.append((lo, hi, kind, value.lower() if kind == "email" else value))
    return _with_untitled(text, out, people) if people else out


def _with_untitled(text: str, found: list[tuple[int, int, str, str]], people: dict[str, tuple[str, str]]) -> list[tuple[int, int, str, str]]:
    """The entities found, and the other places of the people's names as whole words outside them."""
    names = regex.compile(r"(?<![\p{L}\p{N}_’'-])(?:" + "|".join(map(regex.escape, sorted(people, key=len, reverse=True))) + r")(?![\p{L}\p{N}_’-])")
    out, at = [], 0
    for entity in [*found, (len(text), len(text), "", "")]:
        out += [(*m.span(), *people[m.group()]) for m in names.finditer(text, at, entity[0])]
        if entity[2]:
            out.append(entity)
        at = entity[1]
    return out


def _matches(text: str, starts: Iterable[int]) -> Iterator[regex.Match]:
    """The matches of ``FIND.finditer(text)``, tried at the given places and behind each match."""
    end = 0
    for at in starts:
        if at < end:
            continue
        m = FIND.match(text, at)
        while m:
            yield m
            end = m.end()
            m = FIND.match(text, end)


def _gender(name: str, title: str) -> str:
    """The gender of a given name: its list's, else its title's."""
    for (gender, _), names in GIVEN.items():
        if name.casefold() in names:
            return gender
    return title


class _Draw:
    """A stream of choices from the keyed hash of kind, entity and attempt."""

    def __init__(self, key: bytes, kind: str, entity: str, attempt: int):
        self.seed = hmac.new(key, f"{kind}\0{entity}\0{attempt}".encode(), hashlib.sha256).digest()
        self.state = int.from_bytes(self.seed, "big")
        self.turn = 0

    def below(self, n: int) -> int:
        if self.state < 1 << 64:
            self.turn += 1
            self.state = int.from_bytes(hashlib.sha256(self.seed + self.turn.to_bytes(4, "big")).digest(), "big")
        self.state, out = divmod(self.state, n)
        return out

    def like(self, text: str) -> str:
        """Digits for digits and letters of the same case and script for letters; all else stays."""
        hexadecimal = len(text) >= 8 and set(text) <= set("0123456789abcdef") and not text.isdigit() and not text.isalpha()
        out = []
        for c in text:
            if hexadecimal:
                out.append("0123456789abcdef"[self.below(16)])
            elif c.isdigit():
                out.append(str(self.below(10)))
            elif c.isalpha():
                kind = script(c)
                alphabet = "абвгдежзиклмнопрстуфхцчшэюя" if kind == "cyrillic" else "αβγδεζηθικλμνξοπρστυφχψω" if kind == "greek" else "abcdefghijklmnopqrstuvwxyz"
                d = alphabet[self.below(len(alphabet))]
                out.append(d.upper() if c.isupper() else d)
            else:
                out.append(c)
        return "".join(out)


def surrogate(key: bytes, kind: str, entity: str, attempt: int = 0) -> str:
    """The replacement of a normalised entity, normalised itself."""
    draw = _Draw(key, kind, entity, attempt)
    more = draw.like("a" * (attempt - GROW_AFTER)) if attempt > GROW_AFTER else ""
    digits = draw.like("0" * len(more))
    if kind == "email":
        local, _, host = entity.partition("@")
        labels = host.split(".")[:-2]
        return f"{draw.like(local)}{more}@{'.'.join([*map(draw.like, labels), 'example', ('com', 'net', 'org')[draw.below(3)]])}"
    if kind == "ip":
        octets = entity.split(".")
        fixed = 1 if octets[0] in ("10", "127") else 2 if octets[:2] == ["192", "168"] else 0
        return ".".join(octets[:fixed] + [str(1 + draw.below(223 if i == fixed == 0 else 254)) for i in range(fixed, 4)]) + digits
    if kind == "card":
        body = entity[0] + draw.like(entity[1:-1]) + digits
        valid = luhn(entity)
        return body + next(d for d in "0123456789"[draw.below(10) :] + "0123456789" if luhn(body + d) == valid)
    if kind == "phone":
        country = entity[: max(len(entity) - 10, 2)] if entity.startswith("+") else ""
        out = list(draw.like(entity[len(country) :]))
        for i in {max(len(out) - 10, 0), max(len(out) - 7, 0)}:
            out[i] = str(2 + draw.below(8))
        return country + "".join(out) + digits
    if kind == "iban":
        body = draw.like(entity[4:]) + digits
        return f"{entity[:2]}{98 - _iban_rest(entity[:2] + '00' + body):02d}{body}"
    if kind == "key":
        at = 4
        return entity[:at] + draw.like(entity[at:]) + more
    if kind == "pem":
        head, body, tail = regex.fullmatch(r"(-----BEGIN [^-]*-----)([^-]*)(-----END [^-]*-----)", entity).groups()
        return head + draw.like(body) + more + tail
    if kind.startswith("given-"):
        gender = kind[-1] if kind[-1] in "mf" else "mf"[draw.below(2)]
        names = GIVEN[gender, script(entity)]
        return "-".join(names[draw.below(len(names))] for _ in range(attempt + 1))
    if kind == "family":
        parts = SYLLABLES[script(entity)]
        return "".join(parts[draw.below(len(parts))] for _ in range(max(3, min(5, len(entity) // 3)) + attempt // 4))
    return draw.like(entity) + more


def dress(mention: str, kind: str, core: str) -> str:
    """A normalised surrogate in the format of the mention: its grouping, prefix and case."""
    if kind in ("card", "phone"):
        out, left = [], list(core.removeprefix("+"))
        for c in reversed(mention):
            out.append(left.pop() if c.isdigit() and left else c)
        return "".join(left) + "".join(reversed(out))
    if kind == "iban" and " " in mention:
        return " ".join(core[i : i + 4] for i in range(0, len(core), 4))
    if kind == "email" or kind == "family" or kind.startswith("given-"):
        if mention.isupper():
            return core.upper()
        if mention[:1].isupper():
            return "-".join(p[:1].upper() + p[1:] for p in core.split("-")) if kind != "email" else core[:1].upper() + core[1:]
    return core


_TITLE_HASHES: list[np.ndarray] = []


def _hashes(words: list[bytes]) -> np.ndarray:
    ends = np.cumsum([len(w) for w in words])
    return SpanHasher(np.frombuffer(b"".join(words), np.uint8), lower=True)(np.append(0, ends[:-1]), ends)


class Starts:
    """Places of a chunk where an entity can start: a superset of those where ``FIND`` matches.

    Digits start numbers (with a sign, a bracket or two letters before them), titles of ASCII letters are told by their
    hash, words with other letters are looked at one by one and remembered, and texts that hold an ``@``, a ``:`` or
    ``=``, or a key's prefix are searched for what these belong to.
    """

    def __init__(self):
        self.words: dict[bytes, tuple[int, ...]] = {}
        self.chars: dict[str, bool] = {}
        if not _TITLE_HASHES:
            _TITLE_HASHES.append(_hashes([t.encode() for ts in TITLES.values() for t in ts if t.isascii()]))

    def _in_word(self, word: bytes) -> tuple[int, ...]:
        """Byte places in a word with bytes beyond ASCII where a title or a number can start."""
        if word not in self.words:
            if len(self.words) >= MAX_WORDS:
                self.words.clear()
            text = word.decode()
            at = {m.start() for m in _TITLE_WORD.finditer(text, overlapped=True)} | {i for i, c in enumerate(text) if c.isdecimal()}
            self.words[word] = tuple(len(text[:i].encode()) for i in sorted(at))
        return self.words[word]

    def __call__(self, chunk: Chunk) -> Iterator[tuple[int, str, list[int]]]:
        """Document, text and places (in characters) of the documents that have any."""
        data = chunk.data
        if not len(data):
            return
        digit = (data >= 48) & (data <= 57)
        before = np.append(False, digit[:-1])
        before[chunk.offsets[:-1][chunk.offsets[:-1] < len(data)]] = False
        places = [np.flatnonzero(digit & ~before)]
        start, end, doc = chunk.words(_NO_LETTER)
        span = SpanHasher(data, lower=True)
        places.append(start[np.isin(span(start, end), _TITLE_HASHES[0])])
        high = np.zeros(len(data) + 1, dtype=np.int64)
        np.cumsum(data >= 128, out=high[1:])
        odd = np.flatnonzero(high[end] > high[start])
        raw = data.tobytes()
        more = [a + k for a, b in zip(start[odd].tolist(), end[odd].tolist(), strict=True) for k in self._in_word(raw[a:b])]
        places.append(np.array(more, dtype=np.int64))
        at = np.concatenate(places)
        owner = np.searchsorted(chunk.offsets, at, "right") - 1
        at, owner = np.concatenate([at, at - 1, at - 2]), np.tile(owner, 3)
        inside = at >= chunk.offsets[owner]
        at, owner = at[inside], owner[inside]
        marked = {ord(c): chunk.per_doc(data == ord(c)) > 0 for c in "@:="}
        mail, keyed = marked[ord("@")], marked[ord(":")] | marked[ord("=")]
        # Characters before each byte: a place inside a character means that character.
        chars = np.zeros(len(data) + 1, dtype=np.int64)
        np.cumsum((data & 0xC0) != 0x80, out=chars[1:])
        lead = chars[np.minimum(at + 1, len(data))] - 1 - chars[chunk.offsets[owner]]
        order = np.lexsort((lead, owner))
        lead, owner = lead[order], owner[order]
        bounds = np.searchsorted(owner, np.arange(len(chunk) + 1))
        for i in range(len(chunk)):
            low, top = int(chunk.offsets[i]), int(chunk.offsets[i + 1])
            prefixed = any(raw.find(mark.encode(), low, top) >= 0 for mark in _KEY_MARKS)
            if bounds[i] == bounds[i + 1] and not (mail[i] or keyed[i] or prefixed):
                continue
            text = raw[low:top].decode()
            own = set(lead[bounds[i] : bounds[i + 1]].tolist())
            if keyed[i]:
                own.update(m.start() for m in _SECRET_WORD.finditer(text))
            if prefixed:
                own.update(m.start() for m in _KEY_PREFIX.finditer(text, overlapped=True))
            if mail[i]:
                own.update(self._mails(text))
            if own:
                yield i, text, sorted(own)

    def _mails(self, text: str) -> Iterator[int]:
        """Where the runs before each ``@`` begin."""
        at = text.find("@")
        while at >= 0:
            lo = at
            while lo and self._mail_char(text[lo - 1]):
                lo -= 1
            yield lo
            at = text.find("@", at + 1)

    def _mail_char(self, c: str) -> bool:
        if c not in self.chars:
            self.chars[c] = _MAIL_CHAR.match(c) is not None
        return self.chars[c]


def _found(texts: pa.Array, places: Starts) -> Iterator[tuple[int, str, list[tuple[int, int, str, str]]]]:
    """Row, text and entities of the rows that have any."""
    for chunk in text_chunks(texts):
        for i, text, starts in places(chunk):
            entities = find(text, starts)
            if entities:
                yield chunk.rows.start + i, text, entities


def _mark() -> F.Column:
    return F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string"))


def mentions(docs: DataFrame) -> DataFrame:
    """``mark, kind, entity``: which entities each row holds (``mark``: hash of its id and text)."""

    def detect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = Starts()
        for batch in batches:
            marks = batch.column("mark").to_pylist()
            rows = [(marks[i], kind, entity) for i, _, found in _found(strings(batch.column("text")), places) for kind, entity in {f[2:] for f in found}]
            columns = list(zip(*rows, strict=True)) if rows else [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.string()), pa.array(columns[2], pa.string())], ["mark", "kind", "entity"])

    return map_arrow(docs.select(_mark().alias("mark"), F.col("text").cast("string").alias("text")), detect, "mark long, kind string, entity string")


def attempts(entities: DataFrame, key: bytes) -> DataFrame:
    """``kind, entity, attempt`` of the entities whose first surrogate collides, with an attempt that does not.

    Surrogates of one look must differ: all parts of names are one space, whatever their kind.  A round stores the few
    entities that are drawn again, never the others.
    """

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cores = [surrogate(key, k, e, a) for k, e, a in zip(*(batch.column(c).to_pylist() for c in ("kind", "entity", "attempt")), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cores, pa.string())], ["kind", "entity", "attempt", "core"])

    schema = "kind string, entity string, attempt int, core string"
    space = F.when((F.col("kind") == "family") | F.col("kind").startswith("given-"), "name").otherwise(F.col("kind")).alias("space")
    drawn = store(map_arrow(entities.withColumn("attempt", F.lit(0)), draw, schema))
    taken = entities.select(space, F.col("entity").alias("core")).distinct().withColumn("real", F.lit(True))
    while True:
        now = drawn.groupBy("kind", "entity").agg(F.max(F.struct("attempt", "core")).alias("last")).select("kind", "entity", "last.*", space)
        shared = now.groupBy("space", "core").agg(F.min(F.struct("attempt", "kind", "entity")).alias("owner"), F.count(F.lit(1)).alias("n"))
        clash = shared.join(taken, ["space", "core"], "left").where("n > 1 OR real")
        mine = (F.col("owner.kind") == F.col("kind")) & (F.col("owner.entity") == F.col("entity")) & F.col("real").isNull()
        lost = store(now.join(clash, ["space", "core"]).where(~mine).select("kind", "entity", (F.col("attempt") + 1).alias("attempt")))
        if lost.isEmpty():
            return now.where("attempt > 0").select("kind", "entity", "attempt")
        drawn = drawn.unionByName(store(map_arrow(lost, draw, schema)))


def replace(docs: DataFrame, key: bytes, counted: bool = False) -> DataFrame:
    """``docs`` with surrogates in ``text``; with ``counted``, a last column ``n_entities``.

    ``key`` is a secret: who knows it can tell which surrogate an entity gets.
    """
    held = store(mentions(docs))
    redrawn = store(attempts(held.select("kind", "entity").distinct(), key))
    pair = F.struct("kind", "entity", "attempt")
    row, entities, number = (spare_name(docs, n) for n in ("mark", "redrawn", "n_entities"))
    special = store(held.join(redrawn, ["kind", "entity"]).groupBy(F.col("mark").alias(row)).agg(F.collect_set(pair).alias(entities)))
    joined = docs.withColumn(row, _mark()).join(special, row, "left").select(*docs.columns, entities)
    schema = docs.schema
    where = schema.fieldNames().index("text")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = Starts()
        for batch in batches:
            column = batch.column(where)
            told, n = column.to_pylist(), np.zeros(batch.num_rows, dtype=np.int64)
            redrawn = batch.column(batch.num_columns - 1)
            for i, text, entities in _found(strings(column), places):
                own = {(r["kind"], r["entity"]): r["attempt"] for r in redrawn[i].as_py() or ()}
                out, at = [], 0
                for lo, hi, kind, entity in entities:
                    core = surrogate(key, kind, entity, own.get((kind, entity), 0))
                    out += [text[at:lo], dress(text[lo:hi], kind, core)]
                    at = hi
                told[i], n[i] = "".join([*out, text[at:]]), len(entities)
            columns = [pa.array(told, pa.string()) if j == where else c for j, c in enumerate(batch.columns[:-1])]
            if counted:
                columns.append(pa.array(n))
            yield pa.RecordBatch.from_arrays(columns, schema.fieldNames() + [number] * counted)

    return map_arrow(joined, apply, schema if not counted else type(schema)(schema.fields).add(number, "long"))
