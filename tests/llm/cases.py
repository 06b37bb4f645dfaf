"""Awkward documents: nulls, empty and very long texts, ties, repeated rows, clashing columns."""

from __future__ import annotations

import random

# Extra columns carry names that the operators use inside.
DDL = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, mark long, line_row long, kind string, dropped_id long, n_entities long, held boolean, quality int, toxic int, item_id long"


def prose(seed: int, words: int, vocabulary: int = 400) -> str:
    """Invented words in lines of ten."""
    draw = random.Random(seed)
    parts = ["ba", "ko", "ri", "tu", "se", "ma", "lo", "ne", "pi", "du"]
    known = ["".join(draw.choice(parts) for _ in range(draw.randint(1, 4))) for _ in range(vocabulary)]
    out = [draw.choice(known) for _ in range(words)]
    return "\n".join(" ".join(out[i : i + 10]) for i in range(0, words, 10))


def messy_rows() -> list[tuple]:
    same = prose(1, 120)
    texts = [
        (1, same), (2, same), (2, same), (3, same.replace("ba", "ko", 1)),  # copies, a repeated row, a near copy
        (4, None), (5, ""), (6, " \t\n \r\n"), (7, "word"), (8, "Word"), (9, "two words"),
        (10, prose(2, 60)), (11, prose(3, 60) + "\nshared line"), (None, prose(4, 70)), (None, same),
        (12, "x" * 5000), (13, "ünï cödé 漢字 🙂 " * 20), (14, prose(5, 30_000)), (15, "\x00 nul \x00"),
        (16, "a b c d e f g h i j " * 40), (17, "one\n\n\none\n  One \n"), (18, "Mr. John Smith, mail a.b@c.example.com"),
    ]
    return [(i, t, None if k % 3 else "en", "src0", None, None, k, None, "k", 1, 2, True, None, None, k) for k, (i, t) in enumerate(texts)]


def messy(spark):
    return spark.createDataFrame(messy_rows(), DDL).repartition(3)


def empty(spark):
    return spark.createDataFrame([], DDL)


def labels(spark, rows=()):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")
