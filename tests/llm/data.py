"""Small odd tables: nulls, empty and long texts, ties, repeated rows, clashing extra columns."""

from __future__ import annotations

import random
import re

SCHEMA = ("doc_id bigint, text string, lang string, source string, n_chars bigint, piece int, _part string, length double, "
          "label string, words string, spans string, items string, _order string, _row string, n string, held_out string")
EXTRA = (1, "p", 1.5, "l", "w", "s", "i", "o", "r", "n", "h")


def documents(spark, rows):
    """Rows (doc_id, text[, lang]) with further columns whose names operators use themselves."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "src", len(r[1] or ""), *EXTRA) for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def prose(n: int, seed: int, vocabulary: int = 300) -> str:
    rng = random.Random(seed)
    return " ".join(f"{rng.choice('bdfglmnprst')}{rng.choice('aeiou')}{rng.randrange(vocabulary):x}" for _ in range(n))


def odd_rows():
    base = prose(120, 1)
    passage = prose(60, 2)
    return [
        (None, None), (None, "A null id. " + passage), (1, None), (2, ""), (3, " \t\n\x0b\x0c\r "), (4, "word"), (4, "word"), (5, "Two  words"),
        (6, base), (7, base), (7, base), (8, base.upper()), (9, base + " tail"), (10, "x" * 50_000), (11, "é̀ ñandú 日本語 ١٢٣ \u0085   ok"),
        (12, passage + " " + prose(30, 3)), (13, prose(30, 4) + "\n" + passage), (14, prose(20_000, 5)), (15, "1 2 3 4"), (16, "ha " * 300),
        (17, "ha " * 299 + "ho"), (-5, "negative id " + passage),
    ]


SPACE = re.compile(r"[^\x20\x09-\x0D]+")
LETTERS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(text: str) -> str:
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text)


def table(sf: str, name: str, columns: str):
    import duckdb

    return duckdb.sql(f"SELECT {columns} FROM '{sf}/{name}.parquet'").fetchall()
