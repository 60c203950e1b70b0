"""Vector codes against rounds in which every part meets every entry."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest

from causeway.llm.queries import ORACLES, QUERIES
from causeway.llm.vectorcodes import encode, settle

SCHEMA = "vec_id bigint, embedding array<double>, label int, code string, _code int, error string, _id int, value string"


def brute(rows, parts=16, entries=64, rounds=2, scale=256):
    """Plain integers. Rows (vec_id, vector, label) that take part, to sorted (vec_id, label, code, error, label_error)."""
    kept = [(i, [int(x) * scale if abs(x) >= 2.0**53 else math.floor(x * scale) for x in v], label) for i, v, label in rows]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    size = len(kept[0][1]) // parts if kept else 0
    cut = [[r[1][p * size:(p + 1) * size] for p in range(parts)] for r in kept]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def nearest(point, book):
        return min((sum((a - b) ** 2 for a, b in zip(point, e, strict=True)), i) for i, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for c in cut:
                groups.setdefault(nearest(c[p], books[p])[1], []).append(c[p])
            books[p] = [[sum(x) // len(groups[i]) for x in zip(*groups[i], strict=True)] if i in groups else e
                        for i, e in enumerate(books[p])]
    out, sums = [], {}
    for (i, _, label), c in zip(kept, cut, strict=True):
        found = [nearest(c[p], books[p]) for p in range(parts)]
        error = sum(d for d, _ in found)
        sums[label] = sums.get(label, 0) + error
        out.append((i, label, "".join(f"{e:02x}" for _, e in found), error))
    most = (1 << 63) - 1
    text = ",".join(str(x) for book in books for e in book for x in e)
    return (sorted((*r[:3], min(r[3], most), min(sums[r[1]], most)) for r in out) if all(r[0] is not None for r in out) else
            sorted(((*r[:3], min(r[3], most), min(sums[r[1]], most)) for r in out), key=str)), hashlib.sha256(text.encode()).hexdigest()


def run(spark, rows, **how):
    frame = spark.createDataFrame([(*r, "c", 5, "e", 6, "v") for r in rows], SCHEMA)
    found, books = encode(frame, **how)
    return sorted((tuple(r) for r in found.collect()), key=str), books


@pytest.mark.parametrize("wide", [False, True])
def test_settle(wide):
    rng = np.random.default_rng(5)
    for n in range(40):
        book = rng.integers(-3, 4, (int(rng.integers(1, 20)), 2)) * (10**12 if wide else 1)
        points = rng.integers(-4, 5, (60, 2)) * (10**12 if wide else 1)
        if wide:
            book, points = book.astype(object), points.astype(object)
        own = rng.integers(0, len(book), 60)
        at, best = settle(points, own, book, np.ones(len(book), bool))
        d = ((points[:, None] - book[None]) ** 2).sum(2)
        want = [min(range(len(book)), key=lambda i, row=row: (row[i], i)) for row in d]
        assert at.tolist() == want and best.tolist() == [row[i] for row, i in zip(d, want, strict=True)]
        later = book.copy()
        later[: n % len(book)] += 1
        again, _ = settle(points, at, later, (later != book).any(1))
        d = ((points[:, None] - later[None]) ** 2).sum(2)
        assert again.tolist() == [min(range(len(book)), key=lambda i, row=row: (row[i], i)) for row in d]


def test_given_embeddings(spark, sf):
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf}/embeddings.parquet'")
    rows = con.execute("SELECT vec_id, embedding, label FROM embeddings").fetchall()
    want, told = brute(rows)
    got = sorted(tuple(r) for r in QUERIES["op11_vector_codes"](spark, sf).select(
        "vec_id", "code", "error", "label_error", "codebooks_sha256").collect())
    assert got == [(i, code, error, total, told) for i, _, code, error, total in want]
    assert sorted(con.execute(ORACLES["op11_vector_codes"]).fetchall()) == got


def test_odd_rows(spark):
    rng = random.Random(4)
    good = [(i, [rng.randrange(-3, 4) / 2 for _ in range(32)], (None, 1, 2)[i % 3]) for i in range(120)]
    good += [good[0], good[0], (7, [0.0] * 32, None), (None, [1.0] * 32, 1), (-5, [float(x) for x in range(32)], 9)]
    bad = [(1, None, 1), (2, [None] * 32, 1), (3, [float("nan")] * 32, 2), (4, [float("inf")] * 32, 2), (5, [], 1), (6, [1.0] * 48, 1), (7, [1.0] * 33, 1)]
    got, books = run(spark, good + bad)
    want, told = brute(good)
    assert got == sorted(want, key=str) and books.sha256() == told


def test_few_rows_and_none(spark):
    rows = [(i, [float(i + j) for j in range(16)], 1) for i in range(3)]
    got, books = run(spark, rows)
    want, told = brute(rows)
    assert got == sorted(want, key=str) and books.sha256() == told and {r[3] for r in got} == {0}
    assert run(spark, rows[:0]) == ([], None)


def test_numbers_beyond_64_bits(spark):
    """Doubles up to 1e300: distances, means and errors stay exact, errors are told as the largest 64-bit number."""
    rng = random.Random(9)
    rows = [(i, [rng.choice([1.0, -1.0, 0.3]) * 10.0 ** rng.choice([0, 8, 200, 300]) for _ in range(16)], i % 2) for i in range(90)]
    got, books = run(spark, rows, entries=20)
    want, told = brute(rows, entries=20)
    assert got == sorted(want, key=str) and books.sha256() == told and books.wide
