from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from causeway.llm import substring
from causeway.llm.queries import QUERIES
from tests.llm.data import SPACE, documents, odd_rows, table


def expected(rows, length=50):
    first: dict[tuple, int] = {}
    split = [(doc, SPACE.findall(text or "")) for doc, text in rows]
    rank = lambda doc: substring.LAST_ID if doc is None else doc
    for doc, words in split:
        for k in range(len(words) - length + 1):
            key = tuple(words[k:k + length])
            first[key] = min(first.get(key, rank(doc)), rank(doc))
    out = []
    for doc, words in split:
        gone = np.zeros(len(words), bool)
        for k in range(len(words) - length + 1):
            if first[tuple(words[k:k + length])] < rank(doc):
                gone[k:k + length] = True
        kept = " ".join(w for w, g in zip(words, gone, strict=True) if not g)
        out.append((doc, len(words), int(gone.sum()), hashlib.sha256(kept.encode()).hexdigest()))
    return Counter(out)


def got(frame, length=50):
    return Counter((r.doc_id, r.n_words, r.n_removed, hashlib.sha256(r.kept_text.encode()).hexdigest())
                   for r in substring.remove_repeats(frame, length).collect())


def test_query(spark, sf):
    assert Counter(map(tuple, QUERIES["op4_substring"](spark, sf).collect())) == expected(table(sf, "documents", "doc_id, text"))


def test_odd_rows(spark):
    frame = documents(spark, odd_rows())
    assert got(frame) == expected(odd_rows())
    assert got(frame.limit(0)) == Counter()


@pytest.mark.parametrize("seed,length", [(0, 50), (1, 50), (2, 10), (3, 20), (4, 25), (5, 1)])
def test_edited_copies_and_few_words(spark, seed, length, monkeypatch):
    """Near copies, nested passages and texts of one or two words, in small groups."""
    rng = random.Random(seed)
    monkeypatch.setattr(substring, "GROUP_WORDS", 500)
    base = [str(rng.randrange(50)) for _ in range(400)]
    rows = []
    for doc in range(40):
        a = rng.randrange(300)
        words = base[a:a + rng.randrange(30, 200)]
        for _ in range(rng.randrange(3)):
            words[rng.randrange(len(words))] = f"new{rng.randrange(1000)}"
        rows.append((doc, " ".join(words)))
    rows += [(100 + i, " ".join(rng.choice("ab" if i % 2 else "a") for _ in range(rng.randrange(40, 160)))) for i in range(16)]
    assert got(documents(spark, rows), length) == expected(rows, length)


def test_minimum_is_the_leftmost():
    rng = np.random.default_rng(0)
    values = rng.integers(0, 4, 200)
    for width in (1, 2, 3, 5, 16, 31):
        found = substring.leftmost_minimum(values, width)
        assert found.tolist() == [i + int(np.argmin(values[i:i + width])) for i in range(200 - width + 1)]


def test_full_bit_tables_only_let_rows_through(spark, monkeypatch):
    """Tables far too small for their keys: the same result."""
    monkeypatch.setattr(substring, "LEAST_BITS", 6)
    monkeypatch.setattr(substring, "MOST_BITS", 7)
    assert got(documents(spark, odd_rows())) == expected(odd_rows())
    assert [substring.table_bits(n) for n in (0, 1, 2, 10**12)] == [6, 6, 7, 7]


def test_a_line_that_all_documents_share(spark):
    """One common passage with different surroundings: a class per document of one anchor, and edited copies of it."""
    rng = random.Random(9)
    line = [f"w{i}" for i in range(55)]
    rows = [(i, " ".join([f"a{rng.randrange(10**6)}" for _ in range(rng.randrange(1, 60))] + line + [f"b{rng.randrange(10**6)}" for _ in range(rng.randrange(1, 60))]))
            for i in range(150)]
    rows += [(200 + i, " ".join(line[:50 + i % 6])) for i in range(12)]
    assert got(documents(spark, rows)) == expected(rows)
