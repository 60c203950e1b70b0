from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from causeway.llm import ppm
from causeway.llm.queries import QUERIES
from tests.llm.data import documents, odd_rows, table


def counts(texts, order):
    out: dict[bytes, Counter] = {}
    for text in texts:
        data = ppm.END * order + b" ".join(ppm.normal_words(text)) + ppm.END
        for i in range(order, len(data)):
            for k in range(order + 1):
                out.setdefault(data[i - k:i], Counter())[data[i]] += 1
    return out


def probability(seen, context, order, symbol):
    excluded, p = set(), 1.0
    for k in range(order, -1, -1):
        own = seen.get(context[len(context) - k:] if k else b"")
        if own is None:
            continue
        left = {s: n for s, n in own.items() if s not in excluded}
        total = sum(left.values())
        if symbol in left:
            return p * (2 * left[symbol] - 1) / (2 * total)
        if left:
            p *= len(left) / (2 * total)
        excluded = set(own)
    return p / (256 - len(excluded))


def log10(seen, text, order):
    data = ppm.END * order + b" ".join(ppm.normal_words(text)) + ppm.END
    return sum(math.log10(probability(seen, data[i - order:i], order, data[i])) for i in range(order, len(data)))


TRAIN = ["the cat sat on the mat", "The cat ate a rat. The end", "", None, "déjà vu the cat", "zzz top the", "a" * 400]
TEST = [*TRAIN, "the rat sat xq on vu\x01 the zcat", "日本", "b" * 3000, "  The\t\n cat "]


@pytest.mark.parametrize("order", [1, 3, 5])
def test_against_brute_force(spark, monkeypatch, order):
    monkeypatch.setattr(ppm, "CHUNK", 64)  # long texts are scored in parts
    monkeypatch.setattr(ppm, "HELD", 50)
    monkeypatch.setattr(ppm, "HELD_WORDS", 3)
    rows = [(i, t) for i, t in enumerate(TRAIN)] + [(100 + i, t) for i, t in enumerate(TEST)]
    seen = counts(TRAIN, order)
    for hot in (1000, 0):
        found = ppm.score(documents(spark, rows), F.col("doc_id") < 100, order, hot_words=hot).collect()
        assert len(found) == len(rows)
        words = Counter(w for t in TRAIN for w in ppm.normal_words(t))
        total, different = sum(words.values()) + len(TRAIN), len(words) + 1
        for r in found:
            text = dict(rows)[r.doc_id]
            assert r.score == pytest.approx(log10(seen, text, order), rel=1e-9)
            own = [words[w] for w in ppm.normal_words(text)] + [len(TRAIN)]
            assert (r.n_tokens, r.n_known, r.train_tokens) == (len(own), sum(c > 0 for c in own), total)
            assert r.base_score == pytest.approx(sum(math.log10((c + 0.5) / (total + 0.5 * (different + 1))) for c in own), rel=1e-9)


@pytest.mark.parametrize("order", [1, 3, 5])
@pytest.mark.parametrize("model_rows", [0, 40])
def test_no_ngram_is_left_out_of_a_large_trie(spark, monkeypatch, order, model_rows):
    monkeypatch.setattr(ppm, "CHUNK", 64)
    rows = [(i, t) for i, t in enumerate(TRAIN)] + [(100 + i, t) for i, t in enumerate(TEST)]
    seen = counts(TRAIN, order)
    found = ppm.score(documents(spark, rows), F.col("doc_id") < 100, order, model_rows=model_rows).collect()
    assert len(found) == len(rows)
    for r in found:
        assert r.score == pytest.approx(log10(seen, dict(rows)[r.doc_id], order), rel=1e-9)


def test_no_training_rows_and_no_room(spark):
    (alone,) = ppm.score(documents(spark, [(1, "ab")]), F.lit(False), model_rows=-1).collect()
    assert alone.score == pytest.approx(3 * math.log10(1 / 256))


def test_both_ways_of_scoring_agree(spark, sf):
    """The same scores from a trie that is broadcast whole and from joins, on the given table."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").filter("doc_id % 9 = 0")
    one, two = ({r.doc_id: r for r in ppm.score(docs, F.col("doc_id") % 2 == 0, model_rows=m, hot_words=h).collect()} for m, h in ((2_000_000, 300_000), (5_000, 50)))
    for d, r in one.items():
        assert two[d].score == pytest.approx(r.score, rel=1e-10) and two[d].base_score == pytest.approx(r.base_score, rel=1e-10)
        assert (two[d].n_tokens, two[d].n_known) == (r.n_tokens, r.n_known)


def test_slices_hold_every_text_once(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(ppm, "CHUNK", 10)
    texts = ["a" * 25, None, "", "b" * 4, "c" * 4, "d" * 4, None, "é" * 9, ""]
    parts = list(ppm.slices(pa.RecordBatch.from_arrays([pa.array(texts)], ["text"]).slice(1)))
    assert [t for _, p in parts for t in p] == texts[1:] and [a for a, _ in parts] == [sum(len(p) for _, p in parts[:i]) for i in range(len(parts))]
    assert len(parts) > 2 and list(ppm.slices(pa.RecordBatch.from_arrays([pa.array([], pa.string())], ["text"]))) == []


def test_probabilities_sum_to_one():
    order = 3
    seen = counts(TRAIN, order)
    grams = [{} for _ in range(order + 1)]
    for context, symbols in seen.items():
        for s, n in symbols.items():
            grams[len(context)][int.from_bytes(context + bytes([s]), "big")] = n
    trie = ppm.Trie([np.asarray(list(g), np.uint64) for g in grams], [np.asarray(list(g.values())) for g in grams])
    for context in (b"the", b" ca", b"\n\n\n", b"xyz", b"\xc3\xa9j", b"aaa"):
        logs = [trie.log_probability(np.frombuffer(context + bytes([s]), np.uint8))[0] for s in range(256)]
        assert sum(map(math.exp, logs)) == pytest.approx(1, abs=1e-6)


def test_odd_rows_and_empty_tables(spark):
    rows = odd_rows()
    found = ppm.score_documents(documents(spark, rows)).collect()
    assert Counter(r.doc_id for r in found) == Counter(d for d, _ in rows)
    for r in found:
        assert r.held_out == (zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode()) % 5 == 1)
        assert math.isfinite(r.score) and math.isfinite(r.base_score)
    assert ppm.score_documents(documents(spark, [])).collect() == []
    (alone,) = ppm.score(documents(spark, [(1, "ab")]), F.lit(False)).collect()
    assert alone.score == pytest.approx(3 * math.log10(1 / 256)) and alone.base_score == 0 and alone.n_known == 0


def test_query(spark, sf):
    """Trained texts are predicted better than held-out ones, and the trie far better than even bytes."""
    found = QUERIES["op9_ppm"](spark, sf).toPandas()
    docs = dict(table(sf, "documents", "doc_id, text"))
    size = found.doc_id.map(lambda d: len(b" ".join(ppm.normal_words(docs[d]))) + 1)
    per_byte = found.score / size
    assert per_byte[~found.held_out].mean() > per_byte[found.held_out].mean() > -1.2
    assert len(found) == len(docs)
