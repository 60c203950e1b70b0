from __future__ import annotations

from collections import Counter

import corpus_pipeline
from causeway.llm.common import stored
from tests.llm import test_decontam, test_simhash, test_substring
from tests.llm.data import documents, odd_rows, table


def rows_of(frame):
    return [tuple(r) for r in frame.collect()]


def test_stages_against_brute_force(spark, sf):
    """Each stage judged on its own input, by the operators' brute-force versions."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, items, steps = docs.columns, table(sf, "benchmark", "item_id, text"), []
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stored(stage(spark, docs, sf), f"test-{name}")
        steps.append((name, before, docs))
        assert name == "packing" or docs.columns == columns
    names = [s[0] for s in steps]
    assert names == ["language_id", "simhash_dedup", "substring_dedup", "decontamination", "packing"]
    start, identified, single, cut, clean, packed = [steps[0][1], *[s[2] for s in steps]]

    dropped = {r[0] for r in rows_of(start)} - {r[0] for r in rows_of(identified)}
    assert len(dropped) <= 0.02 * start.count() and set(rows_of(identified)) <= set(rows_of(start))

    text = [(r.doc_id, r.text) for r in identified.collect()]
    keep = {c for _, _, c in test_simhash.expected(text)}
    assert set(rows_of(single)) == {r for r in rows_of(identified) if r[0] in keep} and single.count() == len(keep)

    text = [(r.doc_id, r.text) for r in single.collect()]
    want = {d: (n, gone, sha) for d, n, gone, sha in test_substring.expected(text)}
    for r in cut.collect():
        old = dict(text)[r.doc_id]
        import hashlib

        if want[r.doc_id][1]:
            assert hashlib.sha256(r.text.encode()).hexdigest() == want[r.doc_id][2] and r.n_chars == len(r.text)
        else:
            assert r.text == old
    assert cut.count() == single.count()

    text = [(r.doc_id, r.text) for r in cut.collect()]
    dirty = {row[0] for row in test_decontam.expected(text, items) if row[5]}
    assert set(rows_of(clean)) == {r for r in rows_of(cut) if r[0] not in dirty}

    assert Counter(r.doc_id for r in packed.collect() if r.piece == 0) == Counter(r.doc_id for r in clean.collect())


def test_run_and_odd_rows(spark, sf, tmp_path):
    frame = documents(spark, odd_rows()).select("doc_id", "text", "lang", "source", "n_chars")
    for rows in (frame, frame.limit(0)):
        docs = rows
        for name, stage in corpus_pipeline.STAGES:
            docs = stored(stage(spark, docs, sf), f"odd-{name}")
        assert docs.count() >= (rows.count() > 0)
    assert corpus_pipeline.run(spark, sf).count() > 0
