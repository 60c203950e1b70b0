from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from causeway.llm import decontam
from causeway.llm.queries import QUERIES
from tests.llm.data import LETTERS, documents, lowered, odd_rows, prose, table


def words(text):
    return LETTERS.findall(lowered(text or ""))


def close(own, phrase, slack=2):
    """Whether some run of at most ``slack`` more words than the phrase has them all, as often as it does."""
    need, span = Counter(phrase), len(phrase) + slack
    return any(not need - Counter(own[k:k + span]) for k in range(max(1, len(own) - len(phrase) + 1)))


def expected(docs, items, window=10):
    phrases = defaultdict(set)
    for item, text in items:
        own = words(text)
        for k in range(max(1, len(own) - window + 1) if own else 0):
            phrases[tuple(own[k:k + window])].add("" if item is None else str(item))
    sizes, out = {len(p) for p in phrases}, []
    for doc, text in docs:
        own = words(text)
        hit, found = [False] * len(own), set()
        for n in sizes:
            for k in range(len(own) - n + 1):
                got = phrases.get(tuple(own[k:k + n]))
                if got:
                    found |= got
                    hit[k:k + n] = [True] * n
        near = {item for p, names in phrases.items() if set(p) <= set(own) and close(own, p) for item in names}
        out.append((doc, len(own), sum(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), any(hit), len(near)))
    return Counter(out)


def items_frame(spark, items):
    return spark.createDataFrame([(*i, 1, "x") for i in items], "item_id bigint, text string, segment int, slot string")


ITEMS = [(1, prose(14, 50)), (2, "short Item"), (3, None), (4, " .,- "), (5, "solo"), (None, prose(12, 51)), (1, prose(14, 50)), (20, "the the the")]
DOCS = [(1, "x " + prose(14, 50) + " y"), (2, "SHORT, item! and solo."), (3, "the the the the"), (3, "the the"), (None, prose(12, 51)),
        (6, " ".join(prose(14, 50).split()[:9])), (30, " ".join(prose(14, 50).split()[3:][::-1])), (31, "the q the"), (32, "the q w the e the"),
        (33, " ".join(w + " gap" * (i in (3, 7)) for i, w in enumerate(prose(12, 51).split()))), (7, "short"), (8, "item"), (9, prose(14, 50).replace(" ", "...\n"))]


@pytest.mark.parametrize("block,segment", [(400_000, 100_000), (15, 100_000), (15, 4), (400_000, 1)])
def test_odd_rows(spark, monkeypatch, block, segment):
    monkeypatch.setattr(decontam, "SEGMENT_WORDS", segment)
    whole = decontam.blocks
    monkeypatch.setattr(decontam, "blocks", lambda items, window: whole(items, window, block))
    docs = DOCS + odd_rows()
    found = decontam.find(documents(spark, docs), items_frame(spark, ITEMS))
    assert Counter(map(tuple, found.collect())) == expected(docs, ITEMS)


def test_empty_tables(spark):
    docs, items = documents(spark, DOCS), items_frame(spark, ITEMS)
    assert decontam.find(docs.limit(0), items).collect() == []
    assert Counter(map(tuple, decontam.find(docs, items.limit(0)).collect())) == expected(DOCS, [])


def test_clean_rows_stay_whatever_ids_they_share(spark):
    rows = DOCS + [(None, "clean without an id"), (1, "clean too"), (1, "clean too"), (None, None)] + odd_rows()
    docs = documents(spark, rows)
    kept = decontam.keep_clean(docs, items_frame(spark, ITEMS))
    assert kept.columns == docs.columns
    want = Counter((d, t) for d, t in rows if not next(iter(expected([(d, t)], ITEMS)))[5])
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == want
    assert want[1, "clean too"] == 2 and want[None, "clean without an id"] == 1 and (None, prose(12, 51)) not in want


def test_query(spark, sf):
    found = QUERIES["op6_decontamination"](spark, sf).collect()
    assert Counter(map(tuple, found)) == expected(table(sf, "documents", "doc_id, text"), table(sf, "benchmark", "item_id, text"))


def test_proximity(spark):
    docs = [(1, "alpha x beta y gamma"), (2, "gamma beta alpha"), (3, "alpha a b c d e beta gamma"), (4, "alpha beta"), (5, "gamma"), (6, "beta alpha q gamma alpha beta"),
            (None, None), (7, ""), (8, "two x two one"), (9, "two one"), (8, "one two two")]
    index = decontam.build_index(documents(spark, docs))
    found = decontam.proximity(index, [[b"alpha", b"beta", b"gamma"], [b"two", b"one", b"two"], [], [b"absent"]], 2).collect()
    assert {(r.doc_id, r.start, r.end) for r in found if r.phrase == 0} == {(1, 0, 5), (2, 0, 3), (6, 3, 6)}
    assert {(r.doc_id, r.start, r.end) for r in found if r.phrase == 1} == {(8, 0, 4), (8, 0, 3)}
    assert {r.phrase for r in found} == {0, 1}
    assert decontam.proximity(decontam.build_index(documents(spark, [])), [[b"a"]]).collect() == []


@pytest.mark.parametrize("segment", [7, 100_000])
def test_proximity_equals_brute_force(spark, monkeypatch, segment):
    """Random words of a small vocabulary: repeated words, overlapping windows, document borders."""
    monkeypatch.setattr(decontam, "SEGMENT_WORDS", segment)
    rng = random.Random(8)
    docs = [(i, " ".join(rng.choices("abcdef", k=rng.randrange(0, 30)))) for i in range(80)]
    phrases = [rng.choices("abcdef", k=rng.randrange(1, 6)) for _ in range(40)]
    found = decontam.proximity(decontam.build_index(documents(spark, docs)), [[w.encode() for w in p] for p in phrases], 1).collect()
    assert {(r.doc_id, r.phrase) for r in found} == {(d, k) for d, t in docs for k, p in enumerate(phrases) if t and close(t.split(), p, 1)}
    for r in found:
        own = docs[r.doc_id][1].split()[r.start:r.end]
        assert not Counter(phrases[r.phrase]) - Counter(own) and len(own) <= len(phrases[r.phrase]) + 1


def test_postings_are_stored_in_small_row_groups(spark, monkeypatch):
    """A reader holds a row group at a time; one of a whole file's lists filled an executor's heap."""
    import glob

    import pyarrow.parquet as pq

    monkeypatch.setattr(decontam, "SEGMENT_WORDS", 20_000)
    docs = documents(spark, [(i, prose(20_000, i)) for i in range(20)]).repartition(1).select("doc_id", F.explode(F.array_repeat("text", 10)).alias("text"))
    index = decontam.build_index(docs)
    files = glob.glob(index.inputFiles()[0].removeprefix("file://").rpartition("/")[0] + "/*.parquet")
    groups = [m.row_group(i) for m in (pq.ParquetFile(f).metadata for f in files) for i in range(m.num_row_groups)]
    assert sum(g.num_rows for g in groups) == 200 and max(g.num_rows for g in groups) <= decontam.GROUP_SEGMENTS
    assert max(g.total_byte_size for g in groups) < decontam.GROUP_BYTES
    assert decontam.proximity(index, [prose(5, 3).encode().split()], 0).filter("start = 0").count() == 10


def test_phrases_are_followed_some_at_a_time(monkeypatch):
    import numpy as np

    own, numbers = random.Random(4).choices([b"a", b"b", b"c"], k=400), {b"a": 0, b"b": 1, b"c": 2}
    places = [[i for i, w in enumerate(own) if w == t] for t in numbers]
    postings = decontam.Postings(list(numbers), np.cumsum([len(p) for p in places]), np.concatenate(places), numbers)
    phrases = np.array([[a, b, c] for a in range(3) for b in range(3) for c in (-1, 0, 1, 2)])
    sizes = (phrases >= 0).sum(1)
    want = {(k, i) for k, p in enumerate(phrases.tolist()) for i in range(400) if [numbers[w] for w in own[i:i + sizes[k]]] == p[:sizes[k]]}
    near = [sorted(zip(*(x.tolist() for x in decontam.near_places(postings, phrases, sizes, 1)), strict=True))]
    monkeypatch.setattr(decontam, "PHRASES_AT_ONCE", 5)
    monkeypatch.setattr(decontam, "PLACES_AT_ONCE", 300)
    sliced = list(decontam.rarest_places(postings, phrases, sizes))
    assert len(sliced) > 8 and max(len(which) for _, _, which, _ in sliced) <= 300
    found = list(zip(*(x.tolist() for x in decontam.phrase_starts(postings, phrases, sizes)), strict=True))
    assert len(found) == len(set(found)) and set(found) == want
    near.append(sorted(zip(*(x.tolist() for x in decontam.near_places(postings, phrases, sizes, 1)), strict=True)))
    assert near[0] == near[1] and {(k, p) for k, p in near[0]} >= {(0, p) for p in places[0] if p + 1 in places[0]}
