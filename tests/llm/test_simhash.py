from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest
import xxhash

from causeway.llm import simhash
from causeway.llm.components import min_labels
from causeway.llm.queries import QUERIES
from tests.llm.data import SPACE, documents, lowered, odd_rows, prose, table


def fingerprint(text) -> int:
    words = SPACE.findall(lowered(text or ""))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i:i + 3]).encode(), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


class Union:
    def __init__(self):
        self.parent = {}

    def root(self, x):
        while self.parent.setdefault(x, x) != x:
            x = self.parent[x]
        return x

    def link(self, a, b):
        self.parent[self.root(a)] = self.root(b)


def expected(rows):
    prints = np.asarray([fingerprint(t) for _, t in rows], np.uint64)
    union = Union()
    for i in range(len(rows)):
        for j in np.flatnonzero(np.bitwise_count(prints[i] ^ prints[:i]) <= 2).tolist():
            union.link(i, j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        own = least.get(union.root(i))
        least[union.root(i)] = own if doc is None else doc if own is None else min(own, doc)
    return Counter((doc, f"{int(prints[i]):016x}", least[union.root(i)]) for i, (doc, _) in enumerate(rows))


def test_query(spark, sf):
    rows = table(sf, "documents", "doc_id, text")
    assert Counter(map(tuple, QUERIES["op8_simhash"](spark, sf).collect())) == expected(rows)


def test_odd_rows(spark):
    frame = documents(spark, odd_rows())
    assert Counter(map(tuple, simhash.near_duplicates(frame).collect())) == expected(odd_rows())
    kept = simhash.keep_one(frame)
    assert kept.columns == frame.columns
    components = {c for _, _, c in expected(odd_rows())}
    assert Counter(r.doc_id for r in kept.collect()) == Counter(dict.fromkeys(components, 1))
    assert simhash.near_duplicates(frame.limit(0)).collect() == []
    assert simhash.keep_one(frame.limit(0)).collect() == []


def test_one_row_of_each_component_is_kept(spark):
    """Components of null ids alone, and ids that several components share."""
    texts = [prose(100, seed) for seed in range(60, 66)]
    rows = [(None, texts[0]), (None, texts[1]), (None, texts[1]), (5, texts[2]), (5, texts[3]), (5, texts[3]),
            (7, texts[4]), (7, texts[5]), (3, texts[4])]
    kept = simhash.keep_one(documents(spark, rows)).collect()
    assert Counter((r.doc_id, r.text) for r in kept) == Counter(
        [(None, texts[0]), (None, texts[1]), (5, texts[2]), (5, texts[3]), (3, texts[4]), (7, texts[5])])


@pytest.mark.parametrize("leaf", [4, 16, 1000])
def test_trie_join(spark, leaf):
    rng = random.Random(leaf)
    prints = {0, (1 << 64) - 1}
    for _ in range(40):
        base = rng.getrandbits(64)
        for _ in range(20):
            own = base
            for _ in range(rng.randrange(5)):
                own ^= 1 << rng.randrange(64)
            prints.add(own)
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    links = simhash.near_links(spark.createDataFrame([(s,) for s in signed], "fingerprint bigint"), 2, leaf).collect()
    found, whole = Union(), Union()
    for r in links:
        assert ((r.a ^ r.b) & ((1 << 64) - 1)).bit_count() <= 2
        found.link(r.a, r.b)
    for i, p in enumerate(prints):
        for j in range(i):
            if (p ^ prints[j]).bit_count() <= 2:
                whole.link(signed[i], signed[j])
    pairs = {(found.root(s), whole.root(s)) for s in signed}
    assert len(pairs) == len({a for a, _ in pairs}) == len({b for _, b in pairs})


def test_components(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(i, i + 1) for i in range(1000, 1040)] + [(2000, i) for i in range(2001, 2100)]
    union = Union()
    for a, b in edges:
        union.link(a, b)
    least = {}
    for n in sorted({x for e in edges for x in e}):
        least.setdefault(union.root(n), n)
    want = {n: least[union.root(n)] for e in edges if e[0] != e[1] for n in e}
    assert {r.node: r.label for r in min_labels(spark.createDataFrame(edges, "a bigint, b bigint"), "a", "b").collect()} == want
    assert min_labels(spark.createDataFrame([], "a bigint, b bigint"), "a", "b").collect() == []
