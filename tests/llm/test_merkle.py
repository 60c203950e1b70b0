"""Merkle manifest against trees built node by node."""

from __future__ import annotations

from hashlib import sha256
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from causeway.llm import merkle
from causeway.llm.merkle import ARITY, backward, document_leaf, fold, forward, manifest, verify_lowered
from causeway.llm.queries import QUERIES
from tests.llm.data import documents, lowered, odd_rows, table


def hexed(*parts: str) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def leaf(*values) -> str:
    return hexed(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def tree(leaves: list[str]) -> tuple[str, list[list[tuple[str, str]]]]:
    """Top and, per leaf, the digests before and after on each level."""
    level, proofs, at = leaves, [[] for _ in leaves], list(range(len(leaves)))
    while len(level) > 1:
        for i, place in enumerate(at):
            run = level[place // ARITY * ARITY:(place // ARITY + 1) * ARITY]
            k = place % ARITY
            proofs[i].append(("".join(run[:k]), "".join(run[k + 1:])))
            at[i] = place // ARITY
        level = [hexed(*level[i:i + ARITY]) for i in range(0, len(level), ARITY)]
    return level[0], proofs


def brute(rows):
    """Rows (doc_id, source, lang, n_chars, text) to sorted result rows."""
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    found, subroots = [], []
    for lang in langs:
        own = sorted((r for r in rows if r[2] == lang), key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r)))
        top, proofs = tree([leaf(*r) for r in own])
        subroots.append(top)
        found.append(list(zip(own, proofs, strict=True)))
    root, upper = tree(subroots)
    out = []
    for subroot, rest, group in zip(subroots, upper, found, strict=True):
        for r, proof in group:
            proof = proof + rest
            text = lowered(r[4]) if r[4] is not None and r[0] is not None and crc32(str(r[0]).encode()) % 3 == 0 else r[4]
            now = leaf(*r[:4], text)
            for before, after in proof:
                now = hexed(before, now, after)
            out.append((r[0], leaf(*r), subroot, root, hexed(*[x for step in proof for x in step]), now, now == root))
    return sorted(out, key=str)


def result(frame):
    from causeway.llm.merkle import proof_digest

    rows = frame.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("proof")).alias("p"), "folded_root", "verified")
    return sorted((tuple(r) for r in rows.collect()), key=str)


@pytest.mark.parametrize("n", [1, 2, 7, 8, 9, 64, 65, 511, 513, 600])
def test_sweeps(n):
    leaves = [hexed(str(i)) for i in range(n)]
    runs, level, top = forward(0, n, leaves, 10)
    want, proofs = tree(leaves)
    assert (top, backward(0, n, runs, level, [])) == (want, proofs)


def test_given_documents(spark, sf):
    want = brute(table(sf, "documents", "doc_id, source, lang, n_chars, text"))
    got = sorted((tuple(r) for r in QUERIES["op12_manifest"](spark, sf).collect()), key=str)
    assert got == want
    assert 0 < sum(not r[-1] for r in got) < len(got) // 2


def test_many_passes(spark, sf, monkeypatch):
    """Subtrees of 8 nodes: as many passes as levels, in the trees and in the tree of languages."""
    monkeypatch.setattr(merkle, "LEVELS", 1)
    monkeypatch.setattr(merkle, "SPAN", ARITY)
    rows = [(i, "s", f"l{i % 20}" if i % 3 else "hot", i, f"Text {i}") for i in range(700)]
    frame = spark.createDataFrame(rows, "doc_id bigint, source string, lang string, n_chars bigint, text string")
    assert result(verify_lowered(frame)) == brute(rows)


def test_odd_rows(spark):
    rows = [(r[0], "src", (None, "", "é", "en")[i % 4], len(r[1] or ""), r[1]) for i, r in enumerate(odd_rows())]
    rows += [(None, None, None, None, None), (4, "src", "en", 4, "word"), (4, "src", "en", 4, "word")]
    frame = spark.createDataFrame(rows, "doc_id bigint, source string, lang string, n_chars bigint, text string")
    extra = frame.withColumns({c: F.lit("x") for c in ("_tree", "_pos", "digest", "_group", "leaf", "root", "proof", "present")})
    assert result(verify_lowered(extra)) == brute(rows)


def test_one_row_and_none(spark):
    frame = documents(spark, [(7, "Abc")])
    one = verify_lowered(frame).collect()
    assert len(one) == 1 and one[0]["leaf"] == one[0]["subroot"] == one[0]["root"] and one[0]["proof"] == []
    assert verify_lowered(frame.limit(0)).collect() == []


def test_changed_leaf_folds_to_another_root(spark):
    frame = documents(spark, [(i, f"text {i}") for i in range(30)])
    found = manifest(frame, F.col("lang"), F.col("doc_id"), document_leaf(F.col("text")), {"id": F.col("doc_id")})
    checked = found.select("root", fold(F.col("leaf"), F.col("proof")).alias("own"),
                           fold(F.sha2(F.col("leaf"), 256), F.col("proof")).alias("other")).collect()
    assert all(r["own"] == r["root"] != r["other"] for r in checked)
