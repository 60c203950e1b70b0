from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from causeway.llm import topk
from causeway.llm.queries import ORACLES, QUERIES
from tests.oracle import connect, differences


def test_matches_sql(spark, sf):
    assert differences(QUERIES["op2_topk"](spark, sf).toPandas(), connect(sf).execute(ORACLES["op2_topk"]).df()) is None


@pytest.mark.parametrize("metric", ["ip", "l2"])
@pytest.mark.parametrize("seed", range(4))
def test_block_search_is_exact(metric, seed):
    rng = np.random.default_rng(seed)
    x = np.floor(rng.normal(size=(rng.integers(1, 400), rng.integers(1, 40))) * 3)
    x[rng.integers(0, len(x), len(x) // 3)] = x[0]  # ties
    ids, q = rng.permutation(len(x)), rng.choice(len(x), min(len(x), 70), replace=False)
    at, row, score = topk.block_search(x[q], q, x, np.arange(len(x)), ids, 7, metric)
    for k, i in enumerate(q):
        exact = x @ x[i] if metric == "ip" else -((x - x[i]) ** 2).sum(1)
        best = sorted((-exact[j], ids[j]) for j in range(len(x)) if j != i)[:7]
        assert [(-s, ids[j]) for s, j in zip(score[at == k], row[at == k], strict=True)] == best


def test_bound_holds():
    rng = np.random.default_rng(3)
    a, b = rng.normal(size=(40, 30)), rng.normal(size=(50, 30)) * 2
    na, nb = (a * a).sum(1), (b * b).sum(1)
    last = None
    for level in topk.LEVELS:
        bound = topk.score_bound(topk.segment_stats(a, level), topk.segment_stats(b, level), na, nb, "ip")
        assert (bound >= a @ b.T).all()
        assert last is None or (bound <= last + 1e-6).all()
        last = bound


def test_odd_rows(spark, monkeypatch):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (20, [3.0]), (3, None), (4, [1.0, None]), (5, [nan, 1.0]), (6, [inf, 0.0]), (7, []), (None, [1.0, 1.0]),
            (8, [1.0, 1.0]), (9, [-1.0, 0.0, 5.0])]
    frame = spark.createDataFrame([(*r, 1, 2.0) for r in rows], "vec_id bigint, embedding array<double>, rank int, score double")
    expected = {(0, 1, 0, 5.0), (0, 2, 8, 3.0), (0, 3, 20, 3.0), (20, 1, 0, 3.0), (20, 2, 0, 3.0), (20, 3, 8, 3.0)}
    for block in (2048, 1):
        monkeypatch.setattr(topk, "ROW_BLOCK", block)
        found = topk.search(frame, lambda i: F.pmod(i, F.lit(20)) == 0, 3).collect()
        assert {tuple(r) for r in found} == expected and len(found) == 9
    assert topk.search(frame.limit(0), lambda i: i == 0, 3).collect() == []
    assert topk.search(frame.filter("vec_id = 20"), lambda i: i == 20, 3).collect() == []


def exact(rows, k):
    out = set()
    for i, (qid, q) in enumerate(rows):
        if qid % 20 == 0:
            scores = sorted((-sum(int(a) * int(b) for a, b in zip(q, x, strict=True)), vid, j) for j, (vid, x) in enumerate(rows) if j != i)[:k]
            out |= {(qid, r, vid, max(-(1 << 63), min((1 << 63) - 1, -s))) for r, (s, vid, _) in enumerate(scores, 1)}
    return out


@pytest.mark.parametrize("block", [2048, 7])
@pytest.mark.parametrize("size", [3.0, 2.0**27, 2.0**40, 1e150])
def test_whole_scores_are_exact_at_any_size(spark, monkeypatch, size, block):
    """Neighbours that doubles can't tell apart, scores beyond 64 bits, negative ones and ties."""
    monkeypatch.setattr(topk, "ROW_BLOCK", block)
    rng = np.random.default_rng(11)
    rows = [(i, [float(np.floor(size)) * s + (d if size < 2.0**50 else 0.0) for s, d in zip(rng.choice([-1.0, 1.0], 3), rng.integers(-2, 3, 3).tolist(), strict=True)])
            for i in range(60)]
    rows[7:9] = [(7, rows[3][1]), (8, rows[3][1])]
    frame = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in rows], "vec_id bigint, embedding array<double>")
    found = topk.search(frame, lambda i: F.pmod(i, F.lit(20)) == 0, 9, whole=True)
    assert found.schema["score"].dataType.simpleString() == "bigint"
    assert {tuple(r) for r in found.collect()} == exact(rows, 9)


def test_neighbouring_products_beyond_doubles(spark):
    rows = [(0, [134217728.0, 134217729.0]), (1, [134217728.0, 134217728.0]), (2, [134217727.0, 134217729.0]), (3, [134217728.0, 134217729.0])]
    found = topk.search(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"), lambda i: i == 0, 3, whole=True)
    assert {tuple(r) for r in found.collect()} == exact(rows, 3)


def test_steps_of_large_components(spark):
    rows = [([0.99, -0.01, 2.0**60, -1e200, None],)]
    (row,) = spark.createDataFrame(rows, "v array<double>").select(topk.whole_steps("v", 64).alias("v")).collect()
    assert row.v == [63.0, -1.0, 2.0**66, -64e200, None]
