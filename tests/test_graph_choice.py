"""Task schedules and exact choices against plain programs."""

from __future__ import annotations

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from causeway.operators import choice, graph
from causeway.operators import media as X
from causeway.operators.choice import allocate, combined, exact_selection, split
from causeway.operators.graph import budget_selection, earliest_starts


def starts(tasks, edges):
    into = {t: set() for t in tasks}
    for p, t in edges:
        into[t].add(p)
    out = {}
    while len(out) < len(tasks):
        ready = [t for t in tasks if t not in out and into[t] <= out.keys()]
        assert ready
        for t in ready:
            out[t] = max((out[p] + tasks[p] for p in into[t]), default=0)
    return out


def frames(spark, tasks, edges):
    return (spark.createDataFrame(list(tasks.items()), "task string, duration bigint"),
            spark.createDataFrame(edges, "pred string, task string"))


@pytest.mark.parametrize("seed", range(4))
def test_schedules_equal_a_plain_program(spark, seed):
    rng = np.random.default_rng(seed)
    n = 60
    tasks = {f"t{i}": int(rng.integers(0, 9)) for i in range(n)}
    edges = [(f"t{a}", f"t{b}") for a, b in rng.integers(0, n, (70 + 20 * seed, 2)) if a < b]
    edges += [(f"t{i}", f"t{i + 1}") for i in range(20, 40)] + edges[:5]  # a chain with side branches, and repeated edges
    got = {r.task: (r.start, r.finish) for r in earliest_starts(*frames(spark, tasks, edges)).collect()}
    want = starts(tasks, edges)
    assert got == {t: (s, s + tasks[t]) for t, s in want.items()}


def test_a_long_chain_needs_few_rounds(spark, monkeypatch):
    cuts = []
    whole = graph.cut_lineage
    monkeypatch.setattr(graph, "cut_lineage", lambda df: cuts.append(1) or whole(df))
    n = 10_000
    tasks = spark.range(n).select(F.col("id").alias("task"), F.lit(2).alias("duration"))
    edges = spark.range(n - 1).select(F.col("id").alias("pred"), (F.col("id") + 1).alias("task"))
    out = earliest_starts(tasks, edges)
    assert out.agg(F.max("finish")).first()[0] == 2 * n and out.filter("start != 2 * task").isEmpty()
    assert len(cuts) < 30


def test_each_edge_passes_a_start_once(spark):
    """A ladder: every task waits for the two before it; frontier by frontier, with used edges dropped on the way."""
    tasks = {f"t{i:02d}": 1 + i % 3 for i in range(24)}
    edges = [(f"t{i:02d}", f"t{j:02d}") for i in range(24) for j in (i + 1, i + 2) if j < 24]
    got = {r.task: r.start for r in earliest_starts(*frames(spark, tasks, edges)).collect()}
    assert got == starts(tasks, edges)


@pytest.mark.parametrize("edges", [[("a", "b"), ("b", "a")], [("a", "b"), ("b", "c"), ("c", "b"), ("a", "c")], [("a", "a")]])
def test_cycles_are_found(spark, edges):
    with pytest.raises(ValueError, match="cycle"):
        earliest_starts(*frames(spark, {"a": 1, "b": 1, "c": 1, "d": 2}, edges)).collect()


def test_no_edges_and_no_tasks(spark):
    tasks, edges = frames(spark, {"a": 3, "b": 0}, [("a", "b")])
    assert {r.task: r.start for r in earliest_starts(tasks, edges.limit(0)).collect()} == {"a": 0, "b": 0}
    assert earliest_starts(tasks.limit(0), edges.limit(0)).collect() == []


# ---------------------------------------------------------------- choice


def enumerated(items, cap):
    best = 0.0
    for take in itertools.product((0, 1), repeat=len(items)):
        if sum(w for t, (_, w) in zip(take, items, strict=True) if t) <= cap:
            best = max(best, sum(v for t, (v, _) in zip(take, items, strict=True) if t))
    return best


def test_exact_where_the_ratio_order_is_not(spark):
    rows = [(1, 5.0, 8.0), (2, 17.0, 15.0), (3, 20.0, 17.0), (4, 13.0, 16.0), (5, 6.0, 9.0), (6, 10.0, 11.0)]
    items = spark.createDataFrame(rows, "id bigint, value double, weight double")
    chosen = exact_selection(items, "value", "weight", "id", 60.0)
    took = [r for r in chosen.collect() if r.selected]
    assert sum(r.weight for r in took) <= 60 and sum(r.value for r in took) == enumerated([(v, w) for _, v, w in rows], 60)
    ratio = sum(r.value for r in budget_selection(items, "value", "weight", "id", 60.0).collect() if r.selected)
    assert ratio <= sum(r.value for r in took)


@pytest.mark.parametrize("fan", [64, 3])
def test_groups_equal_enumeration(spark, monkeypatch, fan):
    monkeypatch.setattr(choice, "FAN", fan)
    rng = np.random.default_rng(fan)
    rows = [(g, i, float(rng.integers(0, 9)), float(rng.integers(0, 12)) / 2) for g in ("a", "b", None) for i in range(11)]
    rows += [("c", 1, None, 1.0), ("c", 2, 3.0, None), ("d", 1, 2.0, 99.0), ("e", 1, 7.0, 0.0)]
    out = exact_selection(spark.createDataFrame(rows, "g string, id int, v double, w double"), "v", "w", "id", 8.5, ["g"], unit=0.5).collect()
    assert len(out) == len(rows)
    for g in ("a", "b", None, "c", "d", "e"):
        own = [r for r in out if r.g == g]
        took = [r for r in own if r.selected]
        assert sum(r.w for r in took) <= 8.5
        assert sum(r.v for r in took) == enumerated([(r.v, r.w) for r in own if r.v is not None and r.w is not None], 8.5)


def test_lists_combine_and_split():
    rng = np.random.default_rng(5)
    lists = [np.where(rng.random(13) < 0.3, -np.inf, rng.normal(size=13)) for _ in range(4)]
    for own in lists:
        own[0] = 0.0
    total = lists[0]
    for own in lists[1:]:
        total = combined(total, own)
    want = max(sum(own[w] for own, w in zip(lists, ws, strict=True)) for ws in itertools.product(range(13), repeat=4) if sum(ws) <= 12)
    assert total.max() == pytest.approx(want)
    ws = split(lists, 12)
    assert sum(ws) <= 12 and sum(own[w] for own, w in zip(lists, ws, strict=True)) == pytest.approx(want)


def test_weights_off_the_unit_are_refused(spark):
    items = spark.createDataFrame([(1, 5.0, 1.25)], "id bigint, value double, weight double")
    with pytest.raises(Exception, match="multiples of 1.0"):
        exact_selection(items, "value", "weight", "id", 3.0).collect()
    assert [r.selected for r in exact_selection(items, "value", "weight", "id", 3.0, unit=0.25).collect()] == [True]
    assert allocate(spark.createDataFrame([], "item string, values array<double>"), [], 5).collect() == []


def test_s_shaped_budget_equals_enumeration(spark):
    rows = [("a", 60.0, 3.0, 100.0, 1.0), ("b", 55.0, 4.0, 95.0, 1.0), ("c", 20.0, 0.8, 30.0, 2.0)]
    params = spark.createDataFrame(rows, "channel string, half double, slope double, beta double, price double")
    got = X.exact_budget_split(params, 100.0, 25).collect()

    def response(r, k):
        x = 4.0 * k / r[4]
        return r[3] * x ** r[2] / (x ** r[2] + r[1] ** r[2]) if x else 0.0

    best = max(response(rows[0], i) + response(rows[1], j) + response(rows[2], 25 - i - j) for i in range(26) for j in range(26 - i))
    assert sum(r.spend for r in got) <= 100 + 1e-9 and sum(r.response for r in got) == pytest.approx(best)
    greedy = sum(r.response for r in X.budget_split(params, 100.0, 25).collect())
    assert greedy < best - 1  # the concave envelope splits between two S curves
