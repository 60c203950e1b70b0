"""Log-rank forest against trees grown row by row."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from causeway.operators import forest
from causeway.operators import survival as S
from causeway.operators.forest import SurvivalForest, bag_weights, drawn_features


def statistic(rows, left):
    """Log-rank of a split, from the definition; None without an event time at which both sides can differ."""
    gap = spread = 0.0
    for t in sorted({r["time"] for r in rows if r["event"]}):
        at = [r for r in rows if r["time"] >= t]
        n, n1 = sum(r["w"] for r in at), sum(r["w"] for r in at if left(r))
        dead = [r for r in at if r["time"] == t and r["event"]]
        d, d1 = sum(r["w"] for r in dead), sum(r["w"] for r in dead if left(r))
        gap += d1 - n1 * d / n
        spread += n1 * (n - n1) * d * (n - d) / (n * n * max(n - 1, 1))
    return round(gap * gap / spread, 9) if spread > 1e-12 else None


def grown(rows, names, tree, n_trees, min_split, min_leaf, drawn, seed):
    """(path of (feature, value)) -> leaf rows of one tree, nodes numbered level by level over all trees."""
    weights = bag_weights(np.array([r["row"] for r in rows])[:, None], np.arange(n_trees)[None, :], seed)
    level = [(t, t, (), [r | {"w": int(w)} for r, w in zip(rows, weights[:, t], strict=True) if w]) for t in range(n_trees)]
    next_id, leaves = n_trees, []
    while level:
        below = []
        for node, t, path, own in sorted(level, key=lambda x: x[0]):
            best, size = None, sum(r["w"] for r in own)
            if size >= max(min_split, 2 * min_leaf):
                for f in drawn_features(np.array([node]), len(names), drawn, seed)[0]:
                    for value in sorted({r[names[f]] for r in rows})[:-1]:
                        def left(r, f=f, value=value):
                            return r[names[f]] <= value

                        n1 = sum(r["w"] for r in own if left(r))
                        if min(n1, size - n1) < min_leaf:
                            continue
                        score = statistic(own, left)
                        if score is not None and (best is None or score > best[0]):
                            best = (score, f, value, left)
            if best is None:
                leaves.append((t, path, own))
                continue
            _, f, value, left = best
            below.append((next_id, t, (*path, (f, value, True)), [r for r in own if left(r)]))
            below.append((next_id + 1, t, (*path, (f, value, False)), [r for r in own if not left(r)]))
            next_id += 2
        level = below
    return [leaf for leaf in leaves if leaf[0] == tree]


def curve(rows, times):
    """Nelson-Aalen and Kaplan-Meier of weighted rows at all event times."""
    hazard, survival, out = 0.0, 1.0, []
    for t in times:
        n = sum(r["w"] for r in rows if r["time"] >= t)
        d = sum(r["w"] for r in rows if r["time"] == t and r["event"])
        if d:
            hazard, survival = hazard + d / n, survival * (1 - d / n)
        out.append((hazard, survival))
    return out


@pytest.fixture(scope="module")
def patients(spark):
    rng = np.random.default_rng(31)
    n = 160
    a, b, c = rng.integers(0, 9, n), rng.integers(0, 3, n), rng.normal(size=n).round(1)
    life = rng.exponential(1 / (0.02 + 0.02 * a + 0.05 * (b == 1)))
    stop = rng.uniform(5, 60, n)
    pdf = pd.DataFrame({"id": np.arange(n), "a": a.astype(float), "b": b.astype(float), "c": c, "time": np.minimum(life, stop).round(),
                        "event": life <= stop})
    df = spark.createDataFrame(pdf)
    hashes = {r.id: r.row for r in df.select("id", F.xxhash64("id").alias("row")).collect()}
    return df.repartition(5), [r | {"row": hashes[r["id"]]} for r in pdf.to_dict("records")]


def test_trees_equal_trees_grown_by_hand(spark, patients):
    df, rows = patients
    names, n_trees = ["a", "b", "c"], 3
    model = SurvivalForest.fit(df, "id", names, "time", "event", trees=n_trees, min_split=10, min_leaf=8, max_bins=100, seed=7)
    times = sorted({r["time"] for r in rows if r["event"]})
    assert list(model.times) == times
    want = {r["id"]: np.zeros((len(times), 2)) for r in rows}
    for tree in range(n_trees):
        leaves = grown(rows, names, tree, n_trees, 10, 8, 2, 7)
        assert len(leaves) > 4
        for _, path, own in leaves:
            inside = [r for r in rows if all((r[names[f]] <= value) == low for f, value, low in path)]
            shape = np.array(curve(own, times))
            for r in inside:
                want[r["id"]] += shape / n_trees
    got = model.curves(df, "id").toPandas().sort_values(["id", "time"])
    for i, part in got.groupby("id"):
        assert np.allclose(part[["cumulative_hazard", "survival"]].to_numpy(), want[i], atol=1e-9)
    risk = {r.id: r.risk for r in model.risk(df, "id").collect()}
    assert all(risk[i] == pytest.approx(want[i][:, 0].sum(), rel=1e-9) for i in want)


def test_bags_and_draws():
    w = bag_weights(np.arange(20_000)[:, None], np.arange(3)[None, :], 1)
    assert np.allclose(w.mean(0), 1, atol=0.03) and np.allclose(w.var(0), 1, atol=0.05) and not (w[:, 0] == w[:, 1]).all()
    looks = drawn_features(np.arange(9000), 5, 3, 1)
    assert (np.diff(looks, axis=1) > 0).all() and np.allclose(np.bincount(looks.ravel()) / looks.size, 0.2, atol=0.02)


def test_result_does_not_depend_on_partitions(spark, patients):
    df, _ = patients
    fits = [SurvivalForest.fit(d, "id", ["a", "b", "c"], "time", "event", trees=40, min_leaf=8) for d in (df.coalesce(1), df.repartition(9))]
    risks = [sorted(map(tuple, f.risk(df, "id").collect())) for f in fits]
    assert risks[0] == risks[1]
    assert (fits[0].trees.feature == fits[1].trees.feature).all()


def test_many_trees_order_risk(spark):
    rng = np.random.default_rng(15)
    n = 600
    x = rng.random(n)
    life = rng.exponential(1 / (0.02 + 0.2 * x))
    stop = rng.uniform(5, 60, n)
    df = spark.createDataFrame(pd.DataFrame({"id": np.arange(n), "x": x, "z": rng.random(n), "time": np.minimum(life, stop), "event": life <= stop}))
    model = SurvivalForest.fit(df.filter("id % 4 > 0"), "id", ["x", "z"], "time", "event", trees=200)
    test = df.filter("id % 4 = 0")
    scored = test.join(model.risk(test, "id"), "id")
    got = S.concordance(scored, "time", "event", "risk").first().concordance
    assert got > S.concordance(test, "time", "event", "x").first().concordance - 0.03
    curves = model.curves(test.filter("id < 20"), "id").toPandas().sort_values(["id", "time"])
    for _, c in curves.groupby("id"):
        assert (np.diff(c.survival) <= 1e-12).all() and c.survival.between(0, 1).all() and (np.diff(c.cumulative_hazard) >= 0).all()


def test_leaf_bound_quantiles_and_edges(spark, patients):
    df, _ = patients
    model = SurvivalForest.fit(df, "id", ["a", "b", "c"], "time", "event", trees=20, min_leaf=5, max_leaves=4, max_bins=4, max_times=6)
    assert len(model.times) <= 6 and all(len(e) <= 4 for e in model.edges)
    assert (model.trees.feature >= 0).sum() <= 20 * 3
    holes = df.withColumn("c", F.when(F.col("id") > 3, F.col("c")))
    assert model.risk(holes, "id").count() == df.count() - 4
    with pytest.raises(ValueError, match="no events"):
        SurvivalForest.fit(df.filter("NOT event"), "id", ["a"], "time", "event", trees=2)
    with pytest.raises(ValueError, match="not found"):
        SurvivalForest.fit(df, "id", ["nope"], "time", "event")
    tiny = SurvivalForest.fit(df.filter("id < 8"), "id", ["a"], "time", "event", trees=5)
    assert (tiny.trees.feature == -1).all() and tiny.curves(df.filter("id < 2"), "id").count() == 2 * len(tiny.times)


@pytest.mark.parametrize("max_leaves, max_times", [(4096, 1024), (5, 6)])
def test_large_nodes_and_dealt_out_ones_agree(spark, patients, monkeypatch, max_leaves, max_times):
    """Nodes counted where their rows are down to 40 rows, or dealt out from the root on, in small blocks or at once."""
    df, _ = patients
    found = []
    for group, least, block, cells in ((1 << 18, 10_000, 1 << 17, 1 << 18), (40, 1, 64, 200), (1, 1, 64, 200), (1 << 18, 10_000, 1, 1)):
        for name, value in (("GROUP_ROWS", group), ("GROUP_LEAST", least), ("BLOCK_ROWS", block), ("BLOCK_CELLS", cells)):
            monkeypatch.setattr(forest, name, value)
        model = SurvivalForest.fit(df, "id", ["a", "b", "c"], "time", "event", trees=12, min_leaf=8, max_leaves=max_leaves, max_times=max_times)
        curves = model.curves(df.filter("id < 3"), "id").toPandas().sort_values(["id", "time"]).to_numpy()
        found.append((model, model.steps.toPandas().sort_values(["node", "k"]), curves))
    first, steps, drawn = found[0]
    assert 12 < (first.trees.feature < 0).sum() <= 12 * min(max_leaves, 20)
    for model, own, curves in found[1:]:
        for name in ("feature", "cut", "child"):
            assert (getattr(model.trees, name) == getattr(first.trees, name)).all()
        assert np.allclose(own.to_numpy(), steps.to_numpy(), rtol=1e-9, atol=1e-12)
        assert np.allclose(curves, drawn, rtol=1e-9, atol=1e-12)
        assert np.allclose(model.leaf_risk, first.leaf_risk, rtol=1e-9)


def test_cuts_of_many_nodes_equal_those_of_one(monkeypatch):
    rng = np.random.default_rng(8)
    monkeypatch.setattr(forest, "BLOCK_CELLS", 300)
    sizes = [1, 3, 30, 200, 7, 45, 45, 90, 12, 31]
    own = np.repeat(np.arange(len(sizes)), sizes)
    bins, weight = rng.integers(0, 12, len(own)) * (own % 3 > 0), rng.integers(1, 4, len(own))
    event, moment, n_moments = rng.random(len(own)) < 0.5, np.zeros(len(own), np.int64), np.zeros(len(sizes), np.int64)
    want = []
    for node in range(len(sizes)):
        at = own == node
        reached = rng.integers(0 if node % 2 else 1, 25, at.sum())
        event[at] &= reached > 0
        n, d = np.zeros((12, 26), np.int64), np.zeros((12, 25), np.int64)
        np.add.at(n, (bins[at], reached), weight[at])
        np.add.at(d, (bins[at][event[at]], reached[event[at]] - 1), weight[at][event[at]])
        want.append(forest.best_cut(n, d, 8))
        died = np.unique(reached[event[at]])
        moment[at], n_moments[node] = np.searchsorted(died, reached, "right"), len(died)
    size = np.bincount(own, weights=weight).astype(np.int64)
    score, cut, left = forest._scored(own, bins, weight, event, moment, size, n_moments, 12, 8)
    assert sum(w is not None for w in want) > 3
    for node, w in enumerate(want):
        if w is None:
            assert score[node] < 0
        else:
            assert (score[node], cut[node], left[node], size[node] - left[node]) == (pytest.approx(w[0]), *w[1:])


def test_dealt_out_rows_are_narrow_whole_and_sorted(monkeypatch):
    """A block of two nodes dealt in parts: kept by node and time, five bytes a row with two features, then moved."""
    import pyarrow as pa

    rng = np.random.default_rng(4)
    args, nodes, sizes = (2, 20, 300), [5, 5, 9, 9, 9], [40, 30, 25, 30, 35]
    n = sum(sizes)
    of_time, of_mass, of_bin, n_features = forest._pair_types(args)
    reached, weight, event = rng.integers(0, 301, n).astype(of_time), rng.integers(1, 4, n), rng.random(n) < 0.6
    mass, bins = (2 * weight + event).astype(of_mass), rng.integers(0, 20, (n_features, n)).astype(of_bin)
    ends = np.cumsum(sizes)
    parts = [forest._packed([k], [b - a], reached[a:b], mass[a:b], bins[:, a:b]) for k, a, b in zip(nodes, [0, *ends], ends)]
    assert sum(len(p[1]) for p in parts) == 5 * n
    dealt = pa.RecordBatch.from_arrays([pa.array(v, pa.binary()) for v in zip(*parts)], ["nodes", "pairs"])

    def rows_of(batch):
        (k, m, *columns), = forest._blocks([batch.select(["nodes", "pairs"])], args)
        return list(zip(np.repeat(k, m).tolist(), *(c.tolist() for c in columns[:2]), columns[2].T.tolist(), strict=True))

    grow = forest._grower(args, 10, 8, 2, 7)
    out = {b.column("kind")[0].as_py(): b for b in grow(0, None)([dealt])}
    want = sorted(zip(np.repeat(nodes, sizes).tolist(), reached.tolist(), mass.tolist(), bins.T.tolist(), strict=True))
    kept = rows_of(out["rows"])
    assert sorted(kept) == want and [r[:2] for r in kept] == [r[:2] for r in want]
    split = {r["node"]: r for r in out["split"].to_pylist()}
    assert set(split) == {5, 9}
    feature, cut, child = (np.zeros(5, np.int32) for _ in range(3))
    for node, to in ((5, 20), (9, 22)):
        feature[node - 5], cut[node - 5], child[node - 5] = split[node]["feature"], split[node]["cut"], to
    monkeypatch.setattr(forest, "best_cuts", lambda reach, died, *_: np.ones(died.shape))  # all that can be cut are
    moved = [b for b in grow(5, forest.Trees(feature, cut, child))([out["rows"]])]
    left = [r for b in moved if b.column("kind")[0].as_py() == "rows" for r in rows_of(b)]
    goes = [(child[k - 5] + (b[split[k]["feature"]] > split[k]["cut"]), t, m, b) for k, t, m, b in want]
    held = {r[0] for r in left}
    assert held and sorted(left) == sorted(r for r in goes if r[0] in held)
    for side, node in (("left", 20), ("right", 21)):
        assert sum(m >> 1 for k, _, m, _ in goes if k == node) == split[5][side]


def test_nodes_of_many_rows_grow_like_the_others(monkeypatch):
    """Scored from their cells or with others, then moved: equal cuts, rows, and falls of leaves."""
    import pyarrow as pa

    rng = np.random.default_rng(5)
    args, nodes, sizes = (2, 20, 300), [3, 5, 6, 9], [300, 12, 5, 400]
    n, ends = sum(sizes), np.cumsum(sizes)
    of_time, of_mass, of_bin, _ = forest._pair_types(args)
    reached, bins = rng.integers(0, 301, n).astype(of_time), rng.integers(0, 20, (2, n)).astype(of_bin)
    mass = (2 * rng.integers(1, 4, n) + (rng.random(n) < 0.6)).astype(of_mass)
    parts = [forest._packed([k], [b - a], reached[a:b], mass[a:b], bins[:, a:b]) for k, a, b in zip(nodes, [0, *ends], ends)]
    dealt = pa.RecordBatch.from_arrays([pa.array(v, pa.binary()) for v in zip(*parts)], ["nodes", "pairs"])
    found = []
    for rows in (1, 100, 1 << 16):
        monkeypatch.setattr(forest, "CELL_ROWS", rows)
        grow, levels, own = forest._grower(args, 10, 8, 2, 7), [], [dealt]
        first, moves = 0, None
        for level in range(2):
            out = list(grow(first, moves)(own))
            of = {kind: [b for b in out if b.column("kind")[0].as_py() == kind] for kind in ("split", "rows", "step")}
            split = sorted(tuple(r[c] for c in ("node", "feature", "cut", "left", "right")) for b in of["split"] for r in b.to_pylist())
            kept = sorted(r for b in of["rows"] for k, m, *c in forest._blocks([b.select(["nodes", "pairs"])], args)
                          for r in zip(np.repeat(k, m).tolist(), *(v.tolist() for v in c[:2]), c[2].T.tolist(), strict=True))
            leaves = sorted(tuple(r) for b in of["step"] for r in np.frombuffer(b.column("nodes")[0].as_py(), forest._LEAVES).tolist())
            levels.append((split, kept, [r[:2] for r in leaves], np.array([r[2] for r in leaves])))
            feature, cut, child = np.full(20, -1, np.int32), np.zeros(20, np.int32), np.zeros(20, np.int32)
            for i, (node, f, c, *_) in enumerate(split):
                if level == 0 and node != 9:  # its cut is refused
                    feature[node], cut[node], child[node] = f, c, 20 + 2 * i
            first, moves, own = 0, forest.Trees(feature, cut, child), of["rows"]
        found.append(levels)
    assert len(found[0][0][0]) >= 2 and len(found[0][1][0]) > 0 and 9 in [k for k, _ in found[0][1][2]]
    for levels in found[1:]:
        for a, b in zip(levels, found[0], strict=True):
            assert a[:3] == b[:3] and np.allclose(a[3], b[3], rtol=1e-12)


def test_risk_is_spread_and_equals_the_leaves(spark, patients):
    df, _ = patients
    model = SurvivalForest.fit(df, "id", ["a", "b", "c"], "time", "event", trees=7, min_leaf=8)
    few = df.coalesce(1)
    assert model.risk(few, "id").rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    bins = np.random.default_rng(2).integers(0, 30, (500, 3))
    apart = model.trees.apart(np.arange(7))
    want = model.leaf_risk[model.trees.leaves_of(bins, np.arange(7))].sum(1)
    assert np.allclose(apart.sums(bins, model.leaf_risk[apart.nodes]), want, rtol=1e-12)
    leaves = np.flatnonzero(model.trees.feature < 0)
    wanted = np.isin(np.arange(len(model.trees.feature)), leaves[::2])
    assert {r.node for r in model.falls.steps(wanted).collect()} == {r.node for r in model.steps.collect()} & set(leaves[::2].tolist())
