"""Random survival forest with log-rank splits, grown level by level for all trees at once.

Nodes of more than ``GROUP_ROWS`` bag rows are never gathered. A level is one aggregate: tasks route their
rows through the trees so far and count (node, feature, bin, time) cells of weights and deaths; cells are
summed, and a node's cells, whose number is set by bins and times and not by rows, give the log-rank
statistic of all its cuts by running sums.

The bag rows of a smaller node are dealt out once, as narrow records, to one of many tasks. From then on its
subtree grows there without a shuffle: a level moves the records to the children the driver has numbered,
scores all cuts of many nodes together, those of a node with many rows from its (bin, time) cells, and gives off
deaths and rows at risk of finished leaves, whose records go. The driver holds the trees, at most ``max_leaves``
leaves each.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from causeway.session import cut_lineage, remove_path, require_columns, scratch_path

TREE_CHUNKS = 8  # copies of the narrow rows; each meets its share of the trees
TREES_AT_ONCE = 32
GROUP_ROWS = 1 << 22  # bag rows of a node up to which they are dealt out as one group, a few bytes each
GROUP_LEAST = 10_000  # groups of so few rows are not divided for the sake of more tasks
TASK_ROWS = 1_000_000  # bag rows of all trees in a task
BLOCK_ROWS = 1 << 16  # bag rows that are handled at a time
BLOCK_CELLS = 1 << 21  # (cut, time) cells of several nodes that are counted at a time
CACHED_CELLS = 1 << 16  # and summed at a time
CELL_ROWS = 1 << 16  # rows from which on a node is scored alone, from its (bin, time) cells: in little memory
SCORED_ROWS = 1 << 14  # (row, tree) pairs that are routed at a time
_MIX = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)  # fixed values of the splitmix64 generator


def _mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        z = np.asarray(x).astype(np.uint64) + np.uint64(_MIX[0])
        z = (z ^ (z >> np.uint64(30))) * np.uint64(_MIX[1])
        z = (z ^ (z >> np.uint64(27))) * np.uint64(_MIX[2])
        return z ^ (z >> np.uint64(31))


def bag_weights(row: np.ndarray, tree: np.ndarray, seed: int) -> np.ndarray:
    """Poisson(1) draws from hashes of (row, tree): how often a row is in a tree's bag."""
    bag = _mixed(np.asarray(tree, np.uint64) ^ _mixed(np.uint64(seed)))
    u = (_mixed(np.asarray(row, np.int64).astype(np.uint64) ^ bag) >> np.uint64(11)) * 2.0**-53
    upto = np.cumsum(np.cumprod([1.0, *(1.0 / np.arange(1, 20))])) * np.exp(-1.0)
    return np.searchsorted(upto, u, "right").astype(np.int64)


def drawn_features(nodes: np.ndarray, n_features: int, n_drawn: int, seed: int) -> np.ndarray:
    """``n_drawn`` features of each node, ascending, by hashes of (node, feature)."""
    pairs = np.asarray(nodes, np.uint64)[:, None] * np.uint64(n_features) + np.arange(n_features, dtype=np.uint64)
    keys = _mixed(pairs ^ _mixed(np.uint64(seed + 1)))
    return np.sort(np.argsort(keys, axis=1, kind="stable")[:, :n_drawn], axis=1)


def best_cut(n: np.ndarray, d: np.ndarray, min_leaf: int) -> tuple[float, int, int, int] | None:
    """(statistic, cut, rows left, rows right) of the best cut of one feature.

    ``n`` are the weights by (bin, number of event times reached), ``d`` the deaths by (bin, event
    time). Bins up to the cut go left. Equal statistics: the lower cut.
    """
    at = d.any(0)
    left_size = n.sum(1).cumsum()
    valid = (left_size >= min_leaf) & (left_size[-1] - left_size >= min_leaf)
    if not at.any() or not valid.any():
        return None
    risk = n[:, ::-1].cumsum(1)[:, ::-1][:, 1:][:, at].cumsum(0).astype(float)
    died = d[:, at].cumsum(0).astype(float)
    all_risk, all_died = risk[-1], died[-1]
    rows = np.flatnonzero(valid)
    risk, died = risk[rows], died[rows]
    gap = (died - risk * (all_died / all_risk)).sum(1)
    spread = all_died * (all_risk - all_died) / (all_risk * all_risk * np.maximum(all_risk - 1, 1))
    variance = (risk * (all_risk - risk) * spread).sum(1)
    with np.errstate(divide="ignore", invalid="ignore"):
        score = np.round(np.where(variance > 1e-12, gap * gap / variance, -1.0), 9)
    i = int(score.argmax())
    if score[i] < 0:
        return None
    cut = int(rows[i])
    return float(score[i]), cut, int(left_size[cut]), int(left_size[-1] - left_size[cut])


def best_cuts(reach: np.ndarray, died: np.ndarray, hazard: np.ndarray, spread: np.ndarray) -> np.ndarray:
    """Statistic of each cut of many nodes; -1 without one. The cuts are known to leave enough rows.

    ``reach`` are the weights by (node, rows between two cuts, event times not reached), overwritten by their running
    sums, which are the weights at risk from the last event time back; ``died`` the deaths left of each (node, cut). ``hazard``
    and ``spread`` are those of the whole node, from the last event time back; nodes with fewer have zeros there.
    """
    np.cumsum(reach, axis=2, out=reach)
    np.cumsum(reach, axis=1, out=reach)
    risk, rest = reach[:, :-1], reach[:, -1:] - reach[:, :-1]
    gap = died - np.einsum("ncm,nm->nc", risk, hazard)
    variance = np.einsum("ncm,ncm,nm->nc", risk, rest, spread)
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.round(np.where(variance > 1e-12, gap * gap / variance, -1.0), 9)


@dataclass(frozen=True)
class Trees:
    """All trees as one node table: ``feature`` is -1 at leaves, children are ``child`` and ``child + 1``."""

    feature: np.ndarray
    cut: np.ndarray
    child: np.ndarray

    def leaves_of(self, bins: np.ndarray, roots: np.ndarray) -> np.ndarray:
        """Node reached by each row (first axis) in each tree (second axis)."""
        node = np.broadcast_to(roots, (len(bins), len(roots))).copy()
        row = np.arange(len(bins))[:, None]
        while True:
            f = self.feature[node]
            inner = f >= 0
            if not inner.any():
                return node
            right = bins[row, np.maximum(f, 0)] > self.cut[node]
            node = np.where(inner, self.child[node] + right, node)

    def apart(self, roots: np.ndarray) -> Apart:
        """The trees of ``roots`` one by one, each with its nodes next to each other, level by level."""
        nodes, steps, level = [], [], np.asarray(roots, np.int64)
        tree = np.arange(len(level))
        owner = []
        while len(level):
            nodes.append(level)
            owner.append(tree)
            inner = self.feature[level] >= 0
            level, tree = (self.child[level[inner]][:, None] + np.arange(2)).ravel().astype(np.int64), np.repeat(tree[inner], 2)
            steps.append(np.bincount(tree, minlength=len(roots)) > 0)
        nodes, owner = np.concatenate(nodes), np.concatenate(owner)
        order = np.argsort(owner, kind="stable")
        nodes, owner = nodes[order], owner[order]
        sizes = np.bincount(owner, minlength=len(roots))
        starts = np.cumsum(sizes) - sizes
        inner = self.feature[nodes] >= 0
        # a tree's nodes lie by level and ascend in a level, so the children of its inner nodes follow each other
        nth = np.cumsum(inner) - inner
        nth -= nth[starts][owner]
        child = np.where(inner, 1 + 2 * nth, np.arange(len(nodes)) - starts[owner]).astype(np.int32)
        cut = np.where(inner, self.cut[nodes], np.iinfo(np.int32).max).astype(np.int32)
        return Apart(starts, sizes, np.sum(steps, axis=0), np.maximum(self.feature[nodes], 0).astype(np.int32), cut, child, nodes)


@dataclass(frozen=True)
class Apart:
    """Trees as ranges of nodes; children are ``child`` and ``child + 1`` of the range, a leaf's child is the leaf itself."""

    starts: np.ndarray
    sizes: np.ndarray
    depth: np.ndarray
    feature: np.ndarray
    cut: np.ndarray
    child: np.ndarray
    nodes: np.ndarray

    def sums(self, bins: np.ndarray, values: np.ndarray) -> np.ndarray:
        """Sum over the trees of the value of the leaf that each row reaches; ``values`` by place in the ranges."""
        n, n_features = bins.shape
        flat, total = np.ascontiguousarray(bins.astype(np.int32)).ravel(), np.zeros(n)
        for begin in range(0, n, SCORED_ROWS):
            base = np.arange(begin, min(begin + SCORED_ROWS, n)) * n_features
            for start, size, depth in zip(self.starts.tolist(), self.sizes.tolist(), self.depth.tolist(), strict=True):
                own = slice(start, start + size)
                feature, cut, child = self.feature[own], self.cut[own], self.child[own]
                node = np.zeros(len(base), np.int32)
                for _ in range(depth):
                    right = flat.take(base + feature.take(node)) > cut.take(node)
                    node = child.take(node) + right
                total[begin:begin + len(base)] += values[own].take(node)
        return total


@dataclass(frozen=True)
class SurvivalForest:
    """``SurvivalForest.fit(df, "id", features, "time", "event")``, then ``risk`` and ``curves``."""

    features: tuple[str, ...]
    edges: tuple[tuple[float, ...], ...]
    times: tuple[float, ...]
    n_trees: int
    trees: Trees
    falls: Falls
    leaf_risk: np.ndarray

    @property
    def steps(self) -> DataFrame:
        """(node, k, hazard, drop): what a leaf's curves do at event time k."""
        return self.falls.steps()

    @classmethod
    def fit(cls, df: DataFrame, key: str, features: Sequence[str], time: str, event: str, trees: int = 1000,
            min_split: int = 10, min_leaf: int = 15, max_features: int | None = None, max_leaves: int = 4096,
            max_bins: int = 32, max_times: int = 1024, seed: int = 20) -> SurvivalForest:
        """Grow ``trees`` trees on Poisson(1) bags drawn by hashes of (key, tree).

        Sizes count bag rows. Each node looks at ``max_features`` features (the root of their number, rounded
        up) and takes the cut with the largest log-rank statistic; equal ones: the first feature, the lowest
        cut. Features with more than ``max_bins`` values are cut at quantiles, and more than ``max_times``
        event times are brought to quantiles of them. Rows with nulls are left out.
        """
        require_columns(df, [key, *features, time, event])
        rows = df.select(F.xxhash64(key).alias("row"), *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(features)],
                         F.col(time).cast("double").alias("time"), F.col(event).cast("boolean").alias("event")).dropna()
        rows = cut_lineage(rows)
        names = [f"x{i}" for i in range(len(features))]
        edges = tuple(_levels(rows, c, max_bins)[:-1] for c in names)
        times = _levels(rows.filter("event"), "time", max_times)
        if not times:
            raise ValueError("no events to fit")
        drawn = max_features or int(np.ceil(np.sqrt(len(features))))
        share = -(-trees // TREE_CHUNKS)
        chunks = F.explode(F.sequence(F.lit(0), F.lit((trees - 1) // share))).alias("chunk")
        tasks = max(TREE_CHUNKS, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        dealt = cut_lineage(rows.select("row", *names, "time", "event", chunks).repartitionByRange(tasks, "chunk", "row"))
        grown, falls = _grow(dealt, rows.count(), tasks, names, edges, times, trees, share, min_split, min_leaf, drawn, max_leaves, seed)
        return cls(tuple(features), edges, times, trees, grown, falls, falls.risk(len(grown.feature)))

    def _rows(self, df: DataFrame, key: str) -> DataFrame:
        require_columns(df, [key, *self.features])
        return df.select(F.col(key).alias("key"), *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(self.features)]).dropna(
            subset=[f"x{i}" for i in range(len(self.features))])

    def risk(self, df: DataFrame, key: str) -> DataFrame:
        """(key, risk): cumulative hazard summed over the event times, mean of all trees. One narrow pass, whose work is rows times
        trees: few bytes of rows are spread over as many tasks as a shuffle has."""
        edges, n, trees = self.edges, self.n_trees, self.trees.apart(np.arange(self.n_trees))
        leaf_risk = self.leaf_risk[trees.nodes]
        rows = self._rows(df, key).repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))

        def run(batches):
            import pyarrow as pa

            for batch in batches:
                total = trees.sums(_binned(batch, edges), leaf_risk)
                yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(total / n)], ["key", "risk"])

        out = rows.select("key").schema.add("risk", "double")
        return rows.mapInArrow(run, out).select(F.col("key").alias(key), "risk")

    def curves(self, df: DataFrame, key: str) -> DataFrame:
        """(key, time, cumulative_hazard, survival) of each row at every event time: means over the trees.

        ``key`` is unique. Rows are multiplied by trees and joined with the leaves' steps; the sum per
        (key, event time) combines before the shuffle.
        """
        rows, edges, trees, n = cut_lineage(self._rows(df, key)), self.edges, self.trees, self.n_trees

        def run(batches):
            import pyarrow as pa

            for batch in batches:
                bins = _binned(batch, edges)
                for at in range(0, n, TREES_AT_ONCE):
                    nodes = trees.leaves_of(bins, np.arange(at, min(at + TREES_AT_ONCE, n)))
                    keys = batch.column("key").take(pa.array(np.repeat(np.arange(len(bins)), nodes.shape[1])))
                    yield pa.RecordBatch.from_arrays([keys, pa.array(nodes.ravel())], ["key", "node"])

        reached = rows.mapInArrow(run, rows.select("key").schema.add("node", "long"))
        wanted = np.zeros(len(trees.feature), bool)
        wanted[reached.select("node").distinct().toArrow()["node"].to_numpy()] = True  # at most all leaves
        sums = reached.join(self.falls.steps(wanted), "node").groupBy("key", "k").agg(F.sum("hazard").alias("hazard"), F.sum("drop").alias("drop"))
        moments = F.posexplode(F.array(*[F.lit(t) for t in self.times])).alias("k", "time")
        grid = rows.select("key", moments)
        upto = Window.partitionBy("key").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)  # event times of one row
        filled = grid.join(sums, ["key", "k"], "left").fillna(0.0, ["hazard", "drop"])
        return filled.select(F.col("key").alias(key), "time", (F.sum("hazard").over(upto) / n).alias("cumulative_hazard"),
                             F.greatest(1.0 - F.sum("drop").over(upto) / n, F.lit(0.0)).alias("survival"))


# ---------------------------------------------------------------- growing


def _levels(rows: DataFrame, column: str, most: int) -> tuple[float, ...]:
    """Distinct values, or quantiles where there are more than ``most``; ascending."""
    found = rows.select(column).distinct().limit(most + 1).collect()
    if len(found) > most:
        probs = [i / most for i in range(1, most + 1)]
        found = [[v] for v in rows.agg(F.percentile_approx(column, probs, 10 * most).alias("q")).collect()[0]["q"]]
    return tuple(sorted({float(r[0]) for r in found}))


def _binned(batch, edges) -> np.ndarray:
    """Bin of each feature: the number of its edges below the value."""
    return np.column_stack([np.searchsorted(np.asarray(e), batch.column(f"x{i}").to_numpy(zero_copy_only=False), "left")
                            for i, e in enumerate(edges)])


def _reached(batch, times) -> tuple[np.ndarray, np.ndarray]:
    """Number of event times up to each row's time, and whether the row died at the last of them."""
    reached = np.searchsorted(np.asarray(times), batch.column("time").to_numpy(), "right")
    return reached, batch.column("event").to_numpy(zero_copy_only=False)


def _in_bags(batch, trees: Trees, bins: np.ndarray, n_trees: int, share: int, seed: int):
    """(row index, node, weight) of bag members, a few trees at a time, tree by tree; a batch may hold several chunks."""
    chunk, row = batch.column("chunk").to_numpy(), batch.column("row").to_numpy()
    for c in np.unique(chunk):
        own = np.flatnonzero(chunk == c)
        for at in range(c * share, min((c + 1) * share, n_trees), TREES_AT_ONCE):
            ids = np.arange(at, min(at + TREES_AT_ONCE, (c + 1) * share, n_trees))
            weight = bag_weights(row[None, own], ids[:, None], seed).ravel()
            member = np.flatnonzero(weight)
            t, r = np.divmod(member, len(own))
            if (trees.feature[ids] < 0).all():  # no tree has a cut yet
                node = ids[t]
            else:
                node = trees.leaves_of(bins[own], ids)[r, t]
            yield own[r], node, weight[member]


def _summed(code: np.ndarray, n: np.ndarray, d: np.ndarray):
    import pyarrow as pa

    cells, at = np.unique(code, return_inverse=True)
    sums = [np.bincount(at, weights=v, minlength=len(cells)).astype(np.int64) for v in (n, d)]
    return pa.RecordBatch.from_arrays([pa.array(cells), *map(pa.array, sums)], ["cell", "n", "d"])


CELLS = "cell bigint, n bigint, d bigint"


SPLITS = "node bigint, feature bigint, cut bigint, `left` bigint, `right` bigint"
STEPS = "node bigint, k int, hazard double, drop double"
_LEAVES = np.dtype([("node", np.int64), ("rows", np.int32), ("risk", np.float64)])


@dataclass(frozen=True)
class Falls:
    """Leaves of the nodes dealt out as stored bytes: their numbers of steps and cumulative risk (``nodes``), event times,
    deaths and rows at risk of the steps (``pairs``). ``large`` has the steps of leaves that were counted where their rows are."""

    stored: DataFrame | None
    large: DataFrame | None
    n_times: int

    def steps(self, wanted: np.ndarray | None = None) -> DataFrame:
        """(node, k, hazard, drop) of all leaves or of those ``wanted`` (by node)."""
        parts = []
        if self.stored is not None:
            mask = None if wanted is None else np.packbits(wanted)

            def run(batches):
                keep = None if mask is None else np.unpackbits(mask).astype(bool)
                for batch in batches:
                    for own, pairs in zip(batch.column("nodes"), batch.column("pairs"), strict=True):
                        own, pairs = np.frombuffer(own.as_buffer(), _LEAVES), pairs.as_buffer()
                        m, at = int(own["rows"].sum()), 0
                        columns = []
                        for kind in (np.int32, np.uint32, np.uint32):
                            columns.append(np.frombuffer(pairs, kind, m, at))
                            at += 4 * m
                        node = np.repeat(own["node"], own["rows"])
                        if keep is not None:
                            some = np.flatnonzero(np.repeat(keep[own["node"]], own["rows"]))
                            node, columns = node[some], [c[some] for c in columns]
                        if len(node):
                            yield _curves(node, *columns)

            parts.append(self.stored.mapInArrow(run, STEPS))
        if self.large is not None:
            rows = self.large
            if wanted is not None:
                rows = rows.filter(F.col("node").isin([int(v) for v in self.large_nodes() if wanted[v]]))
            parts.append(rows)
        return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])

    def large_nodes(self) -> list[int]:
        return [r["node"] for r in self.large.select("node").distinct().collect()]  # few, as they are large

    def risk(self, n_nodes: int) -> np.ndarray:
        """Cumulative hazard of each node summed over the event times; 0 where a node is no leaf."""
        risk = np.zeros(n_nodes)
        if self.stored is not None:
            for own in self.stored.select("nodes").toArrow()["nodes"].to_pylist():  # a number per leaf
                own = np.frombuffer(own, _LEAVES)
                risk[own["node"]] = own["risk"]
        if self.large is not None:
            own = self.large.groupBy("node").agg(F.sum(F.col("hazard") * (self.n_times - F.col("k"))).alias("risk")).toArrow()
            risk[own["node"].to_numpy()] = own["risk"].to_numpy()
        return risk


def _grow(dealt, n_rows, tasks, names, edges, times, n_trees, share, min_split, min_leaf, drawn, max_leaves, seed) -> tuple[Trees, Falls]:
    """The trees and what the curves of their leaves do."""
    spark = dealt.sparkSession
    path = scratch_path(spark, "forest-steps")
    limit = min(GROUP_ROWS, max(GROUP_LEAST, n_rows * n_trees // tasks))
    tasks = max(tasks, n_rows * n_trees // TASK_ROWS)
    args = (len(names), max(len(e) for e in edges) + 1, len(times))
    feature, cut, child = np.full(n_trees, -1, np.int32), np.zeros(n_trees, np.int32), np.zeros(n_trees, np.int32)
    tree_of, leaves = np.arange(n_trees), np.ones(n_trees, np.int64)
    sizes, below_big = np.full(n_trees, n_rows), np.ones(n_trees, bool)  # of the nodes born last
    first, level, groups, large_leaves, dealt_out = 0, 0, None, [], False
    grow = _grower(args, min_split, min_leaf, drawn, seed)
    while True:
        trees, born = Trees(feature, cut, child), np.arange(len(feature) - len(sizes), len(feature))
        large, small = born[below_big & (sizes > limit)], born[below_big & (sizes <= limit)]
        parts, found, waiting = [], [], 0
        if groups is not None:
            moves = Trees(*(v[first:len(feature) - len(sizes)] for v in (feature, cut, child)))
            parts.append(groups.mapInArrow(grow(first, moves), GROWN))
        if len(small):
            placed = _gathered(dealt, args, edges, times, trees, small, n_trees, share, seed, tasks)
            parts.append(placed.mapInArrow(grow(0, None), GROWN))
        if parts:
            dealt_out = True
            out = parts[0].union(parts[1]) if len(parts) > 1 else parts[0]
            out.write.partitionBy("kind", "part").options(**_STORED).parquet(f"{path}/level={level}")
            grown = spark.read.schema(GROWN).parquet(f"{path}/level={level}")
            found.append(grown.filter("kind = 'split'").select("node", "feature", "cut", "left", "right").toArrow())  # at most the frontier
            waiting = found[0].num_rows
            groups = grown.filter("kind = 'rows'").select("nodes", "pairs") if waiting else None
            if level:  # what has been read
                for kind in ("rows", "split"):
                    remove_path(spark, f"{path}/level={level - 1}/kind={kind}")
        level += 1
        if len(large):
            found.append(_large_splits(dealt, args, edges, times, trees, large, n_trees, share, min_split, min_leaf, drawn, seed).toArrow())
        if not found:
            break
        node, by, at_most, left, right = (np.concatenate([t[c].to_numpy() for t in found]) for c in ("node", "feature", "cut", "left", "right"))
        order = np.lexsort((node, -(left + right), tree_of[node]))  # the largest nodes of each tree first
        tree = tree_of[node[order]]
        place = np.arange(len(tree)) - np.searchsorted(tree, tree)
        taken = np.sort(order[place < max_leaves - leaves[tree]])
        taken = taken[np.argsort(node[taken], kind="stable")]
        node, by, at_most, left, right = (v[taken] for v in (node, by, at_most, left, right))
        leaves += np.bincount(tree_of[node], minlength=n_trees)
        large_leaves.append(np.setdiff1d(large, node))
        feature[node], cut[node], child[node] = by, at_most, len(feature) + 2 * np.arange(len(node))
        first = len(feature) - len(sizes)
        sizes = np.column_stack([left, right]).ravel()
        below_big = np.repeat(np.isin(node, large), 2)
        tree_of = np.concatenate([tree_of, np.repeat(tree_of[node], 2)])
        feature = np.concatenate([feature, np.full(len(sizes), -1, np.int32)])
        cut, child = (np.concatenate([v, np.zeros(len(sizes), np.int32)]) for v in (cut, child))
        if not waiting and not below_big.any():
            break
    trees, rest = Trees(feature, cut, child), np.concatenate([*large_leaves, np.empty(0, np.int64)]).astype(np.int64)
    large = None
    if len(rest):
        own = _leaf_steps(dealt, edges, times, trees, rest, n_trees, share, seed)
        own.write.option("compression", "zstd").parquet(f"{path}-large")
        large = spark.read.schema(STEPS).parquet(f"{path}-large")
    stored = spark.read.schema(f"{GROWN}, level int").parquet(path).filter("kind = 'step'").select("nodes", "pairs") if dealt_out else None
    return trees, Falls(stored, large, len(times))


def _live(trees: Trees, nodes: np.ndarray) -> np.ndarray:
    live = np.zeros(len(trees.feature), bool)
    live[nodes] = True
    return live


def _large_splits(dealt, args, edges, times, trees, nodes, n_trees, share, min_split, min_leaf, drawn, seed) -> DataFrame:
    """Best cuts of nodes whose rows are counted where they are."""
    n_features, n_bins, n_times = args
    width = n_bins * (n_times + 1)
    live, looks = _live(trees, nodes), drawn_features(np.arange(len(trees.feature)), n_features, drawn, seed)

    def cells(batches):
        for batch in batches:
            bins = _binned(batch, edges)
            reached, event = _reached(batch, times)
            for r, node, weight in _in_bags(batch, trees, bins, n_trees, share, seed):
                r, node, weight = (v[live[node]] for v in (r, node, weight))
                code = [((node * drawn + j) * n_bins + bins[r, looks[node, j]]) * (n_times + 1) + reached[r] for j in range(drawn)]
                yield _summed(np.concatenate(code), np.tile(weight, drawn), np.tile(weight * event[r], drawn))

    def cuts(batches):
        import pyarrow as pa

        out = []
        for node, code, n, d in _by_node(batches, drawn * width):
            best = None
            for j in range(drawn):
                own = (code >= j * width) & (code < (j + 1) * width)
                at = code[own] - j * width
                sizes = np.bincount(at, weights=n[own], minlength=width).reshape(n_bins, n_times + 1)
                deaths = np.bincount(at, weights=d[own], minlength=width).reshape(n_bins, n_times + 1)[:, 1:]
                found = best_cut(sizes, deaths, min_leaf) if sizes.sum() >= min_split else None
                if found and (best is None or found[0] > best[0]):
                    best = (*found, int(looks[node, j]))
            if best:
                out.append((node, best[4], best[1], best[2], best[3]))
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], pa.int64()) for i in range(5)],
                                         ["node", "feature", "cut", "left", "right"])

    summed = dealt.mapInArrow(cells, CELLS).groupBy("cell").agg(F.sum("n").alias("n"), F.sum("d").alias("d"))
    node = F.floor(F.col("cell") / F.lit(drawn * width)).cast("bigint")
    return summed.repartition(node).sortWithinPartitions("cell").mapInArrow(cuts, SPLITS)


# ---------------------------------------------------------------- nodes dealt out


GROWN = f"{SPLITS}, nodes binary, pairs binary, kind string, part int"  # kind: split, rows or step
PARTS = 2  # files of rows that a task writes, so that a level has no fewer tasks than the one before for want of files
_STORED = {"compression": "zstd", "parquet.compression.codec.zstd.level": "1", "parquet.enable.dictionary": "false"}  # rows don't repeat


def _pair_types(args) -> tuple[np.dtype, np.dtype, np.dtype, int]:
    """What is kept of a row in a tree's bag: event times reached; twice its weight, and one if it died; bins (so many features)."""
    n_features, n_bins, n_times = args
    return np.min_scalar_type(n_times), np.dtype(np.uint8), np.min_scalar_type(n_bins), n_features


def _packed(nodes, sizes, reached, mass, bins) -> tuple[bytes, bytes]:
    """Nodes with their numbers of rows; the rows column by column, ``bins`` by feature."""
    own = np.empty(len(nodes), _NODES)
    own["node"], own["rows"] = nodes, sizes
    return own.tobytes(), reached.tobytes() + mass.tobytes() + np.ascontiguousarray(bins).tobytes()


_NODES = np.dtype([("node", np.int64), ("rows", np.int32)])


def _gathered(dealt, args, edges, times, trees, nodes, n_trees, share, seed, tasks) -> DataFrame:
    """(nodes, pairs): the bag rows of ``nodes``, all parts of a node in one partition and next to each other."""
    live, (of_time, of_mass, of_bin, _) = _live(trees, nodes), _pair_types(args)

    def deal(batches):
        import pyarrow as pa

        for batch in batches:
            bins = np.ascontiguousarray(_binned(batch, edges).T.astype(of_bin))
            reached, event = _reached(batch, times)
            reached, event = reached.astype(of_time), event.astype(of_mass)
            for r, node, weight in _in_bags(batch, trees, bins.T, n_trees, share, seed):
                own = np.flatnonzero(live[node])
                if not len(own):
                    continue
                if (np.diff(node[own]) < 0).any():
                    own = own[np.argsort(node[own], kind="stable")]
                r, node, weight = r[own], node[own], weight[own].astype(of_mass)
                ends = [*(np.flatnonzero(np.diff(node)) + 1).tolist(), len(node)]
                found = node[np.array(ends) - 1]
                columns = reached[r], 2 * weight + event[r], bins[:, r]
                parts = [_packed([k], [b - a], *(c[..., a:b] for c in columns)) for k, a, b in zip(found, [0, *ends], ends, strict=False)]
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), *(pa.array(v, pa.binary()) for v in zip(*parts, strict=True))],
                                                 ["node", "nodes", "pairs"])

    parts = dealt.mapInArrow(deal, "node bigint, nodes binary, pairs binary").repartition(tasks, "node").sortWithinPartitions("node")
    return parts.select("nodes", "pairs")


def _narrow(key: np.ndarray, most: int) -> np.ndarray:
    """Keys below ``most`` in as few bytes as they need: stable sorts of one or two bytes take linear time."""
    return key.astype(np.min_scalar_type(most))


def _blocks(batches, args):
    """(nodes, rows of each, reached, mass, bins) of about ``BLOCK_ROWS`` rows, a node's parts never apart."""
    of_time, of_mass, of_bin, n_features = _pair_types(args)
    held, size, last = [], 0, None

    def joined():
        return *(np.concatenate([h[i] for h in held]) for i in range(4)), np.concatenate([h[4] for h in held], 1)

    for batch in batches:
        for own, pairs in zip(batch.column("nodes"), batch.column("pairs"), strict=True):
            own, pairs = np.frombuffer(own.as_buffer(), _NODES), pairs.as_buffer()
            if size >= BLOCK_ROWS and own["node"][0] != last:
                yield joined()
                held, size = [], 0
            n, at = int(own["rows"].sum()), 0
            columns = [own["node"], own["rows"]]
            for kind, many in ((of_time, n), (of_mass, n), (of_bin, n * n_features)):
                columns.append(np.frombuffer(pairs, kind, many, at))
                at += many * kind.itemsize
            columns[-1] = columns[-1].reshape(n_features, n)
            held.append(columns)
            size, last = size + n, own["node"][-1]
    if held:
        yield joined()


def _grower(args, min_split: int, min_leaf: int, drawn: int, seed: int):
    """``grow(first, moves)``: a level of the nodes dealt out, after the moves that numbered nodes from ``first`` on took.

    Rows of a block are kept by node, then by time.
    """
    n_features, n_bins, n_times = args
    least = max(min_split, 2 * min_leaf)

    def grow(first: int, moves: Trees | None):
        def run(batches):
            for block, (nodes, sizes, reached, mass, bins) in enumerate(_blocks(batches, args)):
                if moves is None:
                    nodes, place = np.unique(nodes, return_inverse=True)
                    key, stays = np.repeat(_narrow(place, len(nodes)), sizes), np.zeros(len(nodes), bool)
                    order = np.argsort(reached, kind="stable")
                    order = order[np.argsort(key[order], kind="stable")]
                    sizes = np.bincount(key, minlength=len(nodes))
                elif len(reached) >= CELL_ROWS * len(nodes):
                    nodes, sizes, stays, order = moved(nodes, sizes, bins, moves.feature[nodes - first], moves.cut[nodes - first], moves.child[nodes - first])
                else:
                    at = nodes - first
                    by, child = moves.feature[at], moves.child[at]
                    stays = by < 0
                    become = np.where(stays, 1, 2)
                    base = np.cumsum(become) - become
                    value = bins.ravel()[np.repeat(np.maximum(by, 0).astype(np.int64) * len(reached), sizes) + np.arange(len(reached))]
                    key = np.repeat(base, sizes) + (value > np.repeat(np.where(stays, n_bins, moves.cut[at]), sizes))
                    nodes = np.repeat(np.where(stays, nodes, child), become)
                    nodes[base[~stays] + 1] += 1
                    stays = np.repeat(stays, become)
                    order = np.argsort(_narrow(key, len(nodes)), kind="stable")
                    sizes = np.bincount(key, minlength=len(nodes))
                reached, mass, bins = reached[order], mass[order], bins[:, order]
                del order
                ends = np.cumsum(sizes)
                at = 0
                for to in [*np.flatnonzero(sizes >= CELL_ROWS).tolist(), len(nodes)]:  # large nodes one by one, and those between them together
                    for a, b, how in ((at, to, level), (to, to + 1, counted)):
                        if a < min(b, len(nodes)):
                            own = slice(int(ends[a] - sizes[a]), int(ends[b - 1]))
                            yield from how(nodes[a:b], sizes[a:b], reached[own], mass[own], bins[:, own], stays[a:b], block % PARTS)
                    at = to + 1

        return run

    def moved(nodes, sizes, bins, by, cut, child):
        """(nodes, sizes, stays, order) after the moves of few nodes with many rows."""
        ends, out = np.cumsum(sizes), []
        for node, f, c, to, a, b in zip(nodes, by, cut, child, ends - sizes, ends, strict=True):
            if f < 0:
                out.append((node, True, np.arange(a, b)))
            else:
                right = bins[f, a:b] > c
                out += [(to, False, np.flatnonzero(~right) + a), (to + 1, False, np.flatnonzero(right) + a)]
        nodes, stays, rows = zip(*out, strict=True)
        return np.array(nodes, np.int64), np.array([len(r) for r in rows]), np.array(stays), np.concatenate(rows)

    def counted(nodes, sizes, reached, mass, bins, stays, part):
        """``level`` of one node with many rows, from the sums of its (bin, time) cells."""
        width = n_times + 1
        n, d, size, best = np.zeros(width), np.zeros(width), 0, None
        cells = [[np.zeros(n_bins * width), np.zeros(n_bins * width)] for _ in range(0 if stays[0] else drawn)]
        looks = drawn_features(nodes, n_features, drawn, seed)[0]
        for a in range(0, len(reached), BLOCK_ROWS):
            own = slice(a, a + BLOCK_ROWS)
            weight, moment, dead = (mass[own] >> 1).astype(float), reached[own].astype(np.int64), np.flatnonzero(mass[own] & 1)
            n += np.bincount(moment, weight, width)
            d += np.bincount(moment[dead], weight[dead], width)
            for f, (all_, died) in zip(looks, cells, strict=False):
                code = bins[f, own] * np.int64(width) + moment
                all_ += np.bincount(code, weight, n_bins * width)
                died += np.bincount(code[dead], weight[dead], n_bins * width)
        size = int(n.sum())
        for f, (all_, died) in zip(looks, cells, strict=False):
            found = best_cut(all_.reshape(n_bins, width), died.reshape(n_bins, width)[:, 1:], min_leaf) if size >= least else None
            if found and (best is None or found[0] > best[0]):
                best = (*found, f)
        if best:
            yield _batch("split", node=nodes, feature=[best[4]], cut=[best[1]], left=[best[2]], right=[best[3]])
            own, pairs = _packed(nodes, sizes, reached, mass, bins)
            yield _batch("rows", part, node=nodes, nodes=[own], pairs=[pairs])
        elif (d > 0).any():
            at = np.flatnonzero(d)
            yield _falls(np.repeat(nodes, len(at)), at - 1, d[at], n[::-1].cumsum()[::-1][at], n_times)

    def level(nodes, sizes, reached, mass, bins, stays, part):
        ends = np.cumsum(sizes)
        starts, seg = ends - sizes, np.repeat(np.arange(len(nodes)), sizes)
        weight, event = (mass >> 1).astype(float), (mass & 1).astype(bool)
        size = np.add.reduceat(weight, starts).astype(np.int64)
        new_cell = np.concatenate([[True], reached[1:] != reached[:-1]])
        new_cell[starts] = True
        cells = np.flatnonzero(new_cell)
        fell, upto = np.add.reduceat(weight * event, cells), np.cumsum(weight)
        at, dead = cells[fell > 0], fell[fell > 0]
        risk = (upto[ends - 1])[seg[at]] - upto[at] + weight[at]
        # event times of the node, and how many of them a row has reached; deaths before the first of all times are steps of leaves only
        timed = reached[at] > 0
        event &= reached > 0
        moment = np.zeros(len(reached), np.int64)
        moment[at[timed]] = 1
        n_moments = np.bincount(seg[at[timed]], minlength=len(nodes))
        moment = moment.cumsum() - np.repeat(n_moments.cumsum() - n_moments, sizes)
        score, by, cut, left = np.full(len(nodes), -1.0), np.zeros(len(nodes), np.int64), np.zeros(len(nodes), np.int64), np.zeros(len(nodes), np.int64)
        looked = (size >= least) & ~stays & (n_moments > 0)
        if looked.any():
            open_, rows = np.flatnonzero(looked), slice(None)
            if len(open_) < len(nodes):
                rows = np.flatnonzero(np.repeat(looked, sizes))
            times = timed & looked[seg[at]]
            own, looks = np.repeat(np.arange(len(open_)), sizes[open_]), drawn_features(nodes[open_], n_features, drawn, seed)
            w, e, m, at_times = weight[rows], event[rows], moment[rows], (dead[times], risk[times])
            place = np.arange(len(reached))[rows]
            for j in range(drawn):
                values = bins.ravel()[np.repeat(looks[:, j] * len(reached), sizes[open_]) + place]
                s, c, n_left = _scored(own, values, w, e, m, size[open_], n_moments[open_], n_bins, min_leaf, at_times)
                better = s > score[open_]
                to = open_[better]
                score[to], by[to], cut[to], left[to] = s[better], looks[better, j], c[better], n_left[better]
        split = score >= 0
        if split.any():
            yield _batch("split", node=nodes[split], feature=by[split], cut=cut[split], left=left[split], right=(size - left)[split])
            going = slice(None) if split.all() else np.flatnonzero(np.repeat(split, sizes))
            own, pairs = _packed(nodes[split], sizes[split], reached[going], mass[going], bins[:, going])
            yield _batch("rows", part, node=nodes[split][:1], nodes=[own], pairs=[pairs])
        if not split.all():
            of = ~split[seg[at]]
            if of.any():
                yield _falls(nodes[seg[at[of]]], reached[at[of]].astype(np.int64) - 1, dead[of], risk[of], n_times)

    return grow


def _at_times(own, weight, event, moment, n_moments) -> tuple[np.ndarray, np.ndarray]:
    """Deaths and weight at risk at the event times of each node, node by node; rows are sorted by their node, ``own``."""
    width = n_moments + 1  # none reached is a cell of its own
    first = np.cumsum(width) - width
    cell, total = first[own] + moment, int(width.sum())
    n, dead = (np.bincount(cell, weights=v, minlength=total) for v in (weight, weight * event))
    upto = np.cumsum(n)
    risk = np.repeat(upto[first + n_moments], width) - upto + n
    times = np.ones(total, bool)
    times[first] = False
    return dead[times], risk[times]


def _scored(own, bins, weight, event, moment, size, n_moments, n_bins: int, min_leaf: int, at_times=None):
    """(statistic, cut, rows left) of the best cut of one feature in each node; -1 without one. Equal statistics: the lower cut.

    Rows are sorted by their node, ``own``; ``at_times`` is what ``_at_times`` gives for them. Nodes of like numbers of
    cuts and event times are scored together.
    """
    n = len(size)
    dead, risk = at_times or _at_times(own, weight, event, moment, n_moments)
    hazard, spread = dead / risk, dead * (risk - dead) / (risk * risk * np.maximum(risk - 1, 1))
    ahead = np.cumsum(n_moments) - n_moments
    key = own * n_bins + bins
    by_bin, died = (np.bincount(key, weights=v, minlength=n * n_bins).reshape(n, n_bins) for v in (weight, weight * event))
    lower = by_bin.cumsum(1)
    valid = (by_bin > 0) & (lower >= min_leaf) & (size[:, None] - lower >= min_leaf)  # a cut after an empty bin is no other cut
    before = valid.cumsum(1)
    n_cuts = before[:, -1].copy()
    before -= valid
    score, cut = np.full(n, -1.0), np.zeros(n, np.int64)
    cut_starts, cut_bins, cut_died = np.cumsum(n_cuts) - n_cuts, np.nonzero(valid)[1], died.cumsum(1)[valid]
    some = np.flatnonzero((n_cuts > 0) & (n_moments > 0))
    like = np.ceil(np.log2(n_cuts[some] + 1)).astype(np.int64) * 64 + np.ceil(np.log2(n_moments[some] + 1)).astype(np.int64)
    some, like = (v[np.argsort(like, kind="stable")] for v in (some, like))
    # cells of a node: cuts before a row's bin, event times of the node that it has not reached
    begins = np.flatnonzero(np.diff(like, prepend=-1))
    group = np.cumsum(np.diff(like, prepend=-1) != 0) - 1
    c, m = (np.maximum.reduceat(v[some], begins) + 1 if len(some) else begins for v in (n_cuts, n_moments))
    cells = (c * m)[group]
    upto, done = np.cumsum(cells), 0
    while done < len(some):
        begin = upto[done] - cells[done]
        end = max(done + 1, int(np.searchsorted(upto, begin + BLOCK_CELLS, "right")))
        run, total = some[done:end], int(upto[end - 1] - begin)
        base, wide = np.full(n, -1), np.zeros(n, np.int64)
        base[run], wide[run] = upto[done:end] - cells[done:end] - begin + n_moments[run], m[group[done:end]]
        at = (base[:, None] + before * wide[:, None]).ravel()[key]
        if len(run) < n:
            rows = np.flatnonzero((base >= 0)[own])
            lived = np.bincount(at[rows] - moment[rows], weights=weight[rows], minlength=total)
        else:
            lived = np.bincount(at - moment, weights=weight, minlength=total)
        while done < end:
            g = group[done]
            to = min(end, int(begins[g + 1]) if g + 1 < len(begins) else len(some), done + max(1, CACHED_CELLS // int(c[g] * m[g])))
            nodes, a = some[done:to], int(upto[done] - cells[done] - begin)
            reach = lived[a:a + len(nodes) * c[g] * m[g]].reshape(len(nodes), c[g], m[g])
            behind = np.arange(m[g])
            step = (ahead + n_moments - 1)[nodes, None] - behind
            inside = behind < n_moments[nodes, None]
            h, v = (np.where(inside, x[np.where(inside, step, 0)], 0.0) for x in (hazard, spread))
            i = np.arange(c[g] - 1)
            own_cut = cut_starts[nodes, None] + np.minimum(i, n_cuts[nodes, None] - 1)
            found = np.where(i < n_cuts[nodes, None], best_cuts(reach, cut_died[own_cut], h, v), -1.0)
            i = found.argmax(1)
            score[nodes], cut[nodes] = found[np.arange(len(nodes)), i], cut_bins[own_cut[np.arange(len(nodes)), i]]
            done = to
    return score, cut, lower[np.arange(n), cut].astype(np.int64)


def _falls(node, k, d, risk, n_times: int):
    """Deaths and weights at risk at the event times of leaves, leaf by leaf, and what the leaves' hazards sum up to."""
    starts = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]]))
    own = np.empty(len(starts), _LEAVES)
    own["node"], own["rows"], own["risk"] = node[starts], np.diff([*starts, len(node)]), np.add.reduceat(d / risk * (n_times - k), starts)
    pairs = b"".join(v.astype(kind).tobytes() for v, kind in ((k, np.int32), (d, np.uint32), (risk, np.uint32)))
    return _batch("step", node=node[:1], nodes=[own.tobytes()], pairs=[pairs])


def _curves(node, k, d, risk):
    """Steps of leaves from the deaths and the weights at risk at their event times, leaf by leaf; as ``_leaf_steps``."""
    import pyarrow as pa

    starts = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]]))
    sizes = np.diff([*starts, len(node)])
    hazard = d / risk
    with np.errstate(divide="ignore"):
        fall, drop = np.log1p(-hazard), np.empty(len(d))
    like = np.ceil(np.log2(sizes)).astype(np.int64)
    for q in np.unique(like):  # leaves of like numbers of steps together: a row each
        some = np.flatnonzero(like == q)
        width = int(sizes[some].max())
        inside = np.arange(width) < sizes[some, None]
        at = np.where(inside, starts[some, None] + np.arange(width), 0)
        left = np.exp(np.where(inside, fall[at], 0.0).cumsum(1))
        drop[at[inside]] = (np.concatenate([np.ones((len(some), 1)), left[:, :-1]], 1) - left)[inside]
    return pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), pa.array(k, pa.int32()), pa.array(hazard), pa.array(drop)], ["node", "k", "hazard", "drop"])


def _batch(kind: str, part: int = 0, **columns):
    """Rows of ``GROWN``; nulls in the other columns."""
    import pyarrow as pa

    kinds = {**dict.fromkeys(("node", "feature", "cut", "left", "right"), pa.int64()), "nodes": pa.binary(), "pairs": pa.binary()}
    n = len(columns["node"])
    arrays = [pa.array(columns[c], t) if c in columns else pa.nulls(n, t) for c, t in kinds.items()]
    return pa.RecordBatch.from_arrays([*arrays, pa.array([kind] * n, pa.string()), pa.array(np.full(n, part, np.int32))], [*kinds, "kind", "part"])


def _by_node(batches, width: int):
    """(node, cell in node, n, d) of each node from batches sorted by cell."""
    held = [np.empty(0, np.int64)] * 3
    for batch in batches:
        held = [np.concatenate([h, batch.column(i).to_numpy()]) for i, h in enumerate(held)]
        node = held[0] // width
        edges = np.flatnonzero(node[1:] != node[:-1]) + 1
        for a, b in zip([0, *edges], edges, strict=False):
            yield int(node[a]), held[0][a:b] - node[a] * width, held[1][a:b], held[2][a:b]
        if len(edges):
            held = [h[edges[-1]:] for h in held]
    if len(held[0]):
        node = int(held[0][0] // width)
        yield node, held[0] - node * width, held[1], held[2]


def _leaf_steps(dealt, edges, times, trees: Trees, nodes, n_trees, share, seed) -> DataFrame:
    """(node, k, hazard, drop) of large leaves: Nelson-Aalen increments and falls of the survival curve at event time k."""
    n_times, live = len(times), _live(trees, nodes)

    def cells(batches):
        for batch in batches:
            bins = _binned(batch, edges)
            reached, event = _reached(batch, times)
            for r, node, weight in _in_bags(batch, trees, bins, n_trees, share, seed):
                r, node, weight = (v[live[node]] for v in (r, node, weight))
                yield _summed(node * (n_times + 1) + reached[r], weight, weight * event[r])

    summed = dealt.mapInArrow(cells, CELLS).groupBy("cell").agg(F.sum("n").alias("n"), F.sum("d").alias("d"))
    node, reached = F.floor(F.col("cell") / F.lit(n_times + 1)).cast("bigint"), F.pmod(F.col("cell"), F.lit(n_times + 1))
    own = summed.select(node.alias("node"), (reached - 1).cast("int").alias("k"), "n", "d")
    later = Window.partitionBy("node").orderBy(F.desc("k"))  # at most one row per event time
    upto = Window.partitionBy("node").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    risk = own.withColumn("risk", F.sum("n").over(later)).filter("d > 0")
    share_dead: Column = F.col("d") / F.col("risk")
    left = F.exp(F.sum(F.when(F.col("d") < F.col("risk"), F.log1p(-share_dead)).otherwise(F.lit(float("-inf")))).over(upto))
    curve = risk.select("node", "k", share_dead.alias("hazard"), left.alias("left"))
    before = F.coalesce(F.lag("left").over(Window.partitionBy("node").orderBy("k")), F.lit(1.0))
    return curve.select("node", "k", "hazard", (before - F.col("left")).alias("drop"))
