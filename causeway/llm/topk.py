"""Exact top-k search by multi-resolution segment statistics.

A vector is cut into 1, 4 and 16 segments; each keeps its mean and standard deviation. For two
vectors the squared distance is at least  sum len * ((mean - mean')^2 + (dev - dev')^2), and finer
segments only raise that bound. Pairs whose bound shows that they can't reach the k-th best score
known so far are dropped level by level; exact scores are computed for the survivors.

Queries meet all rows in blocks of fixed size: a block of queries and a block of rows are one
group, so no task's memory grows with the table. Each group returns at most k rows a query.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from causeway.session import cut_lineage

LEVELS = (1, 4, 16)
ROW_BLOCK, QUERY_BLOCK, TILE = 2048, 4096, 64


def segment_stats(x, segments: int):
    """Means and deviations times the root of the segment's length, so bounds are plain products."""
    import numpy as np

    edges = np.linspace(0, x.shape[1], min(segments, max(x.shape[1], 1)) + 1).astype(int)
    means = np.empty((len(x), len(edges) - 1))
    devs = np.empty_like(means)
    for i, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
        part = x[:, a:b]
        if b > a:
            means[:, i] = part.mean(1) * np.sqrt(b - a)
            devs[:, i] = part.std(1) * np.sqrt(b - a)
        else:
            means[:, i] = devs[:, i] = 0
    return np.hstack([means, devs])


def score_bound(a, b, norms_a, norms_b, metric: str):
    """Upper bound of the score from two sets of statistics, by the lower bound of the squared distance."""
    lower = norms_a[:, None] + norms_b[None, :] - 2 * (a @ b.T)
    bound = -lower if metric == "l2" else (norms_a[:, None] + norms_b[None, :] - lower) / 2
    return bound + 1e-9 * (norms_a[:, None] + norms_b[None, :]) + 1e-6  # rounding


def exact_score(a, b, norms_a, norms_b, metric: str):
    inner = a @ b.T
    return 2 * inner - norms_a[:, None] - norms_b[None, :] if metric == "l2" else inner


def block_search(q, q_row, x, x_row, x_id, k: int, metric: str):
    """Best ``k`` of the rows ``x`` per query: (query index, row index, score), ties to the smaller id."""
    import numpy as np

    nq, nx = (q * q).sum(1), (x * x).sum(1)
    stats = [(segment_stats(q, s), segment_stats(x, s)) for s in LEVELS]
    order = np.argsort(stats[0][0][:, 0], kind="stable")  # like queries share a tile
    found: list[tuple] = []
    for at in range(0, len(q), TILE):
        tile = order[at:at + TILE]
        alive = np.ones((len(tile), len(x)), bool)
        alive &= q_row[tile][:, None] != x_row[None, :]
        floor = np.full(len(tile), -np.inf)
        columns = np.arange(len(x))
        for level, (sq, sx) in enumerate(stats):
            bound = score_bound(sq[tile], sx[columns], nq[tile], nx[columns], metric)
            bound[~alive[:, columns]] = -np.inf
            if level == 0 and len(columns) > k:  # the k most promising rows give a first k-th best score
                seeds = np.argpartition(-bound, k - 1, axis=1)[:, :k]
                own = np.einsum("qd,qkd->qk", q[tile], x[columns[seeds]])
                if metric == "l2":
                    own = 2 * own - nq[tile][:, None] - nx[columns[seeds]]
                own[~np.take_along_axis(alive, columns[seeds], 1)] = -np.inf
                floor = own.min(1)
            keep = bound >= floor[:, None]
            alive[:, columns] &= keep
            columns = columns[keep.any(0)]
        if not len(columns):
            continue
        score = exact_score(q[tile], x[columns], nq[tile], nx[columns], metric)
        score[~alive[:, columns]] = -np.inf
        ids = x_id[columns]
        for i in range(len(tile)):
            can = np.flatnonzero(score[i] > -np.inf)
            if len(can) > k:  # keep all that tie with the k-th
                kth = np.partition(score[i][can], len(can) - k)[len(can) - k]
                can = can[score[i][can] >= kth]
            best = can[np.lexsort((columns[can], ids[can], -score[i][can]))][:k]
            found.append((np.full(len(best), tile[i]), columns[best], score[i][best]))
    if not found:
        return tuple(np.empty(0, np.int64) for _ in range(3))
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


def _integers(matrix):
    """Whole doubles as unbounded integers."""
    import numpy as np

    out = np.empty(matrix.shape, object)
    out[:] = [[int(v) for v in row] for row in matrix.tolist()]
    return out


def whole_search(q, q_row, x, x_row, x_id, k: int):
    """``block_search`` for inner products of whole numbers, with exact integer scores (as Python integers).

    Sums that stay below 2^53 are exact in doubles. Beyond, double scores with their error bounds only say which
    rows may be among the best, and those are computed again in integers.
    """
    import numpy as np

    with np.errstate(over="ignore", invalid="ignore"):
        nq, nx = np.sqrt((q * q).sum(1)), np.sqrt((x * x).sum(1))
        reach = nq.max(initial=0) * nx.max(initial=0)
    if reach < 2.0**52:
        at, row, score = block_search(q, q_row, x, x_row, x_id, k, "ip")
        return at, row, [int(v) for v in score.tolist()]
    whole_x, whole_q = _integers(x), _integers(q)
    found: tuple[list, list, list] = ([], [], [])
    for i in range(len(q)):
        with np.errstate(over="ignore", invalid="ignore"):
            score = x @ q[i]
            slack = 4.0 * (x.shape[1] + 2) * 2.0**-53 * nq[i] * nx
            low, high = score - slack, score + slack
        can = np.flatnonzero(x_row != q_row[i])
        if np.isfinite(low).all() and np.isfinite(high).all() and len(can) > k:
            kth = np.partition(low[can], len(can) - k)[len(can) - k]
            can = can[high[can] >= kth]
        exact = (whole_x[can] * whole_q[i]).sum(1) if len(can) else []
        best = sorted(zip((-int(v) for v in exact), x_id[can].tolist(), can.tolist(), strict=True))[:k]
        found[0].extend([i] * len(best))
        found[1].extend(c for _, _, c in best)
        found[2].extend(-v for v, _, _ in best)
    return np.asarray(found[0], np.int64), np.asarray(found[1], np.int64), found[2]


def usable(vectors: DataFrame, vector: str) -> DataFrame:
    """Rows whose vector, and every component of it, is neither null nor NaN nor infinite."""
    ok = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != F.lit(float("inf"))))
    return vectors.filter(F.col(vector).isNotNull() & ok)


def search(vectors: DataFrame, is_query, k: int, vec_id: str = "vec_id", vector: str = "embedding",
           metric: str = "ip", whole: bool = False) -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest scores of each query row among all other rows.

    ``is_query`` is a condition on ``vec_id``; ``metric`` is ``ip`` (inner product) or ``l2`` (minus the
    squared distance). Vectors that are null or hold null or non-finite components take no part;
    shorter ones count as filled up with zeros. A row is excluded only from its own query, so
    repeated rows find each other and repeated ids are separate queries. Fewer than k other rows
    give fewer results; an empty table gives none. Other columns are not read.

    Scores are doubles. ``whole`` says that all components are whole numbers: inner products are integers then, exact
    and ranked exactly whatever their size, and ``score`` is a bigint (the nearest one beyond 64 bits).
    """
    if whole and metric != "ip":
        raise ValueError("whole scores are inner products")
    rows = usable(vectors.select(F.col(vec_id).cast("bigint").alias("_id"), F.col(vector).cast("array<double>").alias("_v")), "_v")
    rows = cut_lineage(rows.withColumns({"_row": F.monotonically_increasing_id(), "_q": F.coalesce(is_query(F.col("_id")), F.lit(False))}))
    facts = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if("_q").alias("q"), F.max(F.size("_v")).alias("width"),
                     F.max(F.array_max(F.transform("_v", F.abs))).alias("largest")).first()
    row_blocks, query_blocks = max(1, -(-facts["n"] // ROW_BLOCK)), max(1, -(-facts["q"] // QUERY_BLOCK))
    width = max(1, facts["width"] or 1)
    bound = width * int(facts["largest"] or 0) ** 2 + 1 if whole else 0
    size = (bound.bit_length() + 8) // 8 if whole else 0  # bytes of a score above -bound
    spread = F.pmod(F.xxhash64("_row"), F.lit(1 << 40))
    queries = rows.filter("_q").select("_id", "_row", "_v", F.pmod(spread, F.lit(query_blocks)).alias("_qb"),
                                       F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(row_blocks - 1).cast("bigint"))).alias("_xb"))
    others = rows.select("_id", "_row", "_v", F.pmod(spread, F.lit(row_blocks)).alias("_xb"),
                         F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(query_blocks - 1).cast("bigint"))).alias("_qb"))

    def meet(left, right):
        import numpy as np
        import pyarrow as pa

        def dense(table):
            table = table.combine_chunks()
            lists = table["_v"].combine_chunks()
            size = np.diff(lists.offsets.to_numpy())
            flat = np.asarray(lists.flatten())
            out = np.zeros((len(size), width))
            row = np.repeat(np.arange(len(size)), size)
            out[row, np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
            ids = table["_id"].combine_chunks()
            known = np.asarray(ids.is_valid())
            return out, table["_row"].to_numpy(), np.where(known, ids.fill_null(0).to_numpy(zero_copy_only=False), np.iinfo(np.int64).max), ids

        q, q_row, _, q_ids = dense(left)
        x, x_row, x_id, x_ids = dense(right)
        search_block = (lambda *a: whole_search(*a, k)) if whole else (lambda *a: block_search(*a, k, metric))
        at, best, score = search_block(q, q_row, x, x_row, x_id) if len(q) and len(x) else ([], [], [])
        take = pa.array(np.asarray(best, np.int64))
        of = pa.array(np.asarray(at, np.int64))
        return pa.table({"_query_row": left["_row"].combine_chunks().take(of), "query_id": q_ids.take(of), "vec_id": x_ids.take(take),
                         "_row": right["_row"].combine_chunks().take(take),
                         "score": pa.array([(v + bound).to_bytes(size, "big") for v in score], pa.binary()) if whole else pa.array(np.asarray(score, np.float64))})

    schema = f"_query_row bigint, query_id bigint, vec_id bigint, _row bigint, score {'binary' if whole else 'double'}"
    found = queries.groupBy("_qb", "_xb").cogroup(others.groupBy("_qb", "_xb")).applyInArrow(meet, schema)
    best = Window.partitionBy("_query_row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "_row")
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    ranked = ranked.select("query_id", "rank", "vec_id", "score")
    if not whole:
        return ranked

    def numbers(batches):
        import pyarrow as pa

        for batch in batches:
            score = [max(-(1 << 63), min((1 << 63) - 1, int.from_bytes(v, "big") - bound)) for v in batch.column("score").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(score, pa.int64())], batch.schema.names)

    return ranked.mapInArrow(numbers, "query_id bigint, rank int, vec_id bigint, score bigint")


def whole_steps(column: str, steps: int):
    """Components as whole numbers of 1/steps, rounded down."""
    def step(v):
        value = v.cast("double")
        return F.when(F.abs(value) < 2.0**53, F.floor(value * steps).cast("double")).otherwise(value * steps)  # larger ones are whole

    return F.transform(column, step)
