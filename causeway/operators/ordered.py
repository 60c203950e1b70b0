"""Order-dependent operators that keep a hot group spread over many tasks.

A plain window puts a whole group into one task. Here rows are range-partitioned on
(group keys, order keys): a group that holds a third of the table covers a third of
the partitions. Per-partition totals are tiny, their prefix sums give the offset of
each partition, and the windows run inside (group, partition) only.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from causeway.session import cut_lineage, require_columns


def place(df: DataFrame, by: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Range-partition on (by, order) and freeze the placement in ``_block``."""
    require_columns(df, by)
    placed = df.repartitionByRange(*[F.col(c).asc() for c in by], *order)
    return cut_lineage(placed.withColumn("_block", F.spark_partition_id()))


def running(placed: DataFrame, by: Sequence[str], order: Sequence[Column], sums: dict[str, Column]) -> DataFrame:
    """Add inclusive running sums per group to a placed frame, keeping ``_block``."""
    staged = placed.withColumns({f"_v_{name}": value for name, value in sums.items()})
    totals = staged.groupBy(*by, "_block").agg(*[F.sum(f"_v_{n}").alias(f"_t_{n}") for n in sums])
    earlier = Window.partitionBy(*by).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *[F.col(c).alias(f"_k_{c}") for c in by], F.col("_block").alias("_k_block"),
        *[F.coalesce(F.sum(f"_t_{n}").over(earlier), F.lit(0)).alias(f"_o_{n}") for n in sums],
    )
    match = F.col("_block") == F.col("_k_block")
    for c in by:
        match = match & F.col(c).eqNullSafe(F.col(f"_k_{c}"))
    inside = Window.partitionBy(*by, "_block").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return staged.join(offsets, match).select(
        *placed.columns, *[(F.col(f"_o_{n}") + F.sum(f"_v_{n}").over(inside)).alias(n) for n in sums],
    )


def ordered_scan(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[Column],
    sums: dict[str, Column] | None = None,
    position: str | None = "position",
) -> DataFrame:
    """Add the 1-based row position and running sums of each group.

    ``order`` must be a total order inside a group (end it with a unique key), so that
    the result does not depend on how rows were placed.
    """
    wanted = dict(sums or {})
    if position:
        wanted[position] = F.lit(1).cast("bigint")
    return running(place(df, by, order), by, order, wanted).drop("_block")


def row_number(df: DataFrame, by: Sequence[str], order: Sequence[Column], name: str = "row_number") -> DataFrame:
    return ordered_scan(df, by, order, position=name)


def running_sum(df: DataFrame, by: Sequence[str], order: Sequence[Column], value: Column, name: str) -> DataFrame:
    return ordered_scan(df, by, order, {name: value}, position=None)


# ---------------------------------------------------------------- affine scans


class Edge(NamedTuple):
    """What a block tells its neighbours: its first and last group, and the composed maps of the last."""

    block: int
    first: tuple
    last: tuple
    one: bool  # both are the same run of rows
    a: list
    b: list


def _starts(batch, by: Sequence[str], before):
    """Whether each row begins a group, given the row before the batch (a one-row batch, or None)."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    out = np.zeros(batch.num_rows, bool)
    out[0] = before is None
    for c in by:
        column = batch.column(c)
        if before is not None:
            column = pa.concat_arrays([before.column(c), column])
        left, right = column.slice(0, len(column) - 1), column.slice(1)
        differ = pc.or_(pc.xor(pc.is_null(left), pc.is_null(right)), pc.fill_null(pc.not_equal(left, right), False))
        out[-len(left):] |= np.asarray(differ.to_numpy(zero_copy_only=False), bool) if len(left) else False
    return out


def _compose(a, b, starts):
    """Inclusive products of the maps s -> a s + b along each run of rows, by doubling steps."""
    import numpy as np

    closed, step = starts.copy(), 1
    while step < len(a):
        free = ~closed[step:, None]
        b = np.concatenate([b[:step], np.where(free, b[step:] + a[step:] * b[:-step], b[step:])])
        a = np.concatenate([a[:step], np.where(free, a[step:] * a[:-step], a[step:])])
        closed = np.concatenate([closed[:step], closed[step:] | closed[:-step]])
        step *= 2
    return a, b


def _composed_batches(batches, by: Sequence[str], n: int):
    """(batch, starts, a, b): maps composed from the start of the block or the group, over batch borders."""
    import numpy as np

    before, last_a, last_b = None, None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        a, b = (np.column_stack([batch.column(f"_{kind}{i}").to_numpy(zero_copy_only=False) for i in range(n)]) for kind in "ab")
        starts = _starts(batch, by, before)
        a, b = _compose(a, b, starts)
        if before is not None and not starts[0]:
            upto = np.argmax(starts) if starts.any() else len(starts)
            b[:upto] += a[:upto] * last_b
            a[:upto] *= last_a
        before, last_a, last_b = batch.slice(batch.num_rows - 1), a[-1].copy(), b[-1].copy()
        yield batch, starts, a, b  # the caller may change a and b


def _entering(edges: list[Edge], n: int) -> dict[int, list]:
    """State that each block's first group brings from earlier blocks."""
    out, held, state = {}, None, [0.0] * n
    for e in sorted(edges):
        coming = state if held is not None and held == e.first else [0.0] * n
        out[e.block] = coming
        state = [x * s + y for x, s, y in zip(e.a, coming, e.b, strict=True)] if e.one else e.b
        held = e.last
    return out


def affine_scan(df: DataFrame, by: Sequence[str], order: Sequence[Column], maps: dict[str, tuple[Column, Column]]) -> DataFrame:
    """Add columns that follow ``s = decay * s_before + x`` along each group, from zero, without a cut.

    ``maps`` names (decay, x); both may differ by row, nulls count as zero. Maps compose, so a group is
    scanned in blocks on many tasks: the pass that places the rows composes the maps of each block, the
    driver chains one state per block (at most the number of partitions), and rows of a block's first group
    add what its state gives them. Rows move once. ``order`` must be a total order in a group.
    """
    require_columns(df, by)
    names, n, columns = list(maps), len(maps), df.columns
    staged = df.withColumns({f"_{kind}{i}": F.coalesce(column.cast("double"), F.lit(0.0))
                             for i, name in enumerate(names) for kind, column in zip("ab", maps[name], strict=True)})
    dealt = staged.repartitionByRange(*[F.col(c).asc() for c in by], *order).sortWithinPartitions(*[F.col(c).asc() for c in by], *order)
    dealt = dealt.withColumn("_block", F.spark_partition_id())
    numbers = [f"_{kind}{i}" for kind in "ab" for i in range(n)]

    def composed(batches):
        import numpy as np
        import pyarrow as pa

        held, begun, inside = None, False, True
        for batch, starts, a, b in _composed_batches(batches, by, n):
            if held is not None:
                yield held()
            own = (starts.cumsum() <= (0 if begun else 1)) & inside  # the block's first group
            inside = inside and bool(own[-1])
            edge = np.zeros(len(own), np.int32)
            edge[0] = 0 if begun else 1
            begun = True

            def held(last=False, batch=batch, own=own, edge=edge, a=a, b=b):
                edge[-1] += 2 * last
                values = [pa.array(m[:, i]) for m in (a, b) for i in range(n)]
                return pa.RecordBatch.from_arrays(
                    [*[batch.column(c) for c in (*columns, "_block")], pa.array(own), pa.array(edge), *values], [*columns, "_block", "_own", "_edge", *numbers])

        if held is not None:
            yield held(last=True)

    schema = dealt.select(*columns, "_block").schema.add("_own", "boolean").add("_edge", "integer")
    for name in numbers:
        schema = schema.add(name, "double")
    placed = cut_lineage(dealt.mapInArrow(composed, schema))
    ends: dict[int, dict] = {}
    for r in placed.filter("_edge > 0").select(*by, "_block", "_own", "_edge", *numbers).collect():  # two rows a block
        key, own = tuple(r[c] for c in by), ends.setdefault(r["_block"], {})
        if r["_edge"] & 1:
            own["first"] = key
        if r["_edge"] & 2:
            own |= {"last": key, "one": r["_own"], "a": [r[f"_a{i}"] for i in range(n)], "b": [r[f"_b{i}"] for i in range(n)]}
    entering = _entering([Edge(block, **e) for block, e in ends.items()], n)
    moved = {block: state for block, state in entering.items() if any(state)}
    if not moved:
        return placed.select(*columns, *[F.col(f"_b{i}").alias(name) for i, name in enumerate(names)])
    states = df.sparkSession.createDataFrame([(block, *state) for block, state in moved.items()], "_at int, " + ", ".join(f"_s{i} double" for i in range(n)))
    joined = placed.join(F.broadcast(states), (F.col("_block") == F.col("_at")) & F.col("_own"), "left")  # a row per block
    return joined.select(*columns, *[(F.col(f"_b{i}") + F.coalesce(F.col(f"_a{i}") * F.col(f"_s{i}"), F.lit(0.0))).alias(name)
                                     for i, name in enumerate(names)])


# ---------------------------------------------------------------- carried values


class Margin(NamedTuple):
    """What a block tells its neighbours: first and last group, and the known values nearest to its ends."""

    block: int
    first: tuple
    last: tuple
    one: bool
    first_known: tuple | None
    last_known: tuple | None


def _runs(batches, by: Sequence[str]):
    """(rows of one group in the block, whether it is the block's first run, whether the last), as Arrow tables."""
    import numpy as np
    import pyarrow as pa

    held, before, index = [], None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        starts = _starts(batch, by, before)
        before = batch.slice(batch.num_rows - 1)
        at = 0
        for cut in np.flatnonzero(starts):
            if cut > at:
                held.append(batch.slice(at, cut - at))
            if held:
                yield held, index == 0, False
                held, index = [], index + 1
            at = cut
        held.append(batch.slice(at))
    if held:
        yield held, index == 0, True


def nearest_known(df: DataFrame, by: Sequence[str], order: Sequence[Column], at: str, value: str) -> DataFrame:
    """Add ``_before`` and ``_after``: (at, value) of the nearest row with a known value up to each row and from it on.

    Rows are ordered by ``order`` in each group; ``at`` and ``value`` are doubles, ``value`` null where unknown.
    A group may lie in any number of blocks: each block tells its outermost known values, at most two rows a
    block reach the driver, and a second pass fills the blocks from their neighbours.
    """
    placed = place(df, by, order)
    rows = placed.sortWithinPartitions(*[F.col(c).asc() for c in by], *order)
    keys, columns = [*by, at, value, "_block"], df.columns
    pair = "struct<at:double,value:double>"

    def known(held):
        import numpy as np

        x, y = (np.concatenate([b.column(c).to_numpy(zero_copy_only=False).astype(float) for b in held]) for c in (at, value))
        spots = np.flatnonzero(~np.isnan(y))
        return x, y, spots

    def margins(batches):
        import pyarrow as pa

        first = last = None
        for held, is_first, _ in _runs(batches, by):
            x, y, spots = known(held)
            ends = [(float(x[i]), float(y[i])) for i in spots[[0, -1]]] if len(spots) else [None, None]
            last = (held[0].slice(0, 1), is_first, ends)
            first = first or last
        if first is not None:
            for row, told, one, end in ((first[0], False, last[1], first[2][0]), (last[0], True, last[1], last[2][1])):
                yield pa.RecordBatch.from_arrays(
                    [*[row.column(c) for c in (*by, "_block")], pa.array([told]), pa.array([one]), pa.array([end[0] if end else None], pa.float64()),
                     pa.array([end[1] if end else None], pa.float64())], [*by, "_block", "last", "one", "at", "value"])

    unknown = F.lit(None).cast("double")
    schema = placed.select(*by, "_block", F.lit(True).alias("last"), F.lit(True).alias("one"), unknown.alias("at"), unknown.alias("value")).schema
    ends = {(r["_block"], r["last"]): r for r in rows.select(*keys).mapInArrow(margins, schema).collect()}  # two rows a block
    group = range(len(by))

    def told(r):
        return None if r["at"] is None else (r["at"], r["value"])

    blocks = [Margin(block, tuple(r[i] for i in group), tuple(ends[block, True][i] for i in group), r["one"], told(r), told(ends[block, True]))
              for (block, last), r in sorted(ends.items(), key=lambda e: e[0]) if not last]
    coming, going = _chained(blocks)

    def fill(batches):
        import numpy as np
        import pyarrow as pa

        for held, is_first, is_last in _runs(batches, by):
            block = held[0].column("_block")[0].as_py()
            x, y, spots = known(held)
            x_known, y_known = x[spots], y[spots]
            outside = coming.get(block) if is_first else None, going.get(block) if is_last else None
            x_known = np.concatenate([[outside[0][0] if outside[0] else np.nan], x_known, [outside[1][0] if outside[1] else np.nan]])
            y_known = np.concatenate([[outside[0][1] if outside[0] else np.nan], y_known, [outside[1][1] if outside[1] else np.nan]])
            before = np.searchsorted(spots, np.arange(len(x)), "right")
            after = np.searchsorted(spots, np.arange(len(x)), "left") + 1
            done = 0
            for b in held:
                part = slice(done, done + b.num_rows)
                done += b.num_rows
                filled = []
                for spot in (before[part], after[part]):
                    missing = np.isnan(y_known[spot])
                    filled.append(pa.StructArray.from_arrays(
                        [pa.array(x_known[spot]), pa.array(y_known[spot])], ["at", "value"], mask=pa.array(missing)))
                yield pa.RecordBatch.from_arrays([*[b.column(c) for c in columns], *filled], [*columns, "_before", "_after"])

    out = df.withColumns({"_before": F.lit(None).cast(pair), "_after": F.lit(None).cast(pair)}).schema
    return rows.mapInArrow(fill, out)


def _chained(blocks: list[Margin]) -> tuple[dict, dict]:
    """Known value that comes into each block's first group from the left, and into its last from the right."""
    coming, going = {}, {}
    held, value = None, None
    for b in blocks:
        coming[b.block] = value if held is not None and held == b.first else None
        value = b.last_known or (coming[b.block] if b.one else None)
        held = b.last
    held, value = None, None
    for b in reversed(blocks):
        going[b.block] = value if held is not None and held == b.last else None
        value = b.first_known or (going[b.block] if b.one else None)
        held = b.first
    return coming, going
