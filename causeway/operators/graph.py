"""Task schedules and budgeted selection as table operators."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from causeway.operators.ordered import place, running
from causeway.session import cut_lineage, require_columns


def _chains(tasks: DataFrame, edges: DataFrame, n_tasks: int) -> DataFrame:
    """(task, head, offset): each task's chain and the time from its head's start to its own.

    ``edges`` carry ``only``: the sole way out of one task and into the other. Such links make paths; pointers to
    the path's head double their reach every round.
    """
    lengths = tasks.select(F.col("task").alias("_p"), F.col("duration").alias("_d"))
    links = edges.filter("only").select("task", "pred").join(lengths, F.col("pred") == F.col("_p"))
    inside = links.select(F.col("task").alias("_t"), F.lit(True).alias("_link"))
    now = cut_lineage(links.join(inside, F.col("pred") == F.col("_t"), "left").select(
        "task", F.col("pred").alias("head"), F.col("_d").alias("offset"), F.col("_link").isNull().alias("_end")))
    done = tasks.join(now.select("task"), "task", "left_anti").select("task", F.col("task").alias("head"), (F.col("duration") * 0).alias("offset"))
    rounds = 0
    while not now.filter("NOT _end").isEmpty():
        rounds += 1
        if (1 << rounds) > 4 * n_tasks:
            raise ValueError("the precedence graph has a cycle")
        above = now.select(F.col("task").alias("_t"), F.col("head").alias("_h"), F.col("offset").alias("_o"), F.col("_end").alias("_e"))
        jumped = now.filter("NOT _end").join(above, F.col("head") == F.col("_t")).select(
            "task", F.col("_h").alias("head"), (F.col("offset") + F.col("_o")).alias("offset"), F.col("_e").alias("_end"))
        now = cut_lineage(now.filter("_end").unionByName(jumped))
    return cut_lineage(done.unionByName(now.drop("_end")))


def earliest_starts(tasks: DataFrame, edges: DataFrame) -> DataFrame:
    """Earliest start and finish of each task of an acyclic precedence graph.

    ``tasks`` is (task, duration), ``edges`` (pred, task); repeated edges count once. Chains, tasks that are each
    other's only successor and predecessor, shrink to their heads first, in as many rounds as the logarithm of the
    longest. In the rest a task enters the frontier when its last predecessor is done, so each edge
    passes on one start, once; used edges are dropped from the table whenever half of it is. Rounds are
    the depth of what is left, and a round that reaches no new task before all are done means a cycle.
    """
    require_columns(tasks, ["task", "duration"])
    require_columns(edges, ["pred", "task"])
    tasks = cut_lineage(tasks.select("task", "duration"))
    edges = edges.select("pred", "task").distinct()
    into = edges.groupBy("task").agg(F.count(F.lit(1)).alias("_in"))
    out = edges.groupBy("pred").agg(F.count(F.lit(1)).alias("_out"))
    edges = cut_lineage(edges.join(into, "task").join(out, "pred").select(
        "pred", "task", "_in", ((F.col("_in") == 1) & (F.col("_out") == 1)).alias("only")))
    ends = edges.select(F.col("pred").alias("task")).unionByName(edges.select("task"))
    if not ends.join(tasks, "task", "left_anti").isEmpty():
        raise ValueError("an edge names an unknown task")
    chains = _chains(tasks, edges, tasks.count())
    # an edge that is no link ends at a head; it leaves its chain's head by the way to its own task's finish
    ways = chains.join(tasks, "task").select(F.col("task").alias("_p"), F.col("head").alias("from"), (F.col("offset") + F.col("duration")).alias("length"))
    left = cut_lineage(edges.filter("NOT only").join(ways, F.col("pred") == F.col("_p")).select("from", "task", "length", "_in"))
    total = rows = left.count()
    heads = chains.filter("task = head").select("task", F.col("offset").alias("start"))
    front = cut_lineage(heads.join(left.select("task").distinct(), "task", "left_anti"))
    found, waiting, used, spent = [front], None, 0, []
    while total:
        reached = left.join(front.select(F.col("task").alias("from"), "start"), "from").groupBy("task").agg(
            F.max(F.col("start") + F.col("length")).alias("start"), F.count(F.lit(1)).alias("_got"), F.max("_in").alias("_in"))
        if waiting is not None:
            reached = reached.unionByName(waiting).groupBy("task").agg(
                F.max("start").alias("start"), F.sum("_got").alias("_got"), F.max("_in").alias("_in"))
        reached = cut_lineage(reached)
        spent.append(front.select(F.col("task").alias("from")))
        waiting = reached.filter("_got < _in")
        front = reached.filter("_got = _in").select("task", "start")
        counts = reached.agg(F.count_if(F.col("_got") == F.col("_in")).alias("ready"), F.sum(F.when(F.col("_got") == F.col("_in"), F.col("_in"))).alias("edges"),
                             F.count_if(F.col("_got") < F.col("_in")).alias("held")).collect()[0]
        used += counts["edges"] or 0
        if not counts["ready"]:
            raise ValueError("the precedence graph has a cycle")
        found.append(front)
        if used == total:
            break
        if 2 * (total - used) < rows:
            left = cut_lineage(left.join(reduce(DataFrame.unionByName, spent), "from", "left_anti"))
            rows, spent = left.count(), []
    begun = reduce(DataFrame.unionByName, found).withColumnRenamed("task", "head")
    started = chains.join(begun, "head")
    return tasks.join(started.select("task", (F.col("start") + F.col("offset")).alias("start")), "task").select(
        "task", "duration", "start", (F.col("start") + F.col("duration")).alias("finish"))


def project_finish(schedule: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return schedule.groupBy(*by).agg(F.max("finish").alias("finish"))


def greedy_order(value: str, weight: str, key: str) -> list[Column]:
    ratio = F.when(F.col(weight) == 0, F.lit(float("inf"))).otherwise(F.col(value) / F.col(weight))
    return [ratio.desc(), F.asc(key)]


def budget_selection(items: DataFrame, value: str, weight: str, key: str, cap: float,
                     by: Sequence[str] = ()) -> DataFrame:
    """Items by value per weight while the running weight stays within ``cap``, per group.

    Adds ``running_weight``, ``running_value`` and ``selected``. Greedy is feasible and not always
    optimal; ``selection_bound`` gives the fractional upper bound to compare with.
    """
    require_columns(items, [value, weight, key, *by])
    order = greedy_order(value, weight, key)
    summed = running(place(items, by, order), by, order,
                     {"running_weight": F.col(weight), "running_value": F.col(value)}).drop("_block")
    return summed.withColumn("selected", F.col("running_weight") <= F.lit(cap))


def selection_bound(selection: DataFrame, value: str, weight: str, key: str, cap: float,
                    by: Sequence[str] = ()) -> DataFrame:
    """Per group: greedy value and weight, and the fractional upper bound of the optimum."""
    out = F.when(~F.col("selected"), F.struct(
        F.col("running_weight").alias("w"), F.col(key).alias("k"), F.col(value).alias("value"), F.col(weight).alias("weight")))
    taken = selection.groupBy(*by).agg(
        F.coalesce(F.sum(F.when(F.col("selected"), F.col(value))), F.lit(0.0)).alias("value"),
        F.coalesce(F.sum(F.when(F.col("selected"), F.col(weight))), F.lit(0.0)).alias("weight"),
        F.sum(F.col("selected").cast("bigint")).alias("n_selected"), F.min(out).alias("_next"))
    rest = F.coalesce((F.lit(cap) - F.col("weight")) / F.col("_next.weight") * F.col("_next.value"), F.lit(0.0))
    return taken.select(*by, "n_selected", "value", "weight", (F.col("value") + rest).alias("upper_bound"))
