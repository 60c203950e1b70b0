"""Merkle manifest of a dataset by time-forward processing.

Every node of a tree has a label: the last leaf below it, then its level. Children have smaller labels
than their parents, so a sweep in label order meets each node after all its children. A priority queue
ordered by label holds the digests on their way: a node takes its children's digests from the top of
the queue, hashes them, and sends its own digest to its parent's label. The reversed sweep goes back
through the same runs and sends each child its parent's proof suffix, with its own siblings in front.

On Spark the queue is external: the shuffle, sorted by tree and label, delivers all messages of a subtree
of ``ARITY ** LEVELS`` nodes in order, and a task holds those of one subtree. The subtrees' tops are the
nodes of the next pass, so passes grow with the logarithm of the table, trees of any size are spread
over tasks, and no tree, level or proof set meets in one place.
"""

from __future__ import annotations

from collections.abc import Sequence
from hashlib import sha256
from heapq import heappop, heappush

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from causeway.llm.common import stored
from causeway.operators.ordered import place, row_number

ARITY = 8
LEVELS = 3
SPAN = ARITY**LEVELS
PROOF = "array<struct<before string, after string>>"


# ---------------------------------------------------------------- digests


def field(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(*values: Column) -> Column:
    return F.sha2(F.concat(*map(field, values)).cast("binary"), 256)


def fold(leaf: Column, proof: Column) -> Column:
    """The root that follows from a leaf and its proof."""
    return F.aggregate(proof, leaf, lambda digest, step: F.sha2(F.concat(step["before"], digest, step["after"]).cast("binary"), 256))


def proof_digest(proof: Column) -> Column:
    siblings = F.array_join(F.transform(proof, lambda step: F.concat(step["before"], step["after"])), "")
    return F.sha2(siblings.cast("binary"), 256)


# ---------------------------------------------------------------- sweeps over one subtree


def nodes_at(n: int, level: int) -> int:
    """Nodes of a tree of ``n`` leaves at a level."""
    return -(-n // ARITY**level)


def forward(first: int, n: int, digests: Sequence[str], levels: int) -> tuple[list, int, str]:
    """Runs in the order of their labels, and the top's level and digest.

    ``digests`` are the nodes from position ``first`` on, of ``n`` in the whole tree. A run is its
    parent's level and its nodes as (position, digest).
    """
    queue, runs, top = [], [], None

    def send(position: int, level: int, digest: str) -> tuple[int, str] | None:
        if level == levels or nodes_at(n, level) == 1:
            return level, digest
        last = min((position // ARITY + 1) * ARITY ** (level + 1), n) - 1
        heappush(queue, (last, level + 1, position, digest))
        return None

    for time, digest in enumerate(digests, first):
        top = send(time, 0, digest)
        while queue and queue[0][0] == time:
            label, run = queue[0][:2], []
            while queue and queue[0][:2] == label:
                run.append(heappop(queue)[2:])
            runs.append((label[1], run))
            top = send(run[0][0] // ARITY, label[1], sha256("".join(d for _, d in run).encode()).hexdigest())
    return runs, *top


def backward(first: int, count: int, runs: list, level: int, suffix: list) -> list[list]:
    """Proofs of the ``count`` nodes from ``first`` on, given the top's; a step is the digests before and after."""
    sent = {(level, first // ARITY**level): suffix}
    for upper, run in reversed(runs):
        rest = sent.pop((upper, run[0][0] // ARITY))
        for i, (position, _) in enumerate(run):
            step = ("".join(d for _, d in run[:i]), "".join(d for _, d in run[i + 1:]))
            sent[upper - 1, position] = [step, *rest]
    return [sent[0, first + i] for i in range(count)]


# ---------------------------------------------------------------- passes


def _subtrees(batches):
    """Tables of one (_tree, _chunk) each from batches sorted by them."""
    import numpy as np
    import pyarrow as pa

    held = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if held is not None:
            table = pa.concat_tables([held, table])
        if not table.num_rows:
            continue
        tree, chunk = (table.column(c).to_numpy() for c in ("_tree", "_chunk"))
        at = 0
        for edge in np.flatnonzero((tree[1:] != tree[:-1]) | (chunk[1:] != chunk[:-1])) + 1:
            yield table.slice(at, edge - at)
            at = edge
        held = table.slice(at)
    if held is not None and held.num_rows:
        yield held


def rise(nodes: DataFrame) -> DataFrame:
    """Tops (_tree, _pos, _n, digest) of the subtrees of one pass, where _n counts the tree's tops."""
    chunk = F.floor(F.col("_pos") / SPAN).cast("bigint")
    dealt = nodes.select("_tree", chunk.alias("_chunk"), "_pos", "_n", "digest").repartition("_tree", "_chunk")

    def run(batches):
        import pyarrow as pa

        names = ["_tree", "_pos", "_n", "digest"]
        for table in _subtrees(batches):
            tree, chunk, n = (table.column(c)[0].as_py() for c in ("_tree", "_chunk", "_n"))
            _, _, digest = forward(chunk * SPAN, n, table.column("digest").to_pylist(), LEVELS)
            yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(
                (tree, chunk, nodes_at(n, LEVELS), digest), (pa.int64(), pa.int64(), pa.int64(), pa.string()), strict=True)], names)

    return dealt.sortWithinPartitions("_tree", "_chunk", "_pos").mapInArrow(
        run, "_tree bigint, _pos bigint, _n bigint, digest string")


def deliver(nodes: DataFrame, suffixes: DataFrame, keep: Sequence[str]) -> DataFrame:
    """(_tree, _pos, digest, *keep, proof, _top) of a pass's nodes from (_tree, _chunk, proof, _top) of their subtrees."""
    chunk = F.floor(F.col("_pos") / SPAN).cast("bigint")
    own = nodes.select("_tree", chunk.alias("_chunk"), "_pos", "_n", "digest", *keep)
    both = own.withColumn("proof", F.lit(None).cast(PROOF)).withColumn("_top", F.lit(None).cast("string")).unionByName(
        suffixes.select("_tree", "_chunk", F.lit(-1).cast("bigint").alias("_pos"), "proof", "_top"), allowMissingColumns=True)
    dealt = both.repartition("_tree", "_chunk").sortWithinPartitions("_tree", "_chunk", "_pos")
    names = ["_tree", "_pos", "digest", *keep, "proof", "_top"]

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for table in _subtrees(batches):
            suffix = [(s["before"], s["after"]) for s in table.column("proof")[0].as_py()]
            top = table.column("_top")[0].as_py()
            table = table.slice(1).combine_chunks()
            first, n = (table.column(c)[0].as_py() for c in ("_pos", "_n"))
            runs, level, _ = forward(first, n, table.column("digest").to_pylist(), LEVELS)
            proofs = backward(first, table.num_rows, runs, level, suffix)
            steps = [step for proof in proofs for step in proof]
            offsets = np.cumsum([0, *map(len, proofs)]).astype("i4")
            sides = pa.StructArray.from_arrays([pa.array([s[i] for s in steps], pa.string()) for i in (0, 1)], ["before", "after"])
            columns = [table.column(c).chunk(0) for c in ("_tree", "_pos", "digest", *keep)]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.ListArray.from_arrays(offsets, sides), pa.array([top] * table.num_rows, pa.string())], names)

    return dealt.mapInArrow(run, both.select(*names).schema)


def passes(nodes: DataFrame, largest: int) -> list[DataFrame]:
    """Node tables from the leaves up; a tree is in all until it has one node. ``largest`` leaves at most in a tree."""
    found = [nodes]
    while largest > 1:
        found.append(stored(rise(found[-1].filter("_n > 1")), f"merkle-{len(found)}"))
        largest = nodes_at(largest, LEVELS)
    return found


def tops(found: list[DataFrame]) -> DataFrame:
    """(_tree, digest, _pass) of every tree's top, with the pass in which it is alone."""
    out = None
    for i, nodes in enumerate(found):
        one = nodes.filter("_n = 1").select("_tree", "digest", F.lit(i).alias("_pass"))
        out = one if out is None else out.unionByName(one)
    return out


def descend(found: list[DataFrame], starts: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Leaves with their proofs. ``starts`` (_tree, _pass, proof, _top) are the proofs of the trees' tops."""
    starts, above = starts.select("_tree", "_pass", F.lit(0).cast("bigint").alias("_chunk"), "proof", "_top"), None
    for i in range(len(found) - 1, -1, -1):
        suffixes = starts.filter(F.col("_pass") == i).drop("_pass")
        if above is not None:
            suffixes = suffixes.unionByName(above)
        done = deliver(found[i], suffixes, keep if i == 0 else [])
        if i:
            above = stored(done.select("_tree", F.col("_pos").alias("_chunk"), "proof", "_top"), f"proofs-{i}")
    return done


def positions(rows: DataFrame, order: Sequence[Column]) -> DataFrame:
    """``rows`` with ``_tree`` (dense rank of ``_group``, nulls first), ``_pos`` in it from 0 and its row count ``_n``."""
    placed = place(rows, ["_group"], order)
    sizes = placed.groupBy("_group", "_block").agg(F.count(F.lit(1)).alias("_rows"))
    groups = row_number(sizes.groupBy("_group").agg(F.sum("_rows").alias("_n")), [], [F.col("_group").asc()], "_tree")
    groups = groups.select(F.col("_group").alias("_g"), "_n", (F.col("_tree") - 1).alias("_tree"))
    earlier = Window.partitionBy("_group").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(F.col("_group").alias("_k"), F.col("_block").alias("_b"),
                          F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_start"))
    starts = starts.join(groups, F.col("_k").eqNullSafe(F.col("_g"))).drop("_g")
    inside = Window.partitionBy("_group", "_block").orderBy(*order)
    return placed.join(starts, F.col("_group").eqNullSafe(F.col("_k")) & (F.col("_block") == F.col("_b"))).withColumn(
        "_pos", F.col("_start") + F.row_number().over(inside) - 1).drop("_k", "_b", "_start", "_block")


def manifest(rows: DataFrame, group: Column, order: Column, leaf: Column, keep: dict[str, Column]) -> DataFrame:
    """(*keep, leaf, subroot, root, proof) of every row: a tree per group, and one tree over the groups' roots.

    Groups ascend bytewise, null first. In a group leaves ascend by ``order``, null first; rows that share it
    by their digest. ``proof`` lists, level by level up to the root, the digests before and after the node in
    its run; ``fold`` gives the root from it. Repeated rows are leaves each; a group of one row is its own
    root; null values are part of the digest as the leaf expression has them; an empty table gives no rows.
    """
    spark = rows.sparkSession
    leaves = rows.select(group.alias("_group"), order.alias("_order"), leaf.alias("digest"),
                         *[value.alias(f"_keep_{name}") for name, value in keep.items()], F.monotonically_increasing_id().alias("_row"))
    kept = [f"_keep_{name}" for name in keep]
    placed = positions(stored(leaves, "leaves"), [F.col("_order").asc(), F.col("digest").asc(), F.col("_row").asc()])
    nodes = stored(placed.select("_tree", "_pos", "_n", "digest", *kept), "merkle-0")
    size = nodes.agg(F.max("_n").alias("n"), F.max("_tree").alias("trees")).collect()[0]
    forest = passes(nodes, size["n"] or 0)
    groups = (size["trees"] if size["trees"] is not None else -1) + 1
    subroots = stored(tops(forest).select(F.lit(0).cast("bigint").alias("_tree"), F.col("_tree").alias("_pos"),
                                          F.lit(groups).cast("bigint").alias("_n"), "digest", "_pass"), "subroots")
    upper = passes(subroots, groups)
    top = tops(upper)
    root = [r["digest"] for r in top.collect()]  # one row, or none of an empty table
    start = top.select("_tree", "_pass", F.array().cast(PROOF).alias("proof"), F.lit(None).cast("string").alias("_top"))
    proved = stored(descend(upper, start, ["_pass"]).select(
        F.col("_pos").alias("_tree"), "_pass", "proof", F.col("digest").alias("_top")), "subroot-proofs")
    found = descend(forest, proved, kept)
    return found.select(*[F.col(f"_keep_{name}").alias(name) for name in keep], F.col("digest").alias("leaf"),
                        F.col("_top").alias("subroot"), F.lit(root[0] if root else None).cast("string").alias("root"), "proof")


def document_leaf(text: Column) -> Column:
    return leaf_digest(F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), text)


def verify_lowered(documents: DataFrame) -> DataFrame:
    """Manifest of ``documents`` by lang, then a check of the rows as they are after a tampering.

    Tampering lower-cases A-Z in the text where 3 divides the crc32 of the decimal doc_id; rows without
    doc_id or text stay as they are. (doc_id, leaf, subroot, root, proof, folded_root, verified).
    """
    capitals = "".join(map(chr, range(65, 91)))
    lowered = F.translate("text", capitals, capitals.lower())
    chosen = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) == 0
    present = F.when(chosen, document_leaf(lowered)).otherwise(document_leaf(F.col("text")))
    found = manifest(documents, F.col("lang"), F.col("doc_id"), document_leaf(F.col("text")),
                     {"doc_id": F.col("doc_id"), "present": present})
    folded = found.withColumn("folded_root", fold(F.col("present"), F.col("proof")))
    return folded.select("doc_id", "leaf", "subroot", "root", "proof", "folded_root",
                         (F.col("folded_root") == F.col("root")).alias("verified"))
