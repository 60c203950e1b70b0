"""SimHash near-duplicates: fingerprints within a few differing bits, found by a binary trie self-join.

Distinct fingerprints form a binary trie. The self-join starts with the pair (root, root) and walks
node pairs together: both nodes of a pair are split by the next bits, the differing bits so far
are added up, and a pair is dropped once they exceed the budget. A pair that holds few fingerprints
is finished inside one task, by the same walk down to single bits. The frontier of node pairs is a
DataFrame, so nothing but its row count reaches the driver.

Copies share a fingerprint and never meet as pairs: links are sought between distinct
fingerprints, and each task reports a spanning forest of the links it found.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from causeway.llm.common import stored
from causeway.llm.components import min_labels
from causeway.session import cut_lineage

BITS = 64
STEP = 4  # bits per level of the distributed walk
LEAF = 32768  # a node pair with at most so many fingerprints is finished in one task
WIDE = 1 << 20  # bytes of one slab of majority counting


def fingerprints(documents: DataFrame, shingle: int = 3, seed: int = 42, key: str | None = None) -> DataFrame:
    """(doc_id, fingerprint bigint) per row: bit majority over the XXH64 of all word shingles.

    A bigint column ``key`` is carried along after these.

    A-Z are lower-cased, words are runs without ASCII white space, repeated shingles count each time.
    Fewer words than a shingle give one shingle of all words; null texts and texts without words
    have fingerprint zero. A bit is one if it is set in more than half of the hashes.
    """
    carried = [key] if key else []

    def run(batches):
        import numpy as np
        import pyarrow as pa
        import xxhash

        digest = xxhash.xxh64_intdigest
        for batch in batches:
            found, texts = np.zeros(batch.num_rows, np.uint64), batch["text"]
            for row in range(batch.num_rows):
                text = texts[row].as_py()  # one text as a string at a time
                words = text.encode().lower().split() if text else ()
                if not words:
                    continue
                n = max(1, len(words) - shingle + 1)
                joined = b" ".join(words)
                sizes = np.fromiter(map(len, words), np.int64, len(words))
                ends = np.cumsum(sizes + 1) - 1
                starts = ends - sizes
                lasts = ends[min(shingle, len(words)) - 1:]
                ones = np.zeros(BITS, np.int64)
                hashes = np.fromiter((digest(joined[a:b], seed) for a, b in zip(starts[:n].tolist(), lasts.tolist(), strict=True)),
                                     np.uint64, n)
                for at in range(0, n, WIDE // BITS):
                    slab = np.unpackbits(hashes[at:at + WIDE // BITS].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                    ones += slab.sum(0, dtype=np.int64)
                bits = np.packbits((2 * ones > n).astype(np.uint8), bitorder="little")
                found[row] = bits.view(np.uint64)[0]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(found.view(np.int64)), *[batch[c] for c in carried]],
                                             ["doc_id", "fingerprint", *carried])

    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"), *carried)
    return rows.mapInArrow(run, "doc_id bigint, fingerprint bigint" + "".join(f", {c} bigint" for c in carried))


def prefix(fingerprint: Column, bits: int) -> Column:
    """The first ``bits`` bits as a number."""
    return F.shiftrightunsigned(fingerprint, BITS - bits) if bits else F.lit(0).cast("bigint")


def node_pairs(distinct: DataFrame, distance: int, leaf: int = LEAF) -> DataFrame:
    """Leaf pairs (depth, a, b) of the walk: prefixes of ``depth`` bits.

    Every two fingerprints within ``distance`` bits lie in exactly one leaf pair.
    """
    spark = distinct.sparkSession
    halves = range(1 << STEP)
    ways = spark.createDataFrame(
        [(x, y, bin(x ^ y).count("1")) for x in halves for y in halves if bin(x ^ y).count("1") <= distance],
        "x bigint, y bigint, d int")
    frontier = spark.createDataFrame([(0, 0, 0)], "a bigint, b bigint, diff int")
    leaves, depth = None, 0
    while True:
        nodes = distinct.groupBy(prefix(F.col("fingerprint"), depth).alias("node")).agg(F.count(F.lit(1)).alias("n"))
        sized = frontier.join(nodes.select(F.col("node").alias("a"), F.col("n").alias("na")), "a").join(
            nodes.select(F.col("node").alias("b"), F.col("n").alias("nb")), "b")
        sized = cut_lineage(sized)
        done = (F.col("na") + F.col("nb") <= leaf) if depth < BITS else F.lit(True)
        out = sized.filter(done).select(F.lit(depth).alias("depth"), "a", "b")
        leaves = out if leaves is None else leaves.unionByName(out)
        more = sized.filter(~done)
        if depth >= BITS or more.isEmpty():
            break
        grown = more.join(F.broadcast(ways), F.col("diff") + F.col("d") <= distance).select(
            "a", "b", "x", "y", (F.col("diff") + F.col("d")).alias("diff"))
        frontier = grown.filter("a != b OR x <= y").select(
            F.shiftleft("a", STEP).bitwiseOR(F.col("x")).alias("a"), F.shiftleft("b", STEP).bitwiseOR(F.col("y")).alias("b"), "diff")
        depth += STEP
    return leaves


def trie_links(fingerprints, side, distance: int):
    """Spanning links among sorted distinct uint64 ``fingerprints``: walk node pairs of their trie.

    ``side`` is None to join the fingerprints with themselves, else 0 or 1 per fingerprint; then only
    links between the sides count. Returns index pairs that connect what the links connect.
    """
    import numpy as np

    parent, kept = list(range(len(fingerprints))), []

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        return i

    def finish(a, b, same: bool) -> None:
        """Unite what links; only links that connect something new are kept."""
        for at in range(0, len(a), 256):
            own = a[at:at + 256]
            near = np.bitwise_count(fingerprints[own][:, None] ^ fingerprints[b][None, :]) <= distance
            i, j = np.nonzero(near)
            i, j = own[i], b[j]
            if same:
                i, j = i[i < j], j[i < j]
            for x, y in zip(i.tolist(), j.tolist(), strict=True):
                u, v = root(x), root(y)
                if u != v:
                    parent[u] = v
                    kept.append((x, y))

    def halves(nodes, bit: int):
        one = (fingerprints[nodes] >> np.uint64(bit)) & np.uint64(1) == 1
        return nodes[~one], nodes[one]

    def walk(a, b, bit: int, differing: int, same: bool) -> None:
        if not len(a) or not len(b) or differing > distance:
            return
        if len(a) * len(b) <= 4096 or bit < 0:
            finish(a, b, same)
            return
        a0, a1 = halves(a, bit)
        b0, b1 = (a0, a1) if same else halves(b, bit)
        walk(a0, b0, bit - 1, differing, same)
        walk(a1, b1, bit - 1, differing, same)
        walk(a0, b1, bit - 1, differing + 1, False)
        if not same:
            walk(a1, b0, bit - 1, differing + 1, False)

    everything = np.arange(len(fingerprints))
    if side is None:
        walk(everything, everything, BITS - 1, 0, True)
    else:
        walk(everything[side == 0], everything[side == 1], BITS - 1, 0, False)
    return kept


def near_links(distinct: DataFrame, distance: int, leaf: int = LEAF) -> DataFrame:
    """(a, b) fingerprints within ``distance`` bits, enough of them to connect all that links connect."""
    pairs = cut_lineage(node_pairs(distinct, distance, leaf))
    sides = pairs.select("*", F.col("a").alias("node"), F.lit(0).alias("side")).unionByName(
        pairs.filter("a != b").select("*", F.col("b").alias("node"), F.lit(1).alias("side")))
    depths = [r["depth"] for r in pairs.select("depth").distinct().collect()]  # at most BITS / STEP + 1 numbers
    spots = distinct.select("fingerprint", F.explode(F.array(*[
        F.struct(F.lit(d).alias("depth"), prefix(F.col("fingerprint"), d).alias("node")) for d in depths])).alias("p")).select(
        "fingerprint", "p.*") if depths else distinct.select("fingerprint", F.lit(0).alias("depth"), F.lit(0).cast("bigint").alias("node")).limit(0)
    placed = spots.join(sides, ["depth", "node"]).select("depth", "a", "b", "side", "fingerprint")

    def meet(table):
        import numpy as np
        import pyarrow as pa

        table = table.combine_chunks()
        own = table["fingerprint"].to_numpy().view(np.uint64)
        side = table["side"].to_numpy()
        order = np.argsort(own, kind="stable")
        own, side = own[order], side[order]
        kept = np.asarray(trie_links(own, side if side.any() else None, distance), np.int64).reshape(-1, 2)
        return pa.table({"a": own[kept[:, 0]].view(np.int64), "b": own[kept[:, 1]].view(np.int64)})

    return placed.groupBy("depth", "a", "b").applyInArrow(meet, "a bigint, b bigint")


def labelled(distinct: DataFrame, distance: int) -> DataFrame:
    """Rows of distinct fingerprints with a ``label`` that those of one component share."""
    links = cut_lineage(near_links(distinct.select("fingerprint"), distance))
    labels = min_labels(links, "a", "b")  # (node, label) of linked fingerprints
    return distinct.join(labels, F.col("fingerprint") == F.col("node"), "left").select(
        *distinct.columns, F.coalesce("label", "fingerprint").alias("label"))


def near_duplicates(documents: DataFrame, distance: int = 2, shingle: int = 3, seed: int = 42) -> DataFrame:
    """(doc_id, fingerprint, component_id) per row of ``documents``.

    ``fingerprint`` is 16 hexadecimal digits, ``component_id`` the smallest doc_id that links of at most
    ``distance`` differing bits reach, its own included. Rows that share a doc_id are separate
    rows; null doc_ids count as larger than all others, and a component of nothing else has a null
    id. Texts without words have fingerprint zero and link like any other. An empty table gives
    no rows; other columns are not read.
    """
    rows = cut_lineage(fingerprints(documents, shingle, seed))
    distinct = cut_lineage(rows.groupBy("fingerprint").agg(F.min("doc_id").alias("least")))
    own = labelled(distinct, distance)
    # label sizes may be large, so the least doc_id is aggregated and joined back rather than windowed
    least = own.groupBy("label").agg(F.min("least").alias("component_id"))
    components = own.join(least, "label").select("fingerprint", "component_id")
    return rows.join(components, "fingerprint").select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(documents: DataFrame, distance: int = 2, shingle: int = 3, seed: int = 42) -> DataFrame:
    """Documents without the near-duplicates of a document with a smaller doc_id.

    One row of each component stays: that with the smallest doc_id, of rows that share it one. Null
    doc_ids come last. Rows are told apart by numbers written with them, so components may share ids.
    """
    key = "_dedup_row"
    rows = stored(documents.withColumn(key, F.monotonically_increasing_id()), "numbered")
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", key)
    distinct = cut_lineage(fingerprints(rows, shingle, seed, key).groupBy("fingerprint").agg(F.min(order).alias("least")))
    first = labelled(distinct, distance).groupBy("label").agg(F.min("least").alias("least")).select(F.col(f"least.{key}").alias(key))
    return rows.join(first, key, "left_semi").drop(key)
