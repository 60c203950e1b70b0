"""Best-fit packing of token sequences into fixed-length training sequences.

Items above a third of the capacity pair at most twice per bin by greedy matching, largest first,
each with the tightest bin that takes it; smaller items then fill the tightest remaining gaps.
Lengths are whole numbers up to the capacity, so the plan needs only how many items have each
length: at most ``capacity`` numbers reach the driver however many documents there are, and equal
lengths are placed together. Every item finds its bin from its length and its rank among the items
of that length.
"""

from __future__ import annotations

import bisect
import zlib
from typing import NamedTuple

from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from causeway.llm.common import stored
from causeway.llm.tokens import Coder, byte_bpe
from causeway.session import cut_lineage


class Slot(NamedTuple):
    """Items of ``length`` with ranks from ``rank`` on: ``copies`` in each of ``bins`` bins from ``bin`` on."""

    length: int
    rank: int
    items: int
    copies: int
    bin: int
    offset: int


def plan(counts: dict[int, int], capacity: int) -> list[Slot]:
    """Place ``counts[length]`` items of each length; bins are numbered from 0."""
    open_bins: dict[int, list[tuple[int, int]]] = {}  # gap -> ranges (first bin, bins)
    gaps: list[int] = []  # sorted keys of open_bins
    slots, bins = [], 0

    def leave(gap: int, first: int, n: int) -> None:
        if gap > 0 and n > 0:
            if gap not in open_bins:
                open_bins[gap] = []
                bisect.insort(gaps, gap)
            open_bins[gap].append((first, n))

    def fill(length: int, rank: int, items: int, gap: int, first: int) -> int:
        """Put ``items`` into bins from ``first`` on that have ``gap``; returns the bins used."""
        copies = gap // length
        full, rest = divmod(items, copies)
        for n, each, start in ((full, copies, first), (1, rest, first + full)):
            if n and each:
                slots.append(Slot(length, rank, n * each, each, start, capacity - gap))
                rank += n * each
                leave(gap - each * length, start, n)
        return full + bool(rest)

    for length in sorted(counts, reverse=True):  # above a third first: at most two fit, so this is the matching
        left, rank = counts[length], 0
        if not 0 < length <= capacity:
            raise ValueError(f"length {length} doesn't fit {capacity}")
        while left:
            at = bisect.bisect_left(gaps, length)
            if at == len(gaps):  # no bin takes it
                bins += fill(length, rank, left, capacity, bins)
                break
            gap = gaps[at]
            first, n = open_bins[gap].pop()
            if not open_bins[gap]:
                del open_bins[gap], gaps[at]
            take = min(left, n * (gap // length))
            used = fill(length, rank, take, gap, first)
            leave(gap, first + used, n - used)
            left, rank = left - take, rank + take
    return slots


PIECES = "doc_id bigint, piece int, start bigint, length bigint, _ids binary, _part int, _local bigint"
BROADCAST_ROWS = 100_000  # (task, length) pairs up to which their starts are broadcast: a few MB


def token_pieces(documents: DataFrame, capacity: int, end_id: int) -> DataFrame:
    """Tokenize every text (null: empty), add ``end_id``, cut documents longer than ``capacity``.

    Cuts are made from the end, so only the first piece may be shorter. One row per piece with its ids as
    little-endian 16-bit numbers where the vocabulary allows it, else 32-bit, and the number ``_local`` of earlier
    pieces of its length in its task ``_part``.
    """
    files = byte_bpe()
    kind = id_kind(end_id)

    def run(batches):
        import numpy as np
        import pyarrow as pa

        coder, seen, part = Coder(*files, added=True), {}, TaskContext.get().partitionId()
        names = ["doc_id", "piece", "start", "length", "_ids", "_part", "_local"]
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int64()]
        for batch in batches:
            texts, docs, at = batch["text"], batch["doc_id"].to_pylist(), 0
            while at < len(docs):
                rows, held = tuple([] for _ in names), 0
                while at < len(docs) and held < BATCH_IDS:
                    ids = np.frombuffer(coder.encode(texts[at].as_py() or ""), "<u4")
                    ids = np.append(ids, np.uint32(end_id)).astype(kind)
                    total, piece, start = len(ids), 0, 0
                    while start < total:
                        length = (total - start) % capacity or capacity
                        local = seen.get(length, 0)
                        seen[length] = local + 1
                        for column, value in zip(rows, (docs[at], piece, start, length, ids[start:start + length].tobytes(), part, local), strict=True):
                            column.append(value)
                        piece, start = piece + 1, start + length
                    held, at = held + total, at + 1
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds, strict=True)], names)

    return documents.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string").alias("text")).mapInArrow(run, PIECES)


BATCH_IDS = 1 << 20  # ids of a batch that leaves a tokenizing task


def id_kind(end_id: int) -> str:
    """Unsigned numbers that hold all ids of the vocabulary and the end id."""
    return "<u2" if max(VOCABULARY - 1, end_id) < 1 << 16 else "<u4"


VOCABULARY = 50_257  # ids of the byte-level vocabulary, its added token included


def place(pieces: DataFrame, capacity: int, kind: str | None = None) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to rows with ``length``, ``_part`` and ``_local``; with ``kind`` also what
    ``with_ids`` adds, in the same pass."""
    pieces = stored(pieces, "pieces")
    sizes = cut_lineage(pieces.groupBy("_part", "length").agg(F.count(F.lit(1)).alias("_n")))
    counts = {r["length"]: r["n"] for r in sizes.groupBy("length").agg(F.sum("_n").alias("n")).collect()}
    slots = sorted(plan(counts, capacity), key=lambda s: (s.length, s.rank))
    before = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", "length", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    few = sizes.count() <= BROADCAST_ROWS
    ranked = pieces.join(F.broadcast(starts) if few else starts, ["_part", "length"]).withColumn("_rank", F.col("_before") + F.col("_local"))

    def run(batches):
        import numpy as np
        import pyarrow as pa

        table = np.asarray(slots, np.int64).reshape(-1, 6)
        keys = (table[:, 0] << 44) + table[:, 1]
        for batch in batches:
            length, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "_rank"))
            slot = table[np.searchsorted(keys, (length << 44) + rank, "right") - 1]
            nth = rank - slot[:, 1]
            sequence = slot[:, 4] + nth // slot[:, 3]
            offset = slot[:, 5] + nth % slot[:, 3] * length
            kept = [c for c in batch.schema.names if c not in ("_part", "_local", "_before", "_rank")]
            placed = pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in kept], pa.array(sequence), pa.array(offset)], [*kept, "sequence_id", "offset"])
            yield from [placed] if kind is None else _id_arrays(placed, kind)

    out = ranked.drop("_part", "_local", "_before", "_rank", *(["_ids"] if kind else [])).schema.add("sequence_id", "long").add("offset", "long")
    return ranked.mapInArrow(run, out.add("ids_crc32", "long").add("ids", ArrayType(IntegerType())) if kind else out)


def _id_arrays(batch, kind: str):
    """Parts of a batch with ``_ids`` as an array ``ids``, and the checksum of the ids as unsigned 32-bit numbers."""
    import numpy as np
    import pyarrow as pa

    step = max(1, BATCH_IDS // max(1, int(np.max(batch.column("length").to_numpy(), initial=1))))
    for at in range(0, batch.num_rows, step):
        part = batch.slice(at, step)
        column = part.column("_ids")
        offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + part.num_rows + 1]
        flat = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0]:offsets[-1]].view(kind).astype("<u4")
        ends = (offsets - offsets[0]) // np.dtype(kind).itemsize
        checks = [zlib.crc32(flat[a:b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
        kept = [c for c in part.schema.names if c != "_ids"]
        yield pa.RecordBatch.from_arrays(
            [*[part.column(c) for c in kept], pa.array(checks, pa.int64()),
             pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat.view(np.int32)))], [*kept, "ids_crc32", "ids"])


def with_ids(placed: DataFrame, kind: str) -> DataFrame:
    """``_ids`` of a placed table as an array ``ids``, and their checksum."""
    def run(batches):
        for batch in batches:
            yield from _id_arrays(batch, kind)

    out = placed.drop("_ids").schema.add("ids_crc32", "long").add("ids", ArrayType(IntegerType()))
    return placed.mapInArrow(run, out)


def pack(documents: DataFrame, capacity: int = 1024, end_id: int = 2, in_order: bool = False) -> DataFrame:
    """One row per piece: (doc_id, piece, start, length, ids_crc32, sequence_id, offset, ids).

    Null and empty texts become one piece with the end id; rows that share a doc_id are packed
    each on their own; null doc_ids stay null; an empty table gives no rows; other columns are not read.
    Long documents give as many pieces as they need. Which of two equally long pieces goes into
    which bin follows the order of tasks and rows. With ``in_order`` rows are ranged by sequence and offset, so
    a written table holds each sequence's ids one after the other.
    """
    kind, pieces = id_kind(end_id), token_pieces(documents, capacity, end_id)
    if in_order:
        placed = place(pieces, capacity).repartitionByRange("sequence_id", "offset").sortWithinPartitions("sequence_id", "offset")
        placed = with_ids(placed, kind)
    else:
        placed = place(pieces, capacity, kind)
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "ids")
