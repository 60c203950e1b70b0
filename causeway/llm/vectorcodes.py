"""Vector codes by ball k-means: one byte for each part of a vector, learned per part position.

Components are whole numbers of 1/256, so every distance, mean and tie is exact. A part knows its entry
from the round before and its distance d to it. An entry that lies more than 2d from the part's own
entry can't be nearer, which gives the three savings of the method: the radius of an entry's ball (the
largest d of a batch) bounds the neighbours that its parts can move to; parts with 2d below the distance
of the nearest neighbour are a stable core without any work; and the neighbours' distances, ascending,
cut the rest of the ball into rings, where a part of ring r meets the r nearest neighbours only. Where a
part's own entry hasn't moved, only neighbours that have moved are met.

Spark keeps the vectors with their codes as a table from round to round; tasks return sums and counts
per entry, and only the codebooks, whose size is a parameter, reach the driver.
"""

from __future__ import annotations

import hashlib
import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from causeway.llm.common import stored

LIMB = 30  # bits of a limb of sums that outgrow 64 bits
TILE_COMPONENTS = 1 << 20  # components handled at once
MOST = (1 << 63) - 1


class Books(NamedTuple):
    """Codebooks as nested lists [part][entry][position], and what is needed to compute with them."""

    entries: list
    scale: int
    wide: bool  # numbers beyond 64 bits

    def text(self) -> str:
        return ",".join(str(x) for part in self.entries for entry in part for x in entry)

    def sha256(self) -> str:
        return hashlib.sha256(self.text().encode()).hexdigest()


def settle(points, own_entry, book, moved):
    """Nearest entry of each point (ties: the lower index) and its squared distance.

    ``own_entry`` is the nearest of the entries before they moved, or anything where all of ``moved`` is set.
    """
    import numpy as np

    gaps = ((book[:, None, :] - book[None, :, :]) ** 2).sum(2)
    order = np.argsort(gaps, axis=1, kind="stable")
    ring_edges = np.take_along_axis(gaps, order, 1)
    own = ((points - book[own_entry]) ** 2).sum(1)
    reach = 4 * own  # (2d)^2
    widest = 0
    for i in np.unique(own_entry):
        radius = reach[own_entry == i].max()
        widest = max(widest, int((ring_edges[i] <= radius).sum()))
    best, at = own.copy(), own_entry.copy()
    ball = np.arange(len(points))
    for r in range(widest):
        ball = ball[ring_edges[own_entry[ball], r] <= reach[ball]]
        home = own_entry[ball]
        other = order[home, r]
        meet = (other != home) & (moved[home] | moved[other])
        rows, other = ball[meet], other[meet]
        if not len(rows):
            continue
        d = ((points[rows] - book[other]) ** 2).sum(1)
        better = ((d < best[rows]) | ((d == best[rows]) & (other < at[rows]))).astype(bool)
        best[rows[better]], at[rows[better]] = d[better], other[better]
    return at, best


def whole_numbers(column, width: int, scale: int, wide: bool):
    """floor(scale * x) of a batch of vectors as a matrix of 64-bit or unbounded integers."""
    import numpy as np

    x = column.flatten().to_numpy(zero_copy_only=False).astype("f8").reshape(-1, width)
    if not wide:
        return np.floor(x * scale).astype("i8")
    out = np.empty(x.shape, object)
    for i, row in enumerate(x.tolist()):  # doubles of 2^53 and more are whole
        out[i] = [int(v) * scale if abs(v) >= 2.0**53 else math.floor(v * scale) for v in row]
    return out


def _tiles(batch, width: int):
    step = max(1, TILE_COMPONENTS // width)
    for at in range(0, batch.num_rows, step):
        yield batch.slice(at, step)


def _settled(tile, vector: str, width: int, parts: int, books: Books, moved):
    """Codes (rows x parts) and squared distances of one tile, from the codes it brings."""
    import numpy as np

    x = whole_numbers(tile.column(vector), width, books.scale, books.wide).reshape(tile.num_rows, parts, -1)
    codes = tile.column("_code").to_pylist()
    old = np.frombuffer(b"".join(codes), "u1").reshape(-1, parts).astype("i8")
    found, errors = np.empty_like(old), np.empty(old.shape, object if books.wide else "i8")
    kind = object if books.wide else "i8"
    for p in range(parts):
        found[:, p], errors[:, p] = settle(x[:, p], old[:, p], np.array(books.entries[p], kind), moved[p])
    return x, found, errors


def assign(rows: DataFrame, vector: str, width: int, parts: int, books: Books, moved) -> DataFrame:
    """``rows`` with ``_code`` brought up to date."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for tile in _tiles(batch, width):
                codes = _settled(tile, vector, width, parts, books, moved)[1].astype("u1")
                at = tile.schema.get_field_index("_code")
                yield tile.set_column(at, "_code", pa.array([c.tobytes() for c in codes], pa.binary()))

    return rows.mapInArrow(run, rows.schema)


def means(rows: DataFrame, vector: str, width: int, parts: int, books: Books) -> list:
    """Codebooks whose entries are the floors of the means of their parts; unused entries stay."""
    size, entries = width // parts, len(books.entries[0])

    def run(batches):
        import numpy as np
        import pyarrow as pa

        kind = object if books.wide else "i8"
        total = np.zeros((parts, entries, size + 1), kind)
        for batch in batches:
            for tile in _tiles(batch.select([vector, "_code"]), width):
                x = whole_numbers(tile.column(vector), width, books.scale, books.wide).reshape(tile.num_rows, parts, size)
                codes = np.frombuffer(b"".join(tile.column("_code").to_pylist()), "u1").reshape(-1, parts)
                for p in range(parts):
                    np.add.at(total[p, :, :size], codes[:, p], x[:, p])
                    total[p, :, size] += np.bincount(codes[:, p], minlength=entries).astype(kind)
        found = []
        for place, value in enumerate(total.ravel().tolist()):
            limb = 0
            while value:  # one limb of 62 bits where that is enough
                low = value if abs(value) < 1 << 62 else value % (1 << LIMB)
                found.append((place, limb, low))
                value, limb = (value - low) >> LIMB, limb + 1
        columns = list(zip(*found, strict=True)) if found else ([], [], [])
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int32(), pa.int32(), pa.int64()), strict=True)],
                                         ["place", "limb", "value"])

    summed = rows.select(vector, "_code").mapInArrow(run, "place int, limb int, value bigint").groupBy("place", "limb").agg(
        F.sum(F.col("value").cast("decimal(38,0)")).alias("value"))
    total = [0] * (parts * entries * (size + 1))
    for r in summed.collect():  # entries x positions, whatever the rows
        total[r["place"]] += int(r["value"]) << (LIMB * r["limb"])
    new = []
    for p in range(parts):
        new.append([])
        for e in range(entries):
            at = (p * entries + e) * (size + 1)
            n = total[at + size]
            new[p].append([total[at + i] // n for i in range(size)] if n else books.entries[p][e])
    return new


def usable(rows: DataFrame, vector: str, parts: int) -> DataFrame:
    """Rows whose vector has finite components only and a length that can be cut into ``parts``."""
    def bad(x: Column) -> Column:
        return x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))

    kind = rows.schema[vector].dataType
    if not (isinstance(kind, T.ArrayType) and isinstance(kind.elementType, (T.FloatType, T.DoubleType))):
        rows = rows.withColumn(vector, F.col(vector).cast("array<double>"))
    return rows.filter(F.col(vector).isNotNull() & (F.size(vector) > 0) & (F.size(vector) % parts == 0)
                       & ~F.exists(vector, bad))


def encode(vectors: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2, scale: int = 256,
           id_column: str = "vec_id", vector: str = "embedding", label: str = "label") -> tuple[DataFrame, Books | None]:
    """(id, label, code string, error, label_error) of every usable vector, and the codebooks.

    Entries start as the parts of the vectors with the smallest ids (ties by the components; null ids come
    last), fewer where the table has fewer rows. Dropped: vectors that are null, hold null or non-finite
    components, are empty, can't be cut into ``parts`` equal parts, or differ in length from that of the
    smallest id. Repeated rows count each; null labels are one label; an empty table gives no rows; other
    columns are not read. Errors beyond 64 bits are given as the largest 64-bit number.
    """
    if not 0 < entries <= 256:
        raise ValueError("entries must be between 1 and 256")
    spark = vectors.sparkSession
    rows = usable(vectors.select(F.col(id_column).alias("_id"), F.col(label).alias("_label"), F.col(vector).alias("_vector")),
                  "_vector", parts)
    by_id = [F.col("_id").asc_nulls_last(), F.col("_vector")]
    head = rows.orderBy(*by_id).limit(1).collect()
    out = T.StructType([
        T.StructField(id_column, rows.schema["_id"].dataType), T.StructField(label, rows.schema["_label"].dataType),
        T.StructField("code", T.StringType()), T.StructField("error", T.LongType()), T.StructField("label_error", T.LongType())])
    if not head:
        return spark.createDataFrame([], out), None
    width = len(head[0]["_vector"])
    rows = rows.filter(F.size("_vector") == width)
    largest = rows.agg(F.max(F.array_max(F.transform("_vector", lambda x: F.abs(x).cast("double")))).alias("m")).collect()[0]["m"]
    size = width // parts
    bound = int(largest) * scale + scale
    wide = 16 * size * parts * bound * bound >= 1 << 62  # four times a squared distance, and the sum over parts
    first = [[int(v) * scale if abs(v) >= 2.0**53 else math.floor(v * scale) for v in r["_vector"]]
             for r in rows.orderBy(*by_id).limit(entries).select("_vector").collect()]
    books = Books([[v[p * size:(p + 1) * size] for v in first] for p in range(parts)], scale, wide)

    def changed(old: Books | None, new: Books):
        import numpy as np

        return [np.array([old is None or old.entries[p][e] != new.entries[p][e] for e in range(len(first))]) for p in range(parts)]

    rows, before = rows.withColumn("_code", F.lit(bytes(parts))), None
    for r in range(rounds):
        rows = stored(assign(rows, "_vector", width, parts, books, changed(before, books)), f"codes-{r}")
        before, books = books, Books(means(rows, "_vector", width, parts, books), scale, wide)
    moved = changed(before, books)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for tile in _tiles(batch, width):
                _, codes, errors = _settled(tile, "_vector", width, parts, books, moved)
                text = [c.tobytes().hex() for c in codes.astype("u1")]
                error = [min(int(e), MOST) for e in errors.sum(1).tolist()]
                yield pa.RecordBatch.from_arrays(
                    [tile.column("_id"), tile.column("_label"), pa.array(text, pa.string()), pa.array(error, pa.int64())],
                    ["_id", "_label", "code", "error"])

    kinds = T.StructType([rows.schema["_id"], rows.schema["_label"], out["code"], out["error"]])
    coded = stored(rows.mapInArrow(run, kinds), "codes")
    per_label = coded.groupBy(F.col("_label").alias("_l")).agg(
        F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(MOST).cast("decimal(38,0)")).cast("bigint").alias("label_error"))
    found = coded.join(per_label, F.col("_label").eqNullSafe(F.col("_l")))
    return found.select(F.col("_id").alias(id_column), F.col("_label").alias(label), "code", "error", "label_error"), books
