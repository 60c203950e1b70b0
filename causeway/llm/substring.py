"""Substring deduplication by seed and extend over words.

Seeds are winnowed anchors: in every window of ``length`` words the smallest hash of its runs of ``SEED`` words
is selected, so equal windows select the same anchor at the same place. Neighbouring windows that
select the same anchor form a stretch around it. Extension compares stretches of one anchor:

1. anchors that occur in documents with different ids are shared; all others are done;
2. stretches of a shared anchor that agree to both ends, all of their words, form a class; every member
   but the one of the smallest doc_id is a repeat as a whole;
3. classes of one anchor that differ further out are extended place by place: for each way to
   divide the remaining words between left and right, the owners' words are compared.

Overlapping repeats are united, so what remains are maximal repeats of ``length`` words or more. No
step pairs the documents of an anchor; each is a minimum by key, combined in the tasks first.

Texts are read in three narrow passes rather than shuffled. Bit tables, sized by what they hold, tell a later
pass which stretches matter; a wrong bit lets a row through and changes nothing else. Nothing is joined by anchor,
so a line that very many documents share stays spread.
Words and runs are compared by 64-bit hashes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from causeway.llm.common import scratch, text_slices
from causeway.session import cut_lineage

SEED = 20  # words of an anchor
LEAST_BITS, MOST_BITS = 20, 29  # a bit table has 2^20 to 2^29 bits, 64 MB at most
BITS_PER_KEY = 64  # wanted, as long as the largest table allows it
GROUP_WORDS = 100_000  # words worked on at a time; only a longer document exceeds it
TEXT_BYTES = 1 << 20  # texts that are strings at a time
LAST_ID = (1 << 63) - 1

BASE = 0xD6E8FEB86659FD93  # odd


def mix(x):
    """Finalizer that spreads all bits of 64-bit numbers."""
    import numpy as np

    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Rolling:
    """Hashes of runs of words: differences of prefix sums, shifted back to the origin."""

    def __init__(self):
        import numpy as np

        self.up, self.down = np.ones(1, np.uint64), np.ones(1, np.uint64)

    def load(self, hashes):
        import numpy as np

        n = len(hashes) + 1
        if len(self.up) < n:
            self.up, self.down = (np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n - 1, b, np.uint64)]), dtype=np.uint64)
                                  for b in (BASE, pow(BASE, -1, 1 << 64)))
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * self.up[:n - 1], dtype=np.uint64)])

    def run(self, first, end):
        return mix((self.sums[end] - self.sums[first]) * self.down[first])


def leftmost_minimum(values, width: int):
    """Position of the smallest of ``width`` values from each place on, the first of equal ones."""
    import numpy as np

    at, size = np.arange(len(values)), 1
    while size < width:
        step = min(size, width - size)
        left, right = at[:len(at) - step], at[step:]
        at = np.where(values[right] < values[left], right, left)
        size += step
    return at


def stretches(hashes, ends, length: int, rolling: Rolling):
    """Windows of all documents laid end to end, by selected anchor.

    ``ends`` are the documents' ends. Returns per stretch: document, first window, last window,
    anchor hash, class hash.
    """
    import numpy as np

    seed = min(SEED, length)
    begins = np.concatenate([[0], ends[:-1]])
    none = tuple(np.empty(0, np.int64) for _ in range(3)) + tuple(np.empty(0, np.uint64) for _ in range(2))
    windows = np.maximum(ends - begins - length + 1, 0)
    if not windows.sum():
        return none
    rolling.load(hashes)
    places = np.arange(len(hashes) - seed + 1)
    grams = rolling.run(places, places + seed)
    anchor = leftmost_minimum(grams, length - seed + 1)
    document = np.repeat(np.arange(len(ends)), windows)
    window = begins[document] + np.arange(len(document)) - np.repeat(np.cumsum(windows) - windows, windows)
    anchor = anchor[window]
    new = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (document[1:] != document[:-1])])
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:], [len(new)]]) - 1
    a, b, p = window[first], window[last], anchor[first]
    place = mix(((b - a) * 4096 + (p - a)).astype(np.uint64) + np.uint64(1))
    return document[first], a, b, grams[p], mix(rolling.run(a, b + length) ^ place)


def table_bits(keys: int) -> int:
    """Logarithm of a table's size for so many keys."""
    return min(MOST_BITS, max(LEAST_BITS, (max(keys, 1) * BITS_PER_KEY - 1).bit_length()))


def bit_table(keys: DataFrame, name: str):
    """Bits set at the low bits of all keys, as 64-bit words; the table grows with the number of keys up to a bound."""
    import numpy as np

    bits = table_bits(keys.count())
    low = F.col(name).bitwiseAND(F.lit((1 << bits) - 1))
    words = keys.select(low.alias("k")).select(F.shiftright("k", 6).alias("w"), F.expr("shiftleft(1L, cast(k & 63 as int))").alias("b"))
    found = words.groupBy("w").agg(F.bit_or("b").alias("b")).toArrow()  # at most 2^23 rows
    table = np.zeros(1 << (bits - 6), np.uint64)
    table[found["w"].to_numpy()] = found["b"].to_numpy().view(np.uint64)
    return table


def marked(table, keys):
    import numpy as np

    low = keys & np.uint64(len(table) * 64 - 1)
    return (table[(low >> np.uint64(6)).astype(np.int64)] >> (low & np.uint64(63))) & np.uint64(1) == 1


def marked_rows(rows: DataFrame, name: str, table) -> DataFrame:
    """Rows whose key may be in the table; where they lie stays as it is."""
    held = rows.sparkSession.sparkContext.broadcast(table)

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            yield batch.filter(pa.array(marked(held.value, batch.column(name).to_numpy().view(np.uint64))))

    return rows.mapInArrow(run, rows.schema)


def _rows(documents: DataFrame) -> DataFrame:
    """(doc_id, order, digest, text); null ids come last in order."""
    text = F.col("text").cast("string")
    doc = F.col("doc_id").cast("bigint")
    return documents.select(doc.alias("doc_id"), F.coalesce(doc, F.lit(LAST_ID)).alias("order"), F.xxhash64(text).alias("digest"), text.alias("text"))


def _pass(rows: DataFrame, length: int, schema: str, made) -> DataFrame:
    """Run ``made(order, digest, (document, a, b, anchor, class), begins, rolling)`` over groups of documents."""
    def run(batches):
        import numpy as np
        import pyarrow as pa
        import xxhash

        digest, rolling = xxhash.xxh64_intdigest, Rolling()
        names = [f.split()[0] for f in schema.split(", ")]
        kinds = [pa.int64() if f.split()[1] == "bigint" else pa.int32() for f in schema.split(", ")]

        def groups():
            held, sizes, orders, digests, words = [], [], [], [], 0
            for part in (part for batch in batches for part in text_slices(batch, TEXT_BYTES)):
                for order, mark, text in zip(*(part[c].to_pylist() for c in ("order", "digest", "text")), strict=True):
                    own = text.encode().split() if text else ()
                    if len(own) < length:
                        continue
                    held.append(np.fromiter(map(digest, own), np.uint64, len(own)))
                    sizes.append(len(own))
                    orders.append(order)
                    digests.append(mark)
                    words += len(own)
                    if words >= GROUP_WORDS:
                        yield held, sizes, orders, digests
                        held, sizes, orders, digests, words = [], [], [], [], 0
            if held:
                yield held, sizes, orders, digests

        for held, sizes, orders, digests in groups():
            ends = np.cumsum(sizes)
            found = stretches(np.concatenate(held), ends, length, rolling)
            columns = made(np.asarray(orders, np.int64), np.asarray(digests, np.int64), found, ends - sizes, rolling)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c.view(np.int64) if c.dtype == np.uint64 else c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return rows.select("order", "digest", "text").mapInArrow(run, schema)


def repeats(documents: DataFrame, length: int = 50) -> DataFrame:
    """(order, digest, spans): word spans that repeat a document with a smaller doc_id.

    ``order`` is the doc_id (null: the largest number), ``digest`` the XXH64 of the text; spans are
    pieces [start, end) of at least ``length`` words that may overlap.
    """
    with scratch(documents.sparkSession) as store:
        return _repeats(documents, length, store)


def _repeats(documents: DataFrame, length: int, store) -> DataFrame:
    sc = documents.sparkSession.sparkContext
    rows = _rows(documents)

    def seeds(order, digest, found, begins, rolling):
        return found[3], order[found[0]]

    anchors = _pass(rows, length, "anchor bigint, order bigint", seeds).groupBy("anchor").agg(
        F.min("order").alias("low"), F.max("order").alias("high"))
    shared = sc.broadcast(bit_table(store(anchors.filter("low < high").select("anchor"), "anchors"), "anchor"))

    def shared_stretches(order, digest, found, begins, rolling):
        document, a, b, anchor, kind = (c[marked(shared.value, found[3])] for c in found)
        return anchor, kind, order[document], digest[document], a - begins[document], b - begins[document]

    held = store(_pass(rows, length, "anchor bigint, class bigint, order bigint, digest bigint, first int, last int", shared_stretches), "stretches")
    classes = cut_lineage(held.groupBy("anchor", "class").agg(F.min("order").alias("owner"), F.max("order").alias("high")))
    whole = held.join(classes.filter("owner < high").select("anchor", "class", "owner"), ["anchor", "class"]).filter(
        "owner < order").select("order", "digest", F.col("first").alias("start"), (F.col("last") + length).alias("end"))
    several = classes.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"), F.min("owner").alias("least"), F.max("owner").alias("most")).filter(
        "n > 1 AND least < most").select("anchor")
    several = bit_table(cut_lineage(several), "anchor")
    owners = marked_rows(classes.select("anchor", F.col("class").bitwiseXOR(F.col("owner")).alias("key")), "anchor", several)
    contested = sc.broadcast(bit_table(cut_lineage(owners.select("key")), "key"))
    several = sc.broadcast(several)

    def extended(order, digest, found, begins, rolling):
        import numpy as np

        keep = marked(several.value, found[3]) & marked(contested.value, found[4] ^ order[found[0]].view(np.uint64))
        document, a, b = (c[keep] for c in found[:3])
        n = b - a + 1
        window = np.repeat(a - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        document = np.repeat(document, n)
        return rolling.run(window, window + length), order[document], digest[document], window - begins[document]

    places = store(_pass(rows, length, "words bigint, order bigint, digest bigint, start int", extended), "places")
    least = cut_lineage(places.groupBy("words").agg(F.min("order").alias("least"), F.max("order").alias("most")).filter(
        "least < most").select("words", "least"))
    partly = places.join(least, "words").filter("least < order").select("order", "digest", "start", (F.col("start") + length).alias("end"))
    spans = whole.unionByName(partly).groupBy("order", "digest").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    return cut_lineage(spans)


def remove_repeats(documents: DataFrame, length: int = 50) -> DataFrame:
    """``documents`` with (n_words, n_removed, kept_text, removed_spans) added.

    Words are runs without ASCII white space, unchanged; a word goes if a window of ``length`` words that covers
    it also starts in a document with a smaller doc_id. Windows are judged on the input. ``kept_text`` is
    the kept words joined by one space; ``removed_spans`` are the maximal repeats. Null texts have no words.
    Rows with one doc_id never repeat each other, null doc_ids count as larger than all; copies with a larger
    id lose all their words if they have ``length`` of them. Columns with the added names are replaced.
    """
    added = ["n_words", "n_removed", "kept_text", "removed_spans"]
    spans = repeats(documents, length)
    kept = documents.drop(*added)
    order: Column = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LAST_ID))
    joined = kept.withColumns({"_repeats_order": order, "_repeats_digest": F.xxhash64(F.col("text").cast("string"))}).join(
        spans.withColumnsRenamed({"order": "_repeats_order", "digest": "_repeats_digest", "spans": "_repeats_spans"}), ["_repeats_order", "_repeats_digest"], "left").drop("_repeats_order", "_repeats_digest")

    def run(batches):
        import numpy as np
        import pyarrow as pa

        span_kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        for batch in (part for whole in batches for part in text_slices(whole, TEXT_BYTES)):
            columns: tuple = ([], [], [], [])
            for text, own in zip(batch["text"].to_pylist(), batch["_repeats_spans"].to_pylist(), strict=True):
                words = str(text).encode().split() if text is not None else []
                gone, maximal = [], []
                if own:
                    edge = np.zeros(len(words) + 1, np.int64)
                    np.add.at(edge, [s["start"] for s in own], 1)
                    np.add.at(edge, [s["end"] for s in own], -1)
                    inside = np.cumsum(edge[:-1]) > 0
                    turns = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
                    maximal = [{"start": int(a), "end": int(b)} for a, b in turns.reshape(-1, 2)]
                    gone = [s["end"] - s["start"] for s in maximal]
                    left, at = [], 0
                    for s in maximal:
                        left += words[at:s["start"]]
                        at = s["end"]
                    left += words[at:]
                else:
                    left = words
                for column, value in zip(columns, (len(words), sum(gone), b" ".join(left).decode(), maximal), strict=True):
                    column.append(value)
            names = [c for c in batch.schema.names if c != "_repeats_spans"]
            yield pa.RecordBatch.from_arrays(
                [*[batch[c] for c in names], *[pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int64(), pa.string(), span_kind), strict=True)]],
                [*names, *added])

    schema = kept.limit(0).select("*", F.lit(0).cast("bigint").alias("n_words"), F.lit(0).cast("bigint").alias("n_removed"),
                                  F.lit("").alias("kept_text"), F.lit(None).cast("array<struct<start:int,end:int>>").alias("removed_spans")).schema
    return joined.mapInArrow(run, schema)
