"""Benchmark decontamination with a distributed positional inverted index.

The index is a table with one row per segment, a run of whole documents: for each term the ascending list
of its positions in the segment. One position stays free after each document, so no phrase
crosses documents. Segments are searched on their own, so nothing is shuffled and a frequent term is split
over all segments. Lists are stored as bytes in small row groups: as arrays of a whole file at a time they filled
an executor's heap.

A phrase is searched from its rarest term in the segment: that list, minus the term's place in the phrase,
gives possible starts; the offset-adjusted lists of the other terms, rarer ones first, are
intersected with them. A proximity match needs all words of a phrase, as often as it has them, in any order within
the phrase's length and some slack: places of the rarest term are kept where every other list has a
position near enough, and the few that are left are checked word by word. All phrases of a block
are intersected at once in numpy.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from causeway.llm.common import scratch, stored
from causeway.session import cut_lineage

SEGMENT_WORDS = 100_000  # a segment is closed when it holds so many; only a longer document exceeds it
BLOCK_WORDS = 400_000  # words of test items that are searched at a time
PHRASES_AT_ONCE = 1 << 14  # phrases whose lists are compared at a time
PLACES_AT_ONCE = 1 << 18  # positions of their rarest terms that are followed at a time; only a longer list exceeds it
GROUP_SEGMENTS = 8  # stored segments that are written and read at a time,
GROUP_BYTES = 4 << 20  # or of longer ones as many as compressed bytes allow

INDEX = ("segment bigint, doc_ids array<bigint>, doc_marks array<bigint>, doc_starts array<bigint>, doc_words array<bigint>, "
         "terms binary, list_ends binary, positions binary")  # words between blanks, 64-bit and 32-bit numbers
FOUND = ("segment bigint, slot int, doc_id bigint, mark bigint, n_words bigint, spans array<struct<start:bigint,end:bigint>>, items array<string>, "
         "near array<string>")
SLACK = 2  # words that a proximity match may be longer than its phrase
_STORED = {"parquet.block.row.count.limit": str(GROUP_SEGMENTS), "parquet.block.size": str(GROUP_BYTES), "parquet.page.size.row.check.min": "1",
           "parquet.enable.dictionary": "false"}

#: ASCII letters lower-cased, digits and bytes above ASCII kept, all else a blank
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return text.encode().translate(WORD_BYTES).split() if text else []


def build_index(documents: DataFrame, mark: Column | None = None, store=stored) -> DataFrame:
    """Write the positional index of all tokens of (doc_id, text) rows and return it.

    Each row of ``documents`` has its own slot, in the order of the task's rows. ``mark`` is a number carried along.
    """
    limit = SEGMENT_WORDS

    def run(batches):
        import numpy as np
        import pyarrow as pa

        part, closed = TaskContext.get().partitionId() << 32, 0
        ids, marks, starts, sizes, coded, own, words = [], [], [], [], [], {}, 0

        def segment():
            term = np.concatenate(coded)
            at = np.flatnonzero(term >= 0)  # the free places behind documents are no terms
            order = at[np.argsort(term[at], kind="stable")].astype(np.int32)
            ends = np.cumsum(np.bincount(term[at], minlength=len(own)))
            row = ([part + closed], [ids], [marks], [starts], [sizes], [b" ".join(own)], [ends.astype(np.int64).tobytes()], [order.tobytes()])
            kinds = [pa.int64(), *[pa.list_(pa.int64())] * 4, *[pa.binary()] * 3]
            columns = ["segment", "doc_ids", "doc_marks", "doc_starts", "doc_words", "terms", "list_ends", "positions"]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, kinds, strict=True)], columns)

        for batch in batches:
            texts = batch["text"]
            for i, (doc, own_mark) in enumerate(zip(batch["doc_id"].to_pylist(), batch["mark"].to_pylist(), strict=True)):
                found = words_of(texts[i].as_py())
                ids.append(doc)
                marks.append(own_mark)
                starts.append(words)
                sizes.append(len(found))
                coded.append(np.fromiter((own.setdefault(w, len(own)) for w in found), np.int32, len(found)))
                coded.append(np.array([-1], np.int32))
                words += len(found) + 1
                if words >= limit:
                    yield segment()
                    closed += 1
                    ids, marks, starts, sizes, coded, own, words = [], [], [], [], [], {}, 0
        if ids:
            yield segment()

    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), (F.lit(0) if mark is None else mark).cast("bigint").alias("mark"),
                            F.col("text").cast("string").alias("text"))
    return store(rows.mapInArrow(run, INDEX), "postings", **_STORED)


def segment_of(batch, i: int) -> tuple:
    """(doc_ids, doc_marks, doc_starts, doc_words, terms, list_ends, positions) of a row of the index; the first four as Arrow arrays."""
    import numpy as np

    lists = [np.frombuffer(batch[c][i].as_buffer(), kind) for c, kind in (("list_ends", np.int64), ("positions", np.int32))]
    return *(batch[c][i].values for c in ("doc_ids", "doc_marks", "doc_starts", "doc_words")), batch["terms"][i].as_py().split(), *lists


class Block:
    """Phrases of some test items as numbers: phrase by place, -1 behind its end."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        import numpy as np

        phrases: dict[tuple, int] = {}
        pairs = []
        for i, (_, words) in enumerate(items):
            for at in range(max(1, len(words) - window + 1) if words else 0):
                pairs.append((phrases.setdefault(tuple(words[at:at + window]), len(phrases)), i))
        self.names = [name for name, _ in items]
        self.terms = {t: i for i, t in enumerate(sorted({w for p in phrases for w in p}))}
        self.phrases = np.full((len(phrases), window), -1, np.int64)
        for p, k in phrases.items():
            self.phrases[k, :len(p)] = [self.terms[w] for w in p]
        self.sizes = (self.phrases >= 0).sum(1)
        pairs = np.unique(np.asarray(pairs, np.int64).reshape(-1, 2), axis=0)
        self.pair_phrase, self.pair_item = pairs[:, 0], pairs[:, 1]


class Postings:
    """One segment's lists, addressed by a block's term numbers."""

    def __init__(self, terms, ends, positions, numbers: dict[bytes, int]):
        import numpy as np

        ends = np.asarray(ends, np.int64)
        begins = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
        self.begin, self.size = np.zeros(len(numbers), np.int64), np.zeros(len(numbers), np.int64)
        code = np.fromiter((numbers.get(t, -1) for t in terms), np.int64, len(terms))
        known = np.flatnonzero(code >= 0)
        self.begin[code[known]], self.size[code[known]] = begins[known], (ends - begins)[known]
        self.positions = np.asarray(positions, np.int64)
        # lists lie one after the other, so (list, position) ascends over the whole array
        self.list_of = np.zeros(len(numbers), np.int64)
        self.list_of[code[known]] = known
        self.keys = (np.repeat(np.arange(len(ends)), ends - begins) << 40) + self.positions

    def holds(self, term, position):
        """Whether each term's list holds the position."""
        import numpy as np

        key = (self.list_of[term] << 40) + position
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return (position >= 0) & (self.keys[at] == key)

    def holds_near(self, term, low, high):
        """Whether each term's list holds a position from ``low`` to ``high``."""
        import numpy as np

        first = (self.list_of[term] << 40) + np.maximum(low, 0)
        at = np.minimum(np.searchsorted(self.keys, first), len(self.keys) - 1)
        return (self.keys[at] >= first) & (self.keys[at] <= (self.list_of[term] << 40) + high)


def rarest_places(postings: Postings, phrases, sizes):
    """(rows, places, which, position) for some phrases at a time: those whose terms all occur, their places by rarity, and
    for positions of each one's rarest term the index into ``rows``."""
    import numpy as np

    for begin in range(0, len(phrases), PHRASES_AT_ONCE):
        own = phrases[begin:begin + PHRASES_AT_ONCE]
        length = np.where(own >= 0, postings.size[np.maximum(own, 0)], np.iinfo(np.int64).max)
        rows = np.flatnonzero((length > 0).all(1) & (sizes[begin:begin + PHRASES_AT_ONCE] > 0))
        if not len(rows):
            continue
        places = np.argsort(length[rows], axis=1, kind="stable").astype(np.int32)  # rarest first, places behind the end last
        rarest = own[rows, places[:, 0]]
        n = postings.size[rarest]
        upto, done = np.cumsum(n), 0
        while done < len(rows):
            end = max(done + 1, int(np.searchsorted(upto, upto[done] - n[done] + PLACES_AT_ONCE, "right")))
            m = n[done:end]
            which = np.repeat(np.arange(end - done), m)
            nth = np.arange(int(m.sum())) - np.repeat(np.cumsum(m) - m, m)
            yield begin + rows[done:end], places[done:end], which, postings.positions[postings.begin[rarest[done:end]][which] + nth]
            done = end


def _joined(found: list[tuple]) -> tuple:
    import numpy as np

    none = np.empty(0, np.int64)
    return tuple(np.concatenate([none, *(f[i] for f in found)]) for i in range(2))


def phrase_starts(postings: Postings, phrases, sizes):
    """(phrase, start) of every occurrence."""
    found = []
    for rows, places, which, position in rarest_places(postings, phrases, sizes):
        start = position - places[which, 0]
        for k in range(1, phrases.shape[1]):
            place = places[which, k]
            term = phrases[rows[which], place]
            left = (term < 0) | postings.holds(term.clip(0), start + place)
            which, start = which[left], start[left]
        found.append((rows[which], start))
    return _joined(found)


def near_places(postings: Postings, phrases, sizes, slack: int):
    """(phrase, position of its rarest term) around which each of its terms has a position near enough."""
    found = []
    for rows, places, which, position in rarest_places(postings, phrases, sizes):
        for k in range(1, phrases.shape[1]):
            row = rows[which]
            term, reach = phrases[row, places[which, k]], sizes[row] + slack - 1
            left = (term < 0) | postings.holds_near(term.clip(0), position - reach, position + reach)
            which, position = which[left], position[left]
        found.append((rows[which], position))
    return _joined(found)


def window_around(postings: Postings, terms: list[int], slack: int, at: int, low: int, high: int) -> tuple[int, int] | None:
    """Smallest window (start, end) over position ``at`` within ``low`` to ``high`` that has all ``terms``, each as
    often as the list does, and is at most ``slack`` words longer than the list. Of equal ones the first."""
    import numpy as np

    need = Counter(terms)
    span = len(terms) + slack
    low, high = max(low, at - span + 1), min(high, at + span)
    places = []
    for t in need:
        own = postings.positions[postings.begin[t]:postings.begin[t] + postings.size[t]]
        places += [(int(p), t) for p in own[np.searchsorted(own, low):np.searchsorted(own, high)]]
    places.sort()
    best, left, lacking = None, 0, sum(need.values())
    for place, t in places:
        need[t] -= 1
        lacking -= need[t] >= 0
        while places[left][0] < at and need[places[left][1]] < 0:
            need[places[left][1]] += 1
            left += 1
        first = places[left][0]
        if not lacking and first <= at <= place and place - first < span and (best is None or place + 1 - first < best[1] - best[0]):
            best = (first, place + 1)
    return best


def covered(starts, ends):
    """Union of spans as disjoint ascending spans."""
    import numpy as np

    if not len(starts):
        return starts, ends
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    first = np.concatenate([[True], starts[1:] > reach[:-1]])
    return starts[first], reach[np.concatenate([first[1:], [True]])]


def search_block(index: DataFrame, block: Block, slack: int = SLACK):
    """Per document of the index: spans that phrases of the block cover, the items they come from and items with a
    proximity match. Also returns the broadcast, to be freed after use."""
    held = index.sparkSession.sparkContext.broadcast(
        (block.names, block.terms, block.phrases, block.sizes, block.pair_phrase, block.pair_item))

    def run(batches):
        import numpy as np
        import pyarrow as pa

        names, terms, phrases, sizes, pair_phrase, pair_item = held.value
        span_kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            for i in range(batch.num_rows):
                doc_ids, doc_marks, starts, doc_words, own_terms, ends, positions = segment_of(batch, i)
                starts, n_words = starts.to_numpy(), doc_words.to_numpy()
                docs = len(starts)
                spans: list[list] = [[] for _ in range(docs)]
                items: list[list] = [[] for _ in range(docs)]
                close: list[list] = [[] for _ in range(docs)]
                if len(positions):
                    postings = Postings(own_terms, ends, positions, terms)
                    phrase, at = phrase_starts(postings, phrases, sizes)
                    first, last = covered(at, at + sizes[phrase])
                    of = np.searchsorted(starts, first, "right") - 1
                    for d, a, b in zip(of.tolist(), (first - starts[of]).tolist(), (last - starts[of]).tolist(), strict=True):
                        spans[d].append({"start": a, "end": b})
                    pairs = np.unique(np.stack([np.searchsorted(starts, at, "right") - 1, phrase], 1), axis=0)
                    low, high = np.searchsorted(pair_phrase, pairs[:, 1]), np.searchsorted(pair_phrase, pairs[:, 1], "right")
                    for d, a, b in zip(pairs[:, 0].tolist(), low.tolist(), high.tolist(), strict=True):
                        items[d].extend(names[k] for k in pair_item[a:b])
                    seen = set(map(tuple, pairs.tolist()))  # an occurrence is a proximity match
                    close = [list(x) for x in items]
                    phrase, at = near_places(postings, phrases, sizes, slack)
                    for d, k, p in zip((np.searchsorted(starts, at, "right") - 1).tolist(), phrase.tolist(), at.tolist(), strict=True):
                        if (d, k) not in seen and window_around(
                                postings, phrases[k, :sizes[k]].tolist(), slack, p, int(starts[d]), int(starts[d] + n_words[d])):
                            seen.add((d, k))
                            a, b = np.searchsorted(pair_phrase, [k, k + 1])
                            close[d].extend(names[i] for i in pair_item[a:b])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([batch["segment"][i].as_py()] * docs, pa.int64()), pa.array(np.arange(docs, dtype=np.int32)), doc_ids,
                     doc_marks, doc_words, pa.array(spans, span_kind), *[pa.array([sorted(set(x)) for x in own], pa.list_(pa.string())) for own in (items, close)]],
                    ["segment", "slot", "doc_id", "mark", "n_words", "spans", "items", "near"])

    return index.mapInArrow(run, FOUND), held


def proximity(index: DataFrame, phrases: list[list[bytes]], slack: int = SLACK) -> DataFrame:
    """(segment, slot, doc_id, phrase, start, end): documents with all words of a phrase, in any order, close together.

    A match spans at most as many words as the phrase plus ``slack`` and holds a word as often as the phrase
    does; around each place of the rarest word the smallest one is given. Start and end count the
    document's words. Phrases without words match nothing.
    """
    import numpy as np

    numbers = {t: i for i, t in enumerate(sorted({w for p in phrases for w in p}))}
    sizes = np.array([len(p) for p in phrases], np.int64)
    table = np.full((len(phrases), max(sizes, default=0)), -1, np.int64)
    for k, p in enumerate(phrases):
        table[k, :len(p)] = [numbers[w] for w in p]

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            out = set()
            for i in range(batch.num_rows):
                ids, _, starts, n_words, own_terms, ends, positions = segment_of(batch, i)
                if not len(positions) or not table.size:
                    continue
                starts, n_words, ids = starts.to_numpy(), n_words.to_numpy(), ids.to_pylist()
                postings = Postings(own_terms, ends, positions, numbers)
                for k, at in zip(*(x.tolist() for x in near_places(postings, table, sizes, slack)), strict=True):
                    d = int(np.searchsorted(starts, at, "right") - 1)
                    first = int(starts[d])
                    found = window_around(postings, table[k, :sizes[k]].tolist(), slack, at, first, first + int(n_words[d]))
                    if found:
                        out.add((batch["segment"][i].as_py(), d, ids[d], k, found[0] - first, found[1] - first))
            columns = list(zip(*sorted(out, key=lambda r: (r[0], r[1], *r[3:])), strict=True)) or [[]] * 6
            names = ["segment", "slot", "doc_id", "phrase", "start", "end"]
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

    return index.mapInArrow(run, "segment bigint, slot int, doc_id bigint, phrase int, start bigint, end bigint")


def blocks(items: DataFrame, window: int, most: int = BLOCK_WORDS) -> Iterator[Block]:
    """Test items in blocks of about ``most`` words, read one after the other; at least one block."""
    held, size, none = [], 0, True
    names = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), F.col("text").cast("string").alias("text"))
    for r in names.toLocalIterator():
        words = words_of(r["text"])
        held.append((r["item_id"], words))
        size += len(words)
        if size >= most:
            yield Block(held, window)
            held, size, none = [], 0, False
    if held or none:
        yield Block(held, window)


def find(documents: DataFrame, items: DataFrame, window: int = 10, slack: int = SLACK) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated, n_near) per row of ``documents``.

    Words are ASCII letters (lower-cased), digits and all characters above ASCII. A window is ``window``
    consecutive words of an item (of a shorter item all its words); document words inside any
    occurrence are hit. ``n_near`` counts the items with a proximity match of a window, occurrences included.
    Null and empty texts have no words. Rows sharing a doc_id are separate, repeated item
    ids are one item, a null item id is written as an empty string. Other columns are not
    read; empty tables give no rows or no hits.

    The postings hold all tokens. Items are searched in blocks of ``BLOCK_WORDS`` words, one block
    at a time on the driver and in the tasks; of several blocks each writes its finds.
    """
    return summed_up(search(build_index(documents), items, window, slack))


def search(index: DataFrame, items: DataFrame, window: int = 10, slack: int = SLACK, store=stored) -> DataFrame:
    """(doc_id, mark, n_words, spans, items, near) of each document of an index, over all blocks of items."""
    parts, waiting = [], None
    for block in blocks(items, window):
        if waiting is not None:
            parts.append(_written(*waiting, store))
        waiting = search_block(index, block, slack)
    found = waiting[0]
    if parts:
        found = _written(*waiting, store)
        for other in parts:
            found = found.unionByName(other)
        found = found.groupBy("segment", "slot").agg(
            *[F.first(c).alias(c) for c in ("doc_id", "mark", "n_words")], F.flatten(F.collect_list("spans")).alias("spans"),
            *[F.array_distinct(F.flatten(F.collect_list(c))).alias(c) for c in ("items", "near")])
    return found


def summed_up(found: DataFrame) -> DataFrame:
    """The counts of ``find`` from what ``search`` gives."""
    step = F.aggregate(
        F.array_sort("spans"), F.struct(F.lit(0).cast("bigint").alias("hit"), F.lit(0).cast("bigint").alias("end")),
        lambda s, x: F.struct((s["hit"] + F.greatest(x["end"] - F.greatest(x["start"], s["end"]), F.lit(0))).alias("hit"),
                              F.greatest(s["end"], x["end"]).alias("end")), lambda s: s["hit"])
    return found.select("doc_id", "n_words", step.alias("n_hit"), "items", "near").select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
        F.size("near").cast("bigint").alias("n_near"))


def _written(found: DataFrame, held, store=stored) -> DataFrame:
    out = store(found, "found")
    held.destroy()
    return out


def keep_clean(documents: DataFrame, items: DataFrame, window: int = 10) -> DataFrame:
    """Documents without any occurrence of a window of the items.

    Whether a row goes depends on its text alone, so rows are told apart by two 64-bit hashes of it: clean rows
    stay whatever rows share their id. The index goes when the contaminated hashes are known.
    """
    text = F.col("text").cast("string")
    marks = {"_decontam_a": F.xxhash64(text), "_decontam_b": F.xxhash64(F.lit(1), text)}
    with scratch(documents.sparkSession) as store:
        index = build_index(documents.select(marks["_decontam_a"].alias("doc_id"), "text"), marks["_decontam_b"], store)
        found = search(index, items, window, store=store).filter(F.size("spans") > 0)
        hit = cut_lineage(found.select(F.col("doc_id").alias("_decontam_a"), F.col("mark").alias("_decontam_b")).distinct())
    return documents.withColumns(marks).join(hit, list(marks), "left_anti").drop(*marks)
