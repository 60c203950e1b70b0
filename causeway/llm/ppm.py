"""Language-model scoring by prediction by partial matching over bytes.

A text is its lower-cased words joined by single spaces and closed by an end byte. The model is a
trie of byte contexts up to ``ORDER`` bytes with symbol counts of the training texts. A byte is coded in
its longest known context, or by escapes to shorter ones: a context with total N and q different
symbols gives a symbol seen n times (2n - 1) / 2N and the escape q / 2N, and after an escape the symbols
of the longer context are excluded from both. Below order zero, all remaining bytes are alike.

Training counts are sums of byte n-grams over all training texts, combined in the tasks first.
A trie of up to ``MODEL_ROWS`` n-grams is sent to tasks whole. Scoring is numpy over whole batches then:
one table lookup for a byte whose full context predicts it, a walk down the orders for the rest.

Of a larger trie nothing is left out either. A byte's probability depends on the n-gram that ends
with it alone, so tasks get the finished logarithms of the most frequent n-grams of full length and
hand on what they don't find, counted by document. Different ones of these are looked up by
joins with the stored counts, one order after the other, and their logarithms joined back.
"""

from __future__ import annotations

import math
from collections import Counter

from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from causeway.llm.common import least_count, remainder, stored, text_slices

ORDER = 5
END = b"\n"  # never inside a word
MODEL_ROWS = 2_000_000  # n-grams of all orders in a trie that is broadcast whole, else of full length
LOW = 2  # contexts of fewer bytes have a bounded number of n-grams, which joins broadcast
HOT_WORDS = 300_000  # words whose counts are broadcast; the rest is joined
CHUNK = 1 << 18  # bytes counted or scored at a time
HELD = 1_000_000  # different n-grams a task gathers before it hands them on
HELD_WORDS = 250_000  # the same for words
SCATTER = 0x9E3779B97F4A7C15  # odd, so multiplication permutes the 64-bit numbers


class Index:
    """Static table from 64-bit keys to their positions."""

    def __init__(self, keys):
        import numpy as np

        mixed = keys.astype(np.uint64) * np.uint64(SCATTER)
        bits = max(1, int(len(keys)).bit_length() + 1)
        self.shift = np.uint64(64 - bits)
        self.order = np.argsort(mixed, kind="stable")
        self.mixed = mixed[self.order]
        self.start = np.searchsorted(self.mixed >> self.shift, np.arange((1 << bits) + 1, dtype=np.uint64)).astype(np.int32)
        self.order = self.order.astype(np.int32)

    def find(self, keys):
        """Position of each key, -1 where there is none."""
        import numpy as np

        mixed = keys * np.uint64(SCATTER)
        bucket = (mixed >> self.shift).astype(np.int64)
        at, end = self.start[bucket], self.start[bucket + 1]
        out = np.full(len(keys), -1, np.int32)
        left = np.flatnonzero(at < end)
        while len(left):
            spot = at[left]
            same = self.mixed[spot] == mixed[left]
            out[left[same]] = self.order[spot[same]]
            at[left] += 1
            left = left[~same & (spot + 1 < end[left])]
        return out


class Trie:
    """Counts by order: ``grams[k]`` are numbers of k + 1 bytes, ``counts[k]`` how often they were seen."""

    def __init__(self, grams, counts):
        import numpy as np

        self.order = len(grams) - 1
        self.grams, self.counts, self.contexts = [], [], []
        below = None
        for k in range(self.order + 1):
            order = np.argsort(grams[k], kind="stable")
            keys, n = grams[k][order].astype(np.uint64), counts[k][order].astype(np.float64)
            table = Index(keys)
            self.grams.append(table)
            self.counts.append(n)
            owner = keys >> np.uint64(8)
            first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]])) if len(keys) else np.empty(0, np.int64)
            total = np.add.reduceat(n, first) if len(keys) else np.empty(0)
            symbols = np.diff(np.concatenate([first, [len(keys)]])).astype(np.float64)
            taken = np.zeros(len(first))  # what this context's symbols count in the next shorter one
            if k and len(keys):
                shorter = keys & np.uint64((1 << (8 * k)) - 1)
                taken = np.add.reduceat(below[1][below[0].find(shorter)], first)
            self.contexts.append((Index(owner[first]), total, symbols, taken))
            if k == self.order:
                self.full = np.log((2 * n - 1) / (2 * np.repeat(total, symbols.astype(np.int64))))
            below = (table, n)

    def plain(self) -> dict:
        """Arrays only, for a broadcast: tasks needn't have this package installed to read them."""
        return vars(self) | {"grams": [vars(g) for g in self.grams], "contexts": [(vars(c[0]), *c[1:]) for c in self.contexts]}

    @classmethod
    def of(cls, plain: dict) -> Trie:
        def made(kind, fields):
            out = kind.__new__(kind)
            out.__dict__.update(fields)
            return out

        return made(cls, plain | {"grams": [made(Index, g) for g in plain["grams"]],
                                  "contexts": [(made(Index, c[0]), *c[1:]) for c in plain["contexts"]]})

    def log_probability(self, stream):
        """Natural log of each byte's probability, from the ``order``-th byte of ``stream`` on."""
        import numpy as np

        n = len(stream) - self.order
        if n <= 0:
            return np.empty(0)
        padded = np.concatenate([np.zeros(7 - self.order, np.uint8), stream])
        keys = np.ndarray((n,), ">u8", padded.tobytes(), strides=(1,)).astype(np.uint64)
        keys &= np.uint64((1 << (8 * (self.order + 1))) - 1)
        at = self.grams[self.order].find(keys)
        out = self.full[at] if len(self.full) else np.zeros(n)
        left = np.flatnonzero(at < 0)
        spent = np.zeros(len(left))
        taken, taken_symbols = np.zeros(len(left)), np.zeros(len(left))
        keys = keys[left]
        for k in range(self.order, -1, -1):
            table, total, symbols, shorter = self.contexts[k]
            own = keys & np.uint64((1 << (8 * (k + 1))) - 1)
            context = table.find(own >> np.uint64(8))
            known = context >= 0
            gram = self.grams[k].find(own)
            mass = np.where(known, total[context] if len(total) else 0, 0) - taken
            kinds = np.where(known, symbols[context] if len(symbols) else 0, 0) - taken_symbols
            hit = gram >= 0
            if hit.any():
                out[left[hit]] = spent[hit] + np.log((2 * self.counts[k][gram[hit]] - 1) / (2 * mass[hit]))
            escapes = known & (kinds > 0)
            spent = spent + np.log(np.where(escapes, kinds / np.where(escapes, 2 * mass, 1), 1))
            if k:
                taken = np.where(known, shorter[context] if len(shorter) else 0, 0)
                taken_symbols = np.where(known, symbols[context] if len(symbols) else 0, 0)
            miss = ~hit
            left, keys, spent, taken, taken_symbols = left[miss], keys[miss], spent[miss], taken[miss], taken_symbols[miss]
            if not len(left):
                return out
        seen = self.contexts[0][2][0] if len(self.contexts[0][2]) else 0
        out[left] = spent - math.log(max(256 - seen, 1))
        return out


def normal_words(text: str | None) -> list[bytes]:
    """Words without ASCII white space, A-Z lower-cased."""
    return text.encode().lower().split() if text else []


def slices(batch):
    """Parts (first row, texts) of a batch with about ``CHUNK`` bytes of text, or one longer text."""
    at = 0
    for part in text_slices(batch, CHUNK):
        yield at, part.column("text").to_pylist()
        at += part.num_rows


def streams(items, order: int):
    """Chunks (bytes, [(item, first, end)]) of padded streams; parts of one long item overlap by the context.

    ``items`` yields (item, words). ``first`` is the index of the part's first scored byte.
    """
    held, spans, size = [], [], 0
    pad = END * order
    for item, words in items:
        data = pad + b" ".join(words) + END
        for at in range(0, len(data) - order, CHUNK):
            part = data[at:at + CHUNK + order]
            spans.append((item, size + order, size + len(part)))
            held.append(part)
            size += len(part)
            if size >= CHUNK:
                yield b"".join(held), spans
                held, spans, size = [], [], 0
    if spans:
        yield b"".join(held), spans


def _summed(keys, counts):
    import numpy as np

    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(counts, first)


def gram_counts(texts: DataFrame, order: int = ORDER) -> DataFrame:
    """(gram, n): how often each run of order + 1 bytes occurs in all of ``texts``."""
    def run(batches):
        import numpy as np
        import pyarrow as pa

        def rows():
            for batch in batches:
                for _, texts in slices(batch):
                    for text in texts:
                        yield None, normal_words(text)

        held: list = []
        waiting = 0
        for data, spans in streams(rows(), order):
            padded = np.frombuffer(b"\0" * (7 - order) + data, np.uint8)
            keys = np.ndarray((len(data) - order,), ">u8", padded, strides=(1,)).astype(np.uint64)
            keys &= np.uint64((1 << (8 * (order + 1))) - 1)
            scored = np.zeros(len(keys), bool)
            for _, first, end in spans:
                scored[first - order:end - order] = True
            held.append(np.unique(keys[scored], return_counts=True))
            waiting += len(held[-1][0])
            if waiting > HELD:
                held = [_summed(np.concatenate([k for k, _ in held]), np.concatenate([n for _, n in held]))]
                waiting = len(held[0][0])
                if waiting > HELD:
                    yield pa.RecordBatch.from_arrays([pa.array(held[0][0].astype(np.int64)), pa.array(held[0][1])], ["gram", "n"])
                    held, waiting = [], 0
        if held:
            keys, n = _summed(np.concatenate([k for k, _ in held]), np.concatenate([n for _, n in held]))
            yield pa.RecordBatch.from_arrays([pa.array(keys.astype(np.int64)), pa.array(n)], ["gram", "n"])

    return texts.select("text").mapInArrow(run, "gram bigint, n bigint").groupBy("gram").agg(F.sum("n").alias("n"))


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, n) over all of ``texts``."""
    def run(batches):
        import pyarrow as pa

        def handed(held):
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], ["word", "n"])

        held: Counter = Counter()
        for batch in batches:
            for _, texts in slices(batch):
                for text in texts:
                    held.update(normal_words(text))
                if len(held) >= HELD_WORDS:
                    yield handed(held)
                    held = Counter()
        yield handed(held)

    return texts.select("text").mapInArrow(run, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def low_bytes(gram: Column, n: int) -> Column:
    return gram.bitwiseAND(F.lit((1 << (8 * n)) - 1))


def gram_levels(texts: DataFrame, order: int = ORDER) -> list[DataFrame]:
    """Stored (gram, n) by order: item k has the runs of k + 1 bytes."""
    levels = [stored(gram_counts(texts, order), "grams")]
    for k in range(order - 1, -1, -1):
        shorter = levels[0].groupBy(low_bytes(F.col("gram"), k + 1).alias("gram")).agg(F.sum("n").alias("n"))
        levels.insert(0, stored(shorter, "grams"))
    return levels


def of_all_orders(levels: list[DataFrame]) -> DataFrame:
    every = levels[0].withColumn("k", F.lit(0))
    for k, level in enumerate(levels[1:], 1):
        every = every.unionByName(level.withColumn("k", F.lit(k)))
    return every


def made(kept: DataFrame, order: int) -> Trie:
    """Trie of the n-grams (k, gram, n)."""
    import numpy as np

    table = kept.toArrow()
    k, gram, n = (table[c].to_numpy() for c in ("k", "gram", "n"))
    return Trie([gram[k == i].astype(np.uint64) for i in range(order + 1)], [n[k == i] for i in range(order + 1)])


def context_facts(level: DataFrame, k: int) -> DataFrame:
    """(gram, n, owner, total, symbols, taken) of a level: sums over the n-grams with the same context.

    ``taken`` is what the context's symbols count in the next shorter one. Both windows have at most
    256 rows of a key, one for each value of the first or last byte.
    """
    shorter = F.sum("n").over(Window.partitionBy(low_bytes(F.col("gram"), k))) if k else F.lit(0).cast("bigint")
    own = Window.partitionBy("owner")
    return level.withColumn("shorter", shorter).withColumn("owner", F.shiftrightunsigned("gram", 8)).select(
        "gram", "n", "owner", F.sum("n").over(own).alias("total"), F.count(F.lit(1)).over(own).alias("symbols"),
        F.sum("shorter").over(own).alias("taken"))


def log_probabilities(grams: DataFrame, levels: list[DataFrame], longest: DataFrame) -> DataFrame:
    """(gram, logp): natural log of the probability of the last byte of each n-gram of full length.

    ``grams`` are distinct, ``longest`` the ``context_facts`` of the last level.
    """
    order = len(levels) - 1
    left = grams.select("gram", F.lit(0.0).alias("spent"), F.lit(0).cast("bigint").alias("above"), F.lit(0).cast("bigint").alias("above_symbols"))
    out = None
    for k in range(order, -1, -1):
        small = F.broadcast if k < LOW else lambda df: df
        facts = longest if k == order else context_facts(levels[k], k)
        contexts = facts.groupBy("owner").agg(*[F.max(c).alias(c) for c in ("total", "symbols", "taken")])
        seen = levels[k].select(F.col("gram").alias("own"), "n")
        mass, kinds = F.col("total") - F.col("above"), F.col("symbols") - F.col("above_symbols")
        now = left.withColumn("own", low_bytes(F.col("gram"), k + 1)).withColumn("owner", F.shiftrightunsigned("own", 8))
        now = now.join(small(seen), "own", "left").join(small(contexts), "owner", "left").select(
            "gram", F.when(F.col("n").isNotNull(), F.col("spent") + F.log((2 * F.col("n") - 1) / (2 * mass))).alias("logp"),
            (F.col("spent") + F.when(kinds > 0, F.log(kinds / (2 * mass))).otherwise(0.0)).alias("spent"),
            F.coalesce("taken", F.lit(0)).alias("above"), F.coalesce("symbols", F.lit(0)).alias("above_symbols"))
        now = stored(now, "walk")
        found = now.filter("logp IS NOT NULL").select("gram", "logp")
        out = found if out is None else out.unionByName(found)
        left = now.filter("logp IS NULL").drop("logp")
    bytes_left = F.greatest(F.lit(256) - F.col("above_symbols"), F.lit(1))
    return out.unionByName(left.select("gram", (F.col("spent") - F.log(bytes_left)).alias("logp")))


def hot_logs(longest: DataFrame, model_rows: int) -> dict:
    """Index and finished logarithms of the most frequent n-grams of full length, ``model_rows`` at most."""
    import numpy as np

    kept = longest.filter(F.col("n") >= least_count(longest, model_rows)).select(
        "gram", F.log((2 * F.col("n") - 1) / (2 * F.col("total"))).alias("logp")).toArrow()
    return {"index": vars(Index(kept["gram"].to_numpy().astype(np.uint64))), "logs": kept["logp"].to_numpy()}


def hot_word_table(words: DataFrame) -> tuple[bytes, object, object]:
    """Words as one run of bytes with their ends, and their counts."""
    import numpy as np

    table = words.select("word", F.octet_length("word").alias("size"), "n").toArrow()
    return b"".join(table["word"].to_pylist()), np.cumsum(table["size"].to_numpy()), table["n"].to_numpy()


def word_logs(table, scale: float) -> dict[bytes, float]:
    """Logarithms by word; words with equal counts share the number."""
    text, ends, counts = table
    by_count: dict[int, float] = {}
    out, at = {}, 0
    for end, n in zip(ends.tolist(), counts.tolist(), strict=True):
        if n not in by_count:
            by_count[n] = math.log10(n + 0.5) - scale
        out[text[at:end]] = by_count[n]
        at = end
    return out


class Hot:
    """Logarithms of the n-grams of ``hot_logs``; those of others are missing."""

    def __init__(self, plain: dict, order: int):
        self.order, self.logs = order, plain["logs"]
        self.index = Index.__new__(Index)
        self.index.__dict__.update(plain["index"])

    def lookup(self, stream):
        """(logp, n-grams, positions) from the ``order``-th byte on; the latter two of what is missing, where logp is 0."""
        import numpy as np

        n = len(stream) - self.order
        padded = np.concatenate([np.zeros(7 - self.order, np.uint8), stream])
        keys = np.ndarray((n,), ">u8", padded.tobytes(), strides=(1,)).astype(np.uint64)
        keys &= np.uint64((1 << (8 * (self.order + 1))) - 1)
        at = self.index.find(keys)
        logp = np.zeros(n)
        logp[at >= 0] = self.logs[at[at >= 0]]
        missing = np.flatnonzero(at < 0)
        return logp, keys[missing], missing


def score(documents: DataFrame, learns: Column, order: int = ORDER, model_rows: int = MODEL_ROWS,
          hot_words: int = HOT_WORDS) -> DataFrame:
    """(doc_id, learned, n_tokens, n_known, train_tokens, base_score, score) per row of ``documents``.

    The model and the word counts come from the rows where ``learns`` holds. ``score`` is the log10
    probability of the text under the trie; ``base_score`` that of its words and one end token
    under add-a-half unigrams. Null texts are empty: one end token. Rows sharing a doc_id are separate.
    Without training rows every byte is equally likely. An empty table gives no rows; other columns
    are not read.

    Counts of frequent words are broadcast (``hot_words`` at most), all others are joined. So are
    n-grams where the trie has more than ``model_rows``; no n-gram is left out of the model.
    """
    spark = documents.sparkSession
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"),
                            F.coalesce(learns, F.lit(False)).alias("learned"))
    learned = rows.filter("learned")
    words = stored(word_counts(learned), "words")
    facts = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    ends = learned.count()
    total, different = facts["n"] + ends, facts["v"] + (ends > 0)
    scale = math.log10(total + 0.5 * (different + 1))
    least = least_count(words, hot_words)
    levels = gram_levels(learned, order)
    whole = sum(level.count() for level in levels) <= model_rows
    if whole:
        grams = made(of_all_orders(levels), order).plain()
    else:
        longest = stored(context_facts(levels[order], order), "contexts")
        grams = hot_logs(longest, model_rows)
    model = spark.sparkContext.broadcast((grams, hot_word_table(words.filter(F.col("n") >= least))))
    del grams

    def run(batches):
        import numpy as np
        import pyarrow as pa

        arrays, table = model.value
        trie = Trie.of(arrays) if whole else Hot(arrays, order)
        logs = word_logs(table, scale)
        end_log = math.log10(ends + 0.5) - scale
        part, index = TaskContext.get().partitionId() << 40, 0

        def lists(offsets, **columns):
            fields = pa.StructArray.from_arrays(list(columns.values()), list(columns))
            return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), fields)

        def missed(parts, size):
            """Lists of (gram, n) by text, from parts of (texts, n-grams, counts)."""
            of, gram, n = (np.concatenate(c) for c in zip(*parts, strict=True)) if parts else np.empty((3, 0), np.int64)
            by = np.argsort(of, kind="stable")
            return lists(np.searchsorted(of[by], np.arange(size + 1)), gram=pa.array(gram[by].astype(np.int64)), n=pa.array(n[by].astype(np.int64)))

        for batch in batches:
            for start, texts in slices(batch):
                scores = np.zeros(len(texts))
                tokens, known, base, lost = [], [], [], []
                rare, times, rare_ends = [], [], [0]

                def items(texts=texts, tokens=tokens, known=known, base=base, rare=rare, times=times, rare_ends=rare_ends):
                    for i, text in enumerate(texts):
                        words = normal_words(text)
                        found = list(map(logs.get, words))
                        if None in found:
                            missing = Counter(w for w, x in zip(words, found, strict=True) if x is None)
                            rare.extend(missing)
                            times.extend(missing.values())
                            found = [x for x in found if x is not None]
                        rare_ends.append(len(rare))
                        tokens.append(len(words) + 1)
                        known.append(len(found) + (ends > 0))
                        base.append(math.fsum(found) + end_log)
                        yield i, words

                for data, spans in streams(items(), trie.order):
                    stream = np.frombuffer(data, np.uint8)
                    of, first, end = (np.asarray(c, np.int64) for c in zip(*spans, strict=True))
                    if whole:
                        logp = trie.log_probability(stream)
                    else:
                        logp, gram, spot = trie.lookup(stream)
                        span = np.searchsorted(first - trie.order, spot, side="right") - 1
                        inside = spot < end[span] - trie.order  # others are padding between texts
                        span, gram = span[inside], gram[inside]
                        by = np.lexsort((gram, span))
                        span, gram = span[by], gram[by]
                        new = np.flatnonzero(np.concatenate([[True], (span[1:] != span[:-1]) | (gram[1:] != gram[:-1])])) if len(span) else by
                        lost.append((of[span[new]], gram[new].astype(np.int64), np.diff(np.append(new, len(span)))))
                    sums = np.concatenate([[0.0], np.cumsum(logp)])
                    np.add.at(scores, of, sums[end - trie.order] - sums[first - trie.order])
                own = [batch[c].slice(start, len(texts)) for c in ("doc_id", "learned")]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(index, index + len(texts)) + part), *own, pa.array(tokens, pa.int64()), pa.array(known, pa.int64()),
                     pa.array(base, pa.float64()), pa.array(scores / math.log(10)),
                     lists(rare_ends, word=pa.array(rare, pa.binary()), n=pa.array(times, pa.int64())), missed(lost, len(texts))],
                    ["row", "doc_id", "learned", "n_tokens", "known", "base", "score", "rare", "lost"])
                index += len(texts)

    schema = ("row bigint, doc_id bigint, learned boolean, n_tokens bigint, known bigint, base double, score double, "
              "rare array<struct<word:binary,n:bigint>>, lost array<struct<gram:bigint,n:bigint>>")
    scored = stored(rows.mapInArrow(run, schema), "scored")
    others = scored.select("row", F.explode("rare").alias("r")).select("row", F.col("r.word").alias("word"), F.col("r.n").alias("times"))
    seen = F.coalesce("n", F.lit(0))
    sums = others.join(words.filter(F.col("n") < least), "word", "left").groupBy("row").agg(
        F.sum(F.col("times") * (F.log10(seen + 0.5) - F.lit(scale))).alias("more_base"),
        F.sum(F.when(seen > 0, F.col("times")).otherwise(0)).alias("more_known"))
    score = F.col("score")
    if not whole:
        lost = scored.select("row", F.explode("lost").alias("l")).select("row", "l.gram", F.col("l.n").alias("times"))
        logs = log_probabilities(lost.select("gram").distinct(), levels, longest)
        more = lost.join(logs, "gram").groupBy("row").agg((F.sum(F.col("times") * F.col("logp")) / math.log(10)).alias("more_score"))
        sums, score = sums.join(more, "row", "full"), score + F.coalesce("more_score", F.lit(0.0))
    return scored.drop("rare", "lost").join(sums, "row", "left").select(
        "doc_id", "learned", "n_tokens", (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(total).cast("bigint").alias("train_tokens"), (F.col("base") + F.coalesce("more_base", F.lit(0.0))).alias("base_score"), score.alias("score"))


def score_documents(documents: DataFrame, held_out: int = 1, modulus: int = 5) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score); learns from what isn't held out."""
    found = score(documents, remainder("doc_id", modulus) != held_out)
    return found.select("doc_id", (~F.col("learned")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
