"""Language identification by segmentation-marginalised unigrams.

Every language has probabilities over the pieces of a fixed public vocabulary. A text's likelihood sums
over all segmentations of its words into pieces, by the forward algorithm; single bytes are pieces,
so every text has one. Words are runs without ASCII white space, signs and digits included, with a blank in
front; they don't share pieces, so a word is summed once and then counted. ASCII letters are lower-cased.

Probabilities are fitted by expectation maximisation: expected piece counts come from forward and
backward sums over word counts that Spark adds up.
"""

from __future__ import annotations

import math
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from causeway.llm.common import remainder, text_slices
from causeway.session import cut_lineage

FIT_DOCUMENTS = 1500  # expected number of documents per language that the fit reads
ITERATIONS = 2
FLOOR = 1e-4  # share of probability spread evenly over all pieces
CACHE_LIMIT = 500_000  # words kept per task; the cache is emptied when full
HELD_WORDS = 250_000  # different words a task gathers before it hands them on
TEXT_BYTES = 1 << 20  # texts that are strings at a time
CACHE_CELLS = 4_000_000  # words times languages kept per task
LINEAR = 32  # bytes of a word up to which products can't underflow


class Pieces:
    """Vocabulary as a prefix table: bytes to piece number, -1 for a mere prefix."""

    def __init__(self, model_path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        found: dict[bytes, None] = {bytes([b]): None for b in range(256)}
        for i in range(model.get_piece_size()):
            if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                found.setdefault(model.id_to_piece(i).replace("▁", " ").encode())
        self.size = len(found)
        table = {piece: i for i, piece in enumerate(found)}
        for piece in found:
            for end in range(1, len(piece)):
                table.setdefault(piece[:end], -1)
        self.table = table

    def edges(self, word: bytes) -> list[tuple[int, int, int]]:
        """Pieces of ``word`` as (start, end, number), starts ascending."""
        get, n, out = self.table.get, len(word), []
        for i in range(n):
            for j in range(i + 1, n + 1):
                piece = get(word[i:j])
                if piece is None:
                    break
                if piece >= 0:
                    out.append((i, j, piece))
        return out


class Steps:
    """The prefix table as an array of transitions, for the pieces of many words at a time."""

    def __init__(self, table: dict[bytes, int]):
        import numpy as np

        inner = {prefix[:-1] for prefix in table} | {b""}
        states = sorted(table.keys() | inner, key=lambda prefix: (prefix not in inner, prefix))  # those that go on come first
        number = {prefix: i for i, prefix in enumerate(states, 1)}  # 0: no such prefix
        self.root, self.inner = number[b""], len(inner)
        self.after = np.zeros((self.inner + 1, 257), np.int32)  # the last column is the end of a word
        self.after[[number[prefix[:-1]] for prefix in table], [prefix[-1] for prefix in table]] = [number[prefix] for prefix in table]
        self.piece = np.array([-1] + [table.get(prefix, -1) for prefix in states], np.int64)

    def edges(self, words: list[bytes], sizes):
        """Pieces of the words up to ``LINEAR`` bytes: end, word, start and piece in one number each."""
        import numpy as np

        text = np.zeros(int(sizes.sum()) + len(words), np.int16)
        text[:] = np.frombuffer(b"\0".join([*words, b""]), np.uint8)
        first = np.cumsum(sizes + 1) - sizes - 1
        text[first + sizes] = 256
        short = np.flatnonzero(sizes <= LINEAR)
        own = np.repeat(short, sizes[short])
        start = np.arange(len(own)) - np.repeat(np.cumsum(sizes[short]) - sizes[short], sizes[short])
        at, tag = first[own] + start, (start << 38 | own << 26 | start << 20)
        state, found = np.full(len(own), self.root, np.int32), []
        while len(at):
            state = self.after[state, text[at]]
            at, tag = at + 1, tag + (1 << 38)  # the end moves on by a byte
            piece = self.piece[state]
            hit = piece >= 0
            found.append(tag[hit] | piece[hit])
            on = (state > 0) & (state <= self.inner)
            state, at, tag = state[on], at[on], tag[on]
        return np.concatenate(found) if found else np.empty(0, np.int64)


def log_add(x: float, y: float) -> float:
    if x < y:
        x, y = y, x
    return x if y == -math.inf else x + math.log1p(math.exp(y - x))


def log_likelihoods(words: list[bytes], pieces: Pieces, p, log_p: list[list[float]]):
    """Logs of the sums over all segmentations: a row per word, a column per language.

    The forward sums of many words go on together, from end position to end position.
    """
    import numpy as np

    out = np.zeros((len(words), len(p)))
    by_piece = np.ascontiguousarray(p.T)
    if not hasattr(pieces, "steps"):
        pieces.steps = Steps(pieces.table)
    for at in range(0, len(words), 4096):
        long = [(k, pieces.edges(word)) for k, word in enumerate(words[at:at + 4096]) if len(word) > LINEAR]
        n = np.fromiter(map(len, words[at:at + 4096]), np.int64)
        edge = np.sort(pieces.steps.edges(words[at:at + 4096], n))  # sorting orders them by end and word
        steps = np.searchsorted(edge >> 38, np.arange(1, LINEAR + 2))
        word_of, start, piece_of = (edge >> 26) & 4095, (edge >> 20) & 63, edge & ((1 << 20) - 1)
        a = np.zeros((len(n), LINEAR + 1, len(p)))
        a[:, 0] = 1
        for j in range(1, LINEAR + 1):
            part = slice(steps[j - 1], steps[j])
            own = word_of[part]
            if len(own):
                first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
                a[own[first], j] = np.add.reduceat(a[own, start[part]] * by_piece[piece_of[part]], first)
        short = np.flatnonzero(n <= LINEAR)
        out[at + short] = np.log(a[short, n[short]])
        for k, edges in long:
            for i, own in enumerate(log_p):
                b = [0.0] + [-math.inf] * int(n[k])
                for x, y, piece in edges:
                    b[y] = log_add(b[y], b[x] + own[piece])
                out[at + k, i] = b[-1]
    return out


def expected_counts(edges, n: int, p, log_p, times: float, into: dict[int, float]) -> None:
    """Add ``times`` the expected uses of each piece in a word of ``n`` bytes."""
    if n <= LINEAR:
        a, b = [1.0] + [0.0] * n, [0.0] * n + [1.0]
        for i, j, piece in edges:
            a[j] += a[i] * p[piece]
        scale = times / a[n]
        for i, j, piece in reversed(edges):
            use = p[piece] * b[j]
            b[i] += use
            into[piece] = into.get(piece, 0.0) + a[i] * use * scale
        return
    a, b = [0.0] + [-math.inf] * n, [-math.inf] * n + [0.0]
    for i, j, piece in edges:
        a[j] = log_add(a[j], a[i] + log_p[piece])
    for i, j, piece in reversed(edges):
        b[i] = log_add(b[i], b[j] + log_p[piece])
    for i, j, piece in edges:
        into[piece] = into.get(piece, 0.0) + times * math.exp(a[i] + log_p[piece] + b[j] - a[n])


def words_of(text: str) -> list[bytes]:
    return text.encode().lower().split()


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class LanguageModel:
    """Piece probabilities per language: ``languages`` and a matrix of their probabilities."""

    def __init__(self, languages, probabilities, model_path: str):
        self.languages, self.probabilities, self.model_path = languages, probabilities, model_path

    @classmethod
    def fit(cls, documents: DataFrame, fit_documents: int = FIT_DOCUMENTS, iterations: int = ITERATIONS,
            model_path: str | None = None) -> LanguageModel:
        """Fit on (text, lang) rows; rows with a null in either take no part.

        A language with more than ``fit_documents`` rows is sampled down to about that number by a hash of
        the text; counts of languages cover all rows. Only piece sums per language reach the driver.
        """
        import numpy as np

        path = model_path or vocabulary_path()
        rows = documents.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")).filter(
            "text IS NOT NULL AND lang IS NOT NULL")
        share = {r["lang"]: min(1.0, fit_documents / r["n"]) for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
        languages = sorted(share)
        size = Pieces(path).size
        p = np.full((len(languages), size), 1.0 / size)
        if not languages:
            return cls(languages, p, path)
        limits = F.create_map(*[F.lit(x) for lang in languages for x in (lang, share[lang])])
        draw = F.pmod(F.xxhash64("text"), F.lit(1 << 20)) / F.lit(float(1 << 20))
        sample = rows.filter(draw < F.element_at(limits, F.col("lang")))

        def count(batches):
            import pyarrow as pa

            held: Counter = Counter()
            for batch in batches:
                for part in text_slices(batch, TEXT_BYTES):
                    for lang, text in zip(part["lang"].to_pylist(), part["text"].to_pylist(), strict=True):
                        held.update((lang, word) for word in words_of(text))
                    if len(held) >= HELD_WORDS:
                        yield _counted(pa, held)
                        held = Counter()
            yield _counted(pa, held)

        words = sample.mapInArrow(count, "lang string, word binary, n bigint").groupBy("lang", "word").agg(F.sum("n").alias("n"))
        words = cut_lineage(words)
        for _ in range(iterations):
            log_p, linear, codes = np.log(p), p, {lang: i for i, lang in enumerate(languages)}

            def expect(batches, log_p=log_p, linear=linear, codes=codes):
                import pyarrow as pa

                pieces, held = Pieces(path), {}
                own, own_linear = log_p.tolist(), linear.tolist()
                for batch in batches:
                    for lang, word, n in zip(*(batch[c].to_pylist() for c in ("lang", "word", "n")), strict=True):
                        word = b" " + word
                        code = codes[lang]
                        expected_counts(pieces.edges(word), len(word), own_linear[code], own[code], n, held.setdefault(code, {}))
                flat = [(code, piece, n) for code, sums in held.items() for piece, n in sums.items()]
                columns = list(zip(*flat, strict=True)) or [[], [], []]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.float64())],
                    ["lang", "piece", "n"])

            sums = words.mapInArrow(expect, "lang int, piece int, n double").groupBy("lang", "piece").agg(F.sum("n").alias("n"))
            counts = np.zeros_like(p)
            for r in sums.collect():  # at most languages x pieces
                counts[r["lang"], r["piece"]] = r["n"]
            total = np.maximum(counts.sum(1, keepdims=True), 1e-300)
            p = (1 - FLOOR) * counts / total + FLOOR / size
        return cls(languages, p, path)

    def predict(self, documents: DataFrame, names=("lang_pred", "lang_score")) -> DataFrame:
        """Add the likeliest language and its share among all languages (0 to 1) to ``documents``.

        Only ``text`` is read. Null texts and texts without a letter get ``und`` and 0, as does everything if
        no language was learned. Ties go to the first language by name. Whole texts count; repeated
        words are summed once. Columns named as the results are replaced.
        """
        languages, p, path = self.languages, self.probabilities, self.model_path

        def run(batches):
            import numpy as np
            import pyarrow as pa

            pieces, log_p = Pieces(path), np.log(p).tolist()
            cache: dict[bytes, int] = {}
            room = min(CACHE_LIMIT, max(1, CACHE_CELLS // max(1, len(languages))))
            table = np.empty((0, len(languages)))

            def sums_of(texts: list[list[bytes]]):
                """Log likelihoods of documents given as words."""
                nonlocal table
                new = list({w for words in texts for w in words if w not in cache})
                if len(cache) + len(new) > len(table):
                    cache.clear()
                    new = list({w for words in texts for w in words})
                    if max(room, len(new)) != len(table):  # more than room only where one group needs it
                        table = np.empty((max(room, len(new)), len(languages)))
                table[len(cache):len(cache) + len(new)] = log_likelihoods([b" " + w for w in new], pieces, p, log_p)
                cache.update(zip(new, range(len(cache), len(cache) + len(new)), strict=True))
                at = np.fromiter((cache[w] for words in texts for w in words), np.int64)
                ends = np.cumsum([len(words) for words in texts])
                total = np.concatenate([np.zeros((1, len(languages))), np.cumsum(table[at], 0)])
                return total[ends] - total[np.concatenate([[0], ends[:-1]])]

            def judged(part):
                best, share = ["und"] * part.num_rows, np.zeros(part.num_rows)
                rows: list[int] = []
                held: list[list[bytes]] = []
                for i, text in enumerate(part["text"].to_pylist()):
                    if text is None or not languages or not any(map(str.isalpha, text)):
                        continue
                    rows.append(i)
                    held.append(words_of(text))
                if rows:
                    for i, own in zip(rows, sums_of(held), strict=True):
                        at = int(np.argmax(own))
                        best[i], share[i] = languages[at], 1 / np.exp(own - own[at]).sum()
                kept = [c for c in part.schema.names if c not in names]
                return pa.RecordBatch.from_arrays([*[part[c] for c in kept], pa.array(best, pa.string()), pa.array(share)], [*kept, *names])

            for batch in batches:
                for part in text_slices(batch, TEXT_BYTES):
                    yield judged(part)

        kept = documents.drop(*names).withColumn("text", F.col("text").cast("string"))
        schema = StructType(list(kept.schema)).add(names[0], "string").add(names[1], "double")
        return kept.mapInArrow(run, schema)


def _counted(pa, held: Counter):
    keys = list(held)
    return pa.RecordBatch.from_arrays(
        [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.binary()),
         pa.array([held[k] for k in keys], pa.int64())], ["lang", "word", "n"])


def identify(documents: DataFrame, held_out: int = 2, modulus: int = 4) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) per row; learns from the rows that aren't held out."""
    model = LanguageModel.fit(documents.filter(remainder("doc_id", modulus) != held_out))
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                            (remainder("doc_id", modulus) == held_out).alias("held_out"), "text")
    return model.predict(rows).select("doc_id", "held_out", "lang_pred", F.col("lang_score").alias("score"))


def keep_identified(documents: DataFrame, least: float = 0.5) -> DataFrame:
    """Documents with a language: without null and letterless texts and those with a share under ``least``."""
    found = LanguageModel.fit(documents).predict(documents, ("_lang_pred", "_lang_share"))
    return found.filter((F.col("_lang_pred") != "und") & (F.col("_lang_share") >= least)).drop("_lang_pred", "_lang_share")
