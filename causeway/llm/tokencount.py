"""Token counts by heap-and-linked-list byte-pair merging; no identifiers are made.

A text is cut into the pieces of the vocabulary's pattern. The bytes of a piece are a linked list of
symbols and its adjacent pairs lie in a heap by rank: the lowest pair is popped and merged, the pairs
it makes with its neighbours are pushed, and popped pairs whose symbols have changed are skipped. A
piece has as many tokens as it had bytes less the merges made. Counts of pieces are kept per task.
"""

from __future__ import annotations

import json
import re
import unicodedata
from heapq import heapify, heappop, heappush

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEPT_PIECES = 300_000  # counts kept per task; emptied when full
LONGEST_KEPT = 40  # characters
STRETCH = 1 << 16  # characters of a text that are cut into pieces at once


def byte_symbols() -> list[str]:
    """The character that stands for each byte in vocabulary files: itself if it prints, else one from 256 on."""
    printing = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printing]
    names = {b: chr(b) for b in printing} | {b: chr(256 + i) for i, b in enumerate(others)}
    return [names[b] for b in range(256)]


def merges(symbols: list[str], ranks: dict[tuple[str, str], int]) -> int:
    """Merges made on one piece; ``symbols`` is used up. Of pairs with one rank the leftmost goes first."""
    n = len(symbols)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(ranks[pair], i, *pair) for i, pair in enumerate(zip(symbols, symbols[1:], strict=False)) if pair in ranks]
    heapify(heap)
    made = 0
    while heap:
        _, i, a, b = heappop(heap)
        j = after[i]
        if symbols[i] != a or j == n or symbols[j] != b:
            continue
        symbols[i], symbols[j] = a + b, ""
        made += 1
        after[i] = k = after[j]
        for left, right in ((before[i], i), (i, k)):
            if left >= 0 and right < n and (pair := (symbols[left], symbols[right])) in ranks:
                heappush(heap, (ranks[pair], left, *pair))
        if k < n:
            before[k] = i
    return made


class PieceCounts(dict):
    """Tokens by piece, counted when first asked for."""

    def __init__(self, ranks: dict[tuple[str, str], int]):
        super().__init__()
        self._ranks, self._symbols = ranks, byte_symbols()

    def __missing__(self, piece: str) -> int:
        symbols = [self._symbols[b] for b in piece.encode()]
        n = len(symbols) - merges(symbols, self._ranks)
        if len(piece) <= LONGEST_KEPT:
            if len(self) >= KEPT_PIECES:
                self.clear()
            self[piece] = n
        return n


class TokenCounter:
    """Counts of one vocabulary file with byte-level pieces. One object per task.

    The file's added tokens count as one wherever their strings stand in a text.
    """

    def __init__(self, json_path: str, pattern: str):
        import regex

        with open(json_path, encoding="utf-8") as file:
            told = json.load(file)
        model, added = told["model"], told["added_tokens"]
        if (model["type"], told["normalizer"], told["pre_tokenizer"]["type"]) != ("BPE", None, "ByteLevel"):
            raise ValueError("not a plain byte-level BPE vocabulary")
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in added):
            raise ValueError("added tokens that take in white space or whole words only aren't supported")
        pairs = (tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"])
        self._counts = PieceCounts({pair: rank for rank, pair in enumerate(pairs)})
        self._plain = regex.compile(pattern).findall
        self._json_path, self._library = json_path, None
        names = sorted((t["content"] for t in added), key=len, reverse=True)
        self._added = re.compile("|".join(map(re.escape, names))) if names else None
        self._cut = re.compile(r"(?<=[^\s\x1c-\x1f]) (?=[^\s\x1c-\x1f])")  # no piece reaches over such a space

    def _stretches(self, text: str):
        """The text in runs of about ``STRETCH`` characters, cut where no piece is."""
        at = 0
        while len(text) - at > STRETCH:
            cut = self._cut.search(text, at + STRETCH)
            if cut is None:
                break
            yield text[at:cut.start()]
            at = cut.start()
        yield text[at:] if at else text

    def _pieces(self, run: str) -> list[str]:
        """Pieces of the pattern. Characters of newer Unicode versions have another class in the pattern engine
        than in the tokenizer library, so runs that hold one are cut by the library."""
        if run.isascii() or all(unicodedata.category(c) != "Cn" for c in set(run)):
            return self._plain(run)
        if self._library is None:
            from tokenizers import Tokenizer

            self._library = Tokenizer.from_file(self._json_path).pre_tokenizer
        return [run[a:b] for _, (a, b) in self._library.pre_tokenize_str(run)]

    def count(self, text: str) -> int:
        parts = self._added.split(text) if self._added else [text]
        return len(parts) - 1 + sum(
            sum(map(self._counts.__getitem__, self._pieces(run))) for part in parts for run in self._stretches(part))


def byte_bpe() -> tuple[str, str]:
    """Arguments of ``TokenCounter`` for the installed 50k byte-level vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN


def count_tokens(documents: DataFrame, limit: int = 1024, files: tuple[str, str] | None = None) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every text; one narrow pass.

    Null and empty texts have no bytes and no tokens; null and repeated doc_ids keep a row each; an empty
    table gives no rows; other columns are not read. Texts of any length are cut into pieces run by run.
    """
    files = files or byte_bpe()

    def run(batches):
        import pyarrow as pa

        counter = TokenCounter(*files)
        for batch in batches:
            texts = batch.column("text")
            found = [counter.count(texts[i].as_py()) for i in range(len(texts))]  # one text as a string at a time
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_bytes"), pa.array(found, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = documents.select("doc_id", F.octet_length(text).cast("bigint").alias("n_bytes"), text.alias("text"))
    counted = rows.mapInArrow(run, rows.drop("text").schema.add("n_tokens", "long"))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
