"""Token counts against the library."""

from __future__ import annotations

import random

import pytest

from causeway.llm import tokencount
from causeway.llm.queries import QUERIES
from causeway.llm.tokencount import TokenCounter, byte_bpe, count_tokens
from tests.llm.data import documents, odd_rows, prose, table


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    coder = Tokenizer.from_file(byte_bpe()[0])
    return lambda texts: [len(e.ids) for e in coder.encode_batch(texts, add_special_tokens=False)]


def test_given_documents(spark, sf, library):
    rows = table(sf, "documents", "doc_id, text")
    want = sorted((d, len((t or "").encode()), n, n > 1024) for (d, t), n in zip(rows, library([t or "" for _, t in rows]), strict=True))
    assert sorted(tuple(r) for r in QUERIES["op13_token_count"](spark, sf).collect()) == want


def test_odd_rows(spark, library):
    rows = odd_rows() + [(90, "a <|endoftext|> b<|endoftext|>"), (91, "<|endoftext|>"), (92, "it's  we'LL \n\n x'"), (93, "٣²½ 😀😀👩‍👩‍👧")]
    want = sorted(((d, len((t or "").encode()), n, n > 1024) for (d, t), n in zip(rows, library([t or "" for _, t in rows]), strict=True)), key=str)
    assert sorted((tuple(r) for r in count_tokens(documents(spark, rows)).collect()), key=str) == want
    assert count_tokens(documents(spark, rows).limit(0)).collect() == []


def test_every_character(library):
    """All code points next to letters, white space and themselves; unassigned ones too."""
    counter = TokenCounter(*byte_bpe())
    texts = [f"a{c} b  {c}{c}c {c}'s{c} 1{c}" for c in map(chr, range(0x110000)) if not 0xD800 <= ord(c) < 0xE000]
    texts = ["\n".join(texts[i:i + 16]) for i in range(0, len(texts), 16)]
    assert [counter.count(t) for t in texts] == library(texts)


def test_long_texts_are_cut_where_no_piece_is(monkeypatch, library):
    monkeypatch.setattr(tokencount, "STRETCH", 3)
    monkeypatch.setattr(tokencount, "KEPT_PIECES", 5)
    rng = random.Random(3)
    texts = ["".join(rng.choices(["a", "B", " ", " ", "\n", "\x1c", " ", "1", "'s", "é", ".", "<|endoftext|>"], k=60)) for _ in range(2000)]
    counter = TokenCounter(*byte_bpe())
    assert [counter.count(t) for t in texts] == library(texts)


def test_one_long_piece(library):
    texts = ["ab" * 30_000, "x" * 50_001, "é" * 20_000, prose(5000, 1).replace(" ", "")]
    counter = TokenCounter(*byte_bpe())
    assert [counter.count(t) for t in texts] == library(texts)


def test_other_vocabularies_are_refused():
    import public_tokenizers

    with pytest.raises(ValueError, match="plain byte-level"):
        TokenCounter(public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.PATTERN)
