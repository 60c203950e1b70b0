from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from causeway.llm import packing
from causeway.llm.queries import QUERIES
from causeway.llm.tokens import Coder, byte_bpe
from tests.llm.data import documents, odd_rows, prose, table


@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return t


TEXTS = ["", " ", "  a  b ", "a  b  \n c", "x \x1c y \u0085 z", "　 ᠎ a ​ b", " " * 3000 + "x" + " " * 2999, "a\n b \n",
         "it's 'quoted 's x", "<|endoftext|> a <|endoftext|>", "日本語 テスト 123 ١٢٣ a̧ ﻿", "\t\ta \x0b b\x0cc", " lead", "trail ", "! " * 500,
         "   a  b", "é ̀x ỳ", "a  b c d\x85", "don't  can't  won't"]


def test_ids_equal_the_tokenizers_library(tokenizer, sf):
    coder = Coder(*byte_bpe())
    texts = TEXTS + [t for (t,) in table(sf, "documents", "text")]
    for text, expected in zip(texts, tokenizer.encode_batch(texts, add_special_tokens=False), strict=True):
        assert np.frombuffer(coder.encode(text), "<u4").tolist() == expected.ids, text[:80]


def test_added_tokens_are_found_as_the_unmodified_library_does(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    token = "<|endoftext|>"
    texts = TEXTS + [f"hello {token} world", token, token * 3, f"a{token}b", f"x  {token}  y", f" {token} \n{token}\n", "<|endoftext", prose(50, 1),
                     "a" * 30_000 + token, f"{token} " + "1" * 30_000, f"{prose(2000, 8)} {token}"]
    coder = Coder(*byte_bpe(), added=True)
    for text in texts:
        assert np.frombuffer(coder.encode(text), "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids, text[:80]
    found = packing.pack(documents(spark, list(enumerate(texts))), 1024, 2).collect()
    check(found, plain, dict(enumerate(texts)))


def check(rows, tokenizer, texts, capacity=1024):
    pieces, bins = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        bins[r.sequence_id].append((r.offset, r.length))
    for own in bins.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    for doc, text in texts.items():
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        own = sorted(pieces.pop(doc), key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(len(own))) and own[0].start == 0
        assert all(r.length == capacity for r in own[1:])
        for r in own:
            part = np.asarray(ids[r.start:r.start + r.length], "<u4")
            assert len(part) == r.length and zlib.crc32(part.tobytes()) == r.ids_crc32
        assert sum(r.length for r in own) == len(ids)
    assert not pieces
    return len(bins)


def test_query(spark, sf, tokenizer):
    rows = QUERIES["op1_packing"](spark, sf).collect()
    used = check(rows, tokenizer, dict(table(sf, "documents", "doc_id, text")))
    assert used <= 1.01 * (-(-sum(r.length for r in rows) // 1024))


def test_odd_rows(spark, tokenizer):
    rows = [(i, text) for i, (_, text) in enumerate(odd_rows())]
    found = packing.pack(documents(spark, rows), 1024, 2).collect()
    check(found, tokenizer, dict(rows))
    assert all(len(r.ids) == r.length for r in found)
    same = packing.pack(documents(spark, [(None, "a"), (None, "a"), (3, "a"), (3, "a")]), 16, 2).collect()
    assert sorted((r.doc_id or -1, r.length) for r in same) == [(-1, 2), (-1, 2), (3, 2), (3, 2)]
    assert packing.pack(documents(spark, []), 1024, 2).collect() == []


@pytest.mark.parametrize("seed", range(30))
def test_plan_places_every_item_once(seed):
    rng = random.Random(seed)
    capacity = rng.choice([7, 30, 100, 1024])
    counts = Counter(rng.randint(1, capacity) for _ in range(rng.randint(1, 400)))
    used, seen = defaultdict(list), defaultdict(set)
    for s in packing.plan(counts, capacity):
        for i in range(s.items):
            assert s.rank + i not in seen[s.length]
            seen[s.length].add(s.rank + i)
            assert i // s.copies < s.items
            used[s.bin + i // s.copies].append((s.offset + i % s.copies * s.length, s.length))
    assert {k: set(range(n)) for k, n in counts.items()} == dict(seen)
    for own in used.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
        assert sum(3 * length > capacity for _, length in own) <= 2
    total = sum(k * n for k, n in counts.items())
    large = sum(n for k, n in counts.items() if 2 * k > capacity)
    assert len(used) <= max(1.25 * max(total / capacity, large) + 2, large)


def test_large_items_are_matched():
    """Six against five: each half finds its partner, as an optimal matching would."""
    used = {s.bin for s in packing.plan({60: 3, 40: 3, 55: 2, 45: 2}, 100)}
    assert len(used) <= 5
    assert max(s.bin + -(-s.items // s.copies) for s in packing.plan({60: 3, 40: 3, 55: 2, 45: 2}, 100)) == 5


def test_long_texts_of_one_class(tokenizer):
    coder = Coder(*byte_bpe())
    for text in ("a" * 30_000, "\n" * 30_000, "1" * 30_000, prose(3000, 9)):
        assert np.frombuffer(coder.encode(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_sequences_are_written_in_order(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(300)
    packing.pack(docs, 256, 2, in_order=True).write.parquet(str(tmp_path / "packed"))
    import pyarrow.parquet as pq

    rows = [r for f in sorted((tmp_path / "packed").glob("*.parquet")) for r in pq.read_table(f).to_pylist()]
    places = [(r["sequence_id"], r["offset"]) for r in rows]
    assert places == sorted(places)
    ends = {}
    for r in rows:  # each sequence's ids follow each other without a gap
        assert r["offset"] == ends.get(r["sequence_id"], 0) and len(r["ids"]) == r["length"]
        ends[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(ends.values()) <= 256
