from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import pytest
import xxhash

from causeway.llm import sharding
from causeway.llm.queries import QUERIES
from tests.llm.data import documents, odd_rows, table


def mix(value: int, key: int, modulus: int) -> int:
    first = xxhash.xxh64(value.to_bytes(8, "little", signed=True), seed=42).intdigest()
    last = xxhash.xxh64(key.to_bytes(8, "little", signed=True), seed=first).intdigest()
    return (last - (1 << 64) if last >> 63 else last) % modulus


def position(x: int, n: int, seed: int = 0) -> int:
    a, b = sharding.domain(n)
    while True:
        left, right = divmod(x, b)
        for k in range(sharding.ROUNDS):
            if k % 2 == 0:
                left = (left + mix(right, seed * 64 + k, a)) % a
            else:
                right = (right + mix(left, seed * 64 + k, b)) % b
        x = left * b + right
        if x < n:
            return x


@pytest.mark.parametrize("n", [1, 2, 3, 5, 17, 1000])
def test_permutation(spark, n):
    from pyspark.sql import functions as F

    rows = spark.range(n).withColumn("x", F.col("id"))
    there = sharding.permute(rows, "x", n, 7)
    assert {r.id: r.x for r in there.collect()} == {i: position(i, n, 7) for i in range(n)}
    assert len({r.x for r in there.collect()}) == n
    back = sharding.permute(there, "x", n, 7, inverse=True)
    assert all(r.id == r.x for r in back.collect())


def test_query_is_the_permutation_of_doc_order(spark, sf):
    docs = sorted(table(sf, "documents", "doc_id, text"))
    found = {r.doc_id: r for r in QUERIES["op5_sharding"](spark, sf).collect()}
    for i, (doc, text) in enumerate(docs):
        raw, r = (text or "").encode(), found.pop(doc)
        at = position(i, len(docs))
        assert (r.size, r.text_crc32, r.shard, r.slot, r.law, r.grown_shard) == (len(raw) + 1, zlib.crc32(raw), at % 16, at // 16, "rows", None)
    assert not found


def test_odd_rows(spark):
    rows = odd_rows() + [(7, "same")] * 50
    frame = documents(spark, rows)
    whole = sharding.shard_documents(frame, 4)
    assert whole.columns == [*frame.columns, "shard", "slot"]
    assert Counter((r.doc_id, r.text, r.n_chars) for r in whole.collect()) == Counter((r.doc_id, r.text, r.n_chars) for r in frame.collect())
    found = sharding.text_facts(whole).collect()
    slots = defaultdict(list)
    for r in found:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert Counter((r.doc_id, r.size) for r in found) == Counter((d, len((t or "").encode()) + 1) for d, t in rows)
    assert sharding.text_facts(sharding.shard_documents(documents(spark, []), 4)).collect() == []
    assert [r.slot for r in sharding.shard_documents(documents(spark, [(None, None)]), 4).collect()] == [0]


def test_written_shards_hold_whole_rows_in_order(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    sharding.write_shards(sharding.shard_documents(docs, 5), str(tmp_path / "out"))
    read = spark.read.parquet(str(tmp_path / "out"))
    assert Counter((r.doc_id, r.text, r.lang) for r in read.collect()) == Counter((r.doc_id, r.text, r.lang) for r in docs.collect())
    for k in range(5):
        files = sorted((tmp_path / "out" / f"shard={k}").glob("*.parquet"))
        slots = [x.as_py() for f in files for x in __import__("pyarrow.parquet", fromlist=["x"]).read_table(f)["slot"]]
        assert slots == list(range(len(slots))) and abs(len(slots) - docs.count() / 5) < 1
