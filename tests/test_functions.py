from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from causeway.functions import columns as C
from causeway.functions import stats, text, vectors
from causeway.session import scratch_path
from causeway.sources.tables import ad_facts, read_csv


def test_t_tail_closed_forms():
    for t in (0.0, 0.3, 1.7, 4.0):
        assert stats.t_two_sided(t, 2) == pytest.approx(1 - t / math.sqrt(2 + t * t), abs=1e-13)
        assert stats.t_two_sided(t, 1) == pytest.approx(1 - 2 / math.pi * math.atan(t), abs=1e-13)
    assert stats.t_two_sided(1.959963984540054, 1e7) == pytest.approx(0.05, abs=1e-6)
    assert stats.t_two_sided(-2.0, 10) == stats.t_two_sided(2.0, 10)


def test_normal_and_chi2_tails():
    assert stats.normal_two_sided(1.959963984540054) == pytest.approx(0.05, abs=1e-12)
    assert stats.chi2_one_tail(3.841458820694124) == pytest.approx(0.05, abs=1e-12)


def test_one_sample_t():
    t, p = stats.one_sample_t([1.0, 2.0, 3.0])
    assert t == pytest.approx(2 / (1 / math.sqrt(3)))
    assert 0 < p < 0.1
    assert math.isnan(stats.one_sample_t([1.0])[1])


def test_csv_null_tokens_and_types(spark):
    path = scratch_path(spark, "csv")
    rows = [("Doe", "1960-01-02", "3"), ("NA", "not a day", "N/A"), ("", "1990-12-31", "7")]
    spark.createDataFrame(rows, "last_name string, birthday string, terms string").write.option("header", True).csv(path)
    schema = T.StructType().add("last_name", "string").add("birthday", "string").add("terms", "long")
    out = read_csv(spark, path, schema).withColumn("birthday", C.parse_date(F.col("birthday"))).collect()
    found = sorted((r.last_name or "", str(r.birthday), r.terms or -1) for r in out)
    assert found == [("", "1990-12-31", 7), ("", "None", -1), ("Doe", "1960-01-02", 3)]


def test_ad_facts_schema(spark):
    with pytest.raises(ValueError, match="Spend"):
        ad_facts(spark.createDataFrame([("2024-01-01", "a", 1.0)], "Date string, channel string, Impressions double"))


def test_positive_check(spark):
    df = spark.createDataFrame([(1.0, 2.0), (0.0, 3.0)], "a double, b double")
    C.require_positive(df, ["b"])
    with pytest.raises(ValueError, match="a"):
        C.require_positive(df, ["a", "b"])


def test_one_hot_unseen_level_is_zero(spark):
    train = spark.createDataFrame([("x",), ("y",), ("z",), (None,)], "g string")
    enc = C.OneHot.fit(train, ["g"])
    assert enc.names == ["g_y", "g_z"]
    out = enc.transform(spark.createDataFrame([("y",), ("new",), (None,)], "g string")).collect()
    assert [(r.g_y, r.g_z) for r in out] == [(1, 0), (0, 0), (0, 0)]
    with pytest.raises(ValueError, match="levels"):
        C.OneHot.fit(train, ["g"], max_levels=2)


def test_ordinal_unknown_raises(spark):
    df = spark.createDataFrame([("I",), ("III",), (None,)], "g string")
    assert [r[0] for r in df.select(C.ordinal(F.col("g"), ["I", "II", "III"])).collect()] == [0, 2, None]
    with pytest.raises(Exception, match="unknown level"):
        df.select(C.ordinal(F.col("g"), ["I", "II"])).collect()


def test_scaler_round_trip_and_zero_mean(spark):
    df = spark.createDataFrame([(1.0,), (3.0,)], "a double")
    s = C.MeanScaler.fit(df, ["a"])
    assert [r.a for r in s.transform(df).collect()] == [0.5, 1.5]
    assert [r.a for r in s.inverse(s.transform(df)).collect()] == [1.0, 3.0]
    with pytest.raises(ValueError, match="mean"):
        C.MeanScaler.fit(spark.createDataFrame([(1.0,), (-1.0,)], "a double"), ["a"])


def test_hill_and_hinge(spark):
    df = spark.createDataFrame([(0.0,), (2.0,)], "x double")
    out = df.select(C.hill(F.col("x"), 2.0, 3.0).alias("h"), C.hinge(F.col("x"), 0.5).alias("g")).collect()
    assert [(r.h, r.g) for r in out] == [(0.0, 0.0), (0.5, 1.5)]


def test_vectors(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0], [4.0, 5.0, 6.0])], "a array<double>, b array<double>")
    ones = F.array(*[F.lit(v) for v in (1.0, 1.0, -1.0, -1.0, 1.0, 1.0, -1.0, -1.0)])
    r = df.select(vectors.dot(F.col("a"), F.col("b")).alias("d"), vectors.norm_l1(ones).alias("l1"),
                  vectors.norm_l2(ones).alias("l2"),
                  vectors.linear_map(F.array(F.lit(3.0), F.lit(2.0)), [[2, -2], [1, -2]]).alias("m")).first()
    assert (r.d, r.l1, r.l2, r.m) == (32.0, 8.0, pytest.approx(math.sqrt(8)), [2.0, -1.0])


def test_matrix_product(spark):
    a = spark.createDataFrame([(i, j, float(v)) for i, row in enumerate([[1, 2, 3], [4, 5, 6]]) for j, v in enumerate(row)], "i int, j int, v double")
    b = spark.createDataFrame([(i, j, float(v)) for i, row in enumerate([[2, 1], [2, 1], [2, 1]]) for j, v in enumerate(row)], "i int, j int, v double")
    got = {(r.i, r.j): r.v for r in vectors.matrix_product(a, b).collect()}
    assert got == {(0, 0): 12.0, (0, 1): 6.0, (1, 0): 30.0, (1, 1): 15.0}
    assert vectors.transpose(a).count() == 6


def test_text(spark):
    df = spark.createDataFrame([("hello, WORLD!LOW",)], "t string")
    kept = text.strip_class(F.col("t"), "[a-z, !]")
    r = df.select(kept.alias("k"), text.distinct_chars(kept).alias("u"),
                  text.concat_descending(F.array(F.lit(15), F.lit(1), F.lit(93))).alias("d"),
                  text.codes_to_text(F.array(*[F.lit(c) for c in (72, 105, 33)])).alias("c")).first()
    assert (r.k, r.u, r.d, r.c) == ("WORLDLOW", "WORLD", "93151", "Hi!")
