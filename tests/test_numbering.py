import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ratelens.operators.numbering import global_row_number, row_number_within, with_chunk_id


def _rows(n, hot_share=0.34, seed=1):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        k = 7 if rnd.random() < hot_share else rnd.randint(0, 50)
        if rnd.random() < 0.02:
            k = None
        out.append((k, rnd.randint(0, 1000), i))
    return out


@pytest.mark.parametrize("ranges, hot_rows", [(1, 0), (3, 100), (11, 60), (None, 10_000)])
def test_row_number_within_matches_window(spark, ranges, hot_rows):
    df = spark.createDataFrame(_rows(3000), "k int, o int, u int")
    got = row_number_within(df, ["k"], ["o", "u"], "rn", hot_rows=hot_rows, n_ranges=ranges)
    want = df.withColumn("rn", F.row_number().over(Window.partitionBy("k").orderBy("o", "u")))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_hot_key_is_split(spark):
    df = spark.createDataFrame(_rows(4000, hot_share=0.5), "k int, o int, u int")
    got = row_number_within(df, ["k"], ["o", "u"], "rn", hot_rows=500, n_ranges=8)
    # the hot key's rows are numbered 1..n without gaps
    hot = [r.rn for r in got.filter("k = 7").select("rn").collect()]
    assert sorted(hot) == list(range(1, len(hot) + 1))
    # no task holds more than a part of them
    largest = got.filter("k = 7").groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert largest < len(hot) / 3


def test_global_row_number(spark):
    df = spark.createDataFrame(_rows(2000), "k int, o int, u int")
    got = global_row_number(df, ["o", "u"], "g", n_ranges=6)
    assert sorted(r.g for r in got.collect()) == list(range(1, 2001))
    want = df.withColumn("g", F.row_number().over(Window.orderBy("o", "u")).cast("long"))
    assert got.exceptAll(want).count() == 0


def test_chunk_id_cases(spark):
    df = spark.range(1, 121).withColumnRenamed("id", "row")
    got = {r.row: r.chunk_id for r in with_chunk_id(df, ["row"], 50).collect()}
    assert got[1] == 1 and got[50] == 1 and got[51] == 2 and got[120] == 3
    empty = spark.range(0).withColumnRenamed("id", "row")
    assert with_chunk_id(empty, ["row"], 50).count() == 0


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

_key = st.one_of(st.none(), st.sampled_from(["a", "b", "hot", "é", ""]))
_ord = st.one_of(st.none(), st.integers(-3, 3))


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(_key, _ord, _ord), min_size=1, max_size=120),
       st.integers(1, 9))
def test_numbering_equals_window_with_nulls_and_ties(spark, rows, buckets):
    rows = [(k, a, b, i) for i, (k, a, b) in enumerate(rows)]
    df = spark.createDataFrame(rows, "k string, a int, b int, u int")
    got = row_number_within(df, ["k"], ["a", F.col("b").desc(), "u"], "rn", hot_rows=5, n_ranges=buckets)
    want = df.withColumn("rn", F.row_number().over(
        Window.partitionBy("k").orderBy("a", F.col("b").desc(), "u")))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    g = global_row_number(df, ["k", "a", "u"], "g", n_ranges=buckets)
    want_g = df.withColumn("g", F.row_number().over(Window.orderBy("k", "a", "u")).cast("long"))
    assert g.exceptAll(want_g).count() == 0


def test_numbering_timestamp_and_decimal_keys(spark):
    import datetime as dt
    rows = [(dt.datetime(2024, 1, 1 + (i % 3)), i % 7 / 4, f"s'{i % 5}\\\\", i) for i in range(400)]
    df = spark.createDataFrame(rows, "t timestamp_ntz, d double, s string, u int") \
        .withColumn("m", (F.col("u") % 11).cast("decimal(10,2)"))
    got = row_number_within(df, ["t"], ["m", "s", "d", "u"], "rn", hot_rows=100, n_ranges=9)
    want = df.withColumn("rn", F.row_number().over(
        Window.partitionBy("t").orderBy("m", "s", "d", "u")))
    assert got.exceptAll(want).count() == 0
    g = global_row_number(df, ["t", "s", "u"], "g", n_ranges=7)
    want_g = df.withColumn("g", F.row_number().over(Window.orderBy("t", "s", "u")).cast("long"))
    assert g.exceptAll(want_g).count() == 0


def test_many_ranges_and_descending_order(spark):
    df = spark.createDataFrame(_rows(6000, hot_share=0.4, seed=3), "k int, o int, u int")
    order = [F.col("o").desc_nulls_last(), "u"]
    got = row_number_within(df, ["k"], order, "rn", hot_rows=1000, n_ranges=300)
    want = df.withColumn("rn", F.row_number().over(Window.partitionBy("k").orderBy(F.col("o").desc_nulls_last(), "u")))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    g = global_row_number(df, order, "g", n_ranges=300)
    want_g = df.withColumn("g", F.row_number().over(Window.orderBy(F.col("o").desc_nulls_last(), "u")).cast("long"))
    assert g.exceptAll(want_g).count() == 0 and g.count() == 6000


def test_several_keys_and_no_rows(spark):
    df = spark.createDataFrame([(i % 2, None if i % 3 else "x", i) for i in range(300)], "a int, b string, u int")
    got = row_number_within(df, ["a", "b"], ["u"], "rn", hot_rows=60, n_ranges=4)
    want = df.withColumn("rn", F.row_number().over(Window.partitionBy("a", "b").orderBy("u")))
    assert got.exceptAll(want).count() == 0 and got.schema["rn"].dataType.simpleString() == "int"
    assert row_number_within(df.limit(0), ["a"], ["u"]).count() == 0
    assert sorted(r.rn for r in row_number_within(df, [], ["u"], "rn").collect()) == list(range(1, 301))
