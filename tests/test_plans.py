"""Physical-plan properties the design depends on."""

import re

from ratelens.plans.rateshop import run_rate_shop

from golden import LAYOUTS, PAGES


def _exchange_inputs(df):
    """Column lists entering every Exchange of the formatted plan."""
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue()
    blocks = re.split(r"\n\(\d+\) ", text)
    return [b for b in blocks if b.startswith("Exchange") or b.startswith("BroadcastExchange")]


def test_markup_never_crosses_a_key_shuffle(spark, tmp_dir):
    n = spark.sparkContext.defaultParallelism * 2
    rows = [(f"r{i}", i, "u", PAGES["offers"], None) for i in range(200)]
    caps = spark.createDataFrame(rows, "request_id string, page_id bigint, url string, "
                                       "html string, captured_at timestamp_ntz")
    caps.repartition(n).write.parquet(tmp_dir + "/caps")
    captures = spark.read.parquet(tmp_dir + "/caps")
    requests = spark.createDataFrame(
        [(f"r{i}", str(i), "H", "C", "a", "b", "1", "$1") for i in range(200)],
        "request_id string, hotel_id string, hotel string, city string, check_in string, "
        "check_out string, nights string, listed_base_price string")
    out = run_rate_shop(requests, captures, LAYOUTS, "2024-05-01", cut_lineage=False)
    for df in (out.outcomes, out.offers, out.summary):
        exchanges = _exchange_inputs(df)
        assert exchanges, "expected at least one exchange"
        for block in exchanges:
            inputs = re.search(r"Input \[\d+\]: \[([^\]]*)\]", block)
            assert inputs and "html#" not in inputs.group(1), block[:300]


def test_scan_reads_only_needed_columns(spark):
    import __spark_entry__ as E
    from conftest import SF_SMALL
    plan = E.queries()["searched_dates"](spark, SF_SMALL)._jdf.queryExecution() \
        .executedPlan().toString()
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert "html" not in schema and "url" in schema


def test_hot_request_join_is_split_by_aqe(spark):
    from pyspark.sql import functions as F

    from ratelens.operators.joins import with_offers
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        # one request holds half of all offers
        offers = spark.range(20000).select(
            F.when(F.col("id") % 2 == 0, F.lit(7)).otherwise(F.col("id") % 500)
            .alias("request_id"), F.col("id").alias("offer"))
        requests = spark.range(600).select(F.col("id").alias("request_id"),
                                           (F.col("id") * 10).alias("hotel_id"))
        joined = with_offers(requests, offers, "request_id")
        got = sorted(tuple(r) for r in joined.collect())
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan, plan[:2000]
        want = sorted(tuple(r) for r in requests.join(offers, "request_id", "left")
                      .select(*joined.columns).collect())
        assert got == want
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
