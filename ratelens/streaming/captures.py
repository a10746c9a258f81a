"""Structured Streaming over a folder of captured pages.

The scraper keeps dropping capture files (parquet) into a folder; this
query picks up new files, runs each micro-batch through the same plan as
the batch run (stream-static join with the requests), and writes offers,
re-attempts and per-request outcomes.

Exactly-once output without a transactional sink: each micro-batch writes
to a folder named by its epoch id with ``overwrite``, so a batch that
Spark re-runs after a failure replaces its own earlier attempt instead of
appending twice.  The stream's progress lives in ``checkpointLocation``
(a durable folder; only a local master may leave it out).

A request captured again in a later batch appears in several epochs;
``latest_outcomes`` keeps the latest capture per request over all epochs.

``requests`` is joined with every micro-batch: pass a table read from
parquet (the manifest written once), not the CSV reader itself.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ratelens.operators.extract import NativeLayout, ParsedLayout
from ratelens.plans.rateshop import run_rate_shop
from ratelens.session import checkpoint_dir
from ratelens.sources.sinks import write_csv

CAPTURE_SCHEMA = ("request_id string, page_id bigint, url string, html string, "
                  "captured_at timestamp_ntz")


def stream_rate_shop(spark: SparkSession, requests: DataFrame, capture_dir: str,
                     layouts: Sequence[NativeLayout] | Sequence[ParsedLayout],
                     out_dir: str, run_date: str, checkpoint_location: str | None = None,
                     available_now: bool = True, max_files_per_trigger: int | None = None,
                     query_name: str = "rate_shop", extra_prices: bool = False,
                     require_dates: bool = False) -> StreamingQuery:
    """Start the incremental run; returns the running query.  ``extra_prices``
    and ``require_dates`` are passed to :func:`run_rate_shop`."""
    reader = spark.readStream.schema(CAPTURE_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    captures = reader.parquet(capture_dir)
    base = out_dir.rstrip("/")

    def process(batch: DataFrame, epoch_id: int) -> None:
        out = run_rate_shop(requests, batch, layouts, run_date, cut_lineage=True,
                            captured_only=True, extra_prices=extra_prices,
                            require_dates=require_dates)
        part = f"run_date={run_date}/epoch={epoch_id}"
        out.outcomes.drop("page").write.mode("overwrite").parquet(f"{base}/outcomes/{part}")
        out.offers.write.mode("overwrite").parquet(f"{base}/offers/{part}")
        write_csv(out.reattempt, f"{base}/reattempt/{part}")

    if checkpoint_location is None and not spark.sparkContext.master.startswith("local"):
        raise ValueError("give checkpoint_location: the stream's progress must outlive the driver")
    location = checkpoint_location or f"{checkpoint_dir(spark).rstrip('/')}/stream-{query_name}"
    writer = (captures.writeStream.queryName(query_name).foreachBatch(process)
              .option("checkpointLocation", location))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime="30 seconds")
    return writer.start()


def latest_offers(spark: SparkSession, out_dir: str, run_date: str) -> DataFrame:
    """Offers of the captures that :func:`latest_outcomes` keeps: rows of
    superseded captures, which stay in their epochs' folders, are left out."""
    offers = spark.read.parquet(f"{out_dir.rstrip('/')}/offers/run_date={run_date}")
    latest = latest_outcomes(spark, out_dir, run_date).select("request_id", "epoch")
    return offers.join(latest, ["request_id", "epoch"], "left_semi")


def missing_requests(spark: SparkSession, requests: DataFrame, out_dir: str, run_date: str) -> DataFrame:
    """Requests that no epoch has an outcome for, with the reason
    (``malformed_row`` or ``no_capture``): the end-of-run report."""
    done = latest_outcomes(spark, out_dir, run_date).select("request_id")
    malformed = F.col("malformed") if "malformed" in requests.columns else F.lit(False)
    return requests.join(done, "request_id", "left_anti").select(
        "request_id", F.when(malformed, "malformed_row").otherwise("no_capture").alias("reason"))


def latest_outcomes(spark: SparkSession, out_dir: str, run_date: str) -> DataFrame:
    """One outcome per request over all epochs: the latest capture wins."""
    df = spark.read.parquet(f"{out_dir.rstrip('/')}/outcomes/run_date={run_date}")
    order = [F.col("captured_at").desc_nulls_last(), F.col("page_id").desc_nulls_last(),
             F.col("epoch").desc()]
    w = Window.partitionBy("request_id").orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")
