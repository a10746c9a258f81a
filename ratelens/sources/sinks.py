"""Writing the run's outputs.

* offers: parquet (typed) under ``offers/run_date=<date>``, plus the legacy
  CSV projection and its backup copy, written only when there is at least
  one row;
* re-attempts: CSV with a header, written even when empty, so "nothing to
  retry" is visible;
* summary and per-request outcomes (status, reason, offer count, capture
  used): parquet.

CSV is written with ``"`` as the escape character so that quotes inside a
field are doubled (what Python's ``csv`` module and pandas read back),
embedded commas and line breaks survive the round trip.

Outputs are published together: everything is written to a staging folder
first, then moved to paths that contain the run date, in place of an earlier
run's, and a marker is set that readers check (``published``,
``read_output``).  A run that fails while writing leaves the earlier outputs
and their marker as they were; one that fails while moving leaves no marker.
Counts (is there any offer; the summary) are observed by the job that writes
the outcomes: nothing is read twice.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ratelens.operators.offers import legacy_projection
from ratelens.operators.outcome import BROKEN, CONTACT, NO_SELLERS, NOT_AVAILABLE, OFFERS
from ratelens.plans.rateshop import RunOutputs


STATUSES = (OFFERS, NOT_AVAILABLE, CONTACT, BROKEN)
LEGACY_NAMES = ("final_data", "final_data_backup")


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Header line, RFC 4180 quoting; ``single_file`` only for small outputs."""
    out = df.coalesce(1) if single_file else df
    (out.write.mode("overwrite").option("header", True).option("escape", '"')
     .option("quote", '"').option("emptyValue", "").csv(path))


def read_csv(spark, path: str, schema) -> DataFrame:
    """Read back a CSV written by :func:`write_csv`."""
    return (spark.read.schema(schema).option("header", True).option("escape", '"')
            .option("multiLine", True).csv(path))


def request_order(request_id: str = "request_id") -> list:
    """Sort columns for the manifest's order: file, row number in the file
    (as a number), then the id itself for ids of another form."""
    row = F.element_at(F.split(request_id, ":"), -1).try_cast("long")
    return [F.regexp_replace(request_id, ":[0-9]+$", ""), row, F.col(request_id)]


class _Files:
    """The output folder's file system (any that Spark writes to)."""

    def __init__(self, spark: SparkSession, base: str):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(base).getFileSystem(spark._jsc.hadoopConfiguration())

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)

    def exists(self, path: str) -> bool:
        return bool(self._fs.exists(self._path(path)))

    def move(self, source: str, target: str) -> None:
        """Put ``source`` in the place of whatever is at ``target``."""
        self.delete(target)
        self._fs.mkdirs(self._path(target).getParent())
        if not self._fs.rename(self._path(source), self._path(target)):
            raise OSError(f"cannot move {source} to {target}")

    def touch(self, path: str) -> None:
        self._fs.create(self._path(path), True).close()


def _marker(base: str, run_date: str) -> str:
    return f"{base}/_committed_{run_date}"


def published(spark: SparkSession, out_dir: str, run_date: str) -> bool:
    """Are the outputs of this run date complete?"""
    base = out_dir.rstrip("/")
    return _Files(spark, base).exists(_marker(base, run_date))


def read_output(spark: SparkSession, out_dir: str, run_date: str, name: str = "offers") -> DataFrame:
    """A published parquet output (``offers``, ``summary``, ``outcomes``); an
    error if the run date isn't published or wrote no such output."""
    base = out_dir.rstrip("/")
    if not published(spark, base, run_date):
        raise FileNotFoundError(f"no complete run of {run_date} in {base}")
    return spark.read.parquet(f"{base}/{name}/run_date={run_date}")


def _observed(outcomes: DataFrame) -> tuple[DataFrame, Observation]:
    """``outcomes`` with counts taken by the job that writes it."""
    seen, metrics = Observation(), []
    for status in STATUSES:
        here = F.col("status") == status
        metrics += [F.count_if(here).alias(f"requests_{status}"),
                    F.sum(F.when(here, F.col("n_offers").cast("long"))).alias(f"offers_{status}"),
                    F.count_if(here & (F.coalesce("reason", F.lit("")) == NO_SELLERS)).alias(f"no_sellers_{status}")]
    return outcomes.observe(seen, *metrics), seen


def write_outputs(outputs: RunOutputs, out_dir: str, run_date: str,
                  legacy_csv: bool = True, ordered: bool = False) -> dict[str, str]:
    """Write all outputs of one run and publish them; returns the paths.

    ``ordered`` sorts the legacy CSV by request and position (a range
    shuffle; the files are then in that order one after the other)."""
    base = out_dir.rstrip("/")
    spark = outputs.outcomes.sparkSession
    files = _Files(spark, base)
    staging = f"{base}/_staging/{run_date}-{uuid.uuid4().hex}"
    final = {"outcomes": f"{base}/outcomes/run_date={run_date}", "summary": f"{base}/summary/run_date={run_date}",
             "reattempt": f"{base}/reattempt_{run_date}", "offers": f"{base}/offers/run_date={run_date}"}
    final |= {name: f"{base}/{name}_{run_date}" for name in LEGACY_NAMES}
    written = ["outcomes", "summary", "reattempt"]
    try:
        # every request once, with its outcome: the audit trail behind the summary
        outcomes, seen = _observed(outputs.outcomes)
        outcomes.select("request_id", "hotel_id", "status", "reason", "n_offers",
                        "page_id", "captured_at").write.parquet(f"{staging}/outcomes")
        counts = seen.get
        rows = [(s, *(counts[f"{k}_{s}"] or 0 for k in ("requests", "offers", "no_sellers"))) for s in STATUSES]
        spark.createDataFrame([r for r in rows if r[1]], "status string, requests long, offers long, no_sellers long") \
            .coalesce(1).write.parquet(f"{staging}/summary")
        write_csv(outputs.reattempt, f"{staging}/reattempt")
        # seller rows, and a row per request without sellers
        if counts[f"offers_{OFFERS}"] or counts[f"requests_{NOT_AVAILABLE}"] or counts[f"requests_{CONTACT}"]:
            offers = outputs.offers
            offers.write.parquet(f"{staging}/offers")
            written.append("offers")
            if legacy_csv:
                src = offers.orderBy(*request_order("request_id"),
                                     F.col("scrape_position").asc_nulls_first()) if ordered else offers
                legacy = legacy_projection(src)
                for name in LEGACY_NAMES:
                    write_csv(legacy, f"{staging}/{name}")
                    written.append(name)
        # all is written: now in place of the earlier run's outputs
        files.delete(_marker(base, run_date))
        for name, path in final.items():
            if name in written:
                files.move(f"{staging}/{name}", path)
            else:  # a rerun without offers leaves none of the earlier run behind
                files.delete(path)
        files.touch(_marker(base, run_date))
    finally:
        files.delete(staging)
    return {name: final[name] for name in written}
