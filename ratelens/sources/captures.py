"""The captured-page table: one row per capture of a request.

``request_id string, page_id bigint, url string, html string,
captured_at timestamp_ntz`` — ``page_id``, ``url`` and ``captured_at`` are
optional in the files and filled with NULL when absent.  Parquet is the
primary format (column pruning keeps ``html`` out of every plan that does
not extract); JSON lines are accepted for scrapers that append text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CAPTURE_COLUMNS = {
    "request_id": "string",
    "page_id": "bigint",
    "url": "string",
    "html": "string",
    "captured_at": "timestamp_ntz",
}


def conform_captures(df: DataFrame) -> DataFrame:
    """Select the capture columns in order, cast, NULL for the missing ones."""
    missing = {"request_id", "html"} - set(df.columns)
    if missing:
        raise ValueError(f"captures need columns {sorted(missing)}")
    return df.select(*[
        (F.col(c) if c in df.columns else F.lit(None)).cast(t).alias(c)
        for c, t in CAPTURE_COLUMNS.items()
    ])


def read_captures(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Read capture files (``parquet`` or ``json`` lines) in the capture schema."""
    if fmt == "parquet":
        df = spark.read.parquet(path)
    elif fmt == "json":
        schema = ", ".join(f"{c} {'string' if t == 'timestamp_ntz' else t}"
                           for c, t in CAPTURE_COLUMNS.items())
        df = spark.read.schema(schema).json(path)
    else:
        raise ValueError(f"unsupported capture format: {fmt}")
    return conform_captures(df)
