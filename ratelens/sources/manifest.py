"""The request manifest: a CSV file (or folder of files) with a header line
and at least 19 fields per row, addressed by position.

Read as all-string columns ``_c0 .. _cN`` (the width is taken from the
header line, its names discarded), then the used positions are projected
to named columns.  Quoted fields may hold commas, quotes and line breaks.
A row with too few fields is kept whole in ``_corrupt`` and routed to the
re-attempt output, never dropped and never fatal; fields beyond the header's
are ignored, as fields are read by position.

``request_id`` is ``<file>:<row number in file>`` (data rows from 1), where
the file is given relative to the manifest's folder (its name, if the path is
that file): duplicates stay distinct requests, and a file's keys stay the same
whatever other files are added.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratelens.functions.text import price_decimal, stay_date

# Manifest field positions (0-based) used by the job.
FIELD_POSITIONS = {
    "hotel_id": 0,
    "hotel": 1,
    "city": 4,
    "check_in": 10,
    "check_out": 12,
    "nights": 14,
    "listed_base_price": 15,
    "fees": 16,
    "average_price": 17,
    "total_price": 18,
}
MIN_WIDTH = 19
CORRUPT = "_corrupt"

def _reader(spark: SparkSession, multi_line: bool = True):
    return (spark.read.option("header", True).option("multiLine", multi_line)
            .option("escape", '"').option("quote", '"').option("encoding", "UTF-8"))


def manifest_width(spark: SparkSession, path: str) -> int:
    """Number of fields in the header line (reads the header only)."""
    return max(MIN_WIDTH, len(_reader(spark).csv(path).columns))


def manifest_header(spark: SparkSession, path: str) -> list[str]:
    """The header line's field names (reads the header only)."""
    return _reader(spark).csv(path).columns


def _records(spark: SparkSession, path: str) -> DataFrame:
    """CSV records of files that several tasks may read: ``source_file``,
    ``row_in_file`` (the header is 0) and ``record``, its lines joined.

    Physical lines are read by split.  A line starts a record if an even number
    of quotes stands before it in its file: the quotes before it in its split,
    by a running sum, and those of the file's earlier splits, from a table with
    one row per split.  That parity isn't known inside a split, so record starts
    are counted for both.  A line with paired quotes of its own is a record; the
    lines of others are grouped by their record's number (gaps and islands).
    """
    lines = (spark.read.option("lineSep", "\n").text(path)
             .select(F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.file_block_start").alias("block"),
                     F.monotonically_increasing_id().alias("id"), F.regexp_replace("value", "\r$", "").alias("line"))
             .withColumn("quotes", F.regexp_count("line", F.lit('"')))
             .withColumn("blank", F.btrim("line") == ""))
    here = Window.partitionBy("source_file", "block").orderBy("id")
    before = F.coalesce(F.sum("quotes").over(here.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) % 2
    so_far = here.rowsBetween(Window.unboundedPreceding, 0)
    counted = lines.withColumn("odd", before)
    for parity in (0, 1):  # if the split's start stands outside quotes, or inside
        starts = (F.col("odd") == parity) & ~F.col("blank")
        counted = counted.withColumn(f"starts_{parity}", F.sum(starts.cast("long")).over(so_far))
    splits = counted.groupBy("source_file", "block").agg(
        F.sum("quotes").alias("quotes"), F.max("starts_0").alias("n_0"), F.max("starts_1").alias("n_1"))
    earlier = Window.partitionBy("source_file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("begins", F.coalesce(F.sum("quotes").over(earlier), F.lit(0)) % 2)
    own = F.when(F.col("begins") == 0, F.col("n_0")).otherwise(F.col("n_1"))
    splits = splits.withColumn("n", own).select(
        "source_file", "block", "begins", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("rows_before"))
    placed = (counted.join(splits, ["source_file", "block"])
              .withColumn("inside", (F.col("begins") + F.col("odd")) % 2 == 1)
              .where("inside OR NOT blank")
              .withColumn("row_in_file", F.col("rows_before") + F.when(F.col("begins") == 0, F.col("starts_0"))
                          .otherwise(F.col("starts_1")) - 1))
    whole = (F.col("quotes") % 2 == 0) & ~F.col("inside")
    single = placed.where(whole).select("source_file", "row_in_file", F.col("line").alias("record"))
    parts = F.array_sort(F.collect_list(F.struct("block", "id", "line")))
    several = (placed.where(~whole).groupBy("source_file", "row_in_file")
               .agg(F.array_join(F.transform(parts, lambda x: x["line"]), "\n").alias("record")))
    return single.unionByName(several)


def _request_id(path: str):
    """``<file relative to the manifest's folder>:<row number>``."""
    plain = re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "", path)
    if glob := re.search(r"[*?\[{]", plain):  # the folder above the first wildcard
        plain = plain[:glob.start()].rpartition("/")[0]
    root = F.lit(plain.rstrip("/") + "/")
    at = F.position(root, F.col("source_file"))
    name = F.when(at > 0, F.substr("source_file", at + F.length(root))).otherwise(
        F.element_at(F.split("source_file", "/"), -1))
    return F.concat(name, F.lit(":"), F.col("row_in_file").cast("string")).alias("request_id")


def read_manifest_raw(spark: SparkSession, path: str, width: int | None = None,
                      multi_line: bool | str = True) -> DataFrame:
    """All fields as strings ``_c0..``, ``_corrupt``, ``source_file``,
    ``row_in_file``, ``request_id``.

    ``multi_line=True`` (the default) allows line breaks inside quoted fields;
    large files are read by several tasks.  Quotes then must be CSV's: around a
    field, or doubled inside one.  ``"whole"`` reads a file by one task, as
    Spark's reader does, and takes a lone quote inside a plain field as a
    character.  ``False`` is for files without line breaks inside fields."""
    width = width or manifest_width(spark, path)
    schema = T.StructType(
        [T.StructField(f"_c{i}", T.StringType(), True) for i in range(width)]
        + [T.StructField(CORRUPT, T.StringType(), True)]
    )
    if multi_line is True:
        options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "escape": '"', "quote": '"',
                   "multiLine": "true"}
        columns = ", ".join(f"{f.name} string" for f in schema.fields)
        rows = (_records(spark, path).where("row_in_file > 0")  # the header
                .withColumn("_rl_fields", F.from_csv("record", columns, options)))
        return rows.select("_rl_fields.*", "source_file", "row_in_file", _request_id(path))
    raw = (_reader(spark, bool(multi_line)).schema(schema).option("enforceSchema", True)
           .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
           .csv(path))
    # Rows of one file split (the whole file when multi-line) are read in
    # order by one task, so their ids are consecutive: the row number is the
    # id minus the split's first id, plus the rows of the file's earlier
    # splits.  The per-split table has one row per split.
    raw = raw.select("*", F.col("_metadata.file_path").alias("source_file"),
                     F.col("_metadata.file_block_start").alias("_rl_block"),
                     F.monotonically_increasing_id().alias("_rl_id"))
    splits = raw.groupBy("source_file", "_rl_block").agg(
        F.min("_rl_id").alias("_rl_first"), F.count(F.lit(1)).alias("_rl_n"))
    earlier = Window.partitionBy("source_file").orderBy("_rl_block").rowsBetween(
        Window.unboundedPreceding, -1)
    splits = splits.select("source_file", "_rl_block", "_rl_first",
                           F.coalesce(F.sum("_rl_n").over(earlier), F.lit(0)).alias("_rl_before"))
    numbered = raw.join(splits, ["source_file", "_rl_block"]).withColumn(
        "row_in_file",
        (F.col("_rl_before") + F.col("_rl_id") - F.col("_rl_first") + 1).cast("long"))
    return numbered.withColumn("request_id", _request_id(path)).drop("_rl_id", "_rl_first", "_rl_block", "_rl_before")


def _malformed():
    """The row has fewer than ``MIN_WIDTH`` fields (a row with another number
    of fields than the header is in ``_corrupt`` as well, but the fields read
    by position are all there).  Written so that it also reads ``_c0``: Spark
    refuses a CSV scan whose only data column is the corrupt-record column
    (e.g. ``filter("malformed").count()``)."""
    corrupt = F.col(CORRUPT)
    bare = F.regexp_replace(corrupt, '"(?:[^"]|"")*"', "")  # without quoted commas
    return F.when(corrupt.isNull() & F.col("_c0").isNull(), F.lit(False)).otherwise(
        corrupt.isNotNull() & (F.regexp_count(bare, F.lit(",")) < MIN_WIDTH - 1))


def read_manifest(spark: SparkSession, path: str, width: int | None = None,
                  multi_line: bool | str = True) -> DataFrame:
    """Requests with named columns, raw strings kept, typed prices added.

    Columns: ``request_id, source_file, row_in_file, hotel_id, hotel, city,
    check_in, check_out, nights, listed_base_price, fees, average_price,
    total_price, nights_int, check_in_date, check_out_date,
    listed_base_price_num, malformed, _corrupt``.
    """
    raw = read_manifest_raw(spark, path, width, multi_line)
    named = [F.col(f"_c{pos}").alias(name) for name, pos in FIELD_POSITIONS.items()]
    return raw.select(
        "request_id", "source_file", "row_in_file", *named,
        F.col(f"_c{FIELD_POSITIONS['nights']}").try_cast("int").alias("nights_int"),
        stay_date(F.col(f"_c{FIELD_POSITIONS['check_in']}")).alias("check_in_date"),
        stay_date(F.col(f"_c{FIELD_POSITIONS['check_out']}")).alias("check_out_date"),
        price_decimal(F.col(f"_c{FIELD_POSITIONS['listed_base_price']}"))
        .alias("listed_base_price_num"),
        _malformed().alias("malformed"),
        CORRUPT,
    )


def sample_manifest(requests: DataFrame, n: int = 14) -> DataFrame:
    """The first ``n`` requests in file order: a quick-test run."""
    return requests.orderBy("source_file", "row_in_file").limit(n)


def reattempt_manifest(spark: SparkSession, path: str, reattempt: DataFrame,
                       width: int | None = None, multi_line: bool | str = True) -> DataFrame:
    """The original manifest rows (all fields, header names) of the requests
    to try again, so that the next run can read them as its manifest.
    Malformed rows cannot be fed back and stay only in the re-attempt output."""
    header = manifest_header(spark, path)
    raw = read_manifest_raw(spark, path, width, multi_line).filter(~_malformed())
    keys = reattempt.select("request_id").distinct()
    rows = raw.join(keys, "request_id", "left_semi")
    return rows.select(*[F.col(f"_c{i}").alias(h) for i, h in enumerate(header)])
