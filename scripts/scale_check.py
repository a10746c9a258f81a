"""Numbering at a size where buckets are used: copies of the line items
(keys made distinct per copy), with one key holding a third of the rows.
Compares ``row_number_within`` with Spark's window and reports time and the
largest number of hot-key rows in one task.

Usage: python scripts/scale_check.py [copies]
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from ratelens.operators.numbering import row_number_within  # noqa: E402
from ratelens.session import get_session  # noqa: E402

ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "copy"]


def main() -> None:
    copies = int(sys.argv[1]) if len(sys.argv) > 1 else 10
    spark = get_session("local[8]", 32)
    li = spark.read.parquet("/root/testdata/sf0.1/lineitem.parquet").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity")
    parts = [li.withColumn("copy", F.lit(c)) for c in range(copies)]
    data = parts[0]
    for p in parts[1:]:
        data = data.unionByName(p)
    data = data.withColumn(
        "k", F.when(F.col("l_partkey") % 3 == 0, F.lit(-1))
        .otherwise(F.col("l_orderkey") * 100 + F.col("copy")))
    data = data.repartition(32, "copy", "l_orderkey").cache()
    n = data.count()

    t = time.time()
    ours = row_number_within(data, ["k"], ORDER, "rn")
    ours_rows = ours.select("k", *ORDER, "rn").cache()
    ours_rows.count()
    t_ours = time.time() - t
    per_task = (ours.withColumn("p", F.spark_partition_id()).groupBy("p")
                .agg(F.sum((F.col("k") == -1).cast("long")).alias("hot"), F.max("rn").alias("m"))
                .agg(F.max("hot").alias("hot"), F.max("m").alias("m")).first())

    t = time.time()
    plain = data.withColumn("rn", F.row_number().over(Window.partitionBy("k").orderBy(*ORDER)))
    plain_rows = plain.select("k", *ORDER, "rn").cache()
    plain_rows.count()
    t_plain = time.time() - t

    diff = ours_rows.exceptAll(plain_rows).count() + plain_rows.exceptAll(ours_rows).count()
    hot = data.filter("k = -1").count()
    print(f"rows={n} hot_key_rows={hot} differences={diff}")
    print(f"bucketed: {t_ours:.1f}s, largest hot-key share of one task: {per_task.hot} rows")
    print(f"plain window: {t_plain:.1f}s, hot key in one task: {hot} rows")


if __name__ == "__main__":
    main()
