"""Whole-run throughput: the captured pages of sf0.1 repeated ``copies``
times (ids made distinct), run with the native rules and with the HTML
parser rules.  Usage: python scripts/throughput.py [copies]
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from ratelens.plans.rateshop import run_rate_shop  # noqa: E402
from ratelens.plans.standins import PARSED_PAGE_LAYOUT, STANDIN_LAYOUT  # noqa: E402
from ratelens.session import get_session  # noqa: E402


def main() -> None:
    copies = int(sys.argv[1]) if len(sys.argv) > 1 else 10
    spark = get_session("local[8]", 8, driver_memory="8g")
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    union = None
    for i in range(copies):
        part = pages.select((F.col("page_id") * 1000 + i).alias("page_id"), "url", "html")
        union = part if union is None else union.unionByName(part)
    pages = union.repartition(2 * spark.sparkContext.defaultParallelism, "page_id").cache()
    n = pages.count()
    mb = pages.select(F.sum(F.length("html"))).first()[0] / 1e6
    rid = F.col("page_id").cast("string")
    none = F.lit(None).cast("string")
    captures = pages.select(rid.alias("request_id"), "page_id", "url", "html",
                            F.lit(None).cast("timestamp_ntz").alias("captured_at"))
    requests = pages.select(rid.alias("request_id"), rid.alias("hotel_id"),
                            F.lit("H").alias("hotel"), *[none.alias(c) for c in (
                                "city", "check_in", "check_out", "nights", "listed_base_price")])
    for name, rules in (("native", [STANDIN_LAYOUT]), ("parsed", [PARSED_PAGE_LAYOUT])):
        warm = run_rate_shop(requests, captures.limit(100), rules, "2024-01-15", cut_lineage=False)
        warm.offers.write.format("noop").mode("overwrite").save()
        t0 = time.time()
        out = run_rate_shop(requests, captures, rules, "2024-01-15", cut_lineage=False)
        out.offers.write.format("noop").mode("overwrite").save()
        secs = time.time() - t0
        print(f"{name}: {n} pages, {mb:.0f} MB of html in {secs:.1f} s "
              f"-> {n / secs:.0f} pages/s, {mb / secs:.1f} MB/s")


if __name__ == "__main__":
    main()
