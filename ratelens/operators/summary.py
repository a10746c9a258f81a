"""Coverage report and list sizes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratelens.operators.outcome import NO_SELLERS


def run_summary(outcomes: DataFrame, status: str = "status",
                n_offers: str = "n_offers", reason: str | None = None) -> DataFrame:
    """Requests and offer rows per outcome, from one row per request; with
    ``reason`` also the requests whose page listed no seller.

    Partial aggregation happens before the shuffle, so the exchange carries
    one row per outcome per task whatever the skew."""
    extra = [F.count_if(F.col(reason) == NO_SELLERS).alias("no_sellers")] if reason else []
    return outcomes.groupBy(status).agg(
        F.count(F.lit(1)).alias("requests"),
        F.sum(F.col(n_offers).cast("long")).alias("offers"), *extra,
    )


def list_sizes(pages: DataFrame, keep: Sequence[str], page: str = "page") -> DataFrame:
    """Number of sellers and prices found per capture (NULL if no layout)."""
    p = F.col(page)
    return pages.select(
        *keep,
        F.when(p.isNotNull(), F.size(p["names"])).cast("int").alias("n_names"),
        F.when(p.isNotNull(), F.size(p["prices"])).cast("int").alias("n_prices"),
    )
