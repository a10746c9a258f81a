"""Attaching offers to requests, and finding requests without a result.

Both joins are equi-joins on the request key, planned by Catalyst and
re-planned by AQE from runtime sizes (broadcast only when the measured
side is under the threshold, sort-merge otherwise).  Two shapes keep a hot
request key from landing in one task:

* the left outer join is written as an inner join (AQE can split a skewed
  partition of either side of an inner join) plus an anti join;
* the anti join first reduces the other side to distinct keys, which is a
  partial (map-side) aggregation, so a hot key is one row per map task
  before anything is shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def requests_without(requests: DataFrame, results: DataFrame, key: str) -> DataFrame:
    """Requests whose ``key`` has no row in ``results`` (NOT EXISTS)."""
    keys = results.select(key).distinct()
    return requests.join(keys, key, "left_anti")


def with_offers(requests: DataFrame, offers: DataFrame, key: str) -> DataFrame:
    """``requests LEFT JOIN offers USING (key)``: every request kept, once
    with NULL offer columns when it has no offer."""
    matched = offers.join(requests, key, "inner")
    missing = requests_without(requests, offers, key)
    cols = matched.columns
    return matched.select(*cols).unionByName(missing, allowMissingColumns=True).select(*cols)
