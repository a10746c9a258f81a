"""Spreading CPU-heavy per-row work over the cluster's cores.

A capture table written as a few large files (or a single parquet row
group) is scanned by few tasks, so regex extraction, transliteration or
HTML parsing right after the scan would run on few cores.  ``spread``
hash-partitions such an input by a unique key into as many partitions as
the cluster has cores; an input already scanned by at least that many
tasks (the normal case on a large table) is returned unchanged, with no
shuffle.  Hash partitioning is deterministic, so a retried task receives
the same rows (round-robin would need a sort first).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def spread(df: DataFrame, by: Sequence[str], min_partitions: int | None = None) -> DataFrame:
    """Hash-partition ``df`` by ``by`` (a unique key) if it has fewer
    partitions than the default parallelism."""
    try:
        target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
        current = df.rdd.getNumPartitions()
    except Exception:  # no RDD view (e.g. a remote session): leave the plan as it is
        return df
    if current >= target:
        return df
    return df.repartition(target, *by)
