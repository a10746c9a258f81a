"""Row numbering that scales: positions within a key, and global batch ids.

``row_number() OVER (PARTITION BY k ORDER BY o)`` sends every row of a key to
one task, and a global ``row_number() OVER (ORDER BY o)`` the whole table.

*Global numbers.*  Rows are dealt into ranges of the order (Spark's
``repartitionByRange``), sorted inside their range and written out with their
place there; a row's number is its place plus the rows of all earlier ranges,
a running sum over one row per range.  The ranges are drawn from a sample, so
they are fixed by writing: a second read, or a lost executor, meets the same
ones.  This is the same at every size; no row is collected, and no table but
the one with a row per range is broadcast.

*Positions within a key.*  Rows per key are counted by partial aggregates.
Keys of at most ``HOT_ROWS`` rows are numbered by a plain window, whose output
stays partitioned by the key.  Rows of larger keys, which no single task should
hold, get global numbers in (key, order), less the number before their key's
first row.  There are at most (rows / ``HOT_ROWS``) such keys; finding them is
one job over the key columns, when the function is called.

Rows that tie on all columns of the order stand in any order, as in a window,
and in one range: give a unique last column if very many rows can tie.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratelens.session import checkpoint_dir

# Rows of one key that one task numbers comfortably; larger keys are dealt
# over several tasks.
HOT_ROWS = 1_000_000
# The list of such keys is broadcast up to this length, which is checked.
BROADCAST_KEYS = 500_000

_PLACE, _RANGE, _START, _N = "_rl_place", "_rl_range", "_rl_start", "_rl_n"
# ``monotonically_increasing_id`` is the partition's number above these bits
# and the row's place in it below.
_BITS = 33


def _written(df: DataFrame) -> DataFrame:
    """``df`` once computed, read back from the shared checkpoint folder."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _ascending(order_cols: Sequence[Column | str]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order_cols]


def global_row_number(df: DataFrame, order_cols: Sequence[Column | str],
                      name: str = "row_number", n_ranges: int | None = None) -> DataFrame:
    """Global 1-based ``row_number()`` over ``order_cols`` as ``long``,
    computed by many tasks instead of a single-partition window; ``n_ranges``
    instead of the session's number of shuffle partitions."""
    order = _ascending(order_cols)
    dealt = df.repartitionByRange(n_ranges, *order) if n_ranges else df.repartitionByRange(*order)
    placed = _written(dealt.sortWithinPartitions(*order).withColumn(_PLACE, F.monotonically_increasing_id()))
    placed = placed.withColumn(_RANGE, F.shiftright(_PLACE, _BITS))
    before = Window.orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    starts = (placed.groupBy(_RANGE).agg(F.count(F.lit(1)).alias(_N))
              .select(_RANGE, F.coalesce(F.sum(_N).over(before), F.lit(0)).alias(_START)))
    place = F.col(_PLACE).bitwiseAND(F.lit((1 << _BITS) - 1))
    return (placed.join(F.broadcast(starts), _RANGE)   # one row per range
            .select(*df.columns, (F.col(_START) + place + 1).alias(name)))


def row_number_within(df: DataFrame, partition_cols: Sequence[str],
                      order_cols: Sequence[Column | str], name: str = "row_number",
                      hot_rows: int | None = None, n_ranges: int | None = None) -> DataFrame:
    """``row_number()`` within ``partition_cols`` ordered by ``order_cols``
    (1-based, ``int``), without putting a key of more than ``hot_rows`` rows
    (default ``HOT_ROWS``) in one task.  NULL keys are a key like any other."""
    keys = list(partition_cols)
    if not keys:
        return global_row_number(df, order_cols, name, n_ranges).withColumn(name, F.col(name).cast("int"))
    order = _ascending(order_cols)
    many = (df.groupBy(*keys).agg(F.count(F.lit(1)).alias(_N))
            .where(F.col(_N) > (HOT_ROWS if hot_rows is None else hot_rows)))
    hot = _written(many.select(*[F.col(k).alias(f"_rl_k{i}") for i, k in enumerate(keys)]))
    window = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    n_hot = hot.count()
    if not n_hot:
        return df.withColumn(name, window).select(*df.columns, name)

    def same(other: DataFrame) -> Column:
        cond = F.lit(True)
        for i, k in enumerate(keys):
            cond = cond & F.col(k).eqNullSafe(other[f"_rl_k{i}"])
        return cond

    cold = df.join(hot, same(hot), "left_anti").withColumn(name, window)
    numbered = global_row_number(df.join(hot, same(hot), "left_semi"), [*keys, *order], name, n_ranges)
    first = numbered.groupBy(*[F.col(k).alias(f"_rl_k{i}") for i, k in enumerate(keys)]).agg(F.min(name).alias(_START))
    # a shuffle by key would gather a key's rows again; AQE splits them where the list is too long to send
    first = F.broadcast(first) if n_hot <= BROADCAST_KEYS else first
    split = numbered.join(first, same(first)).withColumn(name, (F.col(name) - F.col(_START) + 1).cast("int"))
    return cold.select(*df.columns, name).unionByName(split.select(*df.columns, name))


def with_chunk_id(df: DataFrame, order_cols: Sequence[Column | str], size: int = 50,
                  name: str = "chunk_id") -> DataFrame:
    """Consecutive batches of ``size`` rows in ``order_cols`` order, numbered
    from 1 (row 1..size → 1, row size+1 → 2); no rows, no batch."""
    if size <= 0:
        raise ValueError("size must be positive")
    rn = "_rl_rn"
    numbered = global_row_number(df, order_cols, name=rn)
    return numbered.withColumn(
        name, (F.floor((F.col(rn) - 1) / F.lit(size)) + 1).cast("int")
    ).drop(rn)
