"""Offer rows, outcome rows and their union.

One output row per seller of a request with offers, paired with the price
at the same index (1-based ``scrape_position``); one row per request that is
not available or asks to contact the property; legacy CSV projection with
the reference's sentinel texts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratelens.functions.arrays import pair_by_index
from ratelens.operators.outcome import (
    CONTACT,
    CONTACT_TEXT,
    NOT_AVAILABLE,
    NOT_AVAILABLE_TEXT,
    OFFERS,
)


def explode_offers(df: DataFrame, keep: Sequence[str], names: str = "page.names",
                   prices: str = "page.prices", agent: str = "agent",
                   price: str = "scrape_base_price", position: str = "scrape_position",
                   status_col: str | None = "status") -> DataFrame:
    """One row per seller: ``keep`` columns, position (int, from 1), seller
    and price text.  Sellers are paired with prices by index before any
    de-duplication; extra prices are ignored; a request whose status is not
    ``offers`` emits nothing."""
    src = df if status_col is None else df.filter(F.col(status_col) == OFFERS)
    pairs = pair_by_index(F.col(names), F.col(prices), "n", "p")
    return src.select(*keep, F.posexplode(pairs).alias("_pos", "_pair")).select(
        *keep,
        (F.col("_pos") + 1).cast("int").alias(position),
        F.col("_pair.n").alias(agent),
        F.col("_pair.p").alias(price),
    )


def request_rows(df: DataFrame, keep: Sequence[str], names: str = "page.names",
                 prices: str = "page.prices", status_col: str = "status",
                 extras: str | None = None) -> DataFrame:
    """Seller rows of requests with offers and one row per request that is
    not available or asks for contact, in a single pass (one generator, no
    union, so the input is computed once).  Broken requests emit nothing.

    With ``extras`` (an array of per-seller maps aligned with the sellers),
    each seller row also gets its map as ``extra`` (NULL when missing)."""
    st = F.col(status_col)
    ncol, pcol = F.col(names), F.col(prices)
    if extras is None:
        pair_type = "array<struct<n:string,p:string>>"
        pairs = pair_by_index(ncol, pcol, "n", "p")
        single = F.array(F.struct(F.lit(None).cast("string").alias("n"),
                                  F.lit(None).cast("string").alias("p")))
    else:
        pair_type = "array<struct<n:string,p:string,e:map<string,string>>>"
        ecol = F.col(extras)
        pairs = F.transform(ncol, lambda x, i: F.struct(
            x.alias("n"), F.get(pcol, i).alias("p"), F.get(ecol, i).alias("e")))
        single = F.array(F.struct(F.lit(None).cast("string").alias("n"),
                                  F.lit(None).cast("string").alias("p"),
                                  F.lit(None).cast("map<string,string>").alias("e")))
    gen = (F.when(st == OFFERS, pairs)
           .when(st.isin(NOT_AVAILABLE, CONTACT), single.cast(pair_type))
           .otherwise(F.array().cast(pair_type)))
    cols = list(keep) if status_col in keep else [*keep, status_col]
    return df.select(*cols, F.posexplode(gen).alias("_pos", "_pair")).select(
        *cols,
        F.when(st == OFFERS, F.col("_pos") + 1).cast("int").alias("scrape_position"),
        F.col("_pair.n").alias("agent"),
        F.col("_pair.p").alias("scrape_base_price"),
        *([F.col("_pair.e").alias("extra")] if extras is not None else []),
    )


def outcome_rows(df: DataFrame, keep: Sequence[str], run_date: str) -> DataFrame:
    """One row per request that is not available or asks for contact.

    Seller and position are NULL (the reference used an unbound index,
    defect B3); the outcome is in ``status``."""
    src = df.filter(F.col("status").isin(NOT_AVAILABLE, CONTACT))
    return src.select(
        *keep,
        F.lit(None).cast("int").alias("scrape_position"),
        F.lit(None).cast("string").alias("agent"),
        F.lit(None).cast("string").alias("scrape_base_price"),
        F.lit(run_date).cast("date").alias("scrape_date"),
        F.col("status"),
    )


def merge_outcomes(*frames: DataFrame) -> DataFrame:
    """Bag union by column name; a column missing on one side is NULL."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


# Header of the legacy result CSV, in order (files in this
# layout are read by existing consumers of the original job's output).
LEGACY_COLUMNS = ("hotel_id", "hotel", "agents", "scrape_position", "scrape_date",
                  "check_in", "check_out", "check_in_search", "check_out_search",
                  "hoken_base_price", "scrape_base_price", "nights")


def legacy_projection(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The legacy result CSV: ``LEGACY_COLUMNS``, all strings, sentinel
    texts in place of NULLs (``keep`` columns first, unchanged)."""
    na, contact = F.lit(NOT_AVAILABLE_TEXT), F.lit(CONTACT_TEXT)
    st = F.col("status")

    def sentinel(c: str):
        return (F.when(st == NOT_AVAILABLE, na).when(st == CONTACT, contact)
                .otherwise(F.col(c).cast("string")))

    values = (
        F.col("hotel_id").cast("string"),
        F.col("hotel").cast("string"),
        F.when(st == NOT_AVAILABLE, na).otherwise(F.col("agent")),
        F.when(st == NOT_AVAILABLE, na).otherwise(F.col("scrape_position").cast("string")),
        F.col("scrape_date").cast("string"),
        F.col("check_in").cast("string"),
        F.col("check_out").cast("string"),
        sentinel("check_in_search"),
        sentinel("check_out_search"),
        F.col("listed_base_price").cast("string"),
        sentinel("scrape_base_price"),
        F.col("nights").cast("string"),
    )
    return df.select(*keep, *[v.alias(n) for v, n in zip(values, LEGACY_COLUMNS)])
