"""Line dedup by site-relative frequency.

A line is boilerplate of a site if a large share of the site's pages contain
it.  Pages with the same content count once, so that a page copied many
times doesn't make boilerplate of its own text; a page that has nothing but
boilerplate keeps its lines, as it would vanish otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLANKS = " \t\n\r\f\u000b"


def _line_key(line: Column) -> Column:
    """128 bits that stand for a line, apart from white space around it."""
    bare = F.btrim(line, F.lit(BLANKS))
    return F.struct(F.xxhash64(bare).alias("x"), F.xxhash64(F.lit(1), bare).alias("y"))


def line_frequencies(docs: DataFrame, host_col: str, text_col: str) -> DataFrame:
    """``(host, key, pages, total)``: on how many distinct pages of a host a
    non-blank line stands, and how many distinct pages the host has.

    Every page gives each of its lines once; counts are summed on the map
    side, so a host with a third of all rows is no larger task than others.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    pages = (docs.select(F.col(host_col).alias("host"), text.alias("text"))
             .select("host", F.xxhash64("text").alias("page"), F.xxhash64(F.lit(1), "text").alias("page2"),
                     F.array_distinct(F.transform(
                         F.filter(F.split("text", "\n"), lambda s: F.btrim(s, F.lit(BLANKS)) != ""),
                         _line_key)).alias("keys"))
             .groupBy("host", "page", "page2").agg(F.first("keys").alias("keys")))
    marked = pages.select("host", F.explode(F.concat(
        F.transform("keys", lambda k: F.struct(k.alias("key"))),
        F.array(F.struct(F.lit(None).cast("struct<x:bigint,y:bigint>").alias("key"))))).alias("m"))
    counts = marked.groupBy("host", F.col("m.key").alias("key")).agg(F.count(F.lit(1)).alias("pages"))
    totals = counts.where("key IS NULL").select(F.col("host").alias("h"), F.col("pages").alias("total"))
    return (counts.where("key IS NOT NULL").join(totals, F.col("host").eqNullSafe(F.col("h")))
            .select("host", "key", "pages", "total"))


def boilerplate(docs: DataFrame, host_col: str = "source", text_col: str = "text",
                ratio: float = 0.02, min_pages: int = 3) -> DataFrame:
    """``(host, key, pages, total)`` of the lines on more than ``ratio`` of
    their host's distinct pages and on at least ``min_pages`` of them."""
    return (line_frequencies(docs, host_col, text_col)
            .where((F.col("pages") > F.lit(ratio) * F.col("total")) & (F.col("pages") >= min_pages)))


def drop_boilerplate(docs: DataFrame, id_col: str = "doc_id", host_col: str = "source",
                     text_col: str = "text", ratio: float = 0.02, min_pages: int = 3,
                     count_cols: tuple[str, str] | None = None,
                     length_col: str | None = None) -> DataFrame:
    """``docs`` with the boilerplate lines of each row's host taken out of
    ``text_col``; every row and every other column stays.

    Lines are separated by line feeds and compared without white space around
    them; blank lines are never boilerplate.  Rows with a NULL host form one
    host.  NULL and empty texts, and texts of boilerplate only, stay as they
    are; repeated rows and repeated ids are each treated alike, since the
    lines to drop depend on host and text alone.  An empty table stays empty.
    ``count_cols`` names two more columns: lines, and lines dropped.
    ``length_col`` names a column of ``docs`` that is set to the text's length
    wherever lines were dropped.
    """
    common = boilerplate(docs, host_col, text_col, ratio, min_pages)
    # which lines go depends on a page's host and content: look each content up once
    found = docs.select(F.col(host_col).alias("host"),
                        F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    page = [F.xxhash64("text").alias("page"), F.xxhash64(F.lit(1), "text").alias("page2")]
    keys = (found.select("host", *page, F.explode(F.array_distinct(F.transform(
        F.split("text", "\n"), _line_key))).alias("key")).distinct())
    hits = (keys.join(common.select(F.col("host").alias("h"), F.col("key").alias("k")),
                      F.col("host").eqNullSafe(F.col("h")) & (F.col("key") == F.col("k")))
            .groupBy("host", "page", "page2").agg(F.collect_set("key").alias("__drop"))
            .select(F.col("host").alias("__host"), F.col("page").alias("__page"),
                    F.col("page2").alias("__page2"), "__drop"))
    whole = F.coalesce(F.col(text_col), F.lit(""))
    joined = docs.join(hits, docs[host_col].eqNullSafe(F.col("__host"))
                       & (F.xxhash64(whole) == F.col("__page"))
                       & (F.xxhash64(F.lit(1), whole) == F.col("__page2")), "left")
    lines = F.split(F.col(text_col), "\n")
    kept = F.filter(lines, lambda s: ~F.array_contains(F.col("__drop"), _line_key(s)))
    drops = F.col("__drop").isNotNull() & F.exists(kept, lambda s: F.btrim(s, F.lit(BLANKS)) != "")
    text = F.when(drops, F.array_join(kept, "\n")).otherwise(F.col(text_col))
    size = F.when(drops, F.length(text).cast(docs.schema[length_col].dataType)).otherwise(
        F.col(length_col)) if length_col else None
    columns = [text.alias(c) if c == text_col else size.alias(c) if c == length_col else docs[c]
               for c in docs.columns]
    if count_cols:
        total, gone = count_cols
        n = F.when(F.col(text_col).isNull(), 0).otherwise(F.size(lines)).cast("long")
        columns = [c for c, name in zip(columns, docs.columns) if name not in count_cols]
        columns += [n.alias(total), F.when(drops, n - F.size(kept)).otherwise(0).cast("long").alias(gone)]
    return joined.select(*columns)
