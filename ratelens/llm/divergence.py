"""How a source's vocabulary differs from its language's and from every other
source's, with exact integer arithmetic.

Terms are counted by Arrow compute functions inside tasks (``ascii_lower``,
``split_pattern_regex``, ``dictionary_encode``, hash ``group_by``), which
leave partial counts per (language, source, term).  They travel as columns: a
task deals the terms of a language into shards by their hash and writes one
row of arrays a shard.  The rows of a shard are merged by the same ``group_by``
in one task; there are as many shards a language as shuffle partitions, so a
shard grows as a partition does.  A language keeps the terms that at least
``MIN_DOCS`` of its documents use (its V terms), which a shard can tell.
Every group of counts, a source's or the language's, gives a kept term

    p = 1 + floor(SCALE * (count + 1) / (N + V)),   N = sum of its counts,

and p diverges from q by ``floor((p - q)^2 / q)``.

* ``pair``: for every two sources of a language the sum over all kept terms.
  The counts are dealt into shards of terms, each a matrix of terms by
  sources (a column a source, absent terms at their p for count 0); a shard
  gives one partial sum per pair, and Spark adds the shards.  A shard takes a
  block of ``SOURCES`` sources on its p side and reads its terms one stretch
  after another, so a task holds ``CELLS`` cells at most besides one row of
  sums per source of its block.
* ``term``: the terms that a source uses and gives more than its language
  does, the ``TOP`` most divergent.

Defined results: NULL text, language and source are empty ones; a row counts
as a document, however often it or its id is repeated; a text without terms
counts for its (language, source) group only; a language without kept terms
has pairs of value 0 and no ``term`` rows; an empty table gives an empty
result; other columns of the input are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import partial
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratelens.llm.common import cut_lineage, in_workers

#: what stands between terms: ASCII but for letters
NOT_TERM = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
MIN_DOCS = 3
SCALE = 1_000_000_000
TOP = 200
#: text that is split at a time, and rows of partial counts that a task holds
BYTES, ROWS = 8 << 20, 400_000
#: counts of a shard (or the square of the sources, if more), sources of its
#: block, cells that a task computes at a time
SHARD, SOURCES, CELLS = 4096, 512, 1 << 20

_SHARDS = ("lang string, shard int, terms array<string>, entries array<int>, sources array<string>, "
           "source_at array<int>, n array<bigint>, docs array<bigint>")
_COUNTS = "lang string, source string, term string, n bigint, total bigint"
_SUMS = "lang string, a bigint, b bigint, value bigint"


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """``batch`` in pieces of about ``BYTES`` of text, one row at least."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch["text"]), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        base = sizes[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(sizes, base + BYTES, "right")))
        yield batch.take(pa.array(np.arange(at, end)))  # ascii_lower reads a slice's text from its start
        at = end


def _counted(batch: pa.RecordBatch) -> list[pa.Table]:
    """Counts per (lang, source, term), and a row without a term per group."""
    named = {c: pc.fill_null(batch[c], "").cast(pa.string()) for c in ("lang", "source", "text")}
    words = pc.split_pattern_regex(pc.ascii_lower(named["text"].cast(pa.large_string())), NOT_TERM)
    rows, terms = pc.list_parent_indices(words), pc.list_flatten(words)
    real = pc.not_equal(terms, "")
    coded = terms.filter(real).dictionary_encode()
    per_row = pa.table({"row": rows.filter(real), "code": coded.indices}).group_by(["row", "code"]).aggregate(
        [([], "count_all")])
    groups = pa.table({"lang": named["lang"].dictionary_encode().indices,
                       "source": named["source"].dictionary_encode().indices})
    langs, sources = (named[c].dictionary_encode().dictionary for c in ("lang", "source"))
    row = per_row["row"]
    summed = pa.table({"lang": groups["lang"].take(row), "source": groups["source"].take(row),
                       "code": per_row["code"], "n": per_row["count_all"]}).group_by(
        ["lang", "source", "code"]).aggregate([("n", "sum"), ([], "count_all")])
    present = groups.group_by(["lang", "source"]).aggregate([])

    def table(t: pa.Table, term: pa.Array, n: pa.Array, docs: pa.Array) -> pa.Table:
        return pa.table({"lang": langs.take(t["lang"].combine_chunks()), "source": sources.take(t["source"].combine_chunks()),
                         "term": term, "n": n, "docs": docs})

    zeros = pa.array(np.zeros(present.num_rows, np.int64))
    return [table(summed, coded.dictionary.take(summed["code"].combine_chunks()).cast(pa.string()),
                  summed["n_sum"], summed["count_all"]),
            table(present, pa.nulls(present.num_rows, pa.string()), zeros, zeros)]


def _merged(tables: list[pa.Table]) -> pa.Table:
    t = pa.concat_tables(tables).group_by(["lang", "source", "term"]).aggregate([("n", "sum"), ("docs", "sum")])
    return t.rename_columns({"n_sum": "n", "docs_sum": "docs"}).select(["lang", "source", "term", "n", "docs"])


def _packed(counts: pa.Table, shards: int) -> Iterator[pa.RecordBatch]:
    """Counts as one row per (lang, shard): its terms, each with its number of
    ``entries``, and per entry the place of its source among ``sources``, n and
    docs."""
    coded = {c: counts[c].combine_chunks().dictionary_encode() for c in ("lang", "source", "term")}
    terms, langs, sources = coded["term"].dictionary, coded["lang"].dictionary, coded["source"].dictionary
    # the entry without a term stands behind all others, in shard 0
    term = pc.fill_null(coded["term"].indices, len(terms)).to_numpy(zero_copy_only=False)
    shard_of = np.fromiter((zlib.crc32(t) % shards for t in terms.cast(pa.binary()).to_pylist()), np.int64, len(terms))
    shard = np.append(shard_of, 0)[term]
    lang, source = (coded[c].indices.to_numpy(zero_copy_only=False) for c in ("lang", "source"))
    order = np.lexsort((term, shard, lang))
    lang, shard, term, source = lang[order], shard[order], term[order], source[order]
    n, docs = (counts[c].to_numpy()[order] for c in ("n", "docs"))
    terms = pa.concat_arrays([terms, pa.nulls(1, terms.type)])
    cuts = np.flatnonzero((np.diff(lang) != 0) | (np.diff(shard) != 0)) + 1
    rows: dict[str, list] = {f.split()[0]: [] for f in _SHARDS.split(", ")}
    bounds = [0, *cuts.tolist(), len(lang)] if len(lang) else []
    for lo, hi in zip(bounds, bounds[1:]):
        here, entries = np.unique(term[lo:hi], return_counts=True)
        used, at = np.unique(source[lo:hi], return_inverse=True)
        for name, value in (("lang", langs[int(lang[lo])]), ("shard", int(shard[lo])), ("terms", terms.take(pa.array(here))),
                            ("entries", entries), ("sources", sources.take(pa.array(used))), ("source_at", at),
                            ("n", n[lo:hi]), ("docs", docs[lo:hi])):
            rows[name].append(value)

    def lists(name: str, kind: pa.DataType) -> pa.Array:
        sizes = np.cumsum([0, *map(len, rows[name])], dtype=np.int32)
        return pa.ListArray.from_arrays(pa.array(sizes), pa.concat_arrays([pa.array(v).cast(kind) for v in rows[name]]))

    if rows["lang"]:
        yield pa.record_batch({
            "lang": pa.array([v.as_py() for v in rows["lang"]], pa.string()), "shard": pa.array(rows["shard"], pa.int32()),
            "terms": lists("terms", pa.string()), "entries": lists("entries", pa.int32()),
            "sources": lists("sources", pa.string()), "source_at": lists("source_at", pa.int32()),
            "n": lists("n", pa.int64()), "docs": lists("docs", pa.int64())})


def partial_counts(batches: Iterator[pa.RecordBatch], shards: int) -> Iterator[pa.RecordBatch]:
    """lang, source, text -> shards of counts, added up over what a task has
    read, and let go at ``ROWS`` entries."""
    held: list[pa.Table] = []
    for batch in batches:
        for piece in _slices(batch):
            held += _counted(piece)
            if sum(t.num_rows for t in held) > ROWS:
                held = [_merged(held)]
                if held[0].num_rows > ROWS // 2:
                    yield from _packed(held.pop(), shards)
    if held:
        yield from _packed(_merged(held), shards)


def _unpacked(row: dict[str, pa.Scalar]) -> pa.Table:
    """The counts of one row of ``_packed``."""
    v = {k: row[k].values for k in ("terms", "entries", "sources", "source_at", "n", "docs")}
    terms = v["terms"].take(pa.array(np.repeat(np.arange(len(v["terms"])), v["entries"].to_numpy())))
    return pa.table({"lang": pa.repeat(row["lang"], len(terms)), "source": v["sources"].take(v["source_at"]),
                     "term": terms, "n": v["n"], "docs": v["docs"]})


def _kept(counts: pa.Table) -> list[pa.RecordBatch]:
    """Of a shard's merged counts the terms that enough documents of the
    language use, with the language's count, and the entries without a term."""
    per_term = counts.group_by("term").aggregate([("n", "sum"), ("docs", "sum")])
    coded, names = counts["term"].combine_chunks(), per_term["term"].combine_chunks()
    at = pc.index_in(coded, names)
    total, docs = per_term["n_sum"].take(at), per_term["docs_sum"].take(at)
    kept = pc.or_(pc.is_null(coded), pc.greater_equal(docs, MIN_DOCS))
    table = counts.drop_columns("docs").append_column("total", total).filter(kept)
    return table.select(["lang", "source", "term", "n", "total"]).combine_chunks().to_batches()


def _merge_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of ``_packed`` sorted by (lang, shard) -> kept counts."""
    def rows() -> Iterator[tuple]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield {c: batch[c][i] for c in batch.schema.names}

    for _, same in groupby(rows(), lambda r: (r["lang"].as_py(), r["shard"].as_py())):
        held: list[pa.Table] = []
        for row in same:
            held.append(_unpacked(row))
            if sum(t.num_rows for t in held[1:]) > max(ROWS, held[0].num_rows):
                held = [_merged(held)]
        yield from _kept(_merged(held))


def term_counts(docs: DataFrame) -> DataFrame:
    """``docs(lang, source, text)`` -> kept terms per source: ``(lang, source,
    term, n, total)``, ``total`` being the language's count; and for every
    (lang, source) a row whose term is NULL."""
    shards = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = in_workers(docs).select("lang", "source", "text").mapInArrow(partial(partial_counts, shards=shards), _SHARDS)
    return (parts.repartition("lang", "shard").sortWithinPartitions("lang", "shard")
            .mapInArrow(_merge_shards, _COUNTS))


def _p(count: Column, size: Column) -> Column:
    """1 + floor(SCALE * (count + 1) / size), exactly; 1 where size is 0."""
    above = F.lit(SCALE).cast("decimal(10,0)") * (count + 1).cast("decimal(19,0)")
    return F.when(size == 0, F.lit(1).cast("bigint")).otherwise(
        F.lit(1) + F.call_function("div", above, F.nullif(size, F.lit(0)).cast("decimal(19,0)")))


def _pair_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (lang, shard, block, term, source, p) sorted by the first four; the
    ones without a term, one a source, come first and give the p of terms that
    the source lacks.  Sums per pair of a shard's block with all sources."""
    key, base, row, cells, last = None, [], -1, [], None

    def spread(sums: np.ndarray, lo: int) -> None:
        """Add what the terms in ``cells`` give to ``sums``."""
        if not cells:
            return
        p = np.tile(np.array(base, np.int64), (row + 1, 1))
        r, s, v = map(np.concatenate, zip(*cells))
        p[r, s] = v
        for i in range(len(sums)):
            d = p[:, lo + i:lo + i + 1] - p
            sums[i] += (d * d // p).sum(axis=0)

    def result() -> pa.RecordBatch:
        lang, _, block = key
        lo, n = block * SOURCES, len(base)
        a, b = (x.ravel() for x in np.meshgrid(np.arange(lo, lo + len(sums)), np.arange(n), indexing="ij"))
        keep = a != b
        return pa.record_batch({"lang": pa.array([lang] * int(keep.sum()), pa.string()), "a": a[keep].astype(np.int64),
                                "b": b[keep].astype(np.int64), "value": sums.ravel()[keep]})

    sums = np.zeros((0, 0), np.int64)
    for batch in batches:
        langs, terms = batch["lang"].to_pylist(), batch["term"].to_pylist()
        shards, blocks, sources, ps = (batch[c].to_numpy() for c in ("shard", "block", "source", "p"))
        # a stretch of rows of one term is handled at a time
        at = 0
        while at < batch.num_rows:
            here = (langs[at], int(shards[at]), int(blocks[at]))
            if here != key:
                if key is not None:
                    spread(sums, key[2] * SOURCES)
                    yield result()
                key, base, row, cells, last = here, [], -1, [], None
            end = at
            while (end < batch.num_rows and terms[end] == terms[at] and langs[end] == key[0]
                   and shards[end] == key[1] and blocks[end] == key[2]):
                end += 1
            if terms[at] is None:
                base += ps[at:end].tolist()
                sums = np.zeros((min(SOURCES, max(0, len(base) - key[2] * SOURCES)), len(base)), np.int64)
            else:
                if terms[at] != last:
                    if (row + 1) * len(base) >= CELLS:
                        spread(sums, key[2] * SOURCES)
                        row, cells = -1, []
                    row, last = row + 1, terms[at]
                cells.append((np.full(end - at, row), sources[at:end].astype(np.int64), ps[at:end].astype(np.int64)))
            at = end
    if key is not None:
        spread(sums, key[2] * SOURCES)
        yield result()


def divergences(docs: DataFrame) -> DataFrame:
    """``docs(lang, source, text)`` -> ``(lang, source, part, item, value,
    rank)``: ``pair`` rows for all other sources of the language, ``term`` rows
    for the ``TOP`` most divergent terms."""
    counts = cut_lineage(term_counts(docs))
    kept = counts.where("term IS NOT NULL")
    langs = (kept.groupBy("lang", "term").agg(F.first("total").alias("total"), F.count(F.lit(1)).alias("cells"))
             .groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("total").alias("lang_n"), F.sum("cells").alias("cells")))
    groups = (counts.groupBy("lang", "source").agg(F.sum("n").alias("source_n"))
              .withColumn("id", F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1)
              .withColumn("sources", F.count(F.lit(1)).over(Window.partitionBy("lang")))
              .join(langs, "lang", "left").na.fill(0, ["v", "lang_n", "cells"])
              .withColumn("size", F.col("source_n") + F.col("v"))
              .withColumn("shards", F.greatest(F.lit(1), F.ceil(F.col("cells") / F.greatest(
                  F.lit(SHARD), F.col("sources") * F.col("sources"))))))
    groups = cut_lineage(groups)
    cells = (kept.join(groups, ["lang", "source"])
             .withColumn("p", _p(F.col("n"), F.col("size"))))

    blocks = F.explode(F.sequence(F.lit(0), F.floor((F.col("sources") - 1) / SOURCES).cast("int"))).alias("block")
    rows = cells.select("lang", F.pmod(F.xxhash64("term"), F.col("shards")).alias("shard"), blocks, "term",
                        F.col("id").cast("bigint").alias("source"), "p")
    absent = (groups.withColumn("shard", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("shards") - 1)))
              .select("lang", "shard", blocks, F.lit(None).cast("string").alias("term"),
                      F.col("id").cast("bigint").alias("source"),
                      _p(F.lit(0).cast("bigint"), F.col("size")).alias("p")))
    sums = (in_workers(rows.unionByName(absent)).repartition("lang", "shard", "block")
            .sortWithinPartitions("lang", "shard", "block", "term", "source").mapInArrow(_pair_sums, _SUMS)
            .groupBy("lang", "a", "b").agg(F.sum("value").alias("value")))
    name = groups.select("lang", F.col("id").cast("bigint").alias("id"), "source")
    pairs = (sums.join(name.withColumnRenamed("id", "a"), ["lang", "a"])
             .join(name.withColumnsRenamed({"id": "b", "source": "item"}), ["lang", "b"])
             .select("lang", "source", F.lit("pair").alias("part"), "item", "value"))

    q = _p(F.col("total"), F.col("lang_n") + F.col("v"))
    over = (cells.where("n > 0").withColumn("q", q).where("p > q")
            .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                    F.expr("(p - q) * (p - q) div q").alias("value")))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return (pairs.withColumn("rank", F.row_number().over(order))
            .unionByName(over.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= TOP)))
