"""Benchmark decontamination by winnowing, in DataFrame operations only.

A window is ``span`` consecutive words of a benchmark item (an item of fewer
words is one window).  Texts are compared through fingerprints: every k words
are hashed, and of the hashes inside a window the smallest is kept.  A window
that stands in a document as well keeps the same hash there, so joining the
kept hashes of documents and benchmark finds every shared window, while a
document keeps only about two hashes for every ``span - k + 2`` words.  Hits
are then extended: around each shared hash the document's windows are compared
word for word with the benchmark's, and the words they cover are marked.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratelens.llm.common import cut_lineage

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Benchmark fingerprints are broadcast up to this many rows (16 bytes each).
BROADCAST_ROWS = 200_000


def _words(text: Column) -> Column:
    """Words with A-Z in lower case; NULL has none.  ``lower`` does the same
    as lower-casing A-Z unless a text holds other upper-case letters."""
    text = F.coalesce(text, F.lit(""))
    plain = F.when(text.rlike(r"[^\x00-\x7F]"), F.translate(text, UPPER, LOWER)).otherwise(F.lower(text))
    return F.regexp_extract_all(plain, F.lit(WORD), F.lit(0))


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` worked out once, however often ``body``
    uses it (a projected column would be copied into each use)."""
    return F.transform(F.array(value), body)[0]


def _upto(last: Column, each) -> Column:
    """``each(i)`` for i = 0..last; nothing if last is negative."""
    return F.when(last < 0, F.array()).otherwise(F.transform(F.sequence(F.lit(0), last), each))


def _hashes(words: Column, k: int) -> Column:
    """The hash of every k consecutive words."""
    return _upto(F.size(words) - k, lambda i: F.xxhash64(*[words[i + j] for j in range(k)]))


def _minima(hashes: Column, width: int) -> Column:
    """The smallest hash of every ``width`` consecutive ones."""
    if width == 1:
        return hashes
    return _upto(F.size(hashes) - width, lambda i: F.least(*[hashes[i + j] for j in range(width)]))


def _runs(minima: Column) -> Column:
    """(hash, first, last) of each run of windows that keep the same hash."""
    def ends(starts: Column) -> Column:
        return F.transform(starts, lambda x, j: F.struct(
            minima[x].alias("hash"), x.alias("first"),
            (F.when(j + 1 < F.size(starts), starts[j + 1]).otherwise(F.size(minima)) - 1).alias("last")))
    begins = F.filter(_upto(F.size(minima) - 1, lambda i: i),
                      lambda i: (i == 0) | (minima[i] != minima[F.greatest(i - 1, F.lit(0))]))
    return _let(begins, ends)


def _selected(texts: DataFrame, k: int, span: int, keep: list[str]) -> DataFrame:
    """``keep`` columns and one row per kept hash of ``words``."""
    runs = _let(_words(F.col("text")), lambda w: _let(_hashes(w, k), lambda h: _let(
        _minima(h, span - k + 1), _runs)))
    # an outer explode: Spark would work out ``runs`` twice to filter empty ones
    return (texts.select(*keep, F.explode_outer(runs).alias("__s"))
            .select(*keep, "__s.*").where("hash IS NOT NULL"))


def _window(words: Column, start: Column, span: int) -> Column:
    """A window as text; words hold no blanks, so it stands for its words."""
    return F.array_join(F.slice(words, start + 1, span), " ")


def _item_windows(items: DataFrame, span: int) -> DataFrame:
    """``(item, window)``: the distinct windows of the items."""
    every = _let(_words(F.col("text")), lambda w: _upto(F.size(w) - span, lambda i: _window(w, i, span)))
    return (items.select("item", F.explode_outer(every).alias("window"))
            .where("window IS NOT NULL").distinct())


def _hits(docs: DataFrame, items: DataFrame, k: int, span: int) -> DataFrame:
    """``(id, start, window)``: the documents' windows of ``span`` words that
    are windows of the items too."""
    windows = _item_windows(items, span).select("window").distinct()
    prints = cut_lineage(_selected(items, k, span, []).select("hash").distinct())
    if prints.count() <= BROADCAST_ROWS:
        prints = F.broadcast(prints)
    found = (_selected(docs, k, span, ["id"]).join(prints, "hash").select("id", "first", "last"))
    # the words around the shared hashes, one row per document that has any
    places = found.groupBy("id").agg(F.collect_set(F.struct("first", "last")).alias("places"))
    around = docs.join(places, "id").select("id", F.explode_outer(_let(
        _words(F.col("text")), lambda w: F.flatten(F.transform("places", lambda p: F.transform(
            F.sequence(p["first"], p["last"]), lambda i: F.struct(
                i.alias("start"), _window(w, i, span).alias("window"))))))).alias("w"))
    return around.select("id", "w.start", "w.window").join(windows, "window")


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
                  text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
                  span: int = 10, k: int = 4) -> DataFrame:
    """Per document: ``(id_col, n_words, n_hit, n_items, items_sha256,
    contaminated)``.

    ``n_hit`` counts the words inside an occurrence of any window, ``n_items``
    the items with an occurring window; ``items_sha256`` is the hex digest of
    their ids, sorted as strings and joined by commas.  NULL and empty texts
    have no words and match nothing; so do items without words.  Repeated
    items count each under their own id, items that share an id as one item.
    Ids should be unique per row of ``docs``; rows that repeat an id share its
    counts.  An empty benchmark contaminates nothing; an empty table gives an
    empty result; other columns are not read.
    """
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    items = cut_lineage(benchmark.select(
        F.col(item_col).cast("string").alias("item"), F.col(item_text).alias("text"),
        F.size(_words(F.col(item_text))).alias("n")).where("n > 0"))
    # items of fewer words than a window: one window each; at most span - 1 lengths
    short = sorted(r[0] for r in items.where(F.col("n") < span).select("n").distinct().collect())
    hits = owners = None
    for length, gram in [(span, min(k, span)), *((n, n) for n in short)]:
        some = items.where(F.col("n") >= span if length == span else F.col("n") == length)
        hit = _hits(texts, some, gram, length).select(
            "id", "start", (F.col("start") + length).alias("stop"), "window")
        own = _item_windows(some, length)
        hits = hit if hits is None else hits.unionAll(hit)
        owners = own if owners is None else owners.unionAll(own)
    hits = cut_lineage(hits)
    covered = (hits.groupBy("id").agg(F.array_sort(F.collect_set(F.struct("start", "stop"))).alias("spans"))
               .select("id", F.expr(
                   "aggregate(spans, struct(0 AS n, 0 AS upto), (acc, s) -> struct("
                   "acc.n + greatest(0, s.stop - greatest(s.start, acc.upto)) AS n, "
                   "greatest(acc.upto, s.stop) AS upto)).n").alias("n_hit")))
    named = (hits.select("id", "window").distinct().join(owners, "window")
             .groupBy("id").agg(F.array_sort(F.collect_set("item")).alias("items"))
             .select("id", F.size("items").cast("long").alias("n_items"),
                     F.sha2(F.array_join("items", ","), 256).alias("items_sha256")))
    per_doc = covered.join(named, "id")
    rows = texts.select("id", F.size(_words(F.col("text"))).cast("long").alias("n_words"))
    empty = F.sha2(F.lit(""), 256)
    return (rows.join(per_doc.withColumnRenamed("id", "__id"), F.col("id") == F.col("__id"), "left")
            .select(F.col("id").alias(id_col), "n_words",
                    F.coalesce(F.col("n_hit").cast("long"), F.lit(0)).alias("n_hit"),
                    F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
                    F.coalesce("items_sha256", empty).alias("items_sha256"),
                    (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated")))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
                      text_col: str = "text", **options) -> DataFrame:
    """Rows of ``docs`` that hold no benchmark window; columns stay as they
    are, rows with a NULL id too."""
    bad = (contamination(docs, benchmark, id_col, text_col, **options).where("contaminated")
           .select(F.col(id_col).alias("__bad")).distinct())
    return docs.join(bad, docs[id_col] == bad["__bad"], "left_anti")
