"""Embedding near-duplicates by an epsilon grid order join.

Vectors of unit length have a cosine of at least c exactly if they are at most
eps = sqrt(2 - 2c) apart, and a projection never makes a distance longer.  So
vectors are projected on their leading principal dimensions, put into grid
cells of side eps and sorted by cell, dimension after dimension.  The sorted
sequence is cut into intervals; two intervals whose boxes are further apart
than eps in any way are skipped, the others are joined recursively: halves
against halves, skipping distant ones again, down to small blocks whose
cosines are computed in double precision on the full vectors.

The dimensions come from a bounded sample (about ``SAMPLE`` vectors, by hash of
the id): they decide only what can be skipped, never what is linked.  Vectors
of different lengths are apart; those of other lengths than most use their
first coordinates as dimensions.  Every vector is divided by its largest
magnitude before anything else, so no norm over- or underflows; vectors that
are equal then are joined once, with their number.

Neighbouring intervals form blocks of ``BLOCK`` at most, and a task joins what
isn't skipped between two blocks: an interval travels once per other block, not
once per interval, and a task holds two blocks.  An interval pair reports per
vector how many it linked and a spanning set of links, so a dense group never
gives all its pairs as rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratelens.llm.common import cut_lineage, in_workers
from ratelens.llm.components import connected_components

SAMPLE = 5_000
DIMENSIONS = 8
INTERVAL = 4096      # vectors of an interval, about
BLOCK = 16           # intervals of a block, at most
LEAF = 256


def _unit(values: np.ndarray) -> np.ndarray:
    return values / np.linalg.norm(values, axis=1, keepdims=True)


def principal_dimensions(vectors: DataFrame, dimensions: int, sample: int) -> np.ndarray:
    """The leading principal directions of about ``sample`` unit vectors, one per
    column; of several lengths of vectors the most frequent one's."""
    total = vectors.count()
    part = F.pmod(F.xxhash64("low"), F.lit(1 << 20)) < F.lit(math.ceil((1 << 20) * min(1.0, sample / max(total, 1))))
    rows = [r[0] for r in vectors.where(part).select("vec").collect()] or [
        r[0] for r in vectors.select("vec").limit(1).collect()]
    if not rows:
        return np.zeros((0, 0))
    size = max({len(r) for r in rows}, key=lambda n: (sum(len(r) == n for r in rows), n))
    x = _unit(np.array([r for r in rows if len(r) == size], np.float64))
    _, axes = np.linalg.eigh(np.cov(x.T).reshape(size, size) if len(x) > 1 else np.eye(size))
    return axes[:, ::-1][:, :dimensions]


def _axes_of(width: int, axes: np.ndarray) -> np.ndarray:
    """Dimensions for vectors of this length."""
    return axes if len(axes) == width else np.eye(width)[:, :axes.shape[1]]


class _Groups:
    """Union-find over slots of an interval pair."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def find(self, i: int) -> int:
        while self.root[i] != i:
            self.root[i] = self.root[self.root[i]]
            i = self.root[i]
        return i

    def flatten(self) -> np.ndarray:
        root = self.root
        while True:
            up = root[root]
            if (up == root).all():
                return root
            root[:] = up


def join_intervals(a: np.ndarray, pa_: np.ndarray, na: np.ndarray, b: np.ndarray, pb: np.ndarray,
                   nb: np.ndarray, same: bool, cosine: float) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int]]]:
    """Join two intervals of unit vectors (``same``: one with itself).

    ``pa_``, ``pb`` are their projections, ``na``, ``nb`` how many equal
    vectors each stands for.  Returns the links of each vector of a and of b,
    and a spanning set of links as pairs of positions.
    """
    eps = np.sqrt(max(0.0, 2 - 2 * cosine)) * (1 + 1e-9) + 1e-9
    links_a, links_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
    groups = _Groups(len(a) + len(b))
    if same:
        groups.root[len(a):] = np.arange(len(a))
    spanning: list[tuple[int, int]] = []

    def leaf(i0, i1, j0, j1):
        hit = a[i0:i1] @ b[j0:j1].T >= cosine
        if same and i0 == j0:
            hit &= ~np.eye(i1 - i0, dtype=bool)
        if not hit.any():
            return
        links_a[i0:i1] += hit @ nb[j0:j1]
        if not (same and i0 == j0):
            links_b[j0:j1] += na[i0:i1] @ hit
        while True:      # one link per vector and round, until all are in one group
            root = groups.flatten()
            open_ = hit & (root[i0:i1][:, None] != root[len(a) + j0:len(a) + j1][None, :])
            rows = np.flatnonzero(open_.any(axis=1))
            if not len(rows):
                return
            for r, c in zip(rows, open_[rows].argmax(axis=1)):
                x, y = groups.find(i0 + r), groups.find(len(a) + j0 + c)
                if x != y:
                    groups.root[max(x, y)] = min(x, y)
                    spanning.append((i0 + r, j0 + c))

    def join(i0, i1, j0, j1):
        low_a, high_a = pa_[i0:i1].min(axis=0), pa_[i0:i1].max(axis=0)
        low_b, high_b = pb[j0:j1].min(axis=0), pb[j0:j1].max(axis=0)
        apart = np.maximum(0, np.maximum(low_a - high_b, low_b - high_a))
        if apart @ apart > eps * eps:
            return
        if i1 - i0 <= LEAF and j1 - j0 <= LEAF:
            leaf(i0, i1, j0, j1)
        elif same and (i0, i1) == (j0, j1):
            m = (i0 + i1) // 2
            join(i0, m, i0, m)
            join(i0, m, m, i1)
            join(m, i1, m, i1)
        elif i1 - i0 >= j1 - j0:
            m = (i0 + i1) // 2
            join(i0, m, j0, j1)
            join(m, i1, j0, j1)
        else:
            m = (j0 + j1) // 2
            join(i0, i1, j0, m)
            join(i0, i1, m, j1)

    if len(a) and len(b):
        join(0, len(a), 0, len(b))
    if same:
        links_a += links_b
    return links_a, links_b, spanning


def _pack(axes: np.ndarray, eps: float):
    """Sorted rows (vec, low, n) of a partition -> intervals with their boxes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, seq = [], 0, TaskContext.get().partitionId() << 32

        def flush(rows):
            nonlocal seq
            table = pa.Table.from_batches(rows).combine_chunks()
            vecs, lows, ns = table["vec"].to_pylist(), table["low"].to_numpy(), table["n"].to_numpy()
            for width, where in groupby(range(len(vecs)), key=lambda i: len(vecs[i])):
                where = np.fromiter(where, np.int64)
                x = np.array([vecs[i] for i in where], np.float64)
                p = _unit(x) @ _axes_of(width, axes)
                order = np.lexsort((*np.floor(p / eps).T[::-1],))
                for s in range(0, len(order), INTERVAL):
                    pick = order[s:s + INTERVAL]
                    seq += 1
                    yield pa.RecordBatch.from_arrays([
                        pa.array([x[pick].tobytes()], pa.binary()),
                        pa.array([lows[where[pick]].astype(np.int64).tobytes()], pa.binary()),
                        pa.array([ns[where[pick]].astype(np.int64).tobytes()], pa.binary()),
                        pa.array([p[pick].min(axis=0).tolist()], pa.list_(pa.float64())),
                        pa.array([p[pick].max(axis=0).tolist()], pa.list_(pa.float64())),
                        pa.array([seq], pa.int64()), pa.array([width], pa.int64())],
                        names=["vecs", "lows", "ns", "lo", "hi", "interval", "width"])
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                size += batch.num_rows
            if size >= 4 * INTERVAL:
                yield from flush(held)
                held, size = [], 0
        if held:
            yield from flush(held)
    return run


def _join(axes: np.ndarray, cosine: float):
    """Rows (b1, b2, interval, width, vecs, lows, ns, others), sorted by the
    first two: an interval, and the intervals it is to be joined with as the
    first one (``others``) within the block pair."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                for i in range(batch.num_rows):
                    yield {c: batch[c][i].as_py() for c in batch.schema.names}

        for _, same_blocks in groupby(rows(), key=lambda r: (r["b1"], r["b2"])):
            held, todo = {}, []
            for r in same_blocks:
                x = _unit(np.frombuffer(r["vecs"], np.float64).reshape(-1, r["width"]))
                held[r["interval"]] = (x, x @ _axes_of(r["width"], axes), np.frombuffer(r["ns"], np.int64),
                                       np.frombuffer(r["lows"], np.int64))
                todo += [(r["interval"], o) for o in r["others"] or ()]
            for i1, i2 in todo:
                (x, px, nx, lx), (y, py, ny, ly) = held[i1], held[i2]
                same = i1 == i2
                a, b, spanning = join_intervals(x, px, nx, y, py, ny, same, cosine)
                ids, counts = (lx, a) if same else (np.concatenate((lx, ly)), np.concatenate((a, b)))
                keep = counts > 0
                left = np.array([lx[i] for i, _ in spanning], np.int64)
                right = np.array([ly[j] for _, j in spanning], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate((ids[keep], left)), pa.int64()),
                     pa.array(np.concatenate((counts[keep], np.zeros(len(left), np.int64))), pa.int64()),
                     pa.array([None] * int(keep.sum()) + right.tolist(), pa.int64())],
                    names=["a", "links", "b"])
    return run


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                    cosine: float = 0.95, dimensions: int = DIMENSIONS, sample: int = SAMPLE) -> DataFrame:
    """``(id_col, n_links, component_id, kept)`` per row of ``vectors``.

    Vectors whose cosine is at least ``cosine`` are linked; ``n_links`` counts
    the other rows linked directly, ``component_id`` is the smallest id
    reachable, ``kept`` marks the row whose id that is.  Vectors that are NULL,
    zero, empty, or hold NULL or non-finite components link with nothing;
    vectors of different lengths don't link.  Equal vectors under different ids
    are linked with each other; rows that repeat an id count as further rows.
    An empty table gives an empty result; other columns are not read.
    """
    parts = F.col("vec")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"),
                          F.col(vector_col).cast("array<double>").alias("vec"))
    bad = (parts.isNull() | (F.size(parts) == 0)
           | F.exists(parts, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
           | ~F.exists(parts, lambda x: x != 0))
    usable = F.coalesce(~bad, F.lit(False)) & F.col("id").isNotNull()
    # -0.0 and 0.0 are equal components; the largest magnitude becomes 1
    rows = (rows.select("id", F.when(usable, F.col("vec")).alias("vec"))
            .select("id", F.zip_with("vec", F.array_repeat(F.array_max(F.transform("vec", F.abs)), F.size("vec")),
                                     lambda x, top: x / top + F.lit(0.0)).alias("vec")))  # the maximum once a vector
    # equal vectors once; 128 bits stand for a vector where its rows are found again
    rows = rows.withColumn("k1", F.xxhash64("vec")).withColumn("k2", F.xxhash64(F.lit(1), "vec"))
    distinct = cut_lineage(rows.where("vec IS NOT NULL").groupBy("k1", "k2").agg(
        F.first("vec").alias("vec"), F.min("id").alias("low"), F.count(F.lit(1)).alias("n")))
    axes = principal_dimensions(distinct, dimensions, sample)
    spark = vectors.sparkSession
    if axes.size:
        eps = float(np.sqrt(max(1e-12, 2 - 2 * cosine)))
        # sorted by the leading dimensions' cells, which is what intervals part by first
        norm = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda s, x: s + x * x))
        lead = [F.when(F.size("vec") == len(axes), F.aggregate(
            F.zip_with("vec", F.array(*[F.lit(float(v)) for v in axes[:, d]]), lambda x, y: x * y),
            F.lit(0.0), lambda s, x: s + x)).otherwise(F.coalesce(F.get("vec", F.lit(d)), F.lit(0.0))) / norm
            for d in range(min(2, axes.shape[1]))]
        order = [F.size("vec"), *[F.floor(p / eps) for p in lead], F.col("low")]
        dealt = distinct.repartitionByRange(*order).sortWithinPartitions(*order).select("vec", "low", "n")
        kinds = "vecs binary, lows binary, ns binary, lo array<double>, hi array<double>, interval bigint, width bigint"
        intervals = cut_lineage(in_workers(dealt).mapInArrow(_pack(axes, eps), kinds))
        # neighbours form blocks: few enough that a task holds two, enough for all tasks
        n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
        total = intervals.count()
        size = max(1, min(BLOCK, total // math.ceil(math.sqrt(2 * n))))
        in_order = Window.orderBy("interval")  # one row an interval, without its vectors
        boxes = (intervals.select("interval", "width", "lo", "hi")
                 .withColumn("block", F.floor((F.row_number().over(in_order) - 1) / size)))
        # which pairs are not provably apart: found on the boxes, by the cells of the first dimension
        spans = boxes.withColumn("cell", F.explode(F.sequence(
            F.floor(F.col("lo")[0] / eps), F.floor(F.col("hi")[0] / eps))))
        other = boxes.select(F.col("interval").alias("i2"), F.col("lo").alias("lo2"), F.col("hi").alias("hi2"),
                             F.col("block").alias("b2"), "width",
                             F.explode(F.sequence(F.floor(F.col("lo")[0] / eps) - 1,
                                                  F.floor(F.col("hi")[0] / eps) + 1)).alias("cell"))
        gap = F.zip_with(F.zip_with("lo", "hi2", lambda x, y: x - y), F.zip_with("lo2", "hi", lambda x, y: x - y),
                         lambda x, y: F.greatest(F.lit(0.0), x, y))
        pairs = cut_lineage(
            spans.join(other, ["width", "cell"]).where("interval <= i2")
            .where(F.aggregate(gap, F.lit(0.0), lambda s, x: s + x * x) <= (eps * (1 + 1e-9) + 1e-9) ** 2)
            .select(F.col("block").alias("b1"), "b2", F.col("interval").alias("i1"), "i2").distinct())
        others = pairs.groupBy("b1", "b2", "i1").agg(F.collect_list("i2").alias("others"))
        needed = (others.withColumnRenamed("i1", "interval").unionByName(
            pairs.select("b1", "b2", F.col("i2").alias("interval"), F.lit(None).cast("array<bigint>").alias("others")))
            .groupBy("b1", "b2", "interval").agg(F.max("others").alias("others")))
        joined = (intervals.select("interval", "width", "vecs", "lows", "ns").join(needed, "interval")
                  .repartition(n, "b1", "b2").sortWithinPartitions("b1", "b2"))
        found = cut_lineage(in_workers(joined).mapInArrow(_join(axes, cosine), "a bigint, links bigint, b bigint"))
    else:
        found = spark.createDataFrame([], "a bigint, links bigint, b bigint")
    direct = found.where("b IS NULL").groupBy("a").agg(F.sum("links").alias("links"))
    groups = connected_components(found.where("b IS NOT NULL").select("a", "b"))
    named = (distinct.select("k1", "k2", "low", "n")
             .join(direct.withColumnRenamed("a", "low"), "low", "left")
             .join(groups.withColumnRenamed("node", "low"), "low", "left")
             .select(F.col("k1").alias("d1"), F.col("k2").alias("d2"),
                     (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("links"),
                     F.coalesce("component", "low").alias("component")))
    out = (rows.withColumn("d1", F.when(F.col("vec").isNotNull(), F.col("k1")))
           .withColumn("d2", F.when(F.col("vec").isNotNull(), F.col("k2"))).select("id", "d1", "d2")
           .join(named, ["d1", "d2"], "left"))
    return out.select(F.col("id").alias(id_col), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
                      F.coalesce("component", "id").cast("long").alias("component_id"),
                      F.coalesce(F.col("id") == F.coalesce("component", "id"), F.lit(False)).alias("kept"))
