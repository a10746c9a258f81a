"""SimHash near-duplicates, searched with BK-trees.

A document's fingerprint is 64 bits: bit i is 1 if it is set in more than half
of the hashes of the document's word shingles.  Two documents are linked if
their fingerprints differ in at most ``max_distance`` bits; a component of
links is one group of near duplicates.

Search.  Only distinct fingerprints take part.  Fingerprints that differ in at
most d bits agree on at least one of d + 1 bands of bits, so each fingerprint
goes to d + 1 shards keyed by (band, band value).  A shard's fingerprints form
a BK-tree: the children of a node are keyed by their Hamming distance to it,
and a search with radius d follows only the edges within d of the query's
distance to the node.  A shard of more than ``SHARD`` fingerprints is cut into
parts by hash; the tree of each part is sent to the parts it is compared with
(one task per pair of parts), so what a task holds stays bounded.

Copies of one text share a fingerprint and cost nothing; within a dense group
a search skips subtrees that already belong to the query's component, and
each task reports only the links that join two components, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratelens.llm.common import cut_lineage, hex16, in_workers
from ratelens.llm.components import connected_components

SEED = 42
BLOCK = 1 << 16      # shingles whose bits are counted at a time
SHARD = 2048         # fingerprints in one BK-tree
SLICE = 8 << 20      # bytes of text handled between two output batches


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """SimHash of one text as an unsigned 64-bit number.

    A-Z are lower-cased; words are runs without ASCII white space.  Fewer
    words than a shingle form one shingle; no words (or NULL) give 0.
    """
    words = (text or "").encode("utf-8").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    size = min(shingle, len(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = len(words) - size + 1
    spans = zip(starts[:n].tolist(), ends[size - 1:].tolist())
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    left = n
    while left:
        take = min(left, BLOCK)
        block = np.fromiter((digest(joined[a:b], SEED) for (a, b), _ in zip(spans, range(take))),
                            np.uint64, take)
        bits = np.unpackbits(block.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1,
                             bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
        left -= take
    chosen = np.packbits((counts * 2 > n).astype(np.uint8), bitorder="little")
    return int(chosen.view("<u8")[0])


def _slices(texts: pa.Array, limit: int = SLICE) -> Iterator[pa.Array]:
    start = size = 0
    lengths = pc.binary_length(texts).to_pylist()
    for i, n in enumerate(lengths):
        size += n or 0
        if size >= limit:
            yield texts.slice(start, i + 1 - start)
            start, size = i + 1, 0
    if start < len(lengths):
        yield texts.slice(start)


def _fingerprints(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [fingerprint(t.as_py(), shingle)
                      for part in _slices(batch.column(1)) for t in part]
            signed = np.array(values, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(signed, pa.int64())],
                                             names=["id", "fp"])
    return run


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = 3) -> DataFrame:
    """``(id, fp)`` per row of ``docs``; fp is the fingerprint as a signed
    64-bit number."""
    kind = docs.schema[id_col].dataType.simpleString()
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return in_workers(narrow).mapInArrow(_fingerprints(shingle), f"id {kind}, fp bigint")


class BKTree:
    """A BK-tree over 64-bit numbers that keeps the components of its links.

    ``label`` of a node is a member of the component that its whole subtree
    belongs to, or -1 when the subtree holds several: searches skip subtrees
    of the query's own component.
    """

    def __init__(self, radius: int):
        self.radius = radius
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []
        self.label: list[int] = []
        self.parent: list[int] = []  # of the union-find; also holds queries
        self.links: list[tuple[int, int]] = []

    def find(self, i: int) -> int:
        parent = self.parent
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    def search(self, value: int, me: int) -> None:
        """Link ``me`` (a slot of the union-find) to one member of every
        component that has a fingerprint within the radius."""
        if not self.values:
            return
        radius, values, children, label = self.radius, self.values, self.children, self.label
        mine = self.find(me)
        stack = [0]
        while stack:
            node = stack.pop()
            if label[node] >= 0 and self.find(label[node]) == mine:
                continue
            gap = (value ^ values[node]).bit_count()
            if gap <= radius:
                root = self.find(node)
                if root != mine:
                    self.parent[mine] = root
                    mine = root
                    self.links.append((value, values[node]))
            below = children[node]
            if below:
                for edge in range(gap - radius, gap + radius + 1):
                    child = below.get(edge)
                    if child is not None:
                        stack.append(child)

    def insert(self, value: int) -> None:
        """Add a fingerprint after linking it to the tree's components."""
        me = len(self.values)
        self.parent.append(me)
        self.search(value, me)
        if me:
            node, mine = 0, self.find(me)
            while True:
                if self.label[node] >= 0 and self.find(self.label[node]) != mine:
                    self.label[node] = -1
                edge = (value ^ self.values[node]).bit_count()
                child = self.children[node].get(edge)
                if child is None:
                    self.children[node][edge] = me
                    break
                node = child
        self.values.append(value)
        self.children.append({})
        self.label.append(me)

    def query(self, value: int) -> None:
        """Link a fingerprint that is not part of the tree."""
        me = len(self.parent)
        self.parent.append(me)
        self.search(value, me)


def _search_units(radius: int):
    """Rows sorted by (unit, asks): the tree's fingerprints of a unit first,
    then the queries; emits the links found."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, tree = None, BKTree(radius)
        for batch in batches:
            out: list[tuple[int, int]] = []
            units = zip(*(batch.column(i).to_pylist() for i in range(3)))
            for key, part, row in units:
                if (key, part) != current:
                    out += tree.links
                    current, tree = (key, part), BKTree(radius)
                value = row["fp"] & 0xFFFFFFFFFFFFFFFF
                if row["asks"]:
                    tree.query(value)
                else:
                    tree.insert(value)
            out += tree.links
            tree.links = []
            a = np.array([x for x, _ in out], np.uint64).view(np.int64)
            b = np.array([y for _, y in out], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())],
                                             names=["a", "b"])
    return run


def bk_tree_links(fps: DataFrame, max_distance: int = 3, shard: int = SHARD) -> DataFrame:
    """Links ``(a, b)`` between distinct fingerprints ``fps(fp)`` that connect
    exactly those within ``max_distance`` bits (possibly through others)."""
    bands = max_distance + 1
    width = -(-64 // bands)
    key = F.explode(F.array(*[
        (F.shiftrightunsigned("fp", i * width).bitwiseAND((1 << min(width, 64 - i * width)) - 1)
         * bands + i) if bands > 1 else F.xxhash64("fp")
        for i in range(bands)]))
    keyed = fps.select("fp", key.alias("key"))
    crowded = (keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > shard)
               .select("key", F.ceil(F.col("n") / shard).cast("int").alias("parts")))
    mine = F.pmod(F.xxhash64("fp", "key"), F.col("parts")).cast("int")
    units = (keyed.join(crowded, "key", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
             .withColumn("mine", mine)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
             .select("key", (F.least("mine", "other") * F.col("parts")
                             + F.greatest("mine", "other")).alias("part"),
                     F.struct((F.col("mine") > F.col("other")).alias("asks"), "fp").alias("row")))
    dealt = units.repartition(F.col("key"), F.col("part")).sortWithinPartitions("key", "part", "row")
    return in_workers(dealt).mapInArrow(_search_units(max_distance), "a bigint, b bigint")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = 3, max_distance: int = 3) -> DataFrame:
    """``(id_col, fingerprint, component_id)`` per row of ``docs``.

    ``component_id`` is the smallest id reachable over links of at most
    ``max_distance`` differing bits, the row's own id included.  NULL or
    empty texts have fingerprint zero and are linked like any other; repeated
    rows stay repeated; a row with a NULL id keeps its fingerprint and takes
    its group's component; an empty table gives an empty result; other
    columns are not read.
    """
    rows = cut_lineage(fingerprints(docs, id_col, text_col, shingle))
    first = rows.groupBy("fp").agg(F.min("id").alias("low"))
    links = bk_tree_links(first.select("fp"), max_distance)
    groups = connected_components(links).withColumnRenamed("node", "fp")
    lowest = first.join(groups, "fp", "left")
    linked = (lowest.where("component IS NOT NULL").groupBy("component")
              .agg(F.min("low").alias("component_id")))
    named = (lowest.join(linked, "component", "left")
             .select("fp", F.coalesce("component_id", "low").alias("component_id")))
    return rows.join(named, "fp").select(
        F.col("id").alias(id_col), hex16(F.col("fp")).alias("fingerprint"), "component_id")


def keep_representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         shingle: int = 3, max_distance: int = 3) -> DataFrame:
    """Rows of ``docs`` whose id is the smallest of its near-duplicate group;
    columns stay as they are.  Rows with a NULL id are kept."""
    kept = (near_duplicates(docs.where(F.col(id_col).isNotNull()), id_col, text_col,
                            shingle, max_distance)
            .where(F.col(id_col) != F.col("component_id"))
            .select(F.col(id_col).alias("__gone")).distinct())
    return docs.join(kept, docs[id_col] == kept["__gone"], "left_anti")
