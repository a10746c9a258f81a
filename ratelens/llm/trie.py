"""The prefix trie of a set of conversations, by union-find over sorted
neighbours.

A conversation is a sequence of turns, a turn a (role, text).  Every distinct
sequence of first d turns is a node of depth d; a node's members are the
conversations that start with it.  In sorted order a node's members stand
together, and two neighbours share exactly the nodes down to their longest
common prefix (LCP).  So the trie is built from the edges between neighbours:
taken in descending order of LCP, each edge joins two components of a
union-find; before it does, both components grow upwards to the edge's depth,
a node a step, and the join makes (or widens) the branching node there.

Sequences are sorted by range, and every range builds the forest of its own
distinct sequences.  What neighbouring ranges may share are the nodes on the
paths to a range's first and last sequence: these paths stay open.  All other
nodes are final; each is contracted into the open node it hangs on, as a sum.
The contracted forests, two paths a range, are merged across the boundaries
by the same union-find, over the LCPs between the paths' ends.  Their size is
the number of ranges times the depth, whatever the number of conversations.

A turn travels as the MD5 of its role and text and its text's length, 24
bytes; equal digests count as equal turns.  A conversation is one row of such
turns; copies of it are one row with a count before the forests are built.
The ids of equal conversations are written in sorted stretches by many tasks,
and only these are read on, one after another, for a digest.

Defined results: rows without a conv_id belong to no conversation; NULL role
and text are empty; turns are ordered by turn, NULL first, then by the digest
where turns tie; equal rows are turns of their own; a conversation without
turns ends at the root; an empty table has no nodes, not even a root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import pairwise

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratelens.llm.common import cut_lineage, in_workers

#: bytes of a turn: digest, length of the text
TURN, DIGEST = 24, 16
#: ids of equal conversations that one row holds while their digest is made
IDS = 1000
EMPTY = hashlib.sha256(b"").hexdigest()

_NODE = ("conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, "
         "n_leaves bigint, saved_tokens bigint, ends_sha256 string")
#: a node that is final, or (open) a part of one; ``range``, ``side``, ``open_depth``
#: name the open node that it is, or else hangs on
_PART = _NODE + ", open boolean, range bigint, side bigint, open_depth bigint, turn binary"


def turn_sequences(conversations: DataFrame) -> DataFrame:
    """``conversations(conv_id, turn, role, text)`` -> ``(conv_id, turns)``, the
    ordered turns as binaries of ``TURN`` bytes."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    size = F.octet_length(text).cast("bigint")
    digest = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))
    return (conversations.where("conv_id IS NOT NULL")
            .select("conv_id", F.struct("turn", F.concat(digest, F.lpad(F.hex(size), 16, "0")).alias("said")).alias("t"))
            .groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
            .select("conv_id", F.col("t")["said"].alias("turns")))


def _sequences(convs: DataFrame) -> DataFrame:
    """``convs(conv_id, turns)`` -> distinct sequences ``(seq, conv_id,
    n_convs, ends_sha256)`` with their smallest id, number and ids' digest."""
    seqs = cut_lineage(convs.select("conv_id", F.unhex(F.array_join("turns", "")).alias("seq"))
                       .withColumn("same", F.unhex(F.md5("seq"))))
    stretches = (in_workers(seqs.select("same", "conv_id")).repartitionByRange("same", "conv_id")
                 .sortWithinPartitions("same", "conv_id")
                 .mapInArrow(_stretches, "same binary, first bigint, n bigint, ids string"))
    digests = (stretches.repartition("same").sortWithinPartitions("same", "first")
               .mapInArrow(_digests, "conv_id bigint, n_convs bigint, ends_sha256 string"))
    return seqs.select("conv_id", "seq").join(digests, "conv_id")


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (same, conv_id) -> runs of at most ``IDS`` ids as text."""
    same, ids, done = None, [], []

    def rows() -> pa.RecordBatch:
        return pa.record_batch({"same": pa.array([d[0] for d in done], pa.binary()),
                                "first": pa.array([d[1] for d in done], pa.int64()),
                                "n": pa.array([d[2] for d in done], pa.int64()),
                                "ids": pa.array([d[3] for d in done], pa.string())})

    def close() -> None:
        if ids:
            done.append((same, ids[0], len(ids), ",".join(map(str, ids))))

    for batch in batches:
        for s, i in zip(batch["same"].to_pylist(), batch["conv_id"].to_pylist()):
            if s != same or len(ids) == IDS:
                close()
                same, ids = s, []
            ids.append(i)
        yield rows()
        done = []
    close()
    yield rows()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stretches, sorted -> per sequence the smallest id, the number of ids and
    the digest of them all; only the running digest is held."""
    same, first, n, sha, done = None, None, 0, None, []

    def rows() -> pa.RecordBatch:
        ids, counts, digests = zip(*done) if done else ((), (), ())
        return pa.record_batch({"conv_id": pa.array(ids, pa.int64()), "n_convs": pa.array(counts, pa.int64()),
                                "ends_sha256": pa.array(digests, pa.string())})

    for batch in batches:
        for s, f, k, text in zip(*(batch[c].to_pylist() for c in ("same", "first", "n", "ids"))):
            if s != same or sha is None:
                if sha is not None:
                    done.append((first, n, sha.hexdigest()))
                same, first, n, sha = s, f, 0, hashlib.sha256()
            else:
                sha.update(b",")
            sha.update(text.encode())
            n += k
        yield rows()
        done = []
    if sha is not None:
        done.append((first, n, sha.hexdigest()))
    yield rows()


def _lcp(a: bytes, b: bytes) -> int:
    """Turns that two sequences share at their start."""
    n = min(len(a), len(b)) // TURN
    if a[:n * TURN] == b[:n * TURN]:
        return n
    lo, hi = 0, n  # shares lo turns, doesn't share hi
    while hi - lo > 1:
        mid = (lo + hi) // 2
        lo, hi = (mid, hi) if a[lo * TURN:mid * TURN] == b[lo * TURN:mid * TURN] else (lo, mid)
    return lo


class Node:
    """A node, or what is known of it so far: sums over its final children and
    the conversations that end here."""

    __slots__ = ("depth", "conv", "n", "children", "leaves", "saved", "ends", "below", "parent", "open", "names")

    def __init__(self, depth: int):
        self.depth, self.conv, self.n, self.children, self.leaves, self.saved = depth, None, 0, 0, 0, 0
        self.ends, self.below, self.parent, self.open, self.names = None, [], None, None, []

    def add(self, other: Node) -> None:
        """``other`` is the same node, seen from a neighbour."""
        self.conv = other.conv if self.conv is None else self.conv if other.conv is None else min(self.conv, other.conv)
        self.n += other.n
        self.children += other.children
        self.leaves += other.leaves
        self.saved += other.saved
        self.ends = self.ends or other.ends
        if len(self.below) < len(other.below):
            self.below, other.below = other.below, self.below
        self.below += other.below
        self.names += other.names


def forest(seqs: list[bytes], known: list[dict[int, Node]], closed: bool) -> list[Node]:
    """All nodes of the trie of ``seqs``, sorted; ``known[i]`` holds, by depth,
    what is known beforehand of the nodes on the path to ``seqs[i]``, its end
    always.  Unless ``closed``, nodes on the paths to the first and the last
    sequence stay open: nothing is added up from or through them."""
    n, nodes = len(seqs), []
    if not n:
        return nodes
    parent, left, right = list(range(n)), list(range(n)), list(range(n))
    head = [k.pop(len(s) // TURN) for s, k in zip(seqs, known)]  # topmost node of a component, still growing

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    def grow(i: int, depth: int) -> None:
        """End component ``i``'s head, and the nodes above it down to ``depth``."""
        while head[i].depth > depth:
            node = head[i]
            if not closed and left[i] == 0:
                node.open = 0
            elif not closed and right[i] == n - 1:
                node.open = 1
            else:
                node.leaves = node.leaves or 1
                if node.depth:
                    unit = seqs[i][(node.depth - 1) * TURN:node.depth * TURN]
                    node.saved += (node.n - 1) * int.from_bytes(unit[DIGEST:], "big")
            for child in node.below:
                child.parent = node
            node.below = ()
            nodes.append(node)
            if not node.depth:
                return
            up = known[i].pop(node.depth - 1, None) or Node(node.depth - 1)
            if node.open is None:
                up.conv = node.conv if up.conv is None else min(up.conv, node.conv)
                up.n += node.n
                up.children += 1
                up.leaves += node.leaves
                up.saved += node.saved
            up.below.append(node)
            head[i] = up

    shared = [_lcp(a, b) for a, b in pairwise(seqs)]
    for at in sorted(range(n - 1), key=lambda i: -shared[i]):
        a, b = find(at), find(at + 1)
        grow(a, shared[at])
        grow(b, shared[at])
        small, big = (a, b) if len(known[a]) < len(known[b]) else (b, a)
        parent[small] = big
        left[big], right[big] = left[a], right[b]
        head[big].add(head[small])
        for depth, node in known[small].items():
            known[big].setdefault(depth, Node(depth)).add(node)
        known[small] = {}
    grow(find(0), -1)
    return nodes


def _rows(nodes: list[Node], place: int, path: dict[int, bytes]) -> Iterator[pa.RecordBatch]:
    """The columns of ``_PART``; an open node's turn is read from ``path``, by
    the end that it belongs to."""
    for at in range(0, len(nodes), 10_000):
        part = nodes[at:at + 10_000]
        hung = [v if v.open is not None else v.parent if v.parent is not None and v.parent.open is not None else None
                for v in part]
        yield pa.record_batch({
            "conv_id": pa.array([v.conv for v in part], pa.int64()),
            "depth": pa.array([v.depth for v in part], pa.int64()),
            "parent_conv_id": pa.array([None if h is not None or v.parent is None else v.parent.conv
                                        for v, h in zip(part, hung)], pa.int64()),
            "n_convs": pa.array([v.n for v in part], pa.int64()),
            "n_children": pa.array([v.children for v in part], pa.int64()),
            "n_leaves": pa.array([v.leaves for v in part], pa.int64()),
            "saved_tokens": pa.array([v.saved for v in part], pa.int64()),
            "ends_sha256": pa.array([v.ends for v in part], pa.string()),
            "open": pa.array([v.open is not None for v in part], pa.bool_()),
            "range": pa.array([None if h is None else place for h in hung], pa.int64()),
            "side": pa.array([None if h is None else h.open for h in hung], pa.int64()),
            "open_depth": pa.array([None if h is None else h.depth for h in hung], pa.int64()),
            "turn": pa.array([path[v.open][(v.depth - 1) * TURN:v.depth * TURN] if v.open is not None and v.depth else None
                              for v in part], pa.binary()),
        })


def _range_forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted distinct sequences of one range -> its nodes, open or final."""
    seqs, known, place = [], [], 0
    for batch in batches:
        for seq, conv, n, ends, place in zip(*(batch[c].to_pylist() for c in (
                "seq", "conv_id", "n_convs", "ends_sha256", "range"))):
            end = Node(len(seq) // TURN)
            end.conv, end.n, end.ends = conv, n, ends
            seqs.append(seq)
            known.append({end.depth: end})
    if seqs:
        yield from _rows(forest(seqs, known, closed=False), place, {0: seqs[0], 1: seqs[-1]})


def _merged_paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The open nodes of all ranges, sorted by range, side and depth -> final
    nodes, one row for each of the open nodes that it is made of."""
    seqs, known, last = [], [], None
    for batch in batches:
        for r in batch.to_pylist():
            here = (r["range"], r["side"])
            if here != last:
                # the second path leaves the first one where its own nodes begin
                seqs.append(seqs[-1][:(r["depth"] - 1) * TURN] if r["side"] else b"")
                known.append({})
                last = here
            seqs[-1] += r["turn"] or b""
            node = known[-1][r["depth"]] = Node(r["depth"])
            node.conv, node.n, node.children, node.leaves = r["conv_id"], r["n_convs"], r["n_children"], r["n_leaves"]
            node.saved, node.ends, node.names = r["saved_tokens"], r["ends_sha256"], [(*here, r["depth"])]
    named: list[list] = [[] for _ in range(12)]
    for v in forest(seqs, known, closed=True):
        values = (v.conv, v.depth, v.parent and v.parent.conv, v.n, v.children, v.leaves, v.saved, v.ends)
        for k, (place, side, depth) in enumerate(v.names):
            for column, value in zip(named, (*values, k == 0, place, side, depth)):
                column.append(value)
    types = [pa.int64()] * 7 + [pa.string(), pa.bool_()] + [pa.int64()] * 3
    fields = [f.split()[0] for f in _NODE.split(", ")] + ["once", "range", "side", "open_depth"]
    yield pa.record_batch({f: pa.array(c, t) for f, c, t in zip(fields, named, types)})


def prefix_trie(convs: DataFrame) -> DataFrame:
    """``convs(conv_id, turns)``, ids distinct -> one row per node: ``conv_id``
    (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``,
    ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256``."""
    ranged = (_sequences(convs).repartitionByRange("seq").withColumn("range", F.spark_partition_id().cast("bigint"))
              .sortWithinPartitions("seq"))
    parts = cut_lineage(in_workers(ranged).mapInArrow(_range_forest, _PART))
    name = ["range", "side", "open_depth"]
    paths = parts.where("open").drop("parent_conv_id", "open", "open_depth")
    tops = cut_lineage(paths.repartition(1).sortWithinPartitions("range", "side", "depth")
                       .mapInArrow(_merged_paths, _NODE + ", once boolean, range bigint, side bigint, open_depth bigint"))
    columns = [f.split()[0] for f in _NODE.split(", ")]
    final = parts.where("NOT open")
    hung = (final.where("range IS NOT NULL").drop("parent_conv_id")
            .join(tops.select(*name, F.col("conv_id").alias("parent_conv_id")), name))
    return (final.where("range IS NULL").select(*columns).unionByName(hung.select(*columns))
            .unionByName(tops.where("once").select(*columns))
            .withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(EMPTY))))


def grafted(convs: DataFrame, every: int = 5, most: int = 9) -> DataFrame:
    """Conversations that begin alike: every id c gets the first h turns of
    conversation ``c - c % every`` (all if fewer, none if absent) and then its
    own turns after the first h; h is the CRC-32 of c's digits modulo ``most``."""
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int")
    base = convs.select(F.col("conv_id").alias("base"), F.col("turns").alias("start"))
    rest = F.slice("turns", h + 1, F.greatest(F.size("turns"), F.lit(1)))
    return (convs.withColumn("base", F.col("conv_id") - F.col("conv_id") % every).join(base, "base", "left")
            .select("conv_id", F.concat(F.slice(F.coalesce("start", F.array().cast("array<string>")), F.lit(1), h), rest)
                    .alias("turns")))
