"""Chat formatting into a prefix tree.

Conversations are written turn by turn as ``<s>[ROLE]role[/ROLE]text</s>``;
control strings inside roles and texts are escaped, reversibly.  Tokens are
code points of that text.  Conversations that begin with the same turns share
these turns' tokens: the turns form a prefix tree (a run of turns that the
same conversations share is one node), and the tree is emitted depth first,
each node's tokens once, as one packed sequence.  Every node carries

* ``start``: the place of its first token in the packed sequence,
* ``position``: the position id of its first token, that is the number of
  tokens before it in each of its conversations; the others follow on,
* ``ancestors``: the intervals of the packed sequence that its tokens may
  attend to besides the node's own earlier tokens, root first,
* ``loss``: the intervals of its text that hold assistants' words.

A node's identity is the hash of all turns up to its first one, so equal
beginnings meet by hash whatever task they come from; the order is a sort by
the hashes along the path, and places are running sums over sorted ranges.  A
first turn or a conversation shared by a third of the input is one node: its
rows are counted by partial aggregates, never gathered.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratelens.llm.common import cut_lineage, in_workers

CONTROLS = ["<s>", "</s>", "[INST]", "[/INST]", "[ROLE]", "[/ROLE]"]
_CONTROL = re.compile("|".join(map(re.escape, CONTROLS)))
_ESCAPED = re.compile(r"\\(\\?)", re.S)
_TURN = re.compile(r"<s>\[ROLE\](.*?)\[/ROLE\](.*?)</s>", re.S)
LOSS_ROLE = "assistant"


def escape(text: str) -> str:
    """Double backslashes, and break control strings by a single one."""
    return _CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """A formatted turn, and where its text starts and stops in it."""
    head = f"<s>[ROLE]{escape(role)}[/ROLE]"
    body = escape(text)
    return f"{head}{body}</s>", len(head), len(head) + len(body)


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) turns of a formatted conversation."""
    return [(unescape(m[1]), unescape(m[2])) for m in _TURN.finditer(formatted)]


def _ordered_turns(conversations: DataFrame, id_col: str) -> DataFrame:
    """``(conv, turns)``: each conversation's turns in order; equal turn
    numbers are ordered by role and text, NULL turn numbers come first."""
    return (conversations.where(F.col(id_col).isNotNull())
            .groupBy(F.col(id_col).alias("conv"))
            .agg(F.sort_array(F.collect_list(F.struct(
                F.col("turn"), F.coalesce(F.col("role"), F.lit("")).alias("role"),
                F.coalesce(F.col("text"), F.lit("")).alias("text")))).alias("turns")))


def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv, turns) -> a row per turn: its number, the hash of all turns up
    to it, the tokens before it and its own."""
    for batch in batches:
        convs, ks, hashes, before, size = [], [], [], [], []
        for conv, turns in zip(batch.column(0).to_pylist(), batch.column(1)):
            chain, total = b"", 0
            for k, t in enumerate(turns):
                t = t.as_py()
                role, text = t["role"].encode(), t["text"].encode()
                chain = hashlib.blake2b(chain + len(role).to_bytes(8, "big") + role + text, digest_size=16).digest()
                n = len(format_turn(t["role"], t["text"])[0])
                convs.append(conv)
                ks.append(k)
                hashes.append(chain.hex())
                before.append(total)
                size.append(n)
                total += n
        yield pa.RecordBatch.from_arrays(
            [pa.array(convs, batch.schema.field(0).type), pa.array(ks, pa.int32()), pa.array(hashes, pa.string()),
             pa.array(before, pa.int64()), pa.array(size, pa.int64())],
            names=["conv", "k", "node", "before", "size"])


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, first, last, turns) -> the node's formatted text and its loss."""
    for batch in batches:
        texts, losses = [], []
        for first, last, turns in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3)):
            out, loss, at = [], [], 0
            for t in turns.values[first:last + 1]:
                t = t.as_py()
                text, a, b = format_turn(t["role"], t["text"])
                if t["role"] == LOSS_ROLE:
                    loss.append({"start": at + a, "stop": at + b})
                out.append(text)
                at += len(text)
            texts.append("".join(out))
            losses.append(loss)
        span = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string()), pa.array(losses, span)],
                                         names=["node", "text", "loss"])


def prefix_tree(conversations: DataFrame, id_col: str = "conv_id") -> tuple[DataFrame, DataFrame]:
    """``(packed, leaves)`` of a table of turns (``turn``, ``role``, ``text``).

    ``packed``: ``(node, start, length, position, depth, ancestors, text,
    loss)``, a row per node of the tree; ``start`` orders them depth first.
    ``leaves``: ``(conv, node)``, where each conversation ends.

    NULL texts and roles are empty; rows without a conversation id belong to no
    conversation and are left out; repeated rows are further turns; an empty
    table gives empty results; other columns are not read.
    """
    conversations = conversations.select(id_col, "turn", F.col("role").cast("string").alias("role"),
                                         F.col("text").cast("string").alias("text"))
    turns = _ordered_turns(conversations, id_col)
    kind = turns.schema["conv"].dataType.simpleString()
    paths = cut_lineage(in_workers(turns).mapInArrow(
        _paths, f"conv {kind}, k int, node string, before bigint, size bigint"))
    shared = paths.groupBy("node").agg(F.count(F.lit(1)).alias("uses"))
    counted = paths.join(shared, "node")
    # a node of the tree begins where fewer conversations go on than before
    steps = (counted.groupBy("conv").agg(F.sort_array(F.collect_list(
        F.struct("k", "node", "before", "size", "uses"))).alias("t"))
        .withColumn("heads", F.filter("t", lambda x, i: (i == 0) | (
            F.col("t")[F.greatest(i - 1, F.lit(0))]["uses"] != x["uses"])))
        .withColumn("last", F.element_at("t", -1)))
    spans = steps.select("conv", F.col("heads")["node"].alias("path"), F.posexplode(F.transform(
        "heads", lambda h, i: F.struct(
            h["node"].alias("node"), h["k"].alias("first"), h["before"].alias("position"),
            F.when(i + 1 < F.size("heads"), F.col("heads")[i + 1]["k"] - 1).otherwise(F.col("last")["k"]).alias("final"),
            F.when(i + 1 < F.size("heads"), F.col("heads")[i + 1]["before"])
            .otherwise(F.col("last")["before"] + F.col("last")["size"]).alias("stop")))).alias("depth", "n"))
    nodes = (spans.select("conv", "depth", "n.*", F.slice("path", F.lit(1), F.col("depth") + 1).alias("path"))
             .groupBy("node").agg(F.min("conv").alias("conv"), F.first("depth").alias("depth"),
                                  F.first("first").alias("first"), F.first("final").alias("final"),
                                  F.first("position").alias("position"),
                                  F.first(F.col("stop") - F.col("position")).alias("length"),
                                  F.first("path").alias("path")))
    # depth first: sorted by the hashes along the path, a node before those below it
    n = max(int(conversations.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    dealt = cut_lineage(nodes.repartitionByRange(n, "path").withColumn("part", F.spark_partition_id()))
    parts = (dealt.groupBy("part").agg(F.sum("length").alias("total"))
             .select("part", (F.sum("total").over(Window.orderBy("part")) - F.col("total")).alias("base")))
    within = Window.partitionBy("part").orderBy("path").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = cut_lineage(
        dealt.withColumn("upto", F.sum("length").over(within)).join(F.broadcast(parts), "part")
        .select("node", "conv", "first", "final", "depth", "position", "length", "path",
                (F.col("base") + F.col("upto") - F.col("length")).alias("start")))
    above = (placed.where("depth > 0").select("node", F.posexplode(F.slice("path", F.lit(1), F.col("depth"))).alias("d", "up"))
             .join(placed.select(F.col("node").alias("up"), F.col("start").alias("s"), F.col("length").alias("l")), "up")
             .groupBy("node").agg(F.sort_array(F.collect_list(F.struct(
                 "d", F.col("s").alias("start"), (F.col("s") + F.col("l")).alias("stop")))).alias("a"))
             .select("node", F.transform("a", lambda x: F.struct(
                 x["start"].alias("start"), x["stop"].alias("stop"))).alias("ancestors")))
    sources = placed.select("node", "first", "final", "conv").join(turns, "conv").select("node", "first", "final", "turns")
    texts = in_workers(sources).mapInArrow(
        _texts, "node string, text string, loss array<struct<start:bigint,stop:bigint>>")
    packed = (placed.select("node", "start", "length", "position", "depth").join(above, "node", "left")
              .withColumn("ancestors", F.coalesce("ancestors", F.array().cast("array<struct<start:bigint,stop:bigint>>")))
              .join(texts, "node"))
    leaves = steps.select("conv", F.element_at(F.col("heads")["node"], -1).alias("node"))
    return packed, leaves


def _read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv, pieces in order) -> what the formatted conversation holds."""
    for batch in batches:
        out = []
        for pieces in batch.column(1):
            pieces = pieces.as_py()
            formatted = "".join(p["text"] for p in pieces)
            turns = read_turns(formatted)
            said = [unescape(p["text"][s["start"]:s["stop"]]) for p in pieces for s in p["loss"]]
            digest = hashlib.sha256("".join(f"{role}\n{text}\n" for role, text in turns).encode()).hexdigest()
            loss = "".join(said)
            out.append((len(turns), digest, len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(formatted)))
        n, a, b, c, d = zip(*out) if out else ((),) * 5
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.int64()),
             pa.array(c, pa.string()), pa.array(d, pa.int64())],
            names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])


def read_conversations(packed: DataFrame, leaves: DataFrame) -> DataFrame:
    """Every conversation read from the packed tree: its last node, and the
    nodes at the intervals that this one attends to, root first.

    ``(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256,
    formatted_chars)``; the digests are of the unescaped turns and of the
    unescaped text under the loss mask.
    """
    packed = cut_lineage(packed)
    ends = leaves.join(packed.select("node", "start", "ancestors"), "node")
    wanted = ends.select("conv", F.explode(F.concat(
        F.col("ancestors")["start"], F.array("start"))).alias("start"))
    pieces = (wanted.join(packed.select("start", "position", "text", "loss"), "start")
              .groupBy("conv").agg(F.sort_array(F.collect_list(
                  F.struct("position", "text", "loss"))).alias("pieces")))
    kind = pieces.schema["conv"].dataType.simpleString()
    return in_workers(pieces).mapInArrow(
        _read_back, f"conv_id {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, "
        "loss_sha256 string, formatted_chars bigint")
