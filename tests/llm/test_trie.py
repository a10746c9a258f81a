import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ratelens.llm import trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def ordered(rows):
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            convs[conv].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [t[2:] for t in sorted(turns)] for c, turns in convs.items()}


def graft(convs):
    out = {}
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = convs.get(c - c % 5, [])[:h] + turns[h:]
    return out


def brute(convs):
    """Every prefix by itself, bottom up."""
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    leaves, saved, out = {}, {}, []
    for p in sorted(members, key=len, reverse=True):
        own = (len(members[p]) - 1) * len(p[-1][1].encode()) if p else 0
        leaves[p] = sum(leaves[c] for c in children[p]) or 1
        saved[p] = own + sum(saved[c] for c in children[p])
        ends = ",".join(map(str, sorted(c for c in members[p] if len(convs[c]) == len(p))))
        out.append((min(members[p]), len(p), min(members[p[:-1]]) if p else None, len(members[p]), len(children[p]),
                    leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return out


def check(df, convs):
    got = [tuple(r) for r in df.select(COLUMNS).collect()]
    assert sorted(got, key=repr) == sorted(brute(convs), key=repr)


def units(turns):
    return b"".join(hashlib.md5(f"{len(r)}:{r}{t}".encode()).digest() + len(t.encode()).to_bytes(8, "big")
                    for r, t in turns)


def build(seqs, cuts):
    """The trie of ``seqs`` by ranges cut at ``cuts``, as the jobs do it."""
    convs = defaultdict(list)
    for c, s in enumerate(seqs):
        convs[tuple(s)].append(c)
    order = sorted(convs, key=units)
    bounds = [0, *sorted(c % (len(order) + 1) for c in cuts), len(order)]
    rows, paths = [], []
    for place, (lo, hi) in enumerate(zip(bounds, bounds[1:])):
        part, known = order[lo:hi], []
        for s in part:
            end = trie.Node(len(s))
            end.conv, end.n = min(convs[s]), len(convs[s])
            end.ends = hashlib.sha256(",".join(map(str, convs[s])).encode()).hexdigest()
            known.append({end.depth: end})
        bins = [units(s) for s in part]
        nodes = trie.forest(bins, known, closed=False)
        for batch in trie._rows(nodes, place, {0: bins[0], 1: bins[-1]} if bins else {}):
            for r in batch.to_pylist():
                (paths if r["open"] else rows).append(r)
    import pyarrow as pa
    paths.sort(key=lambda r: (r["range"], r["side"], r["depth"]))
    tops = [r for b in trie._merged_paths(iter([pa.RecordBatch.from_pylist(paths)] if paths else [])) for r in b.to_pylist()]
    name = {(r["range"], r["side"], r["open_depth"]): r["conv_id"] for r in tops}
    for r in rows:
        if r["range"] is not None:
            r["parent_conv_id"] = name[r["range"], r["side"], r["open_depth"]]
    return [tuple(r[c] if c != "ends_sha256" else r[c] or trie.EMPTY for c in COLUMNS)
            for r in rows + [t for t in tops if t["once"]]]


SEQS = st.lists(st.lists(st.tuples(st.sampled_from("ab"), st.sampled_from(["x", "", "éé"])), max_size=5), max_size=14)


@settings(max_examples=500, deadline=None)
@given(SEQS, st.lists(st.integers(0, 40), max_size=5))
def test_ranges_merge_to_the_whole_trie(seqs, cuts):
    want = brute(dict(enumerate(seqs)))
    assert sorted(build(seqs, cuts), key=repr) == sorted(want, key=repr)


def rows_of(rng, n):
    out = []
    for c in range(n):
        for t in range(rng.randint(0, 6)):
            out.append((c, t, rng.choice(["user", "assistant", None]), rng.choice(["a", "", None, "ß" * 3, "\n"])))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_tables_match_brute_force(spark, monkeypatch, seed):
    monkeypatch.setattr(trie, "IDS", 3)
    rng = random.Random(seed)
    rows = rows_of(rng, 120)
    hot = [(1000 + i, t, "user", f"same {t}") for i in range(60) for t in range(3)]  # a third of all
    rows += hot + [(None, 0, "user", "nobody"), (7, None, "user", "first"), (-3, 0, "user", "below"), (-7, 9, None, None)]
    rows += rows[:5] * 2 + [(5000, t, "user", "long") for t in range(400)] + [(5001, t, "user", "long") for t in range(390)]
    rows += [(6000, 0, "user", "x" * 100_000), (6001, 0, "user", "x" * 100_000)]
    convs = trie.turn_sequences(spark.createDataFrame(rows, SCHEMA).repartition(4))
    check(trie.prefix_trie(convs), ordered(rows))
    check(trie.prefix_trie(trie.grafted(convs)), {c: t for c, t in graft_trunc(ordered(rows)).items()})


def graft_trunc(convs):
    """As ``graft``; the remainder has the sign of the id, as in SQL."""
    out = {}
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        out[c] = convs.get(base, [])[:h] + turns[h:]
    return out


def test_empty_table_extra_columns_and_ties(spark):
    empty = trie.prefix_trie(trie.turn_sequences(spark.createDataFrame([], SCHEMA)))
    assert empty.columns == COLUMNS and empty.collect() == []
    rows = [(1, 0, "user", "a"), (1, 0, "user", "a"), (2, 0, "user", "a")]
    df = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], SCHEMA + ", depth int, seq int, `range` int")
    check(trie.prefix_trie(trie.turn_sequences(df)), ordered(rows))
    tied = [(1, 0, "user", "b"), (1, 0, "user", "a"), (2, 0, "user", "a"), (2, 0, "user", "b")]
    one, two = (trie.prefix_trie(trie.turn_sequences(spark.createDataFrame(t, SCHEMA))) for t in (tied, tied[::-1]))
    assert sorted(map(tuple, one.collect()), key=repr) == sorted(map(tuple, two.collect()), key=repr)
