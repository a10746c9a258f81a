import random

import xxhash
from pyspark.sql import functions as F

from ratelens.llm import simhash
from ratelens.llm.components import connected_components

SCHEMA = "doc_id bigint, text string, fp string, component long, text_2 string"


def brute_fingerprint(text, size=3):
    words = [w.lower() for w in (text or "").encode().split()]
    grams = [b" ".join(words[i:i + size]) for i in range(len(words) - size + 1)]
    if words and not grams:
        grams = [b" ".join(words)]
    hashes = [xxhash.xxh64(g, seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def brute_groups(fps, radius=3):
    """fps: list of (id, fingerprint) -> id -> smallest id reachable."""
    parent = list(range(len(fps)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i][1] ^ fps[j][1]).bit_count() <= radius:
                parent[find(i)] = find(j)
    low = {}
    for i, (doc, _) in enumerate(fps):
        low[find(i)] = min(low.get(find(i), doc), doc)
    return sorted((doc, low[find(i)]) for i, (doc, _) in enumerate(fps))


def test_whole_table_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    fps = [(i, brute_fingerprint(t)) for i, t in texts]
    got = simhash.near_duplicates(docs).collect()
    assert sorted((r.doc_id, r.fingerprint) for r in got) == sorted((i, f"{f:016x}") for i, f in fps)
    assert sorted((r.doc_id, r.component_id) for r in got) == brute_groups(fps)


def test_links_and_crowded_shards_against_brute_force(spark):
    rng = random.Random(5)
    centres = [rng.getrandbits(64) for _ in range(6)]
    values = {0, (1 << 64) - 1}
    for c in centres:
        for _ in range(60):
            v = c
            for _ in range(rng.randrange(8)):
                v ^= 1 << rng.randrange(64)
            values.add(v)
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in sorted(values)]
    fps = spark.createDataFrame(signed, "fp bigint")
    want = brute_groups([(s[0], s[0] & (1 << 64) - 1) for s in signed])
    for shard in (10, 2048):
        links = simhash.bk_tree_links(fps, 3, shard)
        assert links.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) > 3).count() == 0
        groups = {r.node: r.component for r in connected_components(links).collect()}
        assert sorted((s[0], groups.get(s[0], s[0])) for s in signed) == want


def test_edge_cases(spark):
    long = "Long text " * 40_000
    rows = [(1, None, "x", 1, "y"), (2, "", None, None, None), (3, " \t\n ", "x", 1, "y"),
            (4, "One two", "x", 1, "y"), (5, "one TWO", "x", 1, "y"), (6, "É one", "x", 1, "y"),
            (6, "É one", "x", 1, "y"), (7, long, "x", 1, "y"), (8, long + "end", "x", 1, "y"),
            (None, "nobody", "x", 1, "y")]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = {}
    for r in simhash.near_duplicates(docs).collect():
        got.setdefault(r.doc_id, []).append((r.fingerprint, r.component_id))
    for i, text, *_ in rows:
        assert got[i][0][0] == f"{brute_fingerprint(text):016x}"
    assert got[1][0][1] == got[2][0][1] == got[3][0][1] == 1      # no words: linked like any other
    assert got[4][0][1] == got[5][0][1] == 4
    assert len(got[6]) == 2 and len(got[None]) == 1
    kept = simhash.keep_representatives(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "4", "6", "6", "7", "8", "None"]  # 8's last shingle settles 7's ties
    assert simhash.near_duplicates(docs.limit(0)).collect() == []


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(7, 7), (None, 3), (200, 201), (201, 200)]
    df = spark.createDataFrame(links, "a bigint, b bigint")
    got = {r.node: r.component for r in connected_components(df).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 140)}, 200: 200, 201: 200}
    assert connected_components(df.limit(0)).collect() == []
