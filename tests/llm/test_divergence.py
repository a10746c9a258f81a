import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ratelens.llm import divergence

SCHEMA = "doc_id bigint, text string, lang string, source string"
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute(rows):
    docs = [(lang or "", source or "", TERM.findall("".join(c.lower() if c.isascii() else c for c in text or "")))
            for _, text, lang, source in rows]
    out = []
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        seen = Counter(t for d in mine for t in set(d[2]))
        kept = sorted(t for t in seen if seen[t] >= 3)
        counts = {s: Counter() for s in {d[1] for d in mine}}
        for _, s, terms in mine:
            counts[s].update(t for t in terms if seen[t] >= 3)
        whole = sum(counts.values(), Counter())

        def given(c):
            size = sum(c.values()) + len(kept)
            return {t: 1 + 10**9 * (c[t] + 1) // size for t in kept}

        ps, q = {s: given(c) for s, c in counts.items()}, given(whole)
        for s, p in ps.items():
            pair = [(sum((p[t] - r[t]) ** 2 // r[t] for t in kept), o) for o, r in ps.items() if o != s]
            term = [((p[t] - q[t]) ** 2 // q[t], t) for t in kept if counts[s][t] and p[t] > q[t]]
            for part, found in (("pair", pair), ("term", term)):
                ranked = sorted(found, key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, t, v, i + 1) for i, (v, t) in enumerate(ranked) if part == "pair" or i < divergence.TOP]
    return sorted(out)


def check(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert sorted(map(tuple, divergence.divergences(df).collect())) == brute(rows)


WORDS = "a B c É é zürich Ω 日本 x_y don't A1b _ \x00 \x7f K".split(" ")


@pytest.mark.parametrize("small", [False, True])
def test_matches_brute_force(spark, monkeypatch, small):
    if small:  # several shards, blocks of sources, stretches and partial counts
        for name, value in (("SHARD", 8), ("SOURCES", 3), ("CELLS", 10), ("BYTES", 64), ("ROWS", 40)):
            monkeypatch.setattr(divergence, name, value)
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice(WORDS) + rng.choice(["", "q", "r"]) for _ in range(rng.randint(0, 30))),
             rng.choice(["en", "en", "de", None, ""]), rng.choice([None, "", "s1", "s2", "s3", "S1", "é", "日"]))
            for i in range(150)]
    rows += [(None, None, "en", "s1"), (1, "", "en", "only-empty"), (1, "common " * 3000, "en", "s1")] + rows[:3] * 4
    rows += [(i, "hot word common", "en", "hot") for i in range(200)]
    rows += [(i, f"É{i} ÉÉ wörd " * 3, "de", "s2") for i in range(40)]
    rows += [(7, "rare", "xx", "s1"), (8, "other", "xx", "s2"), (9, None, "yy", "alone")]
    check(spark, rows)


def test_many_terms_keep_only_the_top(spark, monkeypatch):
    monkeypatch.setattr(divergence, "TOP", 5)
    words = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(60)]
    check(spark, [(i, " ".join(words[:i + 20] * (1 + i % 2)), "en", f"s{i % 2}") for i in range(12)])


def test_empty_table_and_extra_columns(spark):
    assert divergence.divergences(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = [(i, "a b c", "en", f"s{i % 2}") for i in range(6)]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(1) for c in ("term", "n", "total", "p", "shard", "rank")})
    assert sorted(map(tuple, divergence.divergences(df).collect())) == brute(rows)


def test_counts_beyond_32_bits_stay_exact(spark):
    n, size = 10**15 + 7, 3 * 10**15 + 1
    got = spark.range(1).select(divergence._p(F.lit(n), F.lit(size)).alias("p")).first().p
    assert got == 1 + 10**9 * (n + 1) // size
