import hashlib
import random
import re

from ratelens.llm import winnow

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
TABLE = {ord(c): ord(c) + 32 for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def words(text):
    return WORD.findall((text or "").translate(TABLE))


def brute(docs, items, span=10):
    windows = {}
    for item, text in items:
        w = words(text)
        n = min(span, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            windows.setdefault(tuple(w[i:i + n]), set()).add(str(item))
    out = []
    for doc, text in docs:
        w = words(text)
        hit, found = set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                owners = windows.get(tuple(w[i:i + n]))
                if owners:
                    hit.update(range(i, i + n))
                    found |= owners
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((str(doc), len(w), len(hit), len(found), digest, bool(hit)))
    return sorted(out)


def rows(df):
    return sorted((str(r.doc_id), *r[1:]) for r in df.collect())


def test_whole_table_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    want = brute([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    got = rows(winnow.contamination(docs, items))
    assert got == want
    assert any(r[-1] for r in got)


def test_ties_repeats_short_items_and_edges(spark):
    rng = random.Random(3)
    vocabulary = ["the", "a", "é", "É", "Of", "x1", "nine"]

    def text(n):
        return " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, text(rng.choice([1, 2, 4, 9, 10, 11, 25]))) for i in range(12)]
    items += [(50, None), (51, ""), (52, "..."), (53, "the " * 30), (53, "A " * 12), (54, "the " * 30)]
    docs = [(i, text(rng.choice([0, 3, 9, 10, 40, 200]))) for i in range(30)]
    docs += [(100, None), (101, ""), (102, "THE-the_the " * 5000), (103, items[0][1] + "!"),
             (104, text(20) + " ".join(i[1] or "" for i in items))]
    d = spark.createDataFrame([(*r, 1, "w") for r in docs], "doc_id bigint, text string, id int, words string")
    b = spark.createDataFrame([(*r, "h") for r in items], "item_id bigint, text string, hash string")
    assert rows(winnow.contamination(d, b)) == brute(docs, items)
    assert all(not r.contaminated for r in winnow.contamination(d, b.limit(0)).collect())
    assert winnow.contamination(d.limit(0), b).collect() == []
    kept = winnow.drop_contaminated(d, b)
    assert kept.columns == d.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(r[0] for r in brute(docs, items) if not r[-1])


def test_without_broadcast_and_no_python_in_the_plan(spark, monkeypatch):
    monkeypatch.setattr(winnow, "BROADCAST_ROWS", 0)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    result = winnow.contamination(docs, items)
    want = brute([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert rows(result) == want
    plan = result._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
