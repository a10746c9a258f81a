import numpy as np
import pytest

from ratelens.llm import ego


def brute(rows, cosine=0.95):
    good = []
    for i, v in rows:
        ok = i is not None and v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)
        x = np.array(v, float) / np.abs(v).max() if ok else None
        good.append(x / np.linalg.norm(x) if ok else None)
    n = len(rows)
    parent = list(range(n))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    links = [0] * n
    for i in range(n):
        for j in range(i):
            a, b = good[i], good[j]
            if a is not None and b is not None and len(a) == len(b) and a @ b >= cosine:
                links[i] += 1
                links[j] += 1
                parent[find(i)] = find(j)
    low = {}
    for i in range(n):
        if rows[i][0] is not None:
            low[find(i)] = min(low.get(find(i), rows[i][0]), rows[i][0])
    return sorted((str(rows[i][0]), links[i], low.get(find(i)), rows[i][0] == low.get(find(i))
                   if rows[i][0] is not None else False) for i in range(n))


def result(df):
    return sorted((str(r.vec_id), r.n_links, r.component_id, r.kept) for r in df.collect())


@pytest.fixture(params=[(4096, 256), (16, 4)])
def small(request, monkeypatch):
    monkeypatch.setattr(ego, "INTERVAL", request.param[0])
    monkeypatch.setattr(ego, "LEAF", request.param[1])


def test_whole_table_against_brute_force(spark):
    rng = np.random.default_rng(1)
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").collect()]
    rows += [(10_000 + i, (np.array(v) + 0.03 * rng.normal(size=len(v))).tolist()) for i, v in rows[:60]]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    assert result(ego.near_duplicates(df)) == brute(rows)
    assert any(r[1] for r in result(ego.near_duplicates(df)))


def test_interval_join_against_all_pairs(small):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(90, 6))
    x[40:80] = x[rng.integers(0, 6, 40)] + 0.1 * rng.normal(size=(40, 6))
    x = ego._unit(x)
    order = np.argsort(x[:, 0])
    x = x[order]
    n = rng.integers(1, 4, 90)
    for cut in (30, 0):
        a, b = (x[:cut], x[cut:]) if cut else (x, x)
        na, nb = (n[:cut], n[cut:]) if cut else (n, n)
        got = ego.join_intervals(a, a[:, :2], na, b, b[:, :2], nb, not cut, 0.9)
        hit = a @ b.T >= 0.9
        if not cut:
            np.fill_diagonal(hit, False)
        assert (got[0] == hit @ nb).all()
        if cut:
            assert (got[1] == na @ hit).all()
        assert all(hit[i, j] for i, j in got[2])


def test_edges(spark):
    rng = np.random.default_rng(9)
    base = rng.normal(size=(5, 4))
    rows = [(i, (base[i % 5] * (1 + i) + 0.15 * rng.normal(size=4)).tolist()) for i in range(40)]
    rows += [(100, None), (101, []), (102, [0.0] * 4), (103, [1.0, None, 0.0, 0.0]), (104, [float("nan")] * 4),
             (105, [float("inf"), 1.0, 1.0, 1.0]), (106, [1.0, 2.0]), (107, [2.0, 4.1]), (108, [1.0]), (109, [-3.0]),
             (120, [1e-200, 0.0, 0.0, 0.0]), (121, [1e200, 1e190, 0.0, 1e200]), (122, [1.0, 0.0, 0.0, 1.0]),
             (123, [5e-324, 0.0, 0.0, 0.0]), (124, [1e308, 0.0, 1e308, 0.0]), (110, [0.0, 1.0, 0.0, 0.0]),
             (111, [-0.0, 1.0, 0.0, -0.0]), (112, [0.0, 5.0, 0.0, 0.0]), (112, [0.0, 5.0, 0.0, 0.0]), (None, [1.0] * 4)]
    rows += [(200 + i, base[0].tolist()) for i in range(20)]
    df = spark.createDataFrame([(i, v, "x", 3) for i, v in rows], "vec_id bigint, embedding array<double>, low string, n int")
    assert result(ego.near_duplicates(df)) == brute(rows)
    assert ego.near_duplicates(df.limit(0)).collect() == []
    assert [tuple(r) for r in ego.near_duplicates(df.where("vec_id = 100")).collect()] == [(100, 0, 100, True)]


def test_blocks_of_intervals_meet_each_other_once(spark, monkeypatch):
    monkeypatch.setattr(ego, "INTERVAL", 16)
    monkeypatch.setattr(ego, "BLOCK", 3)
    rng = np.random.default_rng(12)
    x = rng.normal(size=(500, 6))
    x[100:400] = x[rng.integers(0, 20, 300)] + 0.1 * rng.normal(size=(300, 6))
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(600 + i, v[:5].tolist()) for i, v in enumerate(x[:60])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    assert result(ego.near_duplicates(df)) == brute(rows)
