"""Every registered query against its SQL oracle (DuckDB) on the smallest
driver tables, and the parser query against plain-Python parsing."""

import math
from collections import Counter
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from ratelens.operators.parsed import parse_page
from ratelens.plans.standins import PARSED_PAGE_LAYOUT, QUERIES

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, Decimal):
        return str(v.normalize())
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


@pytest.mark.parametrize("key", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, duck, key):
    df = E.queries()[key](spark, SF_SMALL)
    rel = duck.sql(E.oracle_sql()[key])
    assert sorted(df.columns) == sorted(rel.columns)
    order = [rel.columns.index(c) for c in df.columns]
    got = Counter(tuple(_norm(x) for x in r) for r in df.collect())
    want = Counter(tuple(_norm(r[i]) for i in order) for r in rel.fetchall())
    assert got == want


def test_every_query_has_oracle_or_brute_force():
    core = {k for k in E.queries() if k in QUERIES}
    assert core == core & set(E.oracle_sql())


def test_parsed_run_matches_python(spark, duck):
    got = E.queries()["page_rate_shop_parsed"](spark, SF_SMALL)
    rows = Counter((r.request_id, r.scrape_position, r.agent, r.scrape_base_price, r.status)
                   for r in got.collect())
    want = Counter()
    for page_id, html in duck.sql("SELECT page_id, html FROM pages").fetchall():
        p = parse_page(html, [PARSED_PAGE_LAYOUT])
        if p is None or len(p["prices"]) < len(p["names"]):
            continue
        for i, name in enumerate(p["names"]):
            price = p["prices"][i].replace("$", "").replace(",", "")
            want[(str(page_id), i + 1, name, price, "offers")] += 1
    assert rows == want


def test_entry_runs(spark):
    from ratelens.plans.rateshop import OFFER_COLS
    df = E.entry(spark)
    assert df.columns == OFFER_COLS
    assert df.count() > 0
