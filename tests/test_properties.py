"""Property tests over generated pages and manifests."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ratelens.operators.numbering import with_chunk_id
from ratelens.plans.rateshop import run_rate_shop

from golden import LAYOUTS, container, price, seller

name = st.text(alphabet="abcXYZ &;é", min_size=0, max_size=6)
page = st.one_of(
    st.lists(st.tuples(name, st.sampled_from(["$1", "$2,500", "", "€3"])), max_size=5).map(
        lambda xs: container("".join(seller(n) + price(p) for n, p in xs))),
    st.sampled_from([container('<div class="na-one">x</div>'),
                     container('<div class="MEVoGd AdWm1c">c</div>'),
                     "<html></html>", "", None,
                     container(seller("A") + seller("B") + price("$1"))]),
)


def _requests(spark, n):
    rows = [(f"r{i}", str(i), f"H{i}", "C", "d1", "d2", "1", "$1") for i in range(n)]
    return spark.createDataFrame(rows, "request_id string, hotel_id string, hotel string, "
                                       "city string, check_in string, check_out string, "
                                       "nights string, listed_base_price string")


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(page, min_size=1, max_size=8), st.integers(0, 3))
def test_every_request_exactly_once(spark, pages, missing):
    n = len(pages) + missing
    caps = spark.createDataFrame(
        [(f"r{i}", i, "u", h, dt.datetime(2024, 1, 1)) for i, h in enumerate(pages)],
        "request_id string, page_id bigint, url string, html string, captured_at timestamp_ntz")
    out = run_rate_shop(_requests(spark, n), caps, LAYOUTS, "2024-05-01", engine="parser", cut_lineage=False)
    outcomes = out.outcomes.select("request_id", "status", "n_offers").collect()
    assert sorted(r.request_id for r in outcomes) == sorted(f"r{i}" for i in range(n))
    offers = out.offers.collect()
    broken = {r.request_id for r in out.reattempt.collect()}
    for o in outcomes:
        rows = [r for r in offers if r.request_id == o.request_id]
        if o.status == "offers":
            assert sorted(r.scrape_position for r in rows) == list(range(1, o.n_offers + 1))
        elif o.status in ("not_available", "contact"):
            assert len(rows) == 1 and rows[0].agent is None
        else:
            assert not rows and o.request_id in broken
    summary = out.summary.collect()
    assert sum(r.requests for r in summary) == n
    assert sum(r.offers for r in summary) == sum(1 for r in offers if r.status == "offers")


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(page, min_size=1, max_size=10), st.integers(1, 4))
def test_chunked_runs_union_to_whole_run(spark, pages, size):
    caps = spark.createDataFrame(
        [(f"r{i}", i, "u", h, None) for i, h in enumerate(pages)],
        "request_id string, page_id bigint, url string, html string, captured_at timestamp_ntz")
    req = with_chunk_id(_requests(spark, len(pages)), ["request_id"], size)
    whole = run_rate_shop(req, caps, LAYOUTS, "2024-05-01", engine="parser", cut_lineage=False).offers
    parts = None
    for (c,) in req.select("chunk_id").distinct().collect():
        part = run_rate_shop(req.filter(F.col("chunk_id") == c), caps, LAYOUTS, "2024-05-01", engine="parser",
                             cut_lineage=False, captured_only=False).offers
        parts = part if parts is None else parts.unionByName(part)
    assert whole.exceptAll(parts).count() == 0 and parts.exceptAll(whole).count() == 0


field = st.text(alphabet='ab ,"\n\'é$1', max_size=6)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(field, min_size=19, max_size=19), min_size=1, max_size=12))
def test_manifest_fields_round_trip(spark, rows):
    """Fields with commas, quotes, line breaks and accents read back exactly
    (empty fields as NULL), one request per written row, in file order."""
    import csv
    import tempfile

    from ratelens.sources.manifest import FIELD_POSITIONS, read_manifest
    path = tempfile.mkdtemp(prefix="ratelens-prop-") + "/m.csv"
    with open(path, "w", newline="", encoding="utf-8") as f:
        w = csv.writer(f)
        w.writerow([f"h{i}" for i in range(19)])
        w.writerows(rows)
    got = read_manifest(spark, path).orderBy("row_in_file").collect()
    assert len(got) == len(rows)
    for g, r in zip(got, rows):
        for name, pos in FIELD_POSITIONS.items():
            assert getattr(g, name) == (r[pos] if r[pos] != "" else None), (name, r)
        assert g.malformed is False
