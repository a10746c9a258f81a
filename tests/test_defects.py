"""One regression test per defect of the original job."""

import pytest
from pyspark.sql import functions as F

from ratelens.functions.text import clean_price
from ratelens.plans.rateshop import run_rate_shop
from ratelens.sources.manifest import read_manifest

from golden import LAYOUTS
from test_rateshop import _captures, manifest_row, write_manifest

CASES = ["blanks", "same_price", "contact_rule1", "contact_rule2", "na_rule2",
         "too_few_prices", "malformed", "dates", "offers"]


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    tmp = str(tmp_path_factory.mktemp("defects"))
    rows = [manifest_row(i + 1, f"Hôtel {c}", ci="May 1, 2024", co="May 3, 2024")
            for i, c in enumerate(CASES)]
    rows.append(manifest_row(1, "Hôtel blanks", ci="May 1, 2024", co="May 3, 2024"))  # duplicate
    path = write_manifest(tmp, rows)
    ids = {c: f"hotels.csv:{i + 1}" for i, c in enumerate(CASES)}
    caps = _captures(spark, [(ids[c], c) for c in CASES] + [("hotels.csv:10", "blanks")])
    out = run_rate_shop(read_manifest(spark, path), caps, LAYOUTS, "2024-05-01")
    return ids, out, {r.request_id: r for r in out.outcomes.collect()}, out.offers.collect()


def _offers(offers, rid):
    return sorted((r for r in offers if r.request_id == rid),
                  key=lambda r: (r.scrape_position is None, r.scrape_position))


def test_b1_offers_path_finishes_with_blanks(run):
    ids, _, outcomes, offers = run
    assert outcomes[ids["blanks"]].status == "offers"
    assert [r.agent for r in _offers(offers, ids["blanks"])] == ["A", "B"]


def test_b2_equal_prices_stay_paired(run):
    ids, _, _, offers = run
    assert [(r.agent, r.scrape_base_price) for r in _offers(offers, ids["same_price"])] == [
        ("A", "99"), ("B", "99")]


def test_b3_contact_row_has_no_seller(run):
    ids, _, outcomes, offers = run
    rows = _offers(offers, ids["contact_rule1"])
    assert len(rows) == 1 and rows[0].agent is None and rows[0].scrape_position is None
    assert rows[0].status == "contact"


def test_b5_b6_either_rule_suffices(run):
    ids, _, outcomes, _ = run
    assert outcomes[ids["contact_rule2"]].status == "contact"
    assert outcomes[ids["na_rule2"]].status == "not_available"


def test_b7_compound_class(run):
    ids, _, outcomes, _ = run
    assert outcomes[ids["contact_rule1"]].status == "contact"


def test_b8_bad_page_is_a_row_value(run):
    ids, _, outcomes, _ = run
    # elements without end tags end with the page: one seller, one price
    row = outcomes[ids["malformed"]]
    assert (row.status, row.reason, row.n_offers) == ("offers", None, 1)


def test_b9_broken_request_emits_no_offers(run):
    ids, out, outcomes, offers = run
    rid = ids["too_few_prices"]
    assert outcomes[rid].status == "broken" and not _offers(offers, rid)
    assert out.reattempt.filter(F.col("request_id") == rid).count() == 1


def test_b10_null_price_is_safe(spark):
    df = spark.createDataFrame([(None,), ("$5",)], "p string")
    assert [r.c for r in df.select(clean_price("p").alias("c")).collect()] == [None, "5"]


def test_b11_hotel_always_transliterated(run):
    ids, out, _, offers = run
    assert all(r.hotel.startswith("Hotel ") for r in offers)
    assert all(r.hotel.startswith("Hotel ") for r in out.reattempt.collect())


def test_b12_searched_dates_from_page(run):
    ids, _, _, offers = run
    assert _offers(offers, ids["dates"])[0].check_in_search == "Wed, May 1"
    assert _offers(offers, ids["offers"])[0].check_in_search == "May 1, 2024"


def test_b13_duplicates_kept(run):
    _, _, outcomes, offers = run
    assert outcomes["hotels.csv:1"].status == outcomes["hotels.csv:10"].status == "offers"
    assert len(_offers(offers, "hotels.csv:10")) == 2
