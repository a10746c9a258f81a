from ratelens.operators.parsed import extract_parsed, parse_page, selector
from ratelens.operators.outcome import classify

from golden import LAYOUTS, PAGES


def page(name, **kw):
    return parse_page(PAGES[name], LAYOUTS, **kw)


def test_offers_and_scope():
    p = page("offers")
    assert p["layout"] == 1
    assert p["names"] == ["Booking.com", "Expedia", "Hotels.com"]
    assert p["prices"] == ["$120", "$1,234", "$99"]


def test_blanks_dropped_order_kept():
    p = page("blanks")
    assert p["names"] == ["A", "B"] and p["prices"] == ["$1", "$2"]


def test_hidden_elements_have_no_text():
    p = page("hidden")
    assert p["names"] == ["A", "B"] and p["prices"] == ["$1", "$2"]


def test_same_price_twice_kept():
    assert page("same_price")["prices"] == ["$99", "$99"]


def test_newline_nested_entities():
    assert page("newline")["names"] == ["Boo king"]
    assert page("nested")["names"] == ["Hôtel & Co"]


def test_flags():
    assert page("na_rule1")["not_available"] and page("na_rule2")["not_available"]
    assert page("contact_rule1")["contact"] and page("contact_rule2")["contact"]
    both = page("both_flags")
    assert both["not_available"] and both["contact"]


def test_layout_fallback_and_neither():
    p = page("listing")
    assert p["layout"] == 2 and p["names"] == ["L1"] and p["is_listing"]
    assert page("neither") is None


def test_dates_and_searched():
    p = page("dates", check_in="May 1, 2024", check_out="May 3, 2024")
    assert p["check_in_found"] is True and p["check_out_found"] is False
    assert p["searched_in"] == "Wed, May 1" and p["searched_out"] == "Fri, May 3"


def test_bad_html_never_raises():
    assert page("malformed")["names"] == ["A$1"] or page("malformed") is not None
    assert page("empty") is None and page("null") is None


def test_fee_fields_keep_pairing():
    p = page("fees")
    assert p["names"][1] == "B"
    assert p["extras"] == [{"average_price": "$110", "total_price": "$220"},
                           {"average_price": None, "total_price": None}]


def test_selector_forms():
    s = selector("div.a.b#x[aria-label='May 1, 2024'][data-k]")
    assert s.tag == "div" and s.classes == {"a", "b"} and s.id == "x"
    assert s.attrs == (("aria-label", "May 1, 2024"), ("data-k", None))


def test_udf_matches_python(spark):
    rows = [(k, v) for k, v in PAGES.items()]
    df = spark.createDataFrame(rows, "request_id string, html string")
    got = classify(extract_parsed(df, LAYOUTS)).select(
        "request_id", "status", "reason", "n_offers", "page.names", "page.prices").collect()
    by = {r.request_id: r for r in got}
    expect = {
        "offers": "offers", "blanks": "offers", "same_price": "offers", "newline": "offers",
        "nested": "offers", "too_few_prices": "broken", "extra_prices": "offers",
        "no_agents": "offers", "na_rule1": "not_available", "na_rule2": "not_available",
        "contact_rule1": "contact", "contact_rule2": "contact", "both_flags": "not_available",
        "listing": "offers", "neither": "broken", "dates": "offers", "empty": "broken",
        "null": "broken", "fees": "offers", "hidden": "offers",
    }
    for k, status in expect.items():
        assert by[k].status == status, k
    assert by["too_few_prices"].reason == "too_few_prices"
    assert by["neither"].reason == "no_layout"
    assert by["null"].reason == "html_missing" and by["empty"].reason == "html_empty"
    assert by["no_agents"].n_offers == 0
    for k, v in PAGES.items():
        py = parse_page(v, LAYOUTS)
        if py is not None:
            assert list(by[k].names) == py["names"], k


def test_rules_round_trip_through_json(tmp_path):
    from ratelens.plans.layouts import DEFAULT_LAYOUTS, dump_layouts, load_layouts
    from ratelens.plans.standins import FALLBACK_LAYOUTS
    assert load_layouts(dump_layouts(DEFAULT_LAYOUTS)) == DEFAULT_LAYOUTS
    assert load_layouts(dump_layouts(LAYOUTS)) == LAYOUTS
    assert load_layouts(dump_layouts(FALLBACK_LAYOUTS)) == FALLBACK_LAYOUTS
    f = tmp_path / "rules.json"
    f.write_text(dump_layouts(LAYOUTS), encoding="utf-8")
    rules = load_layouts(str(f))
    assert parse_page(PAGES["offers"], rules) == parse_page(PAGES["offers"], LAYOUTS)
    minimal = load_layouts('[{"layout": 1, "names": ".a", "prices": ".b"}]')
    assert minimal[0].scope is None and minimal[0].present == ()
