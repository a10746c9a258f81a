"""The default rules on pages of the real layout, and repeatable choices."""

import os
import time

import pytest
from pyspark.sql import functions as F

from golden import PAGES, container, price, seller
from ratelens.functions.text import transliterate
from ratelens.operators.extract import NativeLayout, ParsedLayout
from ratelens.operators.parsed import parse_page
from ratelens.plans.layouts import DEFAULT_LAYOUTS
from ratelens.plans.rateshop import latest_capture, run_rate_shop
from ratelens.sources.manifest import read_manifest
from ratelens.sources.sinks import write_outputs
from test_rateshop import manifest_row, write_manifest


def nested(inner, tags):
    for tag in reversed(tags):
        inner = f"<{tag}>{inner}</{tag}>"
    return inner


def prices_page(section):
    return ('<html><body><div id="dwrFZd0"><div><div><div>Wed, May 1</div></div><div><div>Fri, May 3</div></div></div></div>'
            '<div id="prices">' + nested(section, ["c-wiz", "c-wiz", *["div"] * 7]) + "</div></body></html>")


SOLD_OUT = prices_page("<section><div>head</div><div><c-wiz><c-wiz><div><div><div>Sold out</div></div></div></c-wiz></c-wiz></div></section>")
CONTACT = prices_page("<section><div>head</div><div><c-wiz><div><div><div>Call us</div></div></div></c-wiz></div></section>")
PAGE_CASES = {
    "sold_out": (SOLD_OUT, "not_available", None), "contact_place": (CONTACT, "contact", None),
    "contact_class": (PAGES["contact_rule1"], "contact", None),
    "renamed": (container(seller("A", cls="Renamed") + price("$1")), "offers", "no_sellers"),
    "no_agents": (PAGES["no_agents"], "offers", "no_sellers"), "offers": (PAGES["offers"], "offers", None),
}


def captures(spark, pages):
    return spark.createDataFrame([(k, i, v) for i, (k, v) in enumerate(pages.items())],
                                 "request_id string, page_id bigint, html string").withColumn(
        "captured_at", F.lit(None).cast("timestamp_ntz"))


def requests(spark, ids):
    return spark.createDataFrame([(i, i, "Hotel", "City", "May 1, 2024", "May 3, 2024", "2", "10") for i in ids],
                                 "request_id string, hotel_id string, hotel string, city string, check_in string, "
                                 "check_out string, nights string, listed_base_price string")


def test_default_rules_see_sold_out_contact_and_empty_pages(spark):
    out = run_rate_shop(requests(spark, PAGE_CASES), captures(spark, {k: v[0] for k, v in PAGE_CASES.items()}),
                        DEFAULT_LAYOUTS, "2024-05-01")
    got = {r.request_id: (r.status, r.reason) for r in out.outcomes.collect()}
    assert got == {k: v[1:] for k, v in PAGE_CASES.items()}
    summary = {r.status: r for r in out.summary.collect()}
    assert summary["offers"].requests == 3 and summary["offers"].no_sellers == 2
    assert summary["not_available"].no_sellers == 0
    page = parse_page(SOLD_OUT, DEFAULT_LAYOUTS)
    assert (page["searched_in"], page["searched_out"]) == ("Wed, May 1", "Fri, May 3")


def test_listing_block_fields_and_pairing_in_the_block():
    def block(name, p, fee=""):
        return (f'<div class="ADs2Tc"><div class="NiGhzc">{name}</div><span class="pNExyb">{p}</span>'
                f'<div class="Einivf qOlGCc">{fee}</div></div>')
    html = ('<div class="PVOOXe">' + block("A", "", '<span class="MW1oTb">$11</span>') + block("B", "$2")
            + block("C", "$3", '<span class="UeIHqb">$33</span>') + "</div>")
    page = parse_page(html, DEFAULT_LAYOUTS)
    assert page["names"] == ["A", "B", "C"] and page["prices"] == [None, "$2", "$3"]
    assert [e["average_price"] for e in page["extras"]] == ["$11", None, None]
    assert [e["total_price"] for e in page["extras"]] == [None, None, "$33"]


def test_parser_keeps_nested_sellers_and_stays_fast():
    rules = [ParsedLayout(layout=1, names=".n", prices=".p")]
    page = parse_page('<span class="n"><span class="p">$1</span></span><div class="n">A</div>B', rules)
    assert page["names"] == ["$1", "A"] and page["prices"] == ["$1"]
    assert parse_page('<p class="n"><span>A</span><div>x</div></p>', rules)["names"] == ["A"]
    assert parse_page('<div class="n"><div>A</div>B</div>', rules)["names"] == ["A B"]
    fees = parse_page('<span class="NiGhzc"><span class="MW1oTb">$110</span> Foo</span><div id="prices"></div>'
                      '<div id="prices"><span class="NiGhzc"><span class="MW1oTb">$110</span> Foo</span></div>', DEFAULT_LAYOUTS[:1])
    assert fees["layout"] == 1
    start = time.perf_counter()
    parse_page("<b>" * 8000 + '<div class="n">x</div>' * 8000, rules)
    assert time.perf_counter() - start < 5


def test_scope_over_lines_and_blank_entries(spark):
    from ratelens.operators.extract import extract_native
    lay = NativeLayout(layout=1, names="<a>([^<]*)</a>", prices="<i>([^<]*)</i>", scope=("<nav>", "</nav>"))
    df = spark.createDataFrame([("<nav>\n<a>A</a>\n<a> </a><i>1</i>\n</nav><a>B</a>",)], "html string")
    page = extract_native(df, [lay]).first().page
    assert page.names == ["A"] and page.prices == ["1"]


def test_dates_need_parser_rules_and_both_labels(spark):
    page = container(seller("A") + price("$1"), extra='<div aria-label="May 1, 2024">1</div>%s')
    pages = {"one": page % "", "both": page % '<div aria-label="May 3, 2024">3</div>',
             "words": page % '<div aria-label="Friday, May 3">3</div>', "other_day": page % '<div aria-label="Thu, May 3">3</div>'}
    out = run_rate_shop(requests(spark, pages), captures(spark, pages), DEFAULT_LAYOUTS, "2024-05-01", require_dates=True)
    assert {r.request_id: r.reason for r in out.outcomes.collect()} == {
        "one": "dates_not_found", "both": None, "words": None, "other_day": "dates_not_found"}
    native = [NativeLayout(layout=1, names="(a)", prices="(b)")]
    for option in ({"require_dates": True}, {"extra_prices": True}):
        with pytest.raises(ValueError):
            run_rate_shop(requests(spark, pages), captures(spark, pages), native, "2024-05-01", **option)


def test_latest_capture_without_times_is_repeatable(spark):
    rows = [("r", None, None, h, None) for h in range(8)]
    picks = set()
    for n in (1, 3, 8):
        df = spark.createDataFrame(rows, "request_id string, captured_at timestamp_ntz, page_id bigint, html_hash bigint, "
                                         "html_state string").withColumn("page", F.struct(F.col("html_hash").alias("x")))
        picks.add(latest_capture(df.repartition(n)).first().page.x)
    assert len(picks) == 1


def test_request_ids_extra_fields_and_export_order(spark, tmp_path):
    rows = [manifest_row(i + 1, f"H{i + 1}", ci="May 1, 2024", co="May 3, 2024") for i in range(12)]
    folder = str(tmp_path / "m")
    os.makedirs(f"{folder}/b")
    path = write_manifest(folder, rows)
    name = os.path.basename(path)
    with open(path, encoding="utf-8") as f:
        text = f.read().rstrip("\n").split("\n")
    text[3] += ",more"                      # a field beyond the header
    with open(path, "w", encoding="utf-8") as f:
        f.write("\n".join(text) + "\n")
    before = {r.request_id: r.malformed for r in read_manifest(spark, folder).collect()}
    assert set(before) == {f"{name}:{i}" for i in range(1, 13)} and not any(before.values())
    with open(f"{folder}/b/{name}", "w", encoding="utf-8") as f:
        f.write("\n".join(text[:3]) + "\n")
    again = {r.request_id for r in read_manifest(spark, folder).collect()}
    assert set(before) <= again         # a second file of that name changes no key
    req = read_manifest(spark, path)
    caps = captures(spark, {f"{name}:{i}": PAGES["offers"] for i in range(1, 13)})
    out = run_rate_shop(req, caps, DEFAULT_LAYOUTS, "2024-05-01")
    target = str(tmp_path / "out")
    paths = write_outputs(out, target, "2024-05-01", ordered=True)
    lines = []
    for part in sorted(p for p in os.listdir(paths["final_data"]) if p.startswith("part-")):
        with open(f"{paths['final_data']}/{part}", encoding="utf-8") as f:
            lines += f.read().splitlines()[1:]
    hotels = [x for line in lines for x in line.replace('"', "").split(",") if x.startswith("H") and x[1:].isdigit()]
    assert list(dict.fromkeys(hotels)) == [f"H{i}" for i in range(1, 13)]
    # a rerun without offers leaves no older ones
    empty = run_rate_shop(req, caps.where("false"), DEFAULT_LAYOUTS, "2024-05-01")
    write_outputs(empty, target, "2024-05-01")
    assert not os.path.exists(paths["offers"]) and not os.path.exists(paths["final_data"])


def test_names_of_other_scripts(spark):
    words = {"Ștefan": "Stefan", "sạn": "san", "Nội": "Noi", "café": "cafe", "it’s – 5 €": "it's - 5 EUR",
             "Москва": "Moskva", "Αθήνα": "Athena", "Größe": "Grosse", "Łódź": "Lodz", "東京": "東京"}
    got = spark.createDataFrame([(w,) for w in words], "w string").select("w", transliterate("w").alias("t")).collect()
    assert {r.w: r.t for r in got} == words


def test_no_page_query_shuffles_markup(spark):
    import __spark_entry__ as E
    for name in ("offers", "page_names", "page_outcome", "page_rate_shop", "page_legacy_rows", "page_rate_shop_summary"):
        plan = E.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().sparkPlan().toString()
        executed = E.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan()
        stack, text = [executed], []
        while stack:
            node = stack.pop()
            if "Exchange" in node.nodeName() and "Broadcast" not in node.nodeName():
                text.append(node.output().mkString(","))
            children = node.children()
            stack += [children.apply(i) for i in range(children.size())]
            if node.nodeName() == "AdaptiveSparkPlan":
                stack.append(node.executedPlan())
        assert plan and not any("html#" in t for t in text), (name, text)
