"""Element intervals: nesting of every page, the structural join, and the rule
engine on top of them, against plain Python."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from golden import LAYOUTS, PAGES, price, seller
from ratelens.functions.html import decode_references, visible_text
from ratelens.operators.elements import containing, elements, folded, matched, tokens
from ratelens.operators.fields import block_fields, extract_elements, place_flags, rule_winners, scoped_texts
from ratelens.operators.parsed import Path, parse_page
from ratelens.plans.layouts import DEFAULT_LAYOUTS, NOT_AVAILABLE_PLACES
from ratelens.plans.rateshop import run_rate_shop
from test_defaults import CONTACT, PAGE_CASES, SOLD_OUT, captures, nested, prices_page, requests


def pages_df(spark, pages):
    return spark.createDataFrame(list(pages.items()), "page_id string, html string").repartition(3)


def tree(rng, depth=0):
    """Well-formed markup and its (tag, children) tree; texts are unique."""
    out, nodes = "", []
    for _ in range(rng.randint(0, 3) if depth else 3):
        tag = rng.choice(["div", "span", "section", "br", "b", "c-wiz"])
        if tag == "br":
            out, nodes = out + "<br>x", nodes + [("br", [])]
        elif depth < 6:
            inner, below = tree(rng, depth + 1)
            out, nodes = f"{out}t<{tag}>{inner}</{tag}>", nodes + [(tag, below)]
    return out, nodes


def labels_of(nodes, above="", out=None):
    out, seen = [] if out is None else out, {}
    for tag, below in nodes:
        seen[tag] = seen.get(tag, 0) + 1
        out.append(f"{above}/{tag}[{seen[tag]}]")
        labels_of(below, out[-1], out)
    return out


def test_dewey_labels_of_well_formed_pages(spark):
    rng = random.Random(3)
    trees = {str(i): tree(rng) for i in range(40)}
    rows = elements(tokens(pages_df(spark, {k: v[0] for k, v in trees.items()}))).where("label IS NOT NULL").collect()
    got = {}
    for k in trees:
        mine = sorted((r for r in rows if r.page_id == k), key=lambda r: r.pos)
        name, found = {None: ""}, []
        for r in mine:
            name[r.pos] = f"{name[r.parent]}/{r.tag}[{r.ordinal}]"
            assert r.depth == name[r.pos].count("/")
            found.append(name[r.pos])
        got[k] = found
    assert got == {k: labels_of(v[1]) for k, v in trees.items()}


SOUP = ["<div>", "</div>", "<p>", "</p>", "<li>", "</li>", "<ul>", "</ul>", "<b>", "</b>", "<i>", "</i>", "<br>", "<td>",
        "</span>", "<span class='m'>", "<!-- <div> -->", "a < b", "<script>'</div>'</script>", "<img/>", "text", "</"]


def test_any_markup_gives_nested_intervals_and_the_join_finds_all_of_them(spark):
    rng = random.Random(4)
    soup = {str(i): "".join(rng.choice(SOUP) for _ in range(rng.randint(0, 60))) for i in range(60)}
    rows = elements(tokens(pages_df(spark, soup))).withColumn("m", F.col("tag").isin("div", "span", "b"))
    table = rows.collect()
    pairs = containing(rows, F.col("m"), F.col("text") != "").select("page_id", "pos", "outer", "level").collect()
    for k in soup:
        mine = [r for r in table if r.page_id == k]
        spans = sorted((r.pos, r.end) for r in mine if r.end is not None and r.end > r.pos)
        for a, b in spans:
            assert not any(a < c < b < d for c, d in spans)      # nested or apart
        outers = sorted((r.pos, r.end) for r in mine if r.m and r.end is not None and r.end > r.pos)
        want = {(r.pos, a, i + 1) for r in mine if r.text
                for i, (a, _) in enumerate([o for o in outers if o[0] <= r.pos < o[1]])}
        assert {(p.pos, p.outer, p.level) for p in pairs if p.page_id == k} == want


def test_rules_on_elements_equal_the_parser(spark):
    pages = {**PAGES, **{f"default_{k}": v[0] for k, v in PAGE_CASES.items()}}
    for rules in (LAYOUTS, DEFAULT_LAYOUTS):
        df = pages_df(spark, pages)
        got = {r.page_id: r.page and r.page.asDict(True) for r in
               extract_elements(df, rules, ["page_id"], keep_labels=True).collect()}
        for k, html in pages.items():
            want = parse_page(html, rules, keep_labels=True)
            assert got[k] == (want and {f: want[f] for f in got[k]}), k


def test_default_rules_read_the_price_list_at_its_place(spark):
    other = seller("Elsewhere") + price("$9")
    listed = nested("<div>filters</div><div>" + seller("A") + price("$1") + "</div>", ["c-wiz", "div", "div"])
    pages = {"listed": prices_page(other + f"<section><div>head</div><div>{listed}</div></section>" + other),
             "elsewhere_only": prices_page(f"<section><div>head</div></section>{other}")}
    got = {r.page_id: (r.page.names, r.page.prices, r.page.layout) for r in
           extract_elements(pages_df(spark, pages), DEFAULT_LAYOUTS, ["page_id"]).collect()}
    assert got == {"listed": (["A"], ["$1"], 0), "elsewhere_only": (["Elsewhere"], ["$9"], 1)}
    assert all(parse_page(h, DEFAULT_LAYOUTS)["names"] == got[k][0] for k, h in pages.items())


def test_default_rules_run_without_python(spark):
    out = run_rate_shop(requests(spark, PAGE_CASES), captures(spark, {k: v[0] for k, v in PAGE_CASES.items()}),
                        DEFAULT_LAYOUTS, "2024-05-01", cut_lineage=False)
    plan = out.outcomes._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert "Cartesian" not in plan and "NestedLoop" not in plan
    with pytest.raises(ValueError):
        run_rate_shop(requests(spark, []), captures(spark, {"a": ""}), DEFAULT_LAYOUTS, "2024-05-01", engine="other")


def test_scope_holds_nested_elements_of_its_own_kind(spark):
    html = ("<div class=s>out</div><div id=scope><div class=s>a <div class=s>b</div> c</div></div><div class=s>after</div>"
            "<div id=scope><i class=s>second scope</i></div><p id=x>no end")
    got = scoped_texts(pages_df(spark, {"1": html, "2": None, "3": "<div id=scope><b class=s>open"}), "#scope", ".s").collect()
    assert sorted(map(tuple, got)) == [("1", 1, "a\nb\nc"), ("1", 2, "b"), ("3", 1, "open")]


def test_places_with_and_without_ordinals(spark):
    got = place_flags(pages_df(spark, {"sold": SOLD_OUT, "call": CONTACT, "empty": "", "null": None}),
                      {"na": NOT_AVAILABLE_PLACES, "any": ("section > div",), "second": ("section > div:nth(2)",),
                       "third": ("section > div:nth(3)",), "none": ()}).collect()
    assert {r.page_id: tuple(r)[1:] for r in got} == {
        "sold": (True, True, True, False, False), "call": (False, True, True, False, False),
        "empty": (False,) * 5, "null": (False,) * 5}


def test_block_fields_go_to_the_nearest_block(spark):
    html = ('<div class=b><i>one</i><div class=b><u>inner</u></div><u></u></div><i>no block</i>'
            '<div class=b><u>$3</u><u>again</u></div><div class=b></div>')
    got = block_fields(pages_df(spark, {"1": html}), ".b", {"name": "i", "price": "u"}).collect()
    assert sorted(map(tuple, got)) == [("1", 1, "one", None), ("1", 2, None, "inner"), ("1", 3, None, "$3"), ("1", 4, None, None)]


def test_new_rules_are_new_rows(spark):
    df = pages_df(spark, {"1": '<p id=x class="k l k">a</p><p>b</p>', "2": "<i>only</i><br>", "3": ""})
    schema = "field string, kind string, key string, priority int"
    rules = [("f", "tag", "p", 5), ("f", "tag", "br", 6), ("g", "class", "l", 1), ("g", "class", "none", 0), (None, "tag", "p", 1)]
    got = rule_winners(df, spark.createDataFrame(rules, schema))
    assert sorted(map(tuple, got.collect())) == [("1", "f", 5, "tag", "p", 2, "a"), ("1", "g", 1, "class", "l", 1, "a"),
                                                 ("2", "f", 6, "tag", "br", 1, "")]
    more = rule_winners(df, spark.createDataFrame(rules + [("f", "id", "x", 1), ("f", "tag", "i", 2)], schema))
    assert sorted(tuple(r) for r in more.where("field = 'f'").collect()) == [
        ("1", "f", 1, "id", "x", 1, "a"), ("2", "f", 2, "tag", "i", 1, "only")]


def test_selectors_by_attribute_class_and_descent(spark):
    html = "<div data-k='a b' class='x y'><span><b title='q>r' hidden>h</b></span></div><b title=\"q>r\">t</b><a title=it's>u</a>"
    paths = {"both": ".x.y", "attr": "div[data-k='a b']", "there": "[title]", "value": "b[title='q>r']", "under": ".x >> b",
             "child": ".x > b", "loose": "a[title]"}
    rows = elements(tokens(pages_df(spark, {"1": html}), attrs=["data-k", "title"]))
    marked = matched(rows, {k: Path(s) for k, s in paths.items()}).where("label IS NOT NULL").orderBy("pos").collect()
    got = {k: [r.tag for r in marked if r[k]] for k in paths}
    assert got == {"both": ["div"], "attr": ["div"], "there": ["b", "b", "a"], "value": ["b", "b"], "under": ["b"],
                   "child": [], "loose": ["a"]}


def test_references_and_quoted_signs(spark):
    cases = {"H&ocirc;tel &#233;&#xE9;": "Hôtel éé", "&amp;lt;": "&lt;", "&nosuch; &; & &#0; &#xD800; &#99999999;":
             "&nosuch; &; & &#0; &#xD800; &#99999999;", "&#x1F600;&apos;&nbsp;": "😀'\xa0", "": "", "plain": "plain"}
    df = spark.createDataFrame(list(cases.items()), "s string, want string")
    for r in df.select("want", decode_references("s").alias("got"), folded(F.lit(" a \t b \n \n c ")).alias("f")).collect():
        assert r.got == r.want and r.f == "a b\nc"
    shown = spark.createDataFrame([('<b title="x>y">t &#233;</b>&nbsp;',)], "s string").select(visible_text("s").alias("t")).first()
    assert shown.t == "t é"


def test_a_task_holds_a_bounded_amount_of_markup(spark, monkeypatch):
    from ratelens.operators import elements as module
    page = "<ul>" + "<li class='a'>item</li>" * 50 + "</ul>"
    df = spark.range(120).select(F.col("id").alias("page_id"), F.lit(page).alias("html")).coalesce(1)
    monkeypatch.setattr(module, "IN_TASK", 4 * (len(page) + module.A_TAG * page.count("<")))
    rows = elements(tokens(df)).select("_row", F.spark_partition_id().alias("task")).distinct().collect()
    tasks = Counter(r.task for r in rows)
    assert len(rows) == 120 and len(tasks) >= 20 and max(tasks.values()) <= 15
    assert module._tasks(df.limit(0), "html") == module._tasks(df.select(F.lit(None).cast("string").alias("html")), "html") \
        == spark.sparkContext.defaultParallelism
