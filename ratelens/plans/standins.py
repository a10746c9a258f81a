"""The library's operators run on the driver's tables.

The driver has no hotel pages, so each operator runs on a stand-in:
request = ``orders``, offer = ``lineitem``, seller = ``supplier``,
hotel = ``customer``, city = ``nation``, captured page = ``pages``.  In
``pages`` the seller list is the navigation labels and the price list is
the paragraph texts.  Every query reads whole tables; each callable takes
``(spark, sf_dir)`` and returns a DataFrame without running it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratelens.functions.arrays import distinct_values, drop_blanks, nth
from ratelens.functions.html import attr_present, extract_all, extract_first, region, visible_text
from ratelens.functions.text import (
    clean_price,
    display_date,
    fold_newlines,
    price_decimal,
    search_key,
    transliterate,
)
from ratelens.operators.extract import NativeLayout, ParsedLayout, Test, extract_native, native_fields
from ratelens.operators.fields import block_fields, place_flags, rule_winners, scoped_texts
from ratelens.operators.joins import requests_without, with_offers
from ratelens.operators.numbering import row_number_within, with_chunk_id
from ratelens.operators.offers import (
    explode_offers,
    legacy_projection,
    merge_outcomes,
    outcome_rows,
)
from ratelens.operators.outcome import NOT_AVAILABLE, OFFERS, classify
from ratelens.operators.partitioning import spread
from ratelens.operators.summary import list_sizes, run_summary
from ratelens.plans.rateshop import run_rate_shop
from ratelens.sources.tables import read_table

# Markup of the driver's stand-in pages.
NAV_LABEL = r'<li><a href="[^"]*">([^<]*)</a></li>'
PARAGRAPH = r'(?s)<p>(.*?)(?=</p>|<p>|</article>)'
HEADING = r'<h1>([^<]*)</h1>'
TEXT_NODE = r'>([^<]*)<'
HREF = r'href="([^"]*)"'
NOT_AVAILABLE_MARK = r'<article><h1>[^<]*[*]{3}'
CONTACT_MARK = r'utm_source'
LISTING_MARK = r'<b>'
PAGE_PARAM = r'[?&]page=([0-9]+)'
LANGS = ("en", "de", "fr", "es")

# Fixed run date, so that every result is repeatable.
RUN_DATE = "2024-01-15"

STANDIN_LAYOUT = NativeLayout(
    layout=1,
    names=NAV_LABEL,
    prices=PARAGRAPH,
    not_available=(Test(NOT_AVAILABLE_MARK),),
    contact=(Test(CONTACT_MARK, column="url"),),
    listing=(Test(LISTING_MARK),),
)

# Layout fallback: paragraphs if the page has any, else the heading.
FALLBACK_LAYOUTS = (
    NativeLayout(layout=1, names=NAV_LABEL, prices=PARAGRAPH,
                 present=(Test(r"<p>"),)),
    NativeLayout(layout=2, names=NAV_LABEL, prices=HEADING,
                 present=(Test(r"<h1>[^<]*</h1>"),)),
)

# Parser rules for the same pages: links are sellers, paragraphs are prices.
PARSED_PAGE_LAYOUT = ParsedLayout(layout=1, names="a", prices="p", listing=("b",))

# Places and rules of the same pages, for the element operators.
PLACES = {"not_available": ("body > nav > ul > li:nth(6) > a", "article > p:nth(30)"),
          "contact": (".ad", "article > p:nth(2) > b")}
RULE_TABLE = [("name", "class", "ad", 1), ("name", "tag", "h1", 2), ("price", "tag", "b", 1), ("price", "tag", "p", 2),
              ("flag", "id", "prices", 1)]

TITLE = r'<title>([^<]*)</title>'
HOST = r'://([^/?#]+)'

LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"]


def _page_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The captured pages; their markup is never shuffled."""
    return read_table(spark, sf_dir, "pages")


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_native(_page_table(spark, sf_dir), [STANDIN_LAYOUT])


def _page_fields(spark: SparkSession, sf_dir: str, *names: str, layouts=(STANDIN_LAYOUT,)) -> DataFrame:
    """Some fields of the pages only: the others are not extracted."""
    fields = native_fields(layouts)
    return _page_table(spark, sf_dir).select("page_id", *[fields[n].alias(n) for n in names])


def _classified_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(_pages(spark, sf_dir))


# ---- pages: extraction, classification ------------------------------------


def q_offers(spark, sf_dir):
    """Sellers paired with prices by index, one row per seller."""
    return explode_offers(_classified_pages(spark, sf_dir), keep=["page_id"])


def q_page_names(spark, sf_dir):
    """Every extracted seller with its 1-based position."""
    return _page_fields(spark, sf_dir, "names").select(
        "page_id", F.posexplode("names").alias("pos", "name")
    ).select("page_id", (F.col("pos") + 1).cast("int").alias("pos"), "name")


def q_page_outcome(spark, sf_dir):
    """Outcome per page with precedence not_available > contact > offers."""
    return _classified_pages(spark, sf_dir).select("page_id", "status", "reason", "n_offers")


def q_list_sizes(spark, sf_dir):
    """Seller and price list lengths per page (A2)."""
    pages = _page_fields(spark, sf_dir, "names", "prices")
    return list_sizes(pages.withColumn("page", F.struct("names", "prices")), ["page_id"])


def q_distinct_names(spark, sf_dir):
    """Number of sellers and of distinct sellers per page (E5)."""
    p = _page_fields(spark, sf_dir, "names")
    found = F.col("names").isNotNull()
    return p.select(
        "page_id",
        F.when(found, F.size("names")).cast("int").alias("n_names"),
        F.when(found, F.size(distinct_values("names"))).cast("int").alias("n_distinct"),
    )


def q_page_scoped_items(spark, sf_dir):
    """Links inside the navigation container only."""
    pages = _page_table(spark, sf_dir)
    scoped = extract_all(region("html", "<nav>", "</nav>"), HREF)
    return pages.select("page_id", F.posexplode(scoped).alias("pos", "href")).select(
        "page_id", (F.col("pos") + 1).cast("int").alias("pos"), "href")


def q_nth_section(spark, sf_dir):
    """Fifth paragraph of each page, NULL when there are fewer."""
    pages = _page_table(spark, sf_dir)
    return pages.select("page_id", nth(F.transform(extract_all("html", PARAGRAPH), visible_text), 4).alias("section"))


def q_page_layout(spark, sf_dir):
    """Boolean layout tests per page."""
    fields = native_fields([STANDIN_LAYOUT])
    return _page_table(spark, sf_dir).select(
        "page_id", *[fields[n].alias(n) for n in ("is_listing", "contact", "not_available")])


def q_layout_fallback(spark, sf_dir):
    """First layout present supplies the lists."""
    pages = _page_fields(spark, sf_dir, "layout", "prices", layouts=FALLBACK_LAYOUTS)
    return pages.select(
        "page_id", "layout",
        F.when(F.col("layout").isNotNull(), F.size("prices")).cast("int").alias("n_prices"),
        F.get("prices", F.lit(0)).alias("first_price"),
    )


def q_attr_match(spark, sf_dir):
    """Row-parameterised attribute test: is the requested language on the page."""
    pages = _page_table(spark, sf_dir)
    lang = F.element_at(F.array(*[F.lit(x) for x in LANGS]),
                        (F.col("page_id") % len(LANGS) + 1).cast("int"))
    return pages.select(
        "page_id", lang.alias("lang"),
        attr_present("html", '<html lang="', lang, '">').alias("present"),
    )


def q_searched_dates(spark, sf_dir):
    """Searched value read back from the capture, else the default."""
    pages = _page_table(spark, sf_dir)
    found = extract_first("url", PAGE_PARAM)
    return pages.select(
        "page_id",
        F.coalesce(found, F.lit("1")).alias("searched"),
        found.isNotNull().alias("from_page"),
    )


def q_searched_stay(spark, sf_dir):
    """Searched dates shown without a year, as dates near the requested stay, and
    whether they are the requested ones (E10, F4).  The order date is requested;
    the shown text is the date some weeks around it, in three spellings."""
    shift = (F.col("o_custkey") % 5 - 2) * 40
    shown = F.date_add(F.col("o_orderdate").cast("date"), shift.cast("int"))
    text = (F.when(F.col("o_orderkey") % 3 == 0, F.date_format(shown, "EEE, MMM d"))
            .when(F.col("o_orderkey") % 3 == 1, F.date_format(shown, "d MMMM"))
            .otherwise(F.date_format(shown, "EEEE, MMMM d, yyyy")))
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_orderdate").cast("date").alias("check_in"), text.alias("shown"))
    found = display_date("shown", "check_in")
    return orders.withColumn("searched", found).withColumn("as_requested", F.col("searched") == F.col("check_in"))


def q_drop_blanks(spark, sf_dir):
    """All text nodes, blanks removed, order kept."""
    pages = _page_table(spark, sf_dir)
    texts = drop_blanks(extract_all("html", TEXT_NODE))
    return pages.select("page_id", F.posexplode(texts).alias("i", "l")).select(
        "page_id", (F.col("i") + 1).cast("int").alias("i"), "l")


# ---- scalar text functions ------------------------------------------------


def q_newline_fold(spark, sf_dir):
    """Line feeds to spaces."""
    conv = read_table(spark, sf_dir, "conversations")
    return conv.select("conv_id", "turn", fold_newlines("text").alias("text"))


def q_transliterate(spark, sf_dir):
    """ASCII transliteration of Latin text."""
    docs = spread(read_table(spark, sf_dir, "documents"), ["doc_id"])
    return docs.select("doc_id", transliterate("text").alias("t"))


def q_search_key(spark, sf_dir):
    """Lookup text: transliterated hotel name and city."""
    cust = read_table(spark, sf_dir, "customer")
    nation = read_table(spark, sf_dir, "nation")
    return cust.join(nation, cust.c_nationkey == nation.n_nationkey, "left").select(
        "c_custkey", search_key("c_name", "n_name").alias("search_key"))


def q_price_clean(spark, sf_dir):
    """Price text ``$1,234.56`` cleaned to ``1234.56`` and typed."""
    li = spread(read_table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber", "l_partkey"])
    text = F.concat(F.lit("$"), F.format_number("l_extendedprice", 2))
    return li.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        clean_price(text).alias("price_text"),
        price_decimal(text).alias("price"),
    )


# ---- requests, offers, outcomes -------------------------------------------


def requests(spark: SparkSession, sf_dir: str, orders: DataFrame | None = None) -> DataFrame:
    """Manifest-shaped requests: one per order (P1); ``orders`` narrows them."""
    orders = orders if orders is not None else read_table(spark, sf_dir, "orders")
    cust = read_table(spark, sf_dir, "customer")
    nation = read_table(spark, sf_dir, "nation")
    check_in = F.col("o_orderdate").cast("date")
    nights = F.substring("o_orderpriority", 1, 1).try_cast("int")
    return (
        orders.join(cust, orders.o_custkey == cust.c_custkey, "left")
        .join(nation, F.col("c_nationkey") == nation.n_nationkey, "left")
        .select(
            F.col("o_orderkey").alias("request_id"),
            F.col("o_custkey").alias("hotel_id"),
            transliterate("c_name").alias("hotel"),
            F.col("n_name").alias("city"),
            check_in.cast("string").alias("check_in"),
            F.date_add(check_in, nights).cast("string").alias("check_out"),
            nights.cast("string").alias("nights"),
            F.col("o_totalprice").cast("decimal(12,2)").alias("listed_base_price"),
        )
    )


def offer_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offers with their position within the request and the seller name."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_suppkey", *[c for c in LINE_ORDER if c != "l_suppkey"])
    sup = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    numbered = row_number_within(li, ["l_orderkey"], LINE_ORDER, "scrape_position")
    return numbered.join(sup, numbered.l_suppkey == sup.s_suppkey, "left").select(
        F.col("l_orderkey").alias("request_id"),
        F.col("s_name").alias("agent"),
        "scrape_position",
        F.col("l_extendedprice").cast("decimal(12,2)").alias("scrape_base_price_num"),
    )


def q_manifest_project(spark, sf_dir):
    """Positional pick of the manifest fields used later."""
    return requests(spark, sf_dir).select(
        "request_id", "hotel_id", "hotel", "city", "check_in", "listed_base_price")


def q_manifest_sample(spark, sf_dir):
    """The first 14 requests by key: the quick-test sample."""
    orders = read_table(spark, sf_dir, "orders")
    return orders.orderBy("o_orderkey").limit(14).select("o_orderkey", "o_custkey")


def q_chunk_id(spark, sf_dir):
    """Batches of 50 requests in key order, numbered from 1."""
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey")
    return with_chunk_id(orders, ["o_orderkey"], 50)


def q_offer_position(spark, sf_dir):
    """Position of each offer within its request."""
    li = read_table(spark, sf_dir, "lineitem")
    return row_number_within(li, ["l_orderkey"], LINE_ORDER, "scrape_position").select(
        "l_orderkey", "l_partkey", "l_suppkey", "scrape_position")


def q_request_offers(spark, sf_dir):
    """Every request with its offers; requests without offers kept once."""
    req = read_table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("request_id"), F.col("o_custkey").alias("hotel_id"))
    return with_offers(req, offer_lines(spark, sf_dir), "request_id")


def _orders_without_offers(spark, sf_dir) -> DataFrame:
    """Orders with no line item: the anti join runs on keys, before the
    requests are decorated with names and cities."""
    orders = read_table(spark, sf_dir, "orders")
    keys = read_table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return requests_without(orders, keys, "o_orderkey")


def q_reattempt(spark, sf_dir):
    """Requests without any offer, to try again."""
    return requests(spark, sf_dir, _orders_without_offers(spark, sf_dir)).select(
        "request_id", "hotel_id", "hotel", "check_in", "check_out", "city",
        "listed_base_price", "nights", F.lit("no_offers").alias("reason"))


def _not_available(spark, sf_dir) -> DataFrame:
    missing = requests(spark, sf_dir, _orders_without_offers(spark, sf_dir)).withColumn(
        "status", F.lit(NOT_AVAILABLE))
    return outcome_rows(missing, ["request_id", "hotel_id", "hotel", "check_in", "check_out",
                                  "nights", "listed_base_price"], RUN_DATE)


def _offer_rows(spark, sf_dir) -> DataFrame:
    req = requests(spark, sf_dir)
    return offer_lines(spark, sf_dir).join(req, "request_id").select(
        "request_id", "hotel_id", "hotel", "agent", "scrape_position",
        F.lit(RUN_DATE).cast("date").alias("scrape_date"),
        "check_in", "check_out", "nights", "listed_base_price", "scrape_base_price_num",
        F.col("scrape_base_price_num").cast("string").alias("scrape_base_price"),
        F.lit(OFFERS).alias("status"))


def q_sentinel_rows(spark, sf_dir):
    """Legacy rows of requests that are not available, sentinels filled."""
    rows = _not_available(spark, sf_dir).withColumn(
        "check_in_search", F.lit(None).cast("string")).withColumn(
        "check_out_search", F.lit(None).cast("string"))
    return legacy_projection(rows, keep=["request_id"])


def q_merge_outcomes(spark, sf_dir):
    """Offer rows and outcome rows in one frame by column name."""
    return merge_outcomes(_offer_rows(spark, sf_dir), _not_available(spark, sf_dir))


def q_run_summary(spark, sf_dir):
    """Requests and offers per outcome: the coverage report (A1)."""
    req = read_table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("request_id"))
    per_request = read_table(spark, sf_dir, "lineitem").groupBy(
        F.col("l_orderkey").alias("request_id")).agg(F.count(F.lit(1)).alias("n_offers"))
    outcomes = req.join(per_request, "request_id", "left").select(
        "request_id",
        F.when(F.col("n_offers").isNotNull(), F.lit(OFFERS))
        .otherwise(F.lit(NOT_AVAILABLE)).alias("status"),
        F.coalesce(F.col("n_offers"), F.lit(0)).alias("n_offers"),
    )
    return run_summary(outcomes)


# ---- the whole run over the captured pages ---------------------------------


def page_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One request per captured page: title as hotel, host as city."""
    pages = _page_table(spark, sf_dir)
    none = F.lit(None).cast("string")
    return pages.select(
        F.col("page_id").cast("string").alias("request_id"),
        F.col("page_id").cast("string").alias("hotel_id"),
        extract_first("html", TITLE).alias("hotel"),
        F.regexp_extract("url", HOST, 1).alias("city"),
        none.alias("check_in"), none.alias("check_out"), none.alias("nights"),
        none.alias("listed_base_price"),
    )


def page_captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _page_table(spark, sf_dir)
    return pages.select(F.col("page_id").cast("string").alias("request_id"), "page_id", "url",
                        "html", F.lit(None).cast("timestamp_ntz").alias("captured_at"))


def q_page_rate_shop(spark, sf_dir):
    """The whole run on the pages with native rules: offers and outcome rows."""
    out = run_rate_shop(page_requests(spark, sf_dir), page_captures(spark, sf_dir),
                        [STANDIN_LAYOUT], RUN_DATE, cut_lineage=False)
    return out.offers


def q_page_rate_shop_summary(spark, sf_dir):
    """Coverage of the whole run: requests and offers per outcome."""
    out = run_rate_shop(page_requests(spark, sf_dir), page_captures(spark, sf_dir),
                        [STANDIN_LAYOUT], RUN_DATE, cut_lineage=False)
    return out.summary


def q_page_rate_shop_parsed(spark, sf_dir):
    """The whole run with the HTML parser rules (nested markup, entities)."""
    out = run_rate_shop(page_requests(spark, sf_dir), page_captures(spark, sf_dir),
                        [PARSED_PAGE_LAYOUT], RUN_DATE, cut_lineage=False, engine="parser")
    return out.offers


def q_page_rate_shop_elements(spark, sf_dir):
    """The whole run with the same rules on element intervals: no Python on the
    row path (E1, E2, E8, E11, F1-F3)."""
    out = run_rate_shop(page_requests(spark, sf_dir), page_captures(spark, sf_dir),
                        [PARSED_PAGE_LAYOUT], RUN_DATE, cut_lineage=False)
    return out.offers


def q_element_scope(spark, sf_dir):
    """Texts of the elements of a kind inside a container, by element intervals
    (E1, E2): links of the navigation, paragraphs of the article."""
    pages = _page_table(spark, sf_dir).select("page_id", "html")
    return (scoped_texts(pages, "nav", "a").withColumn("scope", F.lit("nav"))
            .unionByName(scoped_texts(pages, "article", "p").withColumn("scope", F.lit("article"))))


def q_place_flags(spark, sf_dir):
    """Flags by an element's place in the page, two alternatives each (F1, F2)."""
    return place_flags(_page_table(spark, sf_dir).select("page_id", "html"), PLACES)


def q_block_fields(spark, sf_dir):
    """Fields of every block, NULL where the block has none (E8, P9): the bold
    part of each paragraph, the paragraph itself for comparison."""
    pages = _page_table(spark, sf_dir).select("page_id", "html")
    return block_fields(pages, "article > p", {"bold": "b", "whole": "p"})


def q_rule_winner(spark, sf_dir):
    """Rules as a table; per page and field the first rule that matches."""
    rules = spark.createDataFrame(RULE_TABLE, "field string, kind string, key string, priority int")
    return rule_winners(_page_table(spark, sf_dir).select("page_id", "html"), rules)


def q_page_legacy_rows(spark, sf_dir):
    """The legacy result CSV rows of the whole run, sentinel texts in place
    (P4, P6, P7)."""
    out = run_rate_shop(page_requests(spark, sf_dir), page_captures(spark, sf_dir),
                        [STANDIN_LAYOUT], RUN_DATE, cut_lineage=False)
    return legacy_projection(out.offers, keep=["request_id", "status"])


def q_chunk_summary(spark, sf_dir):
    """Per batch of 50 requests: requests, successes and offers (W1 with A1)."""
    orders = read_table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("request_id"))
    per_request = read_table(spark, sf_dir, "lineitem").groupBy(
        F.col("l_orderkey").alias("request_id")).agg(F.count(F.lit(1)).alias("n_offers"))
    chunks = with_chunk_id(orders, ["request_id"], 50)
    return chunks.join(per_request, "request_id", "left").groupBy("chunk_id").agg(
        F.count(F.lit(1)).alias("requests"),
        F.count("n_offers").alias("successes"),
        F.coalesce(F.sum("n_offers"), F.lit(0)).alias("offers"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "offers": q_offers,
    "page_names": q_page_names,
    "page_outcome": q_page_outcome,
    "list_sizes": q_list_sizes,
    "distinct_names": q_distinct_names,
    "page_scoped_items": q_page_scoped_items,
    "nth_section": q_nth_section,
    "page_layout": q_page_layout,
    "layout_fallback": q_layout_fallback,
    "attr_match": q_attr_match,
    "searched_dates": q_searched_dates,
    "searched_stay": q_searched_stay,
    "drop_blanks": q_drop_blanks,
    "newline_fold": q_newline_fold,
    "transliterate": q_transliterate,
    "search_key": q_search_key,
    "price_clean": q_price_clean,
    "manifest_project": q_manifest_project,
    "manifest_sample": q_manifest_sample,
    "chunk_id": q_chunk_id,
    "offer_position": q_offer_position,
    "request_offers": q_request_offers,
    "reattempt": q_reattempt,
    "sentinel_rows": q_sentinel_rows,
    "merge_outcomes": q_merge_outcomes,
    "run_summary": q_run_summary,
    "page_rate_shop": q_page_rate_shop,
    "page_rate_shop_summary": q_page_rate_shop_summary,
    "page_rate_shop_parsed": q_page_rate_shop_parsed,
    "page_legacy_rows": q_page_legacy_rows,
    "page_rate_shop_elements": q_page_rate_shop_elements,
    "element_scope": q_element_scope,
    "place_flags": q_place_flags,
    "block_fields": q_block_fields,
    "rule_winner": q_rule_winner,
    "chunk_summary": q_chunk_summary,
}
