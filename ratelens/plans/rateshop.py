"""The rate-shop run: requests + captured pages → offers, re-attempts, summary.

Plan, per request (no cross-request state except the final count):

1. extract each capture (native rules or the HTML parser) and drop the
   wide ``html`` column right away, so no shuffle ever moves page markup;
2. keep the latest capture per request (``max_by``, partially aggregated
   before the shuffle, so a request captured very often is one row per
   task);
3. join to the requests on ``request_id`` (unique on both sides now; AQE
   picks broadcast or sort-merge from the measured sizes) keeping every
   request, then classify: offers / not_available / contact / broken;
4. the per-request outcome is written once to the checkpoint folder
   (``DataFrame.checkpoint``), which cuts the lineage and is read by the
   three outputs instead of re-parsing pages three times;
5. offers explode per seller; broken requests and malformed manifest rows
   go to re-attempt with a reason; the summary counts both, so no request
   is lost silently.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratelens.functions.text import clean_price, display_date, price_decimal, stay_date, transliterate
from ratelens.operators.extract import NativeLayout, ParsedLayout, extract_native
from ratelens.operators.fields import extract_elements
from ratelens.operators.offers import request_rows
from ratelens.operators.outcome import BROKEN, OFFERS, classify
from ratelens.operators.parsed import extract_parsed
from ratelens.operators.summary import run_summary
from ratelens.session import checkpoint_dir

REQUEST_COLS = ["request_id", "hotel_id", "hotel", "city", "check_in", "check_out",
                "nights", "listed_base_price"]
OFFER_COLS = ["request_id", "hotel_id", "hotel", "agent", "scrape_position", "scrape_date",
              "check_in", "check_out", "check_in_search", "check_out_search",
              "listed_base_price", "scrape_base_price", "scrape_base_price_num", "nights",
              "status"]
# Manifest fee fields and their output names (optional extra price columns).
EXTRA_REQUEST_COLS = {"average_price": "listed_average_price_fees",
                      "total_price": "listed_total_price", "fees": "fees"}
# Per-seller block fields of the page and their output names.
EXTRA_PAGE_FIELDS = {"average_price": "scrape_average_price_fees",
                     "total_price": "scrape_total_price"}
REATTEMPT_COLS = ["request_id", "hotel_id", "hotel", "check_in", "check_out", "city",
                  "listed_base_price", "nights", "reason"]


@dataclass
class RunOutputs:
    offers: DataFrame
    reattempt: DataFrame
    summary: DataFrame
    outcomes: DataFrame


def extract_captures(captures: DataFrame,
                     layouts: Sequence[NativeLayout] | Sequence[ParsedLayout],
                     keep_labels: bool = False, engine: str = "elements") -> DataFrame:
    """Per capture: ``request_id, captured_at, page_id, html_state, html_hash,
    page`` (no html).  ``engine`` reads ``ParsedLayout`` rules: ``elements``
    (element intervals, no Python) or ``parser`` (one Python function)."""
    if engine not in ("elements", "parser"):
        raise ValueError(f"unknown engine: {engine}")
    state = (F.when(F.col("html").isNull(), F.lit("html_missing"))
             .when(F.length("html") == 0, F.lit("html_empty")))
    missing = {"captured_at": "timestamp_ntz", "page_id": "long"}
    cols = ["request_id", *[c if c in captures.columns else F.lit(None).cast(t).alias(c) for c, t in missing.items()],
            state.alias("html_state"), F.xxhash64("html").alias("html_hash")]
    if all(isinstance(x, NativeLayout) for x in layouts):
        return extract_native(captures, layouts).select(*cols, "page")  # type: ignore[arg-type]
    if not all(isinstance(x, ParsedLayout) for x in layouts):
        raise TypeError("layouts must be all NativeLayout or all ParsedLayout")
    if engine == "parser":
        return extract_parsed(captures, layouts, keep_labels=keep_labels).select(*cols, "page")  # type: ignore[arg-type]
    source = captures.select(*cols, "html")
    return extract_elements(source, layouts, [c for c in source.columns if c != "html"],  # type: ignore[arg-type]
                            keep_labels=keep_labels)


def latest_capture(extracted: DataFrame) -> DataFrame:
    """One capture per request: the latest ``captured_at``, ties and NULL
    times broken by the highest ``page_id``, then by a hash of the markup, so
    that the choice is the same on every run."""
    order = F.struct(F.coalesce(F.col("captured_at"), F.lit("0001-01-01").cast("timestamp_ntz")),
                     F.col("page_id"), F.col("html_hash"))
    return extracted.groupBy("request_id").agg(
        F.max_by(F.struct("page_id", "captured_at", "page", "html_state"), order).alias("c")
    ).select("request_id", "c.*")


def classify_requests(requests: DataFrame, captures: DataFrame,
                      captured_only: bool = False, extra_cols: Sequence[str] = (),
                      require_dates: bool = False) -> DataFrame:
    """Every request once, with ``status``, ``reason``, ``n_offers``
    (only the requests that have a capture when ``captured_only``).

    ``require_dates``: a page without a ``div`` whose ``aria-label`` is the
    requested check-in date, as text or as a date, and one for the check-out
    date, is broken, reason ``dates_not_found``.  Only ``ParsedLayout`` rules
    read these labels."""
    extra = [F.col(c) if c in requests.columns else F.lit(None).cast("string").alias(c)
             for c in extra_cols]
    malformed = "malformed" if "malformed" in requests.columns else F.lit(False).alias("malformed")
    req = requests.select(*REQUEST_COLS, *extra, malformed)
    how = "inner" if captured_only else "left"
    joined = req.join(captures.withColumn("_has", F.lit(True)), "request_id", how)
    classified = classify(joined, page="page", html=None)
    no_dates = F.lit(False)
    if require_dates:
        if "labels" not in captures.schema["page"].dataType.names:
            raise ValueError("require_dates needs parser rules (ParsedLayout)")
        # the page's div aria-labels were collected with the page, so the test
        # needs only the narrow extracted row, never the markup; a label counts
        # if it says the requested date in other words
        def shown(requested: str) -> Column:
            day = stay_date(requested)
            return F.array_contains("page.labels", F.col(requested)) | F.exists(
                "page.labels", lambda label: F.coalesce(display_date(label, day) == day, F.lit(False)))

        no_dates = F.coalesce(F.col("page").isNotNull() & ~(shown("check_in") & shown("check_out")), F.lit(False))
    fixed_reason = (
        F.when(F.col("malformed"), F.lit("malformed_row"))
        .when(F.col("_has").isNull(), F.lit("no_capture"))
        .when(F.col("html_state").isNotNull(), F.col("html_state"))
        .when(no_dates, F.lit("dates_not_found"))
    )
    return classified.select(
        *REQUEST_COLS, *extra_cols, "page_id", "captured_at", "page",
        F.when(F.col("malformed") | F.col("_has").isNull(), F.lit(BROKEN))
        .when(F.col("html_state").isNotNull() | no_dates, F.lit(BROKEN))
        .otherwise(F.col("status")).alias("status"),
        F.coalesce(fixed_reason, F.col("reason")).alias("reason"),
    ).withColumn(
        "n_offers",
        F.when(F.col("status") == "offers", F.size("page.names")).otherwise(F.lit(0)).cast("int"),
    ).withColumn("reason", F.when(F.col("status").isin(BROKEN, OFFERS), F.col("reason")))


def run_rate_shop(requests: DataFrame, captures: DataFrame,
                  layouts: Sequence[NativeLayout] | Sequence[ParsedLayout],
                  run_date: str, cut_lineage: bool = True,
                  captured_only: bool = False, extra_prices: bool = False,
                  require_dates: bool = False, engine: str = "elements") -> RunOutputs:
    """The whole run; nothing is computed until an output is written
    (except the checkpoint of the per-request outcomes when ``cut_lineage``).

    ``extra_prices`` adds the manifest's fee fields and each seller's
    average-with-fees and total price read from its block on the page.
    ``engine`` is the reader of ``ParsedLayout`` rules (:func:`extract_captures`)."""
    if extra_prices and not all(isinstance(x, ParsedLayout) for x in layouts):
        raise ValueError("extra_prices needs parser rules (ParsedLayout)")
    extracted = extract_captures(captures, layouts, keep_labels=require_dates, engine=engine)
    extra_cols = list(EXTRA_REQUEST_COLS) if extra_prices else []
    outcomes = classify_requests(requests, latest_capture(extracted), captured_only, extra_cols,
                                 require_dates)
    if cut_lineage:
        checkpoint_dir(outcomes.sparkSession)
        outcomes = outcomes.checkpoint(eager=True)

    searched_in = F.coalesce(F.col("page.searched_in"), F.col("check_in"))
    searched_out = F.coalesce(F.col("page.searched_out"), F.col("check_out"))
    with_search = outcomes.withColumn("check_in_search", searched_in).withColumn(
        "check_out_search", searched_out).withColumn("hotel", transliterate("hotel"))
    keep = ["request_id", "hotel_id", "hotel", "check_in", "check_out", "check_in_search",
            "check_out_search", "listed_base_price", "nights", "status"]
    has_extras = extra_prices and "extras" in outcomes.schema["page"].dataType.names
    rows = request_rows(with_search, keep=keep + extra_cols,
                        extras="page.extras" if has_extras else None)
    offers = rows.withColumn("scrape_base_price_num", price_decimal("scrape_base_price")) \
        .withColumn("scrape_base_price", clean_price("scrape_base_price")) \
        .withColumn("scrape_date", F.lit(run_date).cast("date"))
    if extra_prices:
        fields = []
        for key, name in EXTRA_PAGE_FIELDS.items():
            text = F.col("extra")[key] if has_extras else F.lit(None).cast("string")
            fields += [clean_price(text).alias(name), price_decimal(text).alias(name + "_num")]
        offers = offers.select(
            *OFFER_COLS, *[F.col(c).alias(n) for c, n in EXTRA_REQUEST_COLS.items()], *fields)
    else:
        offers = offers.select(*OFFER_COLS)

    reattempt = outcomes.filter(F.col("status") == BROKEN).withColumn(
        "hotel", transliterate("hotel")).select(*REATTEMPT_COLS)
    summary = run_summary(outcomes, reason="reason")
    return RunOutputs(offers=offers, reattempt=reattempt, summary=summary, outcomes=outcomes)
