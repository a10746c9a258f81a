"""Classification of each request from its extracted page.

Precedence (first match wins): no capture or no usable layout → broken;
not available → ``not_available``; contact the property → ``contact``;
at least as many prices as sellers → ``offers``; otherwise broken because
of too few prices.  A page without any flag and any seller keeps the
outcome ``offers`` with no rows, but has the reason ``no_sellers``, which the
summary counts apart: a sold-out or changed page is never a silent success.
Errors are row values (``reason``), never job failures,
and a broken request never emits offers (all or nothing per request).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OFFERS = "offers"
NOT_AVAILABLE = "not_available"
CONTACT = "contact"
BROKEN = "broken"
NO_SELLERS = "no_sellers"
STATUSES = (OFFERS, NOT_AVAILABLE, CONTACT, BROKEN)

# The sentinel texts of the legacy output.
NOT_AVAILABLE_TEXT = "Not Available"
CONTACT_TEXT = "Contact this property"


def status_expr(page: Column, html: Column | None = None) -> Column:
    """Outcome of one request as a string column."""
    missing = page.isNull()
    if html is not None:
        missing = html.isNull() | (F.length(html) == 0) | missing
    return (
        F.when(missing, F.lit(BROKEN))
        .when(page["not_available"], F.lit(NOT_AVAILABLE))
        .when(page["contact"], F.lit(CONTACT))
        .when(F.size(page["prices"]) >= F.size(page["names"]), F.lit(OFFERS))
        .otherwise(F.lit(BROKEN))
    )


def reason_expr(page: Column, html: Column | None = None, has_capture: Column | None = None) -> Column:
    """Why a request is broken, or has no sellers (NULL for the other
    outcomes); the first failing check wins."""
    checks: list[tuple[Column, Column]] = []
    if has_capture is not None:
        checks.append((~has_capture, F.lit("no_capture")))
    if html is not None:
        checks += [(html.isNull(), F.lit("html_missing")),
                   (F.length(html) == 0, F.lit("html_empty"))]
    checks += [
        (page.isNull(), F.lit("no_layout")),
        (page["not_available"] | page["contact"], F.lit(None).cast("string")),
        (F.size(page["prices"]) < F.size(page["names"]), F.lit("too_few_prices")),
        (F.size(page["names"]) == 0, F.lit(NO_SELLERS)),
    ]
    cond, value = checks[0]
    out = F.when(cond, value)
    for cond, value in checks[1:]:
        out = out.when(cond, value)
    return out


def classify(df: DataFrame, page: str = "page", html: str | None = "html",
             has_capture: str | None = None) -> DataFrame:
    """Add ``status``, ``reason`` and ``n_offers`` (sellers emitted)."""
    p = F.col(page)
    h = F.col(html) if html else None
    cap = F.col(has_capture) if has_capture else None
    status = status_expr(p, h)
    if cap is not None:
        status = F.when(~cap, F.lit(BROKEN)).otherwise(status)
    return (
        df.withColumn("status", status)
        .withColumn("reason", F.when(F.col("status").isin(BROKEN, OFFERS), reason_expr(p, h, cap)))
        .withColumn(
            "n_offers",
            F.when(F.col("status") == OFFERS, F.size(p["names"])).otherwise(F.lit(0)).cast("int"),
        )
    )
