"""Extraction of sellers, prices and page flags from captured pages.

Selector rules are data, not code: a site change means new rules, not a
new program.  Two engines read the same result shape, a struct column
``page``::

    layout int, names array<string>, prices array<string>,
    not_available boolean, contact boolean, is_listing boolean,
    searched_in string, searched_out string

* ``extract_native`` - regular expressions over fixed markup; pure JVM
  expressions, so the scan, extraction and classification fuse into one
  whole-stage-codegen stage.
* ``extract_parsed`` (``ratelens.operators.parsed``) - a tolerant HTML
  parser in one Arrow-batched function for nested markup and entities.

Layouts are tried in priority order; the first one whose ``present`` test
holds supplies the lists (the reference's fallback from the detail page to
the listing page becomes a ``coalesce`` by priority).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratelens.functions.arrays import drop_blanks
from ratelens.functions.html import extract_first, visible_text
from ratelens.functions.text import fold_newlines

PAGE_TYPE = (
    "struct<layout:int,names:array<string>,prices:array<string>,"
    "not_available:boolean,contact:boolean,is_listing:boolean,"
    "searched_in:string,searched_out:string>"
)


@dataclass(frozen=True)
class Test:
    """A regular expression that must occur in one column of the capture."""

    regex: str
    column: str = "html"

    def col(self) -> Column:
        return F.coalesce(F.col(self.column).rlike(self.regex), F.lit(False))


@dataclass(frozen=True)
class NativeLayout:
    """Regular-expression rules of one page layout (group 1 is the value, and
    may hold markup: its tags are dropped and references decoded).

    ``scope`` limits name and price extraction to the markup between two
    patterns (the price container); ``present`` decides whether the page
    has this layout at all.
    """

    layout: int
    names: str
    prices: str
    present: tuple[Test, ...] = ()
    scope: tuple[str, str] | None = None
    not_available: tuple[Test, ...] = ()
    contact: tuple[Test, ...] = ()
    listing: tuple[Test, ...] = ()
    searched_in: str | None = None
    searched_out: str | None = None
    fold_names: bool = True
    drop_blank: bool = True


def _any(tests: Sequence[Test]) -> Column:
    if not tests:
        return F.lit(False)
    out = tests[0].col()
    for t in tests[1:]:
        out = out | t.col()
    return out


FIELDS = ("layout", "names", "prices", "not_available", "contact", "is_listing", "searched_in", "searched_out")


def _layout_fields(rules: NativeLayout, html: Column) -> dict[str, Column]:
    body = html
    if rules.scope is not None:
        start, end = rules.scope
        body = F.regexp_extract(html, f"(?s){start}(.*?){end}", 1)
    names = F.regexp_extract_all(body, F.lit(rules.names), F.lit(1))
    prices = F.regexp_extract_all(body, F.lit(rules.prices), F.lit(1))
    names, prices = F.transform(names, visible_text), F.transform(prices, visible_text)
    if rules.fold_names:
        names = F.transform(names, fold_newlines)
    if rules.drop_blank:
        names, prices = drop_blanks(names), drop_blanks(prices)

    def first(pattern: str | None) -> Column:
        if pattern is None:
            return F.lit(None).cast("string")
        return extract_first(html, pattern)

    return dict(zip(FIELDS, (F.lit(rules.layout), names, prices, _any(rules.not_available), _any(rules.contact),
                             _any(rules.listing), first(rules.searched_in), first(rules.searched_out))))


def native_fields(layouts: Sequence[NativeLayout], html_col: str = "html") -> dict[str, Column]:
    """The fields of the ``page`` struct as separate columns, NULL when no layout
    is present or html is NULL.  Select only those needed: Spark doesn't prune
    the fields of a struct that a condition yields."""
    html = F.col(html_col)
    out: dict[str, Column] = {}
    for rules in sorted(layouts, key=lambda r: r.layout):
        here = html.isNotNull() & _any(rules.present) if rules.present else html.isNotNull()
        for name, value in _layout_fields(rules, html).items():
            out[name] = out[name].when(here, value) if name in out else F.when(here, value)
    return out


def extract_native(df: DataFrame, layouts: Sequence[NativeLayout], html_col: str = "html",
                   out: str = "page") -> DataFrame:
    """Add the ``page`` struct; NULL when no layout is present or html is NULL."""
    fields = native_fields(layouts, html_col)
    if not fields:
        return df.withColumn(out, F.lit(None).cast(PAGE_TYPE))
    page = F.struct(*[value.alias(name) for name, value in fields.items()])
    return df.withColumn(out, F.when(fields["layout"].isNotNull(), page))


@dataclass(frozen=True)
class ParsedLayout:
    """Class/id/attribute selector rules of one layout, for the HTML parser.

    A selector is a compound of ``tag``, ``.class`` tokens, ``#id``,
    ``[attr=value]`` / ``[attr]`` and ``:nth(n)`` parts, e.g.
    ``div.NiGhzc`` or ``.MEVoGd.AdWm1c``; a multi-class value such as
    ``"MEVoGd AdWm1c"`` given in ``classes`` form means all tokens.  Compounds
    may be joined by ``>`` (child) and ``>>`` (descendant).
    ``scope`` restricts names and prices to descendants of its first match.
    """

    layout: int
    names: str
    prices: str
    present: tuple[str, ...] = ()
    scope: str | None = None
    not_available: tuple[str, ...] = ()
    contact: tuple[str, ...] = ()
    listing: tuple[str, ...] = ()
    searched_in: str | None = None
    searched_out: str | None = None
    block: str | None = None
    block_fields: tuple[tuple[str, str], ...] = field(default_factory=tuple)
