"""Native (regular-expression) extraction from page markup.

Used when the markup of a layout is fixed: every call compiles to a JVM
expression.  Nested markup and entities need the parser in
``ratelens.operators.extract`` instead.
"""

from __future__ import annotations

import json
from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def extract_all(html: ColumnOrName, pattern: str, group: int = 1) -> Column:
    """All matches of ``pattern`` (group ``group``), in page order."""
    return F.regexp_extract_all(_col(html), F.lit(pattern), F.lit(group))


def extract_first(html: ColumnOrName, pattern: str, group: int = 1) -> Column:
    """First match, NULL when there is none (``regexp_extract`` alone gives
    '' for both "no match" and "empty match").  Both scans stop at the first
    match instead of collecting every match of the page."""
    c = _col(html)
    return F.when(c.rlike(pattern), F.regexp_extract(c, pattern, group))


def region(html: ColumnOrName, start: str, end: str) -> Column:
    """Markup between the first ``start`` and the next ``end`` ('' if absent)."""
    return F.regexp_extract(_col(html), f"(?s){start}(.*?){end}", 1)


_TAG = r"""<[^>=]*+(?:=(?:\s*+"[^"]*+"|\s*+'[^']*+')?+[^>=]*+)*+>"""
_REFERENCE = r"&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[a-zA-Z][a-zA-Z0-9]*);"
_PIECE = _REFERENCE + r"|[^&]++|&"


def decode_references(text: ColumnOrName) -> Column:
    """Character references replaced by their characters, each once: decimal
    and hexadecimal numbers and the names of HTML 4 (taken from the standard
    library) and ``apos``.  Others, and numbers of no character, stay as they
    are.  Texts without an ampersand are not looked into."""
    c = _col(text)
    # one literal once folded, however often the expression is used
    table = json.dumps({name: chr(point) for name, point in {**name2codepoint, "apos": 39}.items()})
    names = F.from_json(F.lit(table), "map<string,string>")

    def replaced(piece: Column) -> Column:
        inside = F.substr(piece, F.lit(2), F.length(piece) - 2)
        hexed = F.conv(F.substr(inside, F.lit(3)), 16, 10)
        plain = F.substr(inside, F.lit(2))
        point = F.when(inside.rlike("^#[xX]"), hexed).otherwise(plain).try_cast("int")
        real = point.between(1, 0xD7FF) | point.between(0xE000, 0x10FFFF)
        char = F.decode(F.unhex(F.lpad(F.hex(F.when(real, point)), 8, "0")), "UTF-32")
        return F.when(~piece.rlike("^" + _REFERENCE + "$"), piece).when(
            F.startswith(inside, F.lit("#")), F.coalesce(char, piece)).otherwise(
            F.coalesce(F.try_element_at(names, inside), piece))

    pieces = F.regexp_extract_all(c, F.lit(_PIECE), F.lit(0))
    return F.when(~F.contains(c, F.lit("&")), c).otherwise(F.array_join(F.transform(pieces, replaced), ""))


def visible_text(markup: ColumnOrName) -> Column:
    """Text of a piece of markup: tags dropped (a ``>`` inside a quoted value
    ends none), character references decoded, no-break spaces as spaces, white
    space around it removed.  Built-in expressions only."""
    text = F.regexp_replace(_col(markup), _TAG, "")
    return F.btrim(F.regexp_replace(decode_references(text), "\u00a0", " "), F.lit(" \t\n\r\f"))


def attr_present(html: ColumnOrName, prefix: str, value: ColumnOrName, suffix: str) -> Column:
    """Row-parameterised test: does ``prefix + value + suffix`` occur?

    ``value`` is a column, e.g. the requested check-in date tested as an
    ``aria-label`` of the captured page.
    """
    return F.contains(_col(html), F.concat(F.lit(prefix), _col(value), F.lit(suffix)))


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c
