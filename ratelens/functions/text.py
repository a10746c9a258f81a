"""Scalar text functions: transliteration, price cleaning, newline folding.

All of them are compositions of built-in expressions (``translate``,
``replace``, ``try_cast``), NULL-safe, and free of Python on the row path.
"""

from __future__ import annotations

import json
import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# Letters that have no canonical decomposition, with the ASCII
# spelling conventionally used for them; capitals follow by rule.
SPECIAL_LETTERS = {
    "æ": "ae", "ð": "d", "ø": "o", "þ": "th", "ß": "ss", "đ": "d", "ħ": "h", "ı": "i", "ĸ": "q", "ł": "l",
    "ŋ": "ng", "œ": "oe", "ŧ": "t", "ə": "e", "ƒ": "f", "ơ": "o", "ư": "u",
}
GREEK = {
    "α": "a", "β": "b", "γ": "g", "δ": "d", "ε": "e", "ζ": "z", "η": "e", "θ": "th", "ι": "i", "κ": "k",
    "λ": "l", "μ": "m", "ν": "n", "ξ": "x", "ο": "o", "π": "p", "ρ": "r", "ς": "s", "σ": "s", "τ": "t",
    "υ": "u", "φ": "ph", "χ": "kh", "ψ": "ps", "ω": "o",
}
CYRILLIC = {
    "а": "a", "б": "b", "в": "v", "г": "g", "д": "d", "е": "e", "ж": "zh", "з": "z", "и": "i", "й": "i",
    "к": "k", "л": "l", "м": "m", "н": "n", "о": "o", "п": "p", "р": "r", "с": "s", "т": "t", "у": "u",
    "ф": "f", "х": "kh", "ц": "ts", "ч": "ch", "ш": "sh", "щ": "shch", "ъ": "", "ы": "y", "ь": "", "э": "e",
    "ю": "iu", "я": "ia", "ё": "io", "є": "ie", "і": "i", "ї": "yi", "ґ": "g", "ђ": "dj", "ј": "j",
    "љ": "lj", "њ": "nj", "ћ": "tsh", "ў": "u", "џ": "dzh",
}
PUNCTUATION = {
    "\u00a0": " ", "\u2019": "'", "\u2018": "'", "\u201c": '"', "\u201d": '"', "\u201e": ",,", "\u201a": ",",
    "\u2013": "-", "\u2014": "--", "\u2010": "-", "\u2011": "-", "\u2026": "...", "\u2022": "*", "\u20ac": "EUR",
    "\u00a3": "PS", "\u00ab": "<<", "\u00bb": ">>", "\u00b7": "*", "\u00b0": "deg", "\u00a9": "(c)",
    "\u00ae": "(r)", "\u2122": "tm", "\u2032": "'", "\u2009": " ", "\u200b": "", "\ufeff": "",
}

# Blocks covered: Latin-1 Supplement, Latin Extended-A and -B, combining
# marks, Greek, Cyrillic, Latin Extended Additional, Greek Extended.
_RANGES = ((0x00C0, 0x024F), (0x0300, 0x036F), (0x0370, 0x03FF), (0x0400, 0x04FF), (0x1E00, 0x1EFF),
           (0x1F00, 0x1FFF))


def _letter(ch: str, table: dict[str, str]) -> str | None:
    """ASCII spelling of one letter: from the table, as the capital of a
    letter there, or from its Unicode decomposition."""
    if ch in table:
        return table[ch]
    low = ch.lower()
    if len(low) == 1 and low != ch and low in table:
        return table[low].capitalize()
    base = "".join(c for c in unicodedata.normalize("NFKD", ch) if not unicodedata.combining(c))
    if base == ch or not base:
        return None if base else ""
    parts = [c if ord(c) < 128 and c.isalpha() else _letter(c, table) for c in base]
    return "".join(p for p in parts if p) or None


@lru_cache(maxsize=1)
def latin_table() -> tuple[str, str, tuple[tuple[str, str], ...]]:
    """Build the transliteration table from Unicode decomposition and the
    letter tables above.

    Returns ``(from_chars, to_chars, multi)`` where the first two feed one
    ``translate`` call (one letter to one letter, or to nothing: those come
    last) and ``multi`` lists the characters that expand to several (fed to
    ``replace``).
    """
    table = {**SPECIAL_LETTERS, **GREEK, **CYRILLIC}
    found = dict(PUNCTUATION)
    for first, last in _RANGES:
        for code in range(first, last + 1):
            ch = chr(code)
            kind = unicodedata.category(ch)
            if kind == "Mn":
                found[ch] = ""
            elif kind.startswith("L") and (form := _letter(ch, table)) is not None:
                found[ch] = form
    found |= {"Æ": "AE", "Œ": "OE", "Ŋ": "NG"}  # fixed values: capitals written in capitals
    single = {c: f for c, f in found.items() if len(f) == 1}
    gone = [c for c, f in found.items() if not f]
    multi = tuple((c, f) for c, f in found.items() if len(f) > 1)
    return "".join([*single, *gone]), "".join(single.values()), multi


def transliterate(col: ColumnOrName) -> Column:
    """ASCII transliteration (``Hôtel Größe`` → ``Hotel Grosse``).

    Covers Latin letters with marks (composed or decomposed), Greek, Cyrillic
    and common punctuation; other characters pass through unchanged.
    """
    src, dst, multi = latin_table()
    c = _col(col)
    # characters that become several are cut out and looked up, each once; the
    # text between them is translated as it is
    letters = "".join(ch for ch, _ in multi)
    spelled = F.from_json(F.lit(json.dumps(dict(multi))), "map<string,string>")
    pieces = F.regexp_extract_all(c, F.lit(f"[{letters}]|[^{letters}]++"), F.lit(0))
    expanded = F.array_join(F.transform(pieces, lambda p: F.coalesce(
        F.when(F.length(p) == 1, F.try_element_at(spelled, p)), F.translate(p, src, dst))), "")
    out = F.when(c.rlike(f"[{letters}]"), expanded).otherwise(F.translate(c, src, dst))
    # Pure-ASCII text (most names) is returned as it is after one scan.
    return F.when(c.rlike("[^\\x00-\\x7F]"), out).otherwise(c)


def fold_newlines(col: ColumnOrName) -> Column:
    """Replace each line feed by one space (visible text of a label)."""
    return F.replace(_col(col), F.lit("\n"), F.lit(" "))


def clean_price(col: ColumnOrName) -> Column:
    """Legacy price text: ``$`` and ``,`` removed literally, still a string.

    ``$1,234`` → ``1234``; sentinel texts pass through; NULL stays NULL.
    """
    return F.replace(F.replace(_col(col), F.lit("$"), F.lit("")), F.lit(","), F.lit(""))


def price_decimal(col: ColumnOrName, precision: int = 12, scale: int = 2) -> Column:
    """Typed price: the cleaned text cast to a decimal, NULL when not a number."""
    return clean_price(col).try_cast(f"decimal({precision},{scale})")


def search_key(hotel: ColumnOrName, city: ColumnOrName) -> Column:
    """Lookup text for a request: transliterated hotel name, a space, the city.

    NULL when either part is NULL, so a request without a city is not
    searched under a misleading key.
    """
    return F.concat(transliterate(hotel), F.lit(" "), _col(city))


# Date texts accepted for stay dates, tried in this order
# after a leading weekday name ("Wednesday, ") is removed.
DATE_FORMATS = ("yyyy-MM-dd", "MMMM d, yyyy", "MMM d, yyyy", "M/d/yyyy", "d MMMM yyyy")


def stay_date(col: ColumnOrName) -> Column:
    """Typed date from the display text of a stay date, NULL if unreadable.

    ``Wednesday, May 1, 2024`` → 2024-05-01; ``2024-05-01`` → 2024-05-01."""
    text = F.trim(F.regexp_replace(
        _col(col), r"^\s*(?i:mon|tue|wed|thu|fri|sat|sun)[a-z]*\.?,?\s+", ""))
    return F.coalesce(*[F.try_to_date(text, fmt) for fmt in DATE_FORMATS])


# English month and weekday names by their first three letters.
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
WEEKDAYS = ("sun", "mon", "tue", "wed", "thu", "fri", "sat")


def display_date(col: ColumnOrName, near: ColumnOrName) -> Column:
    """Date of a display text, which may leave out the year.

    A text with a year is read as :func:`stay_date` reads it.  Otherwise the
    day is the one nearest to the date ``near`` (the earlier of two equally
    near); a weekday in the text must be that day's, so ``Wed, May 1`` near
    2023-11-20 is 2024-05-01, and 29 February stands in leap years only.  NULL
    if unreadable, or if no year within four of ``near`` fits."""
    text, about = F.lower(F.trim(_col(col))), _col(near)
    shape = r"^(?:([a-z]{3})[a-z]*\.?,?\s+)??(?:([a-z]{3})[a-z]*\.?\s+([0-9]{1,2})|([0-9]{1,2})\.?\s+([a-z]{3})[a-z]*\.?)$"
    month_name = F.concat(F.regexp_extract(text, shape, 2), F.regexp_extract(text, shape, 5))
    day = F.concat(F.regexp_extract(text, shape, 3), F.regexp_extract(text, shape, 4))
    weekday = F.array_position(F.array(*[F.lit(d) for d in WEEKDAYS]), F.regexp_extract(text, shape, 1))
    month = F.array_position(F.array(*[F.lit(m) for m in MONTHS]), month_name)

    def in_year(years: int) -> Column:
        written = F.concat_ws("-", (F.year(about) + years).cast("string"), F.lpad(month.cast("string"), 2, "0"),
                              F.lpad(day, 2, "0"))
        found = written.try_cast("date")
        fits = (weekday == 0) | (F.dayofweek(found) == weekday)
        return F.when(fits, F.struct(F.abs(F.datediff(found, about)).alias("away"), found.alias("date")))

    known = (F.regexp_extract(text, shape, 1) == "") | (weekday > 0)
    nearest = F.array_min(F.filter(F.array(*[in_year(y) for y in range(-4, 5)]), lambda x: x["date"].isNotNull()))
    return F.coalesce(stay_date(_col(col)), F.when(text.rlike(shape) & known & (month > 0), nearest["date"]))


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c
