"""Column functions: every one returns a ``Column`` built from Spark's own
expressions, so it stays inside whole-stage code generation."""

from ratelens.functions.text import (
    clean_price,
    fold_newlines,
    price_decimal,
    search_key,
    stay_date,
    transliterate,
)
from ratelens.functions.arrays import (
    drop_blanks,
    distinct_values,
    nth,
    pair_by_index,
)
from ratelens.functions.html import (
    attr_present,
    extract_all,
    extract_first,
    region,
)

__all__ = [
    "clean_price", "fold_newlines", "price_decimal", "search_key", "stay_date", "transliterate",
    "drop_blanks", "distinct_values", "nth", "pair_by_index",
]
