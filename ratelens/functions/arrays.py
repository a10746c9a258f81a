"""Array helpers used on extracted lists (names, prices, text nodes)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def drop_blanks(col: ColumnOrName) -> Column:
    """Remove empty entries and entries of white space only; order and
    duplicates are kept."""
    return F.filter(_col(col), lambda x: F.btrim(x, F.lit(" \t\n\r\f")) != F.lit(""))


def distinct_values(col: ColumnOrName) -> Column:
    """Distinct entries, first occurrence kept."""
    return F.array_distinct(_col(col))


def nth(col: ColumnOrName, n: int) -> Column:
    """0-based element, NULL when the array is shorter (never raises)."""
    return F.get(_col(col), n)


def pair_by_index(left: ColumnOrName, right: ColumnOrName,
                  left_name: str = "l", right_name: str = "r") -> Column:
    """Array of structs pairing ``left[i]`` with ``right[i]`` for every i of
    ``left``; missing right entries are NULL, extra right entries dropped."""
    lcol, rcol = _col(left), _col(right)
    return F.transform(
        lcol,
        lambda x, i: F.struct(x.alias(left_name), F.get(rcol, i).alias(right_name)),
    )


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c
