from decimal import Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ratelens.functions import (
    clean_price, fold_newlines, price_decimal, search_key, transliterate,
)


def _one(spark, expr, value, dtype="string"):
    df = spark.createDataFrame([(value,)], f"v {dtype}")
    return df.select(expr(F.col("v")).alias("o")).first()["o"]


def test_price_clean_cases(spark):
    cases = [("$1,234", "1234", Decimal("1234.00")), ("$99", "99", Decimal("99.00")),
             ("Not Available", "Not Available", None), (None, None, None),
             ("€ 5", "€ 5", None), ("$1,234.56", "1234.56", Decimal("1234.56"))]
    df = spark.createDataFrame([(c[0],) for c in cases], "v string")
    got = df.select(clean_price("v").alias("t"), price_decimal("v").alias("d")).collect()
    assert [(r.t, r.d) for r in got] == [(c[1], c[2]) for c in cases]


def test_transliterate_cases(spark):
    assert _one(spark, transliterate, "Hôtel Größe") == "Hotel Grosse"
    assert _one(spark, transliterate, "plain ASCII, 123!") == "plain ASCII, 123!"
    assert _one(spark, transliterate, "Æ ø œ") == "AE o oe"
    assert _one(spark, transliterate, "Ĳsselmeer Łódź Þór") == "IJsselmeer Lodz Thor"
    assert _one(spark, transliterate, None) is None


def test_search_key_and_fold(spark):
    df = spark.createDataFrame([("Hôtel X", "Nice"), ("A", None)], "h string, c string")
    got = [r.k for r in df.select(search_key("h", "c").alias("k")).collect()]
    assert got == ["Hotel X Nice", None]
    assert _one(spark, fold_newlines, "Boo\nking") == "Boo king"


@settings(max_examples=30, deadline=None)
@given(st.lists(st.text(alphabet="$,0123456789.abc €", max_size=12), min_size=1, max_size=20))
def test_price_clean_idempotent(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    once = df.select(clean_price("v").alias("a"))
    twice = once.select(F.col("a"), clean_price("a").alias("b")).collect()
    assert all(r.a == r.b for r in twice)
    assert all(r.a == v.replace("$", "").replace(",", "") for r, v in zip(twice, values))


def test_stay_date(spark):
    from ratelens.functions.text import stay_date
    vals = ["Wednesday, May 1, 2024", "2024-05-01", "May 1, 2024", "Wed, May 1, 2024",
            "5/1/2024", "1 May 2024", "soon", None]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    got = [str(r.d) if r.d else None for r in df.select(stay_date("v").alias("d")).collect()]
    assert got == ["2024-05-01"] * 6 + [None, None]


def test_display_dates_without_a_year(spark):
    import datetime as dt

    from ratelens.functions.text import display_date
    near = dt.date(2024, 5, 3)
    cases = {
        "Wed, May 1": (near, dt.date(2024, 5, 1)), "May 1": (near, dt.date(2024, 5, 1)), "1 May": (near, dt.date(2024, 5, 1)),
        "Wednesday, May 1": (near, dt.date(2024, 5, 1)), "Wed 1. May": (near, dt.date(2024, 5, 1)),
        "Dec 30": (dt.date(2024, 1, 2), dt.date(2023, 12, 30)), "Jan 2": (dt.date(2023, 12, 30), dt.date(2024, 1, 2)),
        "Thu, May 1": (near, dt.date(2025, 5, 1)), "Tue, May 1": (near, None),  # no such Tuesday within four years
        "Feb 29": (dt.date(2023, 3, 1), dt.date(2024, 2, 29)), "Feb 30": (near, None), "Foo 3": (near, None),
        "Xyz, May 1": (near, None), "May": (near, None), "": (near, None), None: (near, None),
        "May 1, 2022": (near, dt.date(2022, 5, 1)), "2021-01-31": (near, dt.date(2021, 1, 31)), "sept 9": (near, dt.date(2024, 9, 9)),
        "Fri, May 3": (None, None),
    }
    df = spark.createDataFrame([(t, n, w) for t, (n, w) in cases.items()], "t string, near date, want date")
    for r in df.withColumn("got", display_date("t", "near")).collect():
        assert r.got == r.want, r
