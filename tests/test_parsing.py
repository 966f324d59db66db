import datetime

import pytest
from pyspark.sql import functions as F

from regbook.functions.parsing import parse_decimal, parse_short_date, short_date

DAY = datetime.date(2026, 1, 5)


def test_short_dates(spark):
    expected = {
        "05.01.26": DAY,
        "5.1.26": DAY,
        "05.01.2026": DAY,
        " 05.01.26 ": DAY,
        "05.01.95": datetime.date(1995, 1, 5),
        "29.02.24": datetime.date(2024, 2, 29),
        "05.01.45": datetime.date(2045, 1, 5),
        "05.01.46": datetime.date(1946, 1, 5),
        "32.01.26": None,
        "29.02.25": None,
        "2026-01-05": None,
        "05.01.26xyz": None,
        "05.01.026": None,
        "1.2.3.4": None,
        "": None,
        None: None,
    }
    df = spark.createDataFrame([(t, t) for t in expected], "text string, day string")
    parsed = {r.text: r.day for r in parse_short_date(df, "day").collect()}
    assert parsed == expected


def test_short_date_pivot(spark):
    df = spark.createDataFrame([("01.01.30",)], "t string")
    assert df.select(short_date(F.col("t"), pivot=29)).first()[0].year == 1930


@pytest.mark.parametrize(
    "text, value",
    [
        ("1598,5", 1598.5),
        ("1598.5", 1598.5),
        (" 12 ", 12.0),
        ("-3,25", -3.25),
        (",5", 0.5),
        ("1e3", 1000.0),
        ("12d", None),
        ("1 500", None),
        ("1,2,3", None),
        ("x", None),
        ("NaN", None),
        ("", None),
        (None, None),
    ],
)
def test_decimals(spark, text, value):
    df = spark.createDataFrame([(text,)], "n string")
    assert parse_decimal(df, ["n"]).first()[0] == value
