"""Column functions on small literal frames, including the edge values the
report layouts call for."""

import datetime as dt

from pyspark.sql import functions as F

from ledgerlens.functions import (
    clean_text, duration_text, int_or_zero, iso_date, localise_month, money, money_eu,
    pacific_if_utc, parse_first, percent_text, split_zone, utc_to_pacific_text,
)
from ledgerlens.functions.dates import pattern_shape


def one(spark, expr, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(expr(F.col("v")).alias("r")).first()["r"]


def test_money(spark):
    assert one(spark, money, "1,234.50") == 1234.5
    assert one(spark, money, "  12 ") == 12.0
    assert one(spark, money, "") is None
    assert one(spark, money, "nan") is None
    assert one(spark, money, "1d") is None
    assert one(spark, money, None) is None
    assert one(spark, money_eu, "12,50") == 12.5
    assert one(spark, money_eu, "1.234,5") is None


def test_int_or_zero(spark):
    assert one(spark, int_or_zero, "12.9") == 12
    assert one(spark, int_or_zero, "-3.7") == -3
    assert one(spark, int_or_zero, "98101-1234") == 0
    assert one(spark, int_or_zero, None) == 0
    assert one(spark, int_or_zero, "9007199254740993") == 9007199254740993


def test_clean_text(spark):
    assert one(spark, clean_text, "\u200b Oct 20, 2024\t ") == "Oct 20, 2024"


def test_localise_month(spark):
    assert one(spark, localise_month, "5 ago 2024") == "5 August 2024"
    assert one(spark, localise_month, "5 SEPT 2024") == "5 September 2024"
    # Full English names are not corrupted ('July' stays 'July').
    assert one(spark, localise_month, "July 5, 2024") == "July 5, 2024"
    assert one(spark, localise_month, "Oct 5, 2024") == "October 5, 2024"


def test_iso_date(spark):
    assert one(spark, iso_date, "10-11-2024") == "2024-10-11"   # month first
    assert one(spark, iso_date, "25-10-2024") == "2024-10-25"   # only day first fits
    assert one(spark, iso_date, "2024-10-25") == "2024-10-25"
    assert one(spark, iso_date, "garbage") is None
    for text in ("Oct 20, 2024", "20 Oct 2024 10:00", "10-20-2024 10:00 PM", "2024-10-20T10:11:12Z",
                 "2024-10-20T10:11:12+00:00", "20.10.2024", "10/20/2024", "Sunday, October 20, 2024 1:05:12 PM PDT",
                 "20241020", "2024-10-20 10:11:12.123456"):
        assert one(spark, iso_date, text) == "2024-10-20", text


def test_iso_date_spellings(spark):
    for text, want in [("5-Oct-24", "2024-10-05"), ("Oct-05-2024", "2024-10-05"), ("05/Oct/2024", "2024-10-05"),
                       ("Sept 5 2024", "2024-09-05"), ("Sept. 5, 2024", "2024-09-05"), ("5th October 2024", "2024-10-05"),
                       ("October 1st, 2024", "2024-10-01"), ("10-11-2024 5pm", "2024-10-11"), ("10-11-2024 5 P.M.", "2024-10-11"),
                       ("2024-13-05", "2024-05-13"), ("2024-05-13", "2024-05-13"), ("2024 Oct 5", "2024-10-05"),
                       ("5-Oct-98", "1998-10-05"), ("12/31/73", "2073-12-31"), ("12/31/74", "1974-12-31"),
                       ("2090-01-02", "2090-01-02"), ("2024-10", None), ("34th October 2024", None), ("Monday", None)]:
        assert one(spark, iso_date, text) == want, text


def test_money_decimal(spark):
    from decimal import Decimal
    from ledgerlens.functions.text import decimal_reasons, money_decimal
    for text, want in [("1234.50", "1234.50"), ("-.5", "-0.50"), ("+7", "7.00"), ("1.005", None), ("1.500", "1.50"),
                       ("9999999999999999.99", "9999999999999999.99"), ("99999999999999999.99", None), ("1e3", None), ("", None),
                       ("abc", None), ("0.00000000000000000001", None), ("0.1", "0.10"), ("9" * 60, None)]:
        got = one(spark, lambda c: money_decimal(c), text)
        assert got == (None if want is None else Decimal(want)), text
    why = [one(spark, lambda c, n=n: F.coalesce(*[F.when(h, r) for h, r in decimal_reasons(c)]), t)
           for n, t in enumerate(("abc", "1.005", "9" * 30, "0.00000000000000000001"))]
    assert why == ["not a number", "more than two decimals", "too large for decimal(18,2)", "more than two decimals"]


def test_zone_handling(spark):
    df = spark.createDataFrame([("Oct 20, 2024 1:05:12 PM PDT",), ("Jul 1, 2024 12:00:00 PM UTC",),
                                ("Jul 1, 2024 12:00:00 PM GMT-7",), ("Jul 1, 2024 9:00:00 AM",)], "v string")
    body, zone = split_zone(F.col("v"))
    local = parse_first(body, ["MMM d, yyyy h:mm:ss a"])
    rows = df.select(zone.alias("z"), pacific_if_utc(local, zone).alias("t")).collect()
    assert [r.z for r in rows] == ["PDT", "UTC", "GMT-7", None]
    assert rows[0].t == dt.datetime(2024, 10, 20, 13, 5, 12)      # wall time kept
    assert rows[1].t == dt.datetime(2024, 7, 1, 5, 0, 0)          # UTC -> Pacific (PDT)
    assert rows[2].t == dt.datetime(2024, 7, 1, 12, 0, 0)
    assert rows[3].t == dt.datetime(2024, 7, 1, 9, 0, 0)


def test_utc_to_pacific_dst(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 15, 12),), (dt.datetime(2024, 7, 15, 12),)],
                               "v timestamp_ntz")
    out = [r[0] for r in df.select(utc_to_pacific_text(F.col("v"))).collect()]
    assert out == ["2024-01-15 04:00:00", "2024-07-15 05:00:00"]


def test_duration_text(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 0), dt.datetime(2024, 1, 2, 1, 30))],
                               "a timestamp_ntz, b timestamp_ntz")
    assert df.select(duration_text("a", "b")).first()[0] == "1 hours 30 minutes"


def test_percent_text(spark):
    assert one(spark, percent_text, 0.05, "v double") == "0.05%"
    assert one(spark, percent_text, 12345678.0, "v double") == "12345678.0%"
    assert one(spark, percent_text, None, "v double") is None


def test_pattern_shape_is_not_stricter_than_parser(spark):
    import re
    for pat, txt in [("MMM d, yyyy h:mm:ss a", "Oct 2, 2024 1:05:12 pm"),
                     ("d-M-yyyy H:m:s", "5-1-2024 3:4:5"), ("yyyy-M-d", "2024-10-01")]:
        assert re.match(pattern_shape(pat).replace("\\\\", "\\"), txt)


def test_percent_text_small(spark):
    for value in (0.0005, 0.00123, 0.05, 5e-05, 1.5e-05, -2.5e-07, 0.0, 12345678.5, 1.0, -0.0007, 0.07 / 100, 1e-300):
        assert one(spark, percent_text, value, "v double") == f"{value}%", value
