"""Text to typed values, including text that must not parse."""

from datetime import date
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from shelfline.functions import keys, parsing
from shelfline.functions.measures import mean, ratio


def values(spark, make, texts):
    """Results of ``make(col)`` in the order of ``texts``."""
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r.v for r in df.select("i", make(F.col("t")).alias("v")).orderBy("i").collect()]


D = date(2024, 11, 5)


@pytest.mark.parametrize(
    "layout, text, expected",
    [
        ("yyyy-MM-dd", "2024-11-05", D),
        ("yyyy-MM-dd", "2024-11-5", None),
        ("yyyy-MM-dd", "2024-02-30", None),
        ("yyyy-MM-dd", "2024-11-05 ", None),
        ("yyyy-MM-dd", "20241105", None),
        ("yyyy-MM-dd", "2024-13-01", None),
        ("MM/dd/yyyy", "11/05/2024", D),
        ("MM/dd/yyyy", "1/5/2024", None),
        ("MM/dd/yyyy", "13/05/2024", None),
        ("yyyyMMdd", "20241105", D),
        ("yyyyMMdd", "20241399", None),
        ("yyyyMMdd", "2024-11-05", None),
        ("yyyyMMdd", "", None),
        ("dd.MM.yyyy", "05.11.2024", D),
        ("dd.MM.yyyy", "05x11x2024", None),
        ("dd MMM yyyy", "05 Nov 2024", D),
        ("yyyyMMdd", None, None),
    ],
)
def test_date_layouts(spark, layout, text, expected):
    assert values(spark, lambda c: parsing.parse_date(c, layout), [text]) == [expected]


@settings(max_examples=20, deadline=None)
@given(st.lists(st.dates(date(1, 1, 1), date(9999, 12, 31)), min_size=1, max_size=30))
def test_dates_come_back(spark, days):
    iso = [f"{d:%Y}".zfill(4) + f"-{d:%m-%d}" for d in days]
    us = [f"{d:%m/%d/}" + f"{d.year:04d}" for d in days]
    compact = [f"{d.year:04d}{d:%m%d}" for d in days]
    assert values(spark, lambda c: parsing.parse_date(c, parsing.ISO), iso) == days
    assert values(spark, lambda c: parsing.parse_date(c, parsing.US), us) == days
    assert values(spark, lambda c: parsing.parse_date(c, parsing.COMPACT), compact) == days
    assert values(spark, parsing.parse_date_auto, iso) == days


def test_automatic_date_reads_no_plain_digits(spark):
    assert values(spark, parsing.parse_date_auto, ["2024-11-05", "11/05/2024", "20241105", "1730764800", None]) == [
        D, D, None, None, None,
    ]


def test_date_layout_follows_the_sender(spark):
    rows = [
        ("WMT", "2024-11-05", D), ("WMT", "11/05/2024", None),
        ("KRO", "11/05/2024", D), ("KRO", "20241105", None),
        ("TGT", "20241105", D), ("TGT", "2024-11-05", None),
        ("XXX", "2024-11-05", D), ("XXX", "11/05/2024", D), ("XXX", "20241105", None),
        (None, "2024-11-05", D), (" wmt", "11/05/2024", D),
    ]
    df = spark.createDataFrame(rows, "code string, t string, want date")
    got = df.select("want", parsing.parse_date_by_source(F.col("code"), F.col("t")).alias("got")).collect()
    assert [r.got for r in got] == [r.want for r in got]


def test_numbers(spark):
    texts = ["45", " 45 ", "3.5", "-2.5", "2.4", "1e3", "1,000", "abc", "", None, "-5"]
    assert values(spark, parsing.parse_integer, texts) == [45, 45, 4, -3, 2, 1000, None, None, None, None, -5]
    assert values(spark, lambda c: parsing.parse_decimal(c, 5, 2), ["15", "1.005", "999.999", "1000", "x"]) == [
        Decimal("15.00"), Decimal("1.01"), None, None, None,
    ]


def test_strict_forms_fail_the_job(spark):
    assert values(spark, parsing.strict_integer, ["45", "3.5"]) == [45, 4]
    for make in (parsing.strict_integer, parsing.strict_float, lambda c: parsing.strict_date_by_source(F.lit("WMT"), c)):
        with pytest.raises(PySparkException):
            values(spark, make, ["N/A"])


def test_flags_codes_digits(spark):
    assert values(spark, parsing.yes_flag, ["Y", "N", "y", None]) == [True, False, False, None]
    assert values(spark, lambda c: parsing.flag_number(parsing.yes_flag(c)), ["Y", "N", None]) == [1, 0, None]
    assert values(spark, parsing.tidy_code, [" wmt ", "KRO", None]) == ["WMT", "KRO", None]
    assert values(spark, parsing.digits, ["028-000 01a2", "", None]) == ["02800001" + "2", "", None]
    upcs = ["0" * 11, "0" * 12, "0" * 13, "028-000000012", "0" * 14, None]
    assert values(spark, lambda c: parsing.upc_has_length(c, 12, 13), upcs) == [False, True, True, True, False, None]


def test_check_digit(spark):
    assert values(spark, parsing.check_digit_ok, ["036000291452", "036000291453", "0-36000-29145-2", "12"])[:3] == [
        True, False, True,
    ]
    assert values(spark, lambda c: parsing.check_digit_ok(c, 13), ["4006381333931", "4006381333932"]) == [True, False]


def test_hash_keys(spark):
    df = spark.createDataFrame([("WMT", 1, D), ("WMT", None, D)], "a string, b int, c date")
    joined = [r[0] for r in df.select(keys.joined_key(F.col("a"), F.col("b"), F.col("c"))).collect()]
    hashed = [r[0] for r in df.select(keys.hashed_key(F.col("a"), F.col("b"), F.col("c"))).collect()]
    import hashlib

    md5 = lambda s: hashlib.md5(s.encode()).hexdigest()
    assert joined == [md5("WMT|1|2024-11-05"), None]
    assert hashed == [md5("WMT-1-2024-11-05"), md5(f"WMT-{keys.NULL_PART}-2024-11-05")]


def test_ratio_and_mean(spark):
    df = spark.createDataFrame([(1, 0), (3, 2), (None, 5)], "a int, b int")
    assert [r[0] for r in df.select(ratio(F.col("a"), F.col("b"))).collect()] == [None, 1.5, None]
    assert df.agg(mean(F.col("a"))).first()[0] == 2.0


def test_no_line_feed_after_a_date(spark):
    for layout, text in (("yyyyMMdd", "20240105"), ("yyyy-MM-dd", "2024-01-05")):
        assert values(spark, lambda c: parsing.parse_date(c, layout).isNull(), [text, text + "\n", "\n" + text]) == [False, True, True]


def test_long_numbers_are_read_but_do_not_fit(spark):
    texts = ["9" * 18, "9" * 19, "9" * 38, "9" * 39]
    assert [v is None for v in values(spark, parsing.parse_wide_integer, texts)] == [False, False, False, True]
    assert [v is None for v in values(spark, parsing.parse_integer, texts)] == [False, True, True, True]


def test_numbers_follow_the_natural_key_and_stay(spark):
    rows = [(f"k{i:03}", i % 7) for i in range(300)]
    df = spark.createDataFrame(rows, "k string, price int").repartition(5)
    first = {r.k: r.n for r in keys.number_rows(df, "n", ["k"]).collect()}
    assert [first[k] for k, _ in sorted(rows)] == list(range(1, 301))
    repriced = df.withColumn("price", F.col("price") + 1).unionByName(spark.createDataFrame([("a", 1), ("z", 1)], "k string, price int"))
    again = {r.k: r.n for r in keys.keep_numbers(repriced, keys.number_rows(df, "n", ["k"]), "n", ["k"]).collect()}
    assert again == first | {"a": 301, "z": 302}


def test_numbering_is_dense_with_many_copies(spark):
    one = spark.range(25_000).select(F.lit("a").alias("k"), F.lit(1).alias("v"))
    df = one.unionByName(spark.range(500).select(F.col("id").cast("string").alias("k"), F.lit(2).alias("v")))
    got = keys.number_rows(df, "n", ["k"], start=10)
    row = got.agg(F.count("*"), F.count_distinct("n"), F.min("n"), F.max("n")).first()
    assert tuple(row) == (25_500, 25_500, 11, 25_510)
    assert got.where("k = 'a'").agg(F.max("n") - F.min("n")).first()[0] == 24_999
