from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from starmart.functions import dates, measures, text


def values(spark, rows, schema, column):
    """Evaluate a column on rows, keeping their order."""
    numbered = [(i, *row) for i, row in enumerate(rows)]
    df = spark.createDataFrame(numbered, f"i int, {schema}")
    return [r["v"] for r in df.select("i", column.alias("v")).orderBy("i").collect()]


def banded(spark, bands, inputs):
    return values(spark, [(v,) for v in inputs], "x double", measures.banded("x", bands))


def test_payment_bands_include_their_lower_bound(spark):
    got = banded(spark, measures.PAYMENT_BANDS, [49.99, 50.0, 99.99, 100.0, 499.99, 500.0, None])
    assert got == ["0-50", "50-100", "50-100", "100-500", "100-500", "500+", "500+"]


def test_weight_and_size_bands_put_null_last(spark):
    got = banded(spark, measures.WEIGHT_BANDS, [0.999, 1.0, 4.999, 5.0, None])
    assert got == ["Light", "Medium", "Medium", "Heavy", "Heavy"]
    got = banded(spark, measures.SIZE_BANDS, [4999.0, 5000.0, 19999.0, 20000.0, None])
    assert got == ["Small", "Medium", "Medium", "Large", "Large"]


def test_sentiment(spark):
    rows = [(1,), (2,), (3,), (4,), (5,), (None,)]
    got = values(spark, rows, "s int", measures.sentiment("s"))
    assert got == ["negative", "negative", "neutral", "positive", "positive", "negative"]


def test_region(spark):
    rows = [("SP",), ("ES",), ("PR",), ("SC",), ("BA",), (None,)]
    got = values(spark, rows, "s string", measures.region("s"))
    assert got == ["Southeast", "Southeast", "South", "South", "Other", "Other"]


def test_late_only_after_the_estimate(spark):
    at = datetime(2018, 5, 1, 12)
    rows = [(at, at), (datetime(2018, 5, 1, 12, 0, 1), at), (None, at), (at, None)]
    got = values(spark, rows, "d timestamp, e timestamp", measures.is_late("d", "e"))
    assert got == [0, 1, 0, 0]


def test_days_ignore_the_time_of_day(spark):
    rows = [
        (datetime(2018, 1, 1, 23, 59), datetime(2018, 1, 2, 0, 1)),
        (datetime(2018, 1, 1, 0, 1), datetime(2018, 1, 1, 23, 59)),
        (datetime(2018, 1, 3), datetime(2018, 1, 1)),
        (datetime(2018, 1, 3), None),
    ]
    got = values(spark, rows, "s timestamp, e timestamp", dates.days_between("s", "e"))
    assert got == [1, 0, -2, None]


def test_totals_and_ratio(spark):
    rows = [(1.1, 2.2), (10.0, 0.005), (3.0, 1.0)]
    schema = "price double, freight double"
    assert values(spark, rows, schema, measures.line_total("price", "freight")) == [3.3, 10.01, 4.0]
    assert values(spark, rows, schema, measures.freight_ratio("freight", "price")) == [
        2.0,
        0.0005,
        0.3333,
    ]


def test_threshold_and_scale(spark):
    assert values(spark, [(1,), (2,), (None,)], "n int", measures.above("n", 1)) == [0, 1, 0]
    rows = [(1234.5,), (900.5,), (None,)]
    assert values(spark, rows, "g double", measures.kilograms("g")) == [1.235, 0.901, None]


def test_volume_does_not_overflow_an_int(spark):
    column = measures.volume("a", "b", "c")
    assert values(spark, [(2000, 2000, 2000), (1, None, 1)], "a int, b int, c int", column) == [
        8.0e9,
        None,
    ]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_bad_timestamps_become_null(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        rows = [("2018-01-02 03:04:05",), ("2018-01-02",), ("n/a",), ("",), (None,)]
        got = values(spark, rows, "t string", text.parse_timestamp("t"))
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
    assert got == [datetime(2018, 1, 2, 3, 4, 5), datetime(2018, 1, 2), None, None, None]


def test_trim_takes_spaces_only(spark):
    rows = [("  São Paulo ",), ("\tx ",), (None,)]
    assert values(spark, rows, "c string", text.trim_lower("c")) == ["são paulo", "\tx", None]
    assert values(spark, [(" sp ",)], "c string", text.trim_upper("c")) == ["SP"]


def test_location_key_skips_null_parts(spark):
    rows = [("01001", "SP"), ("01001", None), (None, "SP")]
    got = values(spark, rows, "z string, s string", text.location_key("z", "s"))
    assert got == ["01001_SP", "01001", "SP"]


def test_has_text(spark):
    rows = [(None,), ("",), ("   ",), ('say "hi"\nbye',)]
    assert values(spark, rows, "m string", text.has_text("m")) == [0, 0, 0, 1]


def test_date_attributes(spark):
    rows = [(date(2018, 8, d),) for d in (3, 4, 5, 6)]
    assert values(spark, rows, "d date", dates.is_weekend("d")) == [0, 1, 1, 0]
    assert values(spark, rows, "d date", dates.weekday_name("d"))[:2] == ["Friday", "Saturday"]
    assert values(spark, rows, "d date", dates.month_name("d"))[0] == "August"
    assert values(spark, rows, "d date", dates.date_key("d"))[0] == 20180803
    parts = dates.calendar_parts("d")
    assert [values(spark, rows[:1], "d date", c)[0] for c in parts.values()] == [2018, 8, 3, 3]


def summed(spark, amounts):
    df = spark.createDataFrame([(a,) for a in amounts], "x double").repartition(5)
    return df.agg(measures.money_sum("x").alias("s")).first()["s"]


def test_money_is_exact_to_the_cent(spark):
    assert summed(spark, [0.1] * 1000) == 100.0
    assert summed(spark, [0.1, 0.2, None, -0.3]) == 0.0
    assert summed(spark, [None, None]) is None


def test_money_has_six_decimals_and_no_size_switch(spark):
    assert summed(spark, [0.001, 0.002]) == 0.003
    assert summed(spark, [9e13, 9e13]) == 1.8e14
    assert summed(spark, [8.9e13] * 2000) == 1.78e17
    assert summed(spark, [1e21, 0.01]) == 1e21
    # What is no money counts as missing.
    assert summed(spark, [1e300, 1.0]) == 1.0
    assert summed(spark, [1.0, float("nan"), float("inf")]) == 1.0


def test_money_sum_has_the_same_digits_for_any_partitions(spark):
    df = spark.range(20_000).select((F.col("id") * 0.137 + F.when(F.col("id") % 7 == 0, 1e12).otherwise(0)).alias("x"))
    sums = {df.repartition(n).agg(measures.money_sum("x")).first()[0] for n in (1, 13)}
    assert len(sums) == 1


def test_money_sum_in_groups(spark):
    df = spark.range(100_000).select(
        (F.col("id") % 3).alias("k"), (F.col("id") % 1000 / 100.0).alias("x")
    )
    got = {r["k"]: r["s"] for r in df.groupBy("k").agg(measures.money_sum("x").alias("s")).collect()}
    cents = {k: sum(i % 1000 for i in range(100_000) if i % 3 == k) for k in range(3)}
    assert got == {k: c / 100 for k, c in cents.items()}
