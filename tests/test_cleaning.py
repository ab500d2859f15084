from __future__ import annotations

from starmart.operators import aggregates, cleaning
from tests.plans import plan_of


def column(df, name):
    return sorted((r[name] for r in df.collect()), key=lambda v: (v is None, v or 0))


def test_exact_copies_go_and_padded_variants_stay(spark):
    rows = [("a", 1), ("a", 1), (" A", 1), (None, 1), (None, 1)]
    df = spark.createDataFrame(rows, "k string, n int")
    assert cleaning.drop_exact_copies(df).count() == 3


def test_required_columns_drop_null_and_nan(spark):
    rows = [("a", 1.0), (None, 1.0), ("a", None), ("a", float("nan")), (None, None)]
    df = spark.createDataFrame(rows, "k string, lat double")
    kept = cleaning.require(df, "k", "lat")
    assert kept.count() == df.na.drop(subset=["k", "lat"]).count() == 1
    assert cleaning.not_null(df, "k").count() == 3


def test_sign_filters(spark):
    df = spark.createDataFrame([(-1.0,), (0.0,), (0.01,), (None,)], "x double")
    assert column(cleaning.positive(df, "x"), "x") == [0.01]
    assert column(cleaning.not_negative(df, "x"), "x") == [0.0, 0.01]
    assert column(cleaning.null_or_not_negative(df, "x"), "x") == [0.0, 0.01, None]


def test_closed_range(spark):
    df = spark.createDataFrame([(v,) for v in (None, 0, 1, 3, 5, 6)], "s int")
    assert column(cleaning.in_range(df, "s", 1, 5), "s") == [1, 3, 5]


def test_centroid_weighs_repeats(spark):
    rows = [("1", "x", "SP", 0.0, 0.0), ("1", "x", "SP", 0.0, 0.0), ("1", "x", "SP", 3.0, 6.0)]
    df = spark.createDataFrame(rows, "zip string, city string, state string, lat double, lng double")
    row = aggregates.centroid(df, ["zip", "city", "state"], "lat", "lng").first()
    assert (row["avg_lat"], row["avg_lng"]) == (1.0, 2.0)


def test_monthly_revenue_is_ordered(spark):
    rows = [(2018, 2, 0.1), (2017, 12, 5.0), (2018, 2, 0.2), (2018, 1, 1.0)]
    df = spark.createDataFrame(rows, "year int, month int, price double").repartition(4)
    got = [tuple(r) for r in aggregates.monthly_revenue(df).collect()]
    assert got == [(2017, 12, 5.0), (2018, 1, 1.0), (2018, 2, 0.3)]


def test_first_rows(spark):
    df = spark.range(100).repartition(7)
    assert [r["id"] for r in aggregates.first_rows(df, ["id"], 5).collect()] == [0, 1, 2, 3, 4]


def test_latest_of_nothing_is_null(spark):
    df = spark.createDataFrame([], "ts timestamp")
    assert aggregates.latest(df, "ts", "newest").first()["newest"] is None


def test_required_columns_are_tested_in_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([("a", 1.0)], "k string, lat double").write.parquet(path)
    plan = plan_of(cleaning.require(spark.read.parquet(path), "k", "lat"))
    assert "IsNotNull(k), IsNotNull(lat)" in plan
