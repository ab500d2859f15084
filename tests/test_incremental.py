from __future__ import annotations

from datetime import datetime, timedelta

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from starmart.plans import silver
from starmart.sources.readers import read_parquet
from starmart.streaming import incremental, marks
from starmart.streaming.incremental import load_increment
from tests.plans import plan_of, settings

COLUMNS = (
    "order_id string, customer_id string, order_status string, order_purchase_timestamp string, "
    "order_approved_at string, order_delivered_carrier_date string, "
    "order_delivered_customer_date string, order_estimated_delivery_date string"
)


def order(key, bought, delivered=None):
    return (key, "c", "delivered", bought, bought, None, delivered, "2018-12-31")


class Shop:
    def __init__(self, spark, folder):
        self.spark = spark
        self.control, self.target = f"{folder}/control", f"{folder}/orders"
        marks.init_marks(spark, self.control)

    def load(self, rows, **options):
        raw = self.spark.createDataFrame(rows, COLUMNS)
        return load_increment(
            self.spark,
            silver.order_candidates(raw),
            silver.finish_orders,
            table="orders",
            key="order_id",
            ts="purchase_ts",
            control_path=self.control,
            target_path=self.target,
            partition_by=("year", "month"),
            **options,
        )

    def mark(self):
        return marks.get_mark(self.spark, self.control, "orders")

    def keys(self):
        return sorted(r["order_id"] for r in read_parquet(self.spark, self.target).collect())


@pytest.fixture
def shop(spark, tmp_path):
    return Shop(spark, str(tmp_path))


def test_marks_start_and_move_alone(spark, tmp_path):
    path = str(tmp_path / "control")
    marks.init_marks(spark, path)
    assert {tuple(r) for r in marks.read_marks(spark, path).collect()} == {
        (table, marks.START) for table in ("orders", "reviews", "order_items")
    }
    at = datetime(2018, 10, 17, 17, 30, 18, 123456)
    marks.set_mark(spark, path, "orders", at)
    assert marks.get_mark(spark, path, "orders") == at
    assert marks.get_mark(spark, path, "reviews") == marks.START
    assert marks.get_mark(spark, path, "unknown") == marks.START
    assert marks.read_marks(spark, path).count() == 3
    assert dict(marks.read_marks(spark, path).dtypes)["last_processed_ts"] == "timestamp"
    marks.init_marks(spark, path, keep=True)
    assert marks.get_mark(spark, path, "orders") == at
    marks.init_marks(spark, path)
    assert marks.get_mark(spark, path, "orders") == marks.START


def test_marks_mean_the_session_zone(spark, tmp_path):
    """Not the zone of the Python process."""
    with settings(spark, spark__sql__session__timeZone="Asia/Tokyo"):
        shop = Shop(spark, str(tmp_path))
        shop.load([order("a", "2018-01-05 00:30:00")])
        assert shop.mark() == datetime(2018, 1, 5, 0, 30)
        rows = [order("a", "2018-01-05 00:30:00"), order("b", "2018-01-05 00:30:01")]
        assert shop.load(rows).rows == 1
        marks.set_mark(spark, shop.control, "orders", datetime(2018, 1, 5))
        stored = marks.mark_of(marks.read_marks(spark, shop.control), "orders")
        assert stored.selectExpr("cast(last_processed_ts as string)").first()[0] == "2018-01-05 00:00:00"


def test_filter_is_strict_and_drops_null(spark):
    at = datetime(2018, 1, 1)
    rows = [(at,), (at + timedelta(microseconds=1),), (None,)]
    df = spark.createDataFrame(rows, "ts timestamp")
    assert [r["ts"] for r in marks.after_mark(df, "ts", at).collect()] == [rows[1][0]]


def test_first_load_then_only_newer_rows(shop):
    first = [order("a", "2018-01-05 10:00:00"), order("b", "2018-02-01 00:00:00")]
    assert shop.load([*first, first[0]]).rows == 2
    assert shop.mark() == datetime(2018, 2, 1)
    again = [*first, order("late", "2018-01-06"), order("c", "2018-02-01 00:00:01")]
    result = shop.load(again)
    assert (result.rows, result.mark) == (1, datetime(2018, 2, 1, 0, 0, 1))
    assert shop.keys() == ["a", "b", "c"]


def test_nothing_new_writes_nothing(shop):
    assert shop.load([]).rows == 0 and shop.mark() == marks.START
    shop.load([order("a", "2018-01-05")])
    before = shop.mark()
    files = set(read_parquet(shop.spark, shop.target).inputFiles())
    assert shop.load([order("a", "2018-01-05"), order("x", "not a time")]).rows == 0
    assert shop.mark() == before
    assert set(read_parquet(shop.spark, shop.target).inputFiles()) == files


def test_mark_covers_rows_that_the_features_drop(shop):
    """Delivered before bought: dropped, yet not looked at again."""
    result = shop.load([order("bad", "2018-03-01", delivered="2018-02-01")])
    assert (result.rows, result.mark) == (0, datetime(2018, 3, 1))
    assert shop.load([order("bad", "2018-03-01", delivered="2018-02-01")]).rows == 0
    assert shop.load([order("ok", "2018-03-02")]).rows == 1


def test_undelivered_orders_stay(shop):
    shop.load([order("a", "2018-01-05")])
    row = read_parquet(shop.spark, shop.target).first()
    assert (row["delivery_days"], row["is_late"], row["year"], row["month"]) == (None, 0, 2018, 1)


def test_crash_between_data_and_mark_adds_nothing_twice(shop, monkeypatch):
    rows = [order("a", "2018-01-05"), order("b", "2018-02-05")]

    def crash(*_):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as broken:
        broken.setattr(incremental, "set_mark", crash)
        with pytest.raises(RuntimeError):
            shop.load(rows)
    assert shop.mark() == marks.START and shop.keys() == ["a", "b"]
    shop.load([*rows, order("c", "2018-02-06")])
    assert shop.keys() == ["a", "b", "c"]
    assert shop.mark() == datetime(2018, 2, 6)


def test_rerun_after_a_crash_repairs_the_mark(shop, monkeypatch):
    rows = [order("a", "2018-01-05"), order("b", "2018-02-05")]
    with monkeypatch.context() as broken:
        broken.setattr(incremental, "set_mark", lambda *_: None)
        shop.load(rows)
    assert shop.mark() == marks.START
    assert shop.load(rows).rows == 0
    assert shop.keys() == ["a", "b"] and shop.mark() == datetime(2018, 2, 5)


def test_second_version_of_an_order_survives_a_half_written_batch(shop, monkeypatch):
    early, late = order("a", "2018-01-05"), order("a", "2018-01-05", delivered="2018-01-09")
    with monkeypatch.context() as broken:
        broken.setattr(incremental, "set_mark", lambda *_: None)
        shop.load([early])
    assert shop.load([early, late]).rows == 1
    assert shop.keys() == ["a", "a"]


def test_lookback_finds_late_rows_once(shop):
    shop.load([order("a", "2018-01-05"), order("b", "2018-01-10")])
    rows = [order("a", "2018-01-05"), order("late", "2018-01-08"), order("b", "2018-01-10")]
    assert shop.load(rows).rows == 0
    assert shop.load(rows, lookback=timedelta(days=7)).rows == 1
    assert shop.load(rows, lookback=timedelta(days=7)).rows == 0
    assert shop.keys() == ["a", "b", "late"]
    assert shop.mark() == datetime(2018, 1, 10)


def test_mark_filter_reaches_the_scan_below_the_dedupe(spark, tmp_path):
    path = str(tmp_path / "raw")
    spark.range(10).select(
        F.col("id").alias("order_id"), F.timestamp_seconds("id").alias("ts"), F.lit(1).alias("n")
    ).write.parquet(path)
    df = marks.after_mark(spark.read.parquet(path).dropDuplicates(), "ts", datetime(2018, 1, 1))
    plan = plan_of(df)
    assert plan.index("HashAggregate") < plan.index("Filter") < plan.index("FileScan")
    assert "GreaterThan(ts,2018-01-01" in plan


def test_known_rows_are_looked_for_in_few_months_only(spark, shop):
    shop.load([order("a", "2017-01-05"), order("b", "2018-01-10")])
    target = read_parquet(spark, shop.target)
    loaded = incremental.loaded_after(target, "purchase_ts", datetime(2018, 1, 1), ("year", "month"))
    assert [r["order_id"] for r in loaded.collect()] == ["b"]
    plan = plan_of(loaded)
    assert "year" in plan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert "GreaterThan(purchase_ts,2018-01-01" in plan


def test_written_timestamps_have_statistics(spark, shop):
    shop.load([order("a", "2018-01-05"), order("b", "2018-01-10")])
    (file,) = read_parquet(spark, shop.target).inputFiles()
    footer = pq.ParquetFile(file.removeprefix("file://")).metadata.row_group(0)
    columns = {footer.column(i).path_in_schema: footer.column(i) for i in range(footer.num_columns)}
    assert columns["purchase_ts"].statistics.has_min_max


def test_late_rows_with_one_review_id_are_both_loaded(spark, tmp_path):
    """A review id alone does not name a review row: its order does too."""
    batch = spark.createDataFrame([("r", "o1", 5), ("r", "o2", 3)], "review_id string, order_id string, n int")
    batch = batch.withColumn("ts", F.lit("2018-01-02").cast("timestamp"))
    loaded = batch.where("order_id = 'o1'")
    left = incremental.without_loaded(batch, loaded, ("review_id", "order_id"), "ts", datetime(2018, 2, 1))
    assert [r["order_id"] for r in left.collect()] == ["o2"]
