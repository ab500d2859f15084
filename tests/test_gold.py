from __future__ import annotations

from collections import Counter
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from starmart.operators.joins import left_join
from starmart.plans import gold
from tests.plans import plan_of, settings

ITEMS = "order_id string, order_item_id int, product_id string, seller_id string, price double, freight_value double"
ORDERS = "order_id string, customer_id string, purchase_ts timestamp, delivery_days int, is_late int"
PAYMENTS = "order_id string, payment_value double"
REVIEWS = "order_id string, review_score int"

NO_BROADCAST = {
    "spark__sql__autoBroadcastJoinThreshold": -1,
    "spark__sql__adaptive__autoBroadcastJoinThreshold": -1,
}


def star(spark):
    """Dirty little tables: missing orders, customers and products, repeated keys, late payments."""
    items = spark.createDataFrame(
        [
            ("o1", 1, "p1", "s1", 10.0, 1.0),
            ("o1", 2, "p2", "s1", 20.0, 2.0),
            ("o2", 1, "p1", "s9", 30.0, 3.0),
            ("o3", 1, "p9", "s2", 40.0, 0.0),  # no such order, but payments and a review
            ("o4", 1, "p1", "s1", 50.0, 0.0),  # order appears twice
            ("o5", 1, "p1", "s1", 60.0, 0.0),  # order of an unknown customer
        ],
        ITEMS,
    )
    day = datetime(2018, 3, 4, 23, 59)
    orders = spark.createDataFrame(
        [
            ("o1", "c1", day, 5, 0),
            ("o2", "c2", datetime(2018, 3, 5), None, 0),
            ("o4", "c1", day, 1, 0),
            ("o4", "c1", day, 2, 1),
            ("o5", "c9", day, 3, 0),
        ],
        ORDERS,
    )
    payments = spark.createDataFrame(
        [("o1", 0.1), ("o1", 0.2), ("o3", 7.0), ("o4", 1.0), ("o8", 1.0)], PAYMENTS
    )
    reviews = spark.createDataFrame([("o1", 5), ("o1", 4), ("o3", 2), ("o7", 1)], REVIEWS)
    dims = (
        spark.createDataFrame([(0, "c1"), (1, "c2")], "customer_key long, customer_id string"),
        spark.createDataFrame([(0, "p1"), (1, "p2")], "product_key long, product_id string"),
        spark.createDataFrame([(0, "s1"), (1, "s2")], "seller_key long, seller_id string"),
        gold.dim_date(orders.filter(F.col("order_id") != "o2")),
    )
    return items, orders, payments, reviews, *dims


def chained(items, orders, payments, reviews, customers, products, sellers, dates):
    """The fact as the plain chain of left joins that defines it."""
    paid = payments.groupBy("order_id").agg(F.round(F.sum("payment_value"), 2).alias("payment_value"))
    scored = reviews.groupBy("order_id").agg(F.avg("review_score").alias("review_score"))
    return (
        items.join(orders, "order_id", "left")
        .join(paid, "order_id", "left")
        .join(scored, "order_id", "left")
        .withColumn("full_date", F.to_date("purchase_ts"))
        .join(customers, "customer_id", "left")
        .join(products, "product_id", "left")
        .join(sellers, "seller_id", "left")
        .join(dates.select("date_key", "full_date"), "full_date", "left")
        .select(
            *["customer_key", "product_key", "seller_key", "date_key", "order_id", "order_item_id"],
            *["price", "freight_value", "payment_value", "review_score", "delivery_days", "is_late"],
        )
    )


def bag(df):
    return Counter(map(tuple, df.collect()))


@pytest.mark.parametrize("options", [{}, NO_BROADCAST], ids=["broadcast", "shuffle"])
def test_fact_equals_the_chain_of_left_joins(spark, options):
    tables = star(spark)
    with settings(spark, **options):
        fact = gold.fact_sales(*tables)
        assert bag(fact) == bag(chained(*tables))
    rows = {(r["order_id"], r["order_item_id"], r["delivery_days"]): r for r in fact.collect()}
    assert len(rows) == 7
    assert rows["o1", 1, 5]["payment_value"] == 0.3 and rows["o1", 1, 5]["review_score"] == 4.5
    lost = rows["o3", 1, None]
    assert (lost["payment_value"], lost["review_score"], lost["customer_key"]) == (7.0, 2.0, None)
    assert rows["o2", 1, None]["date_key"] is None and rows["o5", 1, 3]["customer_key"] is None


def test_hot_order_product_and_seller_are_split(spark):
    """One order, product and seller hold a third of all lines; AQE must cut each of the joins."""
    n = 60_000
    hot = F.col("id") % 3 == 0
    items = spark.range(n).select(
        F.when(hot, 0).otherwise(F.col("id")).alias("order_id"),
        F.col("id").alias("order_item_id"),
        F.when(hot, 0).otherwise(F.col("id") % 5_000).alias("product_id"),
        F.when(hot, 0).otherwise(F.col("id") % 3_000).alias("seller_id"),
        (F.col("id") % 500 + 1).cast("double").alias("price"),
        F.lit(1.0).alias("freight_value"),
    )
    orders = spark.range(0, n, 2).select(
        F.col("id").alias("order_id"),
        (F.col("id") % 100).alias("customer_id"),
        F.timestamp_seconds(F.col("id") * 5_000).alias("purchase_ts"),
        F.lit(1).alias("delivery_days"),
        F.lit(0).alias("is_late"),
    )
    payments = spark.range(n).select(
        F.col("id").alias("order_id"), F.lit(1.5).alias("payment_value")
    )
    reviews = spark.range(n).select(
        F.col("id").alias("order_id"), (F.col("id") % 5 + 1).alias("review_score")
    )
    tables = (
        items,
        orders,
        payments,
        reviews,
        spark.range(100).selectExpr("id as customer_key", "id as customer_id"),
        spark.range(4_000).selectExpr("id as product_key", "id as product_id"),
        spark.range(2_000).selectExpr("id as seller_key", "id as seller_id"),
        gold.dim_date(orders),
    )
    options = {
        **NO_BROADCAST,
        "spark__sql__adaptive__advisoryPartitionSizeInBytes": "40KB",
        "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "40KB",
        "spark__sql__adaptive__skewJoin__skewedPartitionFactor": 2,
        "spark__sql__shuffle__partitions": 16,
    }
    with settings(spark, **options):
        fact = gold.fact_sales(*tables)
        got = bag(fact)
        assert plan_of(fact).count("skew=true") >= 3
    assert got == bag(chained(*tables))


def test_order_lines_meet_order_data_in_one_join(spark):
    with settings(spark, spark__sql__adaptive__enabled="false"):
        plan = plan_of(gold.fact_sales(*star(spark)))
    assert plan.count("FullOuter") == 1
    assert plan.count("LeftOuter") == 5
    # No table is broadcast without a check of its size, the days included.
    with settings(spark, **NO_BROADCAST):
        assert plan_of(gold.fact_sales(*star(spark))).count("BroadcastHashJoin") == 0


def test_order_lines_are_shuffled_once_when_the_dimensions_are_small(spark):
    n = 100_000
    key = F.col("id")
    orders = spark.range(n).select(
        key.alias("order_id"),
        (key % 100).alias("customer_id"),
        F.timestamp_seconds(key * 5_000).alias("purchase_ts"),
        F.lit(1).alias("delivery_days"),
        F.lit(0).alias("is_late"),
    )
    items = spark.range(n).select(
        (key % 5_000).alias("order_id"),
        key.alias("order_item_id"),
        (key % 100).alias("product_id"),
        (key % 100).alias("seller_id"),
        F.lit(1.0).alias("price"),
        F.lit(1.0).alias("freight_value"),
    )
    small = spark.range(100)
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="64KB"):
        plan = plan_of(
            gold.fact_sales(
                items,
                orders,
                orders.select("order_id", F.lit(1.5).alias("payment_value")),
                orders.select("order_id", F.lit(3).alias("review_score")),
                small.selectExpr("id as customer_key", "id as customer_id"),
                small.selectExpr("id as product_key", "id as product_id"),
                small.selectExpr("id as seller_key", "id as seller_id"),
                spark.range(100).selectExpr("id as date_key", "date_add(date'1970-01-01', cast(id as int)) as full_date"),
            )
        )
    assert plan.count("BroadcastHashJoin") == 4 and plan.count("SortMergeJoin") == 2
    # Lines, orders, payments with reviews, all order data.
    assert plan.count("Exchange hashpartitioning") == 4


def test_left_join_keeps_unmatched_and_null_keys_and_fans_out(spark):
    left = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    right = spark.createDataFrame([("a", 1), ("a", 2), (None, 3)], "k string, v int")
    got = bag(left_join(left, right, "k"))
    assert got == Counter([("a", 1), ("a", 2), ("b", None), (None, None)])


def test_dim_date_has_one_row_per_day(spark):
    orders = spark.createDataFrame(
        [(datetime(2018, 3, 3, 1),), (datetime(2018, 3, 3, 22),), (datetime(2018, 3, 5),)],
        "purchase_ts timestamp",
    )
    rows = gold.dim_date(orders).orderBy("date_key").collect()
    assert [tuple(r)[0] for r in rows] == [20180303, 20180305]
    assert tuple(rows[0])[2:] == (2018, 1, 3, 3, "March", "Saturday", 1)


def test_dim_product_classes_and_translation(spark):
    schema = (
        "product_id string, product_category_name string, product_name_lenght int, "
        "product_description_lenght int, product_photos_qty int, weight_kg double, "
        "product_volume_cm3 double"
    )
    products = spark.createDataFrame(
        [("b", "toys", 1, 2, 3, 0.5, 100.0), ("a", None, 1, 2, 3, None, None)], schema
    )
    category = spark.createDataFrame(
        [("toys", "games")], "product_category_name string, product_category_name_english string"
    )
    rows = {r["product_id"]: r for r in gold.dim_product(products, category).collect()}
    assert rows["a"]["product_key"] == 0 and rows["a"]["product_category_name_english"] is None
    assert (rows["a"]["weight_category"], rows["a"]["product_size_category"]) == ("Heavy", "Large")
    assert rows["b"]["product_category_name_english"] == "games"
    assert (rows["b"]["weight_category"], rows["b"]["product_size_category"]) == ("Light", "Small")
