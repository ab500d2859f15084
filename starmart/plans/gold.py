"""Star schema: five dimensions and the order-line fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.functions import dates, measures
from starmart.operators import joins
from starmart.operators.keys import numbered


# Columns of the star, here and in the selects below. Key and business key of the keyed tables.
KEYS = {
    "dim_customer": ("customer_key", ["customer_id"]),
    "dim_product": ("product_key", ["product_id"]),
    "dim_seller": ("seller_key", ["seller_id"]),
}


def customer_rows(customers: DataFrame, region: Column | None = None) -> DataFrame:
    named = measures.region("customer_state") if region is None else region
    return customers.select(
        "customer_id",
        "customer_unique_id",
        "customer_city",
        "customer_state",
        named.alias("customer_region"),
    )


def dim_customer(customers: DataFrame, region: Column | None = None) -> DataFrame:
    return numbered(customer_rows(customers, region), *KEYS["dim_customer"])


def seller_rows(sellers: DataFrame, region: Column | None = None) -> DataFrame:
    named = measures.region("seller_state") if region is None else region
    return sellers.select("seller_id", "seller_city", "seller_state", named.alias("seller_region"))


def dim_seller(sellers: DataFrame, region: Column | None = None) -> DataFrame:
    return numbered(seller_rows(sellers, region), *KEYS["dim_seller"])


def product_rows(products: DataFrame, category: DataFrame) -> DataFrame:
    """A category with two translations gives two rows per product."""
    return joins.left_join(products, category, "product_category_name").select(
        "product_id",
        "product_category_name",
        "product_category_name_english",
        "product_name_lenght",
        "product_description_lenght",
        "product_photos_qty",
        "weight_kg",
        measures.banded("weight_kg", measures.WEIGHT_BANDS).alias("weight_category"),
        "product_volume_cm3",
        measures.banded("product_volume_cm3", measures.SIZE_BANDS).alias("product_size_category"),
    )


def dim_product(products: DataFrame, category: DataFrame) -> DataFrame:
    return numbered(product_rows(products, category), *KEYS["dim_product"])


def dim_date(orders: DataFrame) -> DataFrame:
    """One row per day with orders. The day is null where the purchase time is."""
    days = orders.select(dates.calendar_day("purchase_ts").alias("full_date")).distinct()
    parts = dates.calendar_parts("full_date")
    return days.select(
        dates.date_key("full_date").alias("date_key"),
        "full_date",
        parts["year"].alias("year"),
        parts["quarter"].alias("quarter"),
        parts["month"].alias("month"),
        parts["day"].alias("day"),
        dates.month_name("full_date").alias("month_name"),
        dates.weekday_name("full_date").alias("day_of_week"),
        dates.is_weekend("full_date").alias("is_weekend"),
    )


def dim_location(geolocation: DataFrame) -> DataFrame:
    return geolocation.select(
        "location_key",
        F.col("geolocation_zip_code_prefix").alias("zip_code"),
        F.col("geolocation_city").alias("city"),
        F.col("geolocation_state").alias("state"),
        F.col("avg_lat").alias("latitude"),
        F.col("avg_lng").alias("longitude"),
    )


def order_measures(payments: DataFrame, reviews: DataFrame) -> DataFrame:
    """Paid amount and mean score per order, from one grouping over both tables."""
    paid = payments.select("order_id", "payment_value", F.lit(None).cast("int").alias("review_score"))
    scored = reviews.select("order_id", F.lit(None).cast("double").alias("payment_value"), "review_score")
    return (
        paid.unionAll(scored)
        .groupBy("order_id")
        .agg(
            measures.money_sum("payment_value").alias("payment_value"),
            F.avg("review_score").alias("review_score"),
        )
    )


def order_level(
    orders: DataFrame,
    payments: DataFrame,
    reviews: DataFrame,
    dim_customer: DataFrame,
    dim_date: DataFrame,
) -> DataFrame:
    """Everything the fact takes from the order, at order grain.

    The outer join is full because an order line also gets its payments and reviews where the
    order itself is missing. Customer and date keys are looked up here, where there are
    fewer and narrower rows than order lines. Spark broadcasts them where its size checks allow.
    """
    placed = orders.select(
        "order_id",
        "customer_id",
        dates.calendar_day("purchase_ts").alias("full_date"),
        "delivery_days",
        "is_late",
    )
    placed = joins.left_join(placed, dim_customer.select("customer_id", "customer_key"), "customer_id")
    days = dim_date.select("full_date", "date_key")
    placed = joins.left_join(placed, days, "full_date").drop("customer_id", "full_date")
    return placed.join(order_measures(payments, reviews), "order_id", "full")


def fact_sales(
    items: DataFrame,
    orders: DataFrame,
    payments: DataFrame,
    reviews: DataFrame,
    dim_customer: DataFrame,
    dim_product: DataFrame,
    dim_seller: DataFrame,
    dim_date: DataFrame,
) -> DataFrame:
    """One row per order line (more where a looked-up key repeats).

    Product and seller ids are swapped for their keys first, so that the shuffle on
    the order id moves narrow rows. Order lines meet order data in a single join of two plain
    shuffles, which AQE can split when one order id is hot. ``payment_value``,
    ``review_score``, ``delivery_days`` and ``is_late`` belong to the order and repeat on its lines.
    """
    lines = items.select(
        "order_id", "order_item_id", "product_id", "seller_id", "price", "freight_value"
    )
    lines = joins.left_join(lines, dim_product.select("product_id", "product_key"), "product_id")
    lines = joins.left_join(lines, dim_seller.select("seller_id", "seller_key"), "seller_id")
    lines = lines.drop("product_id", "seller_id")
    per_order = order_level(orders, payments, reviews, dim_customer, dim_date)
    return joins.left_join(lines, per_order, "order_id").select(
        "customer_key",
        "product_key",
        "seller_key",
        "date_key",
        "order_id",
        "order_item_id",
        "price",
        "freight_value",
        "payment_value",
        "review_score",
        "delivery_days",
        "is_late",
    )
