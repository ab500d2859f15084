"""Raw tables to cleaned, typed tables.

Row filters come before the dedupe: they look at one row at a time, so the result is the same
and fewer rows are shuffled. Rows are copies of each other only as raw text: timestamps are parsed and
text is standardized after the dedupe, so two rows with different unreadable timestamps stay two. That the
dedupe groups text instead of eight bytes per timestamp is the price.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame

from starmart.functions import dates, measures, text
from starmart.operators import aggregates, cleaning
from starmart.streaming.marks import after_mark


def _parsed(raw: DataFrame, stamps: dict[str, str]) -> DataFrame:
    """Replace timestamp text by parsed columns under their new names; keep all other columns."""
    return raw.withColumns(
        {new: text.parse_timestamp(old) for old, new in stamps.items()}
    ).drop(*stamps)


# Column names of the cleaned tables, here and in the selects below.

# Orders ------------------------------------------------------------------------------

ORDER_STAMPS = {
    "order_purchase_timestamp": "purchase_ts",
    "order_approved_at": "approved_ts",
    "order_delivered_carrier_date": "delivered_carrier_ts",
    "order_delivered_customer_date": "delivered_customer_ts",
    "order_estimated_delivery_date": "estimated_delivery_ts",
}


def order_candidates(raw: DataFrame) -> DataFrame:
    """Raw rows with the keys they need, and their parsed load time beside the raw text."""
    kept = cleaning.not_null(cleaning.require(raw, "order_id", "customer_id"), "order_status")
    return kept.withColumn("purchase_ts", text.parse_timestamp("order_purchase_timestamp"))


def finish_orders(batch: DataFrame) -> DataFrame:
    featured = _parsed(batch, ORDER_STAMPS).withColumns(
        {
            **dates.calendar_parts("purchase_ts"),
            "delivery_days": dates.days_between("purchase_ts", "delivered_customer_ts"),
            "is_late": measures.is_late("delivered_customer_ts", "estimated_delivery_ts"),
        }
    )
    return cleaning.null_or_not_negative(featured, "delivery_days").select(
        "order_id",
        "customer_id",
        "order_status",
        *ORDER_STAMPS.values(),
        "year",
        "month",
        "quarter",
        "day",
        "delivery_days",
        "is_late",
    )


def orders(raw: DataFrame, mark: datetime) -> DataFrame:
    new = after_mark(order_candidates(raw), "purchase_ts", mark)
    return finish_orders(cleaning.drop_exact_copies(new))


def order_versions(raw: DataFrame, mark: datetime) -> DataFrame:
    """The rows of ``orders`` with exact copies left in, for what copies can't change, such as the set of days."""
    return finish_orders(after_mark(order_candidates(raw), "purchase_ts", mark))


# Reviews -----------------------------------------------------------------------------

REVIEW_STAMPS = {
    "review_creation_date": "review_creation_ts",
    "review_answer_timestamp": "review_answer_ts",
}


def review_candidates(raw: DataFrame) -> DataFrame:
    kept = cleaning.in_range(cleaning.require(raw, "review_id", "order_id"), "review_score", 1, 5)
    return kept.withColumn("review_creation_ts", text.parse_timestamp("review_creation_date"))


def finish_reviews(batch: DataFrame) -> DataFrame:
    return _parsed(batch, REVIEW_STAMPS).select(
        "review_id",
        "order_id",
        "review_score",
        "review_creation_ts",
        "review_answer_ts",
        "review_comment_title",
        "review_comment_message",
        measures.sentiment("review_score").alias("sentiment"),
        text.has_text("review_comment_message").alias("has_comment"),
    )


def reviews(raw: DataFrame, mark: datetime) -> DataFrame:
    new = after_mark(review_candidates(raw), "review_creation_ts", mark)
    return finish_reviews(cleaning.drop_exact_copies(new))


# Tables that are rebuilt in full -----------------------------------------------------


def order_items(raw: DataFrame) -> DataFrame:
    kept = cleaning.require(raw, "order_id", "product_id", "seller_id")
    kept = cleaning.not_negative(cleaning.positive(kept, "price"), "freight_value")
    single = cleaning.drop_exact_copies(kept)
    return _parsed(single, {"shipping_limit_date": "shipping_limit_ts"}).select(
        "order_id",
        "order_item_id",
        "product_id",
        "seller_id",
        "shipping_limit_ts",
        "price",
        "freight_value",
        measures.line_total("price", "freight_value").alias("total_item_value"),
        measures.freight_ratio("freight_value", "price").alias("shipping_ratio"),
    )


def payments(raw: DataFrame) -> DataFrame:
    kept = cleaning.positive(cleaning.require(raw, "order_id"), "payment_value")
    return cleaning.drop_exact_copies(kept).select(
        "order_id",
        "payment_sequential",
        text.trim_lower("payment_type").alias("payment_type"),
        "payment_installments",
        "payment_value",
        measures.above("payment_installments", 1).alias("is_installment"),
        measures.banded("payment_value", measures.PAYMENT_BANDS).alias("payment_bucket"),
    )


def customers(raw: DataFrame) -> DataFrame:
    kept = cleaning.require(raw, "customer_id", "customer_unique_id")
    return cleaning.drop_exact_copies(kept).select(
        "customer_id",
        "customer_unique_id",
        "customer_zip_code_prefix",
        text.trim_lower("customer_city").alias("customer_city"),
        text.trim_upper("customer_state").alias("customer_state"),
    )


def sellers(raw: DataFrame) -> DataFrame:
    return cleaning.drop_exact_copies(cleaning.require(raw, "seller_id")).select(
        "seller_id",
        "seller_zip_code_prefix",
        text.trim_lower("seller_city").alias("seller_city"),
        text.trim_upper("seller_state").alias("seller_state"),
    )


def products(raw: DataFrame) -> DataFrame:
    return cleaning.drop_exact_copies(cleaning.require(raw, "product_id")).select(
        "product_id",
        text.trim_lower("product_category_name").alias("product_category_name"),
        "product_name_lenght",
        "product_description_lenght",
        "product_photos_qty",
        "product_weight_g",
        measures.kilograms("product_weight_g").alias("weight_kg"),
        "product_length_cm",
        "product_height_cm",
        "product_width_cm",
        measures.volume("product_length_cm", "product_height_cm", "product_width_cm").alias(
            "product_volume_cm3"
        ),
    )


def geolocation(raw: DataFrame) -> DataFrame:
    """Mean position per zip, city and state. No dedupe: repeated points weigh more."""
    zip_code, city, state = (
        "geolocation_zip_code_prefix",
        "geolocation_city",
        "geolocation_state",
    )
    kept = cleaning.require(raw, zip_code, "geolocation_lat", "geolocation_lng").withColumns(
        {city: text.trim_lower(city), state: text.trim_upper(state)}
    )
    keys = [zip_code, city, state]
    return aggregates.centroid(kept, keys, "geolocation_lat", "geolocation_lng").withColumn(
        "location_key", text.location_key(zip_code, state)
    )


def category_translation(raw: DataFrame) -> DataFrame:
    names = ("product_category_name", "product_category_name_english")
    return cleaning.drop_exact_copies(cleaning.require(raw, *names)).select(
        *[text.trim_lower(name).alias(name) for name in names]
    )
