"""Column types of the raw files and of the small control tables."""

from __future__ import annotations

from pyspark.sql import types as T

# Raw columns in file order. Timestamps stay text until they are parsed;
# zip codes stay text so that leading zeros survive. The misspelt names are in the data.
RAW_COLUMNS = {
    "orders": {
        "order_id": "string",
        "customer_id": "string",
        "order_status": "string",
        "order_purchase_timestamp": "string",
        "order_approved_at": "string",
        "order_delivered_carrier_date": "string",
        "order_delivered_customer_date": "string",
        "order_estimated_delivery_date": "string",
    },
    "order_items": {
        "order_id": "string",
        "order_item_id": "int",
        "product_id": "string",
        "seller_id": "string",
        "shipping_limit_date": "string",
        "price": "double",
        "freight_value": "double",
    },
    "payments": {
        "order_id": "string",
        "payment_sequential": "int",
        "payment_type": "string",
        "payment_installments": "int",
        "payment_value": "double",
    },
    "reviews": {
        "review_id": "string",
        "order_id": "string",
        "review_score": "int",
        "review_comment_title": "string",
        "review_comment_message": "string",
        "review_creation_date": "string",
        "review_answer_timestamp": "string",
    },
    "customers": {
        "customer_id": "string",
        "customer_unique_id": "string",
        "customer_zip_code_prefix": "string",
        "customer_city": "string",
        "customer_state": "string",
    },
    "sellers": {
        "seller_id": "string",
        "seller_zip_code_prefix": "string",
        "seller_city": "string",
        "seller_state": "string",
    },
    "products": {
        "product_id": "string",
        "product_category_name": "string",
        "product_name_lenght": "int",
        "product_description_lenght": "int",
        "product_photos_qty": "int",
        "product_weight_g": "double",
        "product_length_cm": "double",
        "product_height_cm": "double",
        "product_width_cm": "double",
    },
    "geolocation": {
        "geolocation_zip_code_prefix": "string",
        "geolocation_lat": "double",
        "geolocation_lng": "double",
        "geolocation_city": "string",
        "geolocation_state": "string",
    },
    "category_translation": {
        "product_category_name": "string",
        "product_category_name_english": "string",
    },
}

# Text columns of the raw files that hold times.
TIMES = {
    "orders": {
        "order_purchase_timestamp": "timestamp",
        "order_approved_at": "timestamp",
        "order_delivered_carrier_date": "timestamp",
        "order_delivered_customer_date": "timestamp",
        "order_estimated_delivery_date": "timestamp",
    },
    "order_items": {"shipping_limit_date": "timestamp"},
    "reviews": {"review_creation_date": "timestamp", "review_answer_timestamp": "timestamp"},
}

# Tables whose free text may hold line breaks inside quotes.
FREE_TEXT_TABLES = ("reviews",)

CONTROL = T.StructType(
    [
        T.StructField("table_name", T.StringType(), False),
        T.StructField("last_processed_ts", T.TimestampType(), True),
    ]
)
