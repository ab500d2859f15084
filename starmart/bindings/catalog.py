"""One query per operator and job, on the given test tables.

Every query reads whole tables; what a load mark or a range filter leaves out, the query is about. Timestamps leave as ``timestamp_ntz`` so that the
session's time zone plays no part in the comparison.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.bindings import extended
from starmart.bindings.raw import load, raw_frame
from starmart.functions import dates, measures, text
from starmart.operators import aggregates, cleaning, joins, quality
from starmart.operators.keys import numbered
from starmart.operators.synth import mock_orders
from starmart.plans import gold, silver
from starmart.session import run_together, scratch_path
from starmart.sources import readers, writers
from starmart.streaming import marks
from starmart.streaming.incremental import LoadResult, load_increment

Query = Callable[[SparkSession, str], DataFrame]

ORDERS_MARK = datetime(1998, 1, 1)
FUTURE_MARK = datetime(2100, 1, 1)

QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return _plain_timestamps(build(spark, folder))

    QUERIES[build.__name__] = run
    return build


def _plain_timestamps(df: DataFrame) -> DataFrame:
    return df.select(
        *[
            F.col(f.name).cast("timestamp_ntz").alias(f.name)
            if isinstance(f.dataType, T.TimestampType)
            else F.col(f.name)
            for f in df.schema
        ]
    )


# Sources and sinks -------------------------------------------------------------------


@query
def src_csv_roundtrip(spark, folder):
    documents = load(spark, folder, "documents")
    path = scratch_path(spark, "documents_csv")
    writers.write_csv(documents, path)
    types = {f.name: f.dataType.simpleString() for f in documents.schema}
    return readers.read_csv(spark, path, types, multi_line=True)


@query
def synth_orders(spark, folder):
    return mock_orders(load(spark, folder, "orders").select(F.col("o_orderkey").alias("id")))


@query
def sink_parquet_overwrite(spark, folder):
    path = scratch_path(spark, "overwrite")
    orders = load(spark, folder, "orders")
    for _ in range(2):
        writers.overwrite_parquet(orders, path)
    return readers.read_parquet(spark, path)


@query
def sink_partitioned_append(spark, folder):
    path = scratch_path(spark, "partitioned")
    at = F.col("o_orderdate")
    orders = load(spark, folder, "orders").withColumns(
        {"year": F.year(at), "month": F.month(at)}
    )
    first = F.coalesce(F.year(at) < 1998, F.lit(False))
    for part in (orders.filter(first), orders.filter(~first)):
        writers.append_partitioned(part, path, "year", "month")
    return readers.read_parquet(spark, path)


@query
def sink_append(spark, folder):
    path = scratch_path(spark, "append")
    events = load(spark, folder, "events")
    for _ in range(2):
        writers.append_parquet(events, path)
    return readers.read_parquet(spark, path)


@query
def sink_csv_report(spark, folder):
    path = scratch_path(spark, "report")
    writers.write_csv_report(aggregates.monthly_revenue(_order_months(spark, folder)), path)
    return readers.read_csv(spark, path, {"year": "int", "month": "int", "revenue": "double"})


@query
def obs_row_counts(spark, folder):
    """Counts taken while the cleaned tables are computed, before and after the load filter."""
    batch, before = writers.observed(
        cleaning.drop_exact_copies(silver.order_candidates(raw_frame(spark, folder, "orders"))),
        "orders_before",
    )
    new = marks.after_mark(batch, "purchase_ts", ORDERS_MARK)
    rows, after = writers.observed(silver.finish_orders(new), "orders_after")
    rows.write.format("noop").mode("overwrite").save()
    counts = [("orders_before", before.get["rows"]), ("orders_after", after.get["rows"])]
    return spark.createDataFrame(counts, "step string, rows long")


@query
def top_n_preview(spark, folder):
    return aggregates.first_rows(load(spark, folder, "orders"), ["o_orderkey"], 5)


# Filters and cleaning ----------------------------------------------------------------


@query
def clean_exact_distinct(spark, folder):
    lines = load(spark, folder, "lineitem")
    again = lines.filter(F.col("l_returnflag") == "R")
    return cleaning.drop_exact_copies(lines.unionAll(again))


def _orders_with_nulls(spark, folder):
    return load(spark, folder, "orders").selectExpr(
        "o_orderkey",
        "nullif(o_orderstatus, 'P') as status",
        "nullif(o_orderpriority, '5-LOW') as priority",
    )


@query
def clean_required_keys(spark, folder):
    return cleaning.require(_orders_with_nulls(spark, folder), "status", "priority")


@query
def clean_not_null(spark, folder):
    return cleaning.not_null(_orders_with_nulls(spark, folder), "status")


@query
def clean_positive(spark, folder):
    lines = load(spark, folder, "lineitem").selectExpr(
        "l_orderkey",
        "l_linenumber",
        "l_quantity - 10 as price",
        "nullif(l_discount, 0.1) - 0.05 as freight",
    )
    return cleaning.not_negative(cleaning.positive(lines, "price"), "freight")


@query
def clean_between(spark, folder):
    scores = load(spark, folder, "events").selectExpr(
        "event_id",
        "case event_type when 'error' then null else cast(floor(value / 20) as int) end as score",
    )
    return cleaning.in_range(scores, "score", 1, 5)


@query
def clean_null_or_nonneg(spark, folder):
    days = load(spark, folder, "orders").selectExpr(
        "o_orderkey",
        "case o_orderstatus when 'O' then null "
        "else cast(floor(o_totalprice / 6000) as int) - 30 end as delivery_days",
    )
    return cleaning.null_or_not_negative(days, "delivery_days")


# Standardization ---------------------------------------------------------------------


@query
def std_trim_lower(spark, folder):
    names = load(spark, folder, "part").selectExpr(
        "p_partkey", "concat('  ', upper(p_name), ' ') as name"
    )
    return names.select("p_partkey", text.trim_lower("name").alias("name"))


@query
def std_trim_upper(spark, folder):
    segments = load(spark, folder, "customer").selectExpr(
        "c_custkey", "concat(' ', lower(c_mktsegment), '  ') as segment"
    )
    return segments.select("c_custkey", text.trim_upper("segment").alias("segment"))


@query
def std_parse_ts(spark, folder):
    stamps = load(spark, folder, "orders").selectExpr(
        "o_orderkey",
        "case o_orderpriority when '5-LOW' then 'n/a' else cast(o_orderdate as string) end as stamp",
    )
    return stamps.select("o_orderkey", text.parse_timestamp("stamp").alias("purchase_ts"))


@query
def feat_location_key(spark, folder):
    places = load(spark, folder, "customer").selectExpr(
        "c_custkey",
        "concat('0', cast(c_nationkey as string)) as zip",
        "nullif(c_mktsegment, 'MACHINERY') as state",
    )
    return places.select("c_custkey", text.location_key("zip", "state").alias("location_key"))


@query
def feat_has_comment(spark, folder):
    comments = load(spark, folder, "conversations").selectExpr(
        "conv_id", "turn", "case turn when 0 then '   ' when 1 then null else text end as message"
    )
    return comments.select("conv_id", "turn", text.has_text("message").alias("has_comment"))


# Features ----------------------------------------------------------------------------


@query
def feat_calendar_parts(spark, folder):
    parts = dates.calendar_parts("o_orderdate")
    return load(spark, folder, "orders").select(
        "o_orderkey", *[column.alias(name) for name, column in parts.items()]
    )


def _deliveries(spark, folder):
    """Orders with the last ship date of their lines; null where there is no line."""
    shipped = (
        load(spark, folder, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.max("l_shipdate").alias("delivered_ts"))
    )
    orders = load(spark, folder, "orders").selectExpr(
        "o_orderkey",
        "o_orderdate as purchase_ts",
        "o_orderdate + interval '60' day as estimated_ts",
    )
    return joins.left_join(orders, shipped, "o_orderkey")


@query
def feat_delivery_days(spark, folder):
    return _deliveries(spark, folder).select(
        "o_orderkey", dates.days_between("purchase_ts", "delivered_ts").alias("delivery_days")
    )


@query
def feat_is_late(spark, folder):
    return _deliveries(spark, folder).select(
        "o_orderkey", measures.is_late("delivered_ts", "estimated_ts").alias("is_late")
    )


@query
def feat_total_value(spark, folder):
    items = raw_frame(spark, folder, "order_items")
    total = measures.line_total("price", "freight_value")
    return items.select("order_id", "order_item_id", "price", total.alias("total_item_value"))


@query
def feat_ratio(spark, folder):
    items = load(spark, folder, "lineitem")
    ratio = measures.freight_ratio("l_tax", "l_extendedprice")
    return items.select("l_orderkey", "l_linenumber", ratio.alias("shipping_ratio"))


@query
def feat_threshold_flag(spark, folder):
    payments = raw_frame(spark, folder, "payments")
    flag = measures.above("payment_installments", 1)
    return payments.select("order_id", "payment_sequential", flag.alias("is_installment"))


@query
def feat_value_bucket(spark, folder):
    payments = raw_frame(spark, folder, "payments")
    bucket = measures.banded("payment_value", measures.PAYMENT_BANDS)
    return payments.select("order_id", "payment_sequential", bucket.alias("payment_bucket"))


@query
def feat_weight_kg(spark, folder):
    return raw_frame(spark, folder, "products").select(
        "product_id", measures.kilograms("product_weight_g").alias("weight_kg")
    )


@query
def feat_volume(spark, folder):
    sides = measures.volume("product_length_cm", "product_height_cm", "product_width_cm")
    return raw_frame(spark, folder, "products").select(
        "product_id", sides.alias("product_volume_cm3")
    )


@query
def feat_weight_class(spark, folder):
    weights = raw_frame(spark, folder, "products").selectExpr(
        "product_id", "product_weight_g / 1000 as weight_kg"
    )
    label = measures.banded("weight_kg", measures.WEIGHT_BANDS)
    return weights.select("product_id", label.alias("weight_category"))


@query
def feat_size_class(spark, folder):
    sides = measures.volume("product_length_cm", "product_height_cm", "product_width_cm")
    sized = raw_frame(spark, folder, "products").select("product_id", sides.alias("volume"))
    label = measures.banded("volume", measures.SIZE_BANDS)
    return sized.select("product_id", label.alias("product_size_category"))


@query
def feat_sentiment(spark, folder):
    scored = raw_frame(spark, folder, "reviews")
    return scored.select("review_id", measures.sentiment("review_score").alias("sentiment"))


@query
def feat_region(spark, folder):
    customers = raw_frame(spark, folder, "customers").select(
        "customer_id", text.trim_upper("customer_state").alias("state")
    )
    return customers.select("customer_id", measures.region("state").alias("customer_region"))


@query
def feat_date_key(spark, folder):
    return load(spark, folder, "orders").select(
        "o_orderkey", dates.date_key("o_orderdate").alias("date_key")
    )


@query
def feat_date_names(spark, folder):
    return load(spark, folder, "orders").select(
        "o_orderkey",
        dates.month_name("o_orderdate").alias("month_name"),
        dates.weekday_name("o_orderdate").alias("day_of_week"),
    )


@query
def feat_weekend(spark, folder):
    return load(spark, folder, "orders").select(
        "o_orderkey", dates.is_weekend("o_orderdate").alias("is_weekend")
    )


@query
def key_surrogate(spark, folder):
    customers = load(spark, folder, "customer").select("c_name", "c_custkey")
    return numbered(customers, "customer_key", ["c_name"])


# Aggregates --------------------------------------------------------------------------


@query
def agg_geo_centroid(spark, folder):
    points = load(spark, folder, "supplier").selectExpr(
        "s_nationkey", "cast(floor(s_acctbal) as double) as lat", "cast(s_suppkey as double) as lng"
    )
    return aggregates.centroid(points, ["s_nationkey"], "lat", "lng")


@query
def agg_payments_by_order(spark, folder):
    return aggregates.amount_by(
        raw_frame(spark, folder, "payments"), "order_id", "payment_value"
    )


@query
def agg_score_by_order(spark, folder):
    return aggregates.average_by(raw_frame(spark, folder, "reviews"), "order_id", "review_score")


def _order_months(spark, folder):
    at = F.col("o_orderdate")
    return load(spark, folder, "orders").select(
        F.year(at).alias("year"), F.month(at).alias("month"), F.col("o_totalprice").alias("price")
    )


@query
def agg_monthly_revenue(spark, folder):
    return aggregates.monthly_revenue(_order_months(spark, folder))


# Joins -------------------------------------------------------------------------------


@query
def join_category(spark, folder):
    products = silver.products(raw_frame(spark, folder, "products"))
    category = silver.category_translation(raw_frame(spark, folder, "category_translation"))
    return joins.left_join(products, category, "product_category_name").select(
        "product_id", "product_category_name", "product_category_name_english"
    )


def _lines(spark, folder):
    """Order lines; those with the flag A are orphans: their keys are negated and match nothing."""
    sign = "(case when l_returnflag = 'A' then -1 else 1 end)"
    return load(spark, folder, "lineitem").selectExpr(
        f"l_orderkey * {sign} as order_id",
        "l_linenumber as order_item_id",
        f"l_partkey * {sign} as product_id",
        f"l_suppkey * {sign} as seller_id",
        "l_extendedprice as price",
    )


def _all_orders(spark, folder):
    return load(spark, folder, "orders").selectExpr(
        "o_orderkey as order_id", "o_custkey as customer_id", "o_orderdate as purchase_ts"
    )


@query
def join_items_orders(spark, folder):
    return joins.left_join(_lines(spark, folder), _all_orders(spark, folder), "order_id")


@query
def join_payments(spark, folder):
    paid = load(spark, folder, "lineitem")
    paid = paid.selectExpr("l_orderkey as order_id", "l_extendedprice as payment_value")
    paid = aggregates.amount_by(paid, "order_id", "payment_value")
    return joins.left_join(_lines(spark, folder), paid, "order_id")


@query
def join_reviews(spark, folder):
    scores = aggregates.average_by(
        raw_frame(spark, folder, "reviews"), "order_id", "review_score"
    )
    return joins.left_join(_lines(spark, folder), scores, "order_id")


@query
def join_dim_customer(spark, folder):
    known = load(spark, folder, "customer").selectExpr("c_custkey as customer_id")
    dim = numbered(known, "customer_key", ["customer_id"])
    orders = load(spark, folder, "orders").selectExpr(
        "o_orderkey as order_id",
        "o_custkey * (case when o_orderstatus = 'P' then -1 else 1 end) as customer_id",
    )
    return joins.left_join(orders, dim, "customer_id")


@query
def join_dim_product(spark, folder):
    known = load(spark, folder, "part").selectExpr("p_partkey as product_id")
    dim = numbered(known, "product_key", ["product_id"])
    return joins.left_join(_lines(spark, folder), dim, "product_id")


@query
def join_dim_seller(spark, folder):
    known = load(spark, folder, "supplier").selectExpr("s_suppkey as seller_id")
    dim = numbered(known, "seller_key", ["seller_id"])
    return joins.left_join(_lines(spark, folder), dim, "seller_id")


@query
def join_dim_date(spark, folder):
    """Orders with the status P have no purchase time here, and so no date key."""
    days = gold.dim_date(_all_orders(spark, folder)).select("full_date", "date_key")
    orders = load(spark, folder, "orders").selectExpr(
        "o_orderkey as order_id", "case when o_orderstatus <> 'P' then o_orderdate end as purchase_ts"
    )
    orders = orders.select("order_id", dates.calendar_day("purchase_ts").alias("full_date"))
    return joins.left_join(orders, days, "full_date")


# Incremental load and control --------------------------------------------------------


@query
def inc_hwm_filter(spark, folder):
    return marks.after_mark(load(spark, folder, "orders"), "o_orderdate", ORDERS_MARK)


def _load_orders_from(spark, folder, mark: datetime) -> tuple[LoadResult, str]:
    control = scratch_path(spark, "control")
    marks.init_marks(spark, control)
    marks.set_mark(spark, control, "orders", mark)
    result = load_increment(
        spark,
        silver.order_candidates(raw_frame(spark, folder, "orders")),
        silver.finish_orders,
        table="orders",
        key="order_id",
        ts="purchase_ts",
        control_path=control,
        target_path=scratch_path(spark, "orders"),
        partition_by=("year", "month"),
    )
    return result, control


@query
def inc_new_hwm(spark, folder):
    result, control = _load_orders_from(spark, folder, ORDERS_MARK)
    return marks.read_marks(spark, control).withColumn("rows_loaded", F.lit(result.rows).cast("long"))


@query
def inc_empty_batch(spark, folder):
    result, control = _load_orders_from(spark, folder, FUTURE_MARK)
    return marks.read_marks(spark, control).withColumn("rows_loaded", F.lit(result.rows).cast("long"))


@query
def ctl_init(spark, folder):
    """Fresh marks, with the number of rows each source table has after its mark."""
    control = scratch_path(spark, "control")
    marks.init_marks(spark, control)
    sources = {
        "orders": ("orders", "o_orderdate"),
        "reviews": ("events", "ts"),
        "order_items": ("lineitem", "l_shipdate"),
    }
    pending = None
    for table, (source, ts) in sources.items():
        mark = marks.get_mark(spark, control, table)
        new = quality.row_count(marks.after_mark(load(spark, folder, source), ts, mark))
        new = new.select(F.lit(table).alias("table_name"), F.col("row_count").alias("pending_rows"))
        pending = new if pending is None else pending.unionAll(new)
    return joins.left_join(marks.read_marks(spark, control), pending, "table_name")


def _newest(spark, folder, table: str, ts: str) -> datetime:
    """The latest timestamp: one value, whatever the table size."""
    newest = aggregates.latest(load(spark, folder, table), ts, "newest")
    return newest.select(marks.wall_clock(F.col("newest"))).first()[0]


@query
def ctl_set_mark(spark, folder):
    control = scratch_path(spark, "control")
    marks.init_marks(spark, control)
    newest = _newest(spark, folder, "orders", "o_orderdate")
    for mark in (FUTURE_MARK, newest):
        marks.set_mark(spark, control, "orders", mark)
    return marks.read_marks(spark, control)


@query
def ctl_lookup(spark, folder):
    control = scratch_path(spark, "control")
    marks.init_marks(spark, control)
    marks.set_mark(spark, control, "reviews", _newest(spark, folder, "events", "ts"))
    return marks.mark_of(marks.read_marks(spark, control), "reviews")


@query
def ctl_update_mark(spark, folder):
    control = scratch_path(spark, "control")
    marks.init_marks(spark, control)
    marks.set_mark(spark, control, "orders", _newest(spark, folder, "orders", "o_orderdate"))
    marks.set_mark(spark, control, "reviews", _newest(spark, folder, "events", "ts"))
    return marks.read_marks(spark, control)


# Data quality ------------------------------------------------------------------------


@query
def dq_row_count(spark, folder):
    return quality.row_count(load(spark, folder, "lineitem"))


@query
def dq_null_counts(spark, folder):
    return quality.null_counts(
        _orders_with_nulls(spark, folder), ["o_orderkey", "status", "priority"]
    )


@query
def dq_duplicate_keys(spark, folder):
    return quality.duplicate_keys(
        load(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"]
    )


@query
def dq_report(spark, folder):
    return quality.quality_report(raw_frame(spark, folder, "orders"), quality.SPECS["orders"])


@query
def dq_report_all(spark, folder):
    tables = {name: raw_frame(spark, folder, name) for name in quality.SPECS}
    return quality.quality_report_all(tables)


# Jobs --------------------------------------------------------------------------------


def _silver_orders(spark, folder):
    """All orders: only the load has a mark, the star reads the whole cleaned table."""
    return silver.orders(raw_frame(spark, folder, "orders"), marks.START)


def _silver_reviews(spark, folder):
    return silver.reviews(raw_frame(spark, folder, "reviews"), marks.START)


@query
def silver_orders(spark, folder):
    return silver.orders(raw_frame(spark, folder, "orders"), ORDERS_MARK)


@query
def silver_reviews(spark, folder):
    return _silver_reviews(spark, folder)


@query
def silver_order_items(spark, folder):
    return silver.order_items(raw_frame(spark, folder, "order_items"))


@query
def silver_payments(spark, folder):
    return silver.payments(raw_frame(spark, folder, "payments"))


@query
def silver_customers(spark, folder):
    return silver.customers(raw_frame(spark, folder, "customers"))


@query
def silver_sellers(spark, folder):
    return silver.sellers(raw_frame(spark, folder, "sellers"))


@query
def silver_products(spark, folder):
    return silver.products(raw_frame(spark, folder, "products"))


@query
def silver_geolocation(spark, folder):
    return silver.geolocation(raw_frame(spark, folder, "geolocation"))


@query
def silver_category(spark, folder):
    return silver.category_translation(raw_frame(spark, folder, "category_translation"))


@query
def dim_customer(spark, folder):
    return gold.dim_customer(silver.customers(raw_frame(spark, folder, "customers")))


@query
def dim_product(spark, folder):
    return gold.dim_product(
        silver.products(raw_frame(spark, folder, "products")),
        silver.category_translation(raw_frame(spark, folder, "category_translation")),
    )


@query
def dim_seller(spark, folder):
    return gold.dim_seller(silver.sellers(raw_frame(spark, folder, "sellers")))


@query
def dim_date(spark, folder):
    return gold.dim_date(silver.order_versions(raw_frame(spark, folder, "orders"), marks.START))


@query
def dim_location(spark, folder):
    return gold.dim_location(silver.geolocation(raw_frame(spark, folder, "geolocation")))


@query
def fact_sales(spark, folder):
    """The dimensions are written first, as the job does, so that the fact scans each table once."""
    orders = _silver_orders(spark, folder)

    def written(build) -> DataFrame:
        df, path = build(spark, folder), scratch_path(spark, build.__name__)
        writers.overwrite_parquet(df, path)
        return readers.read_parquet(spark, path, df.schema)

    by_customer, by_product, by_seller, by_day = run_together(
        *[partial(written, build) for build in (dim_customer, dim_product, dim_seller, dim_date)]
    )
    return gold.fact_sales(
        silver.order_items(raw_frame(spark, folder, "order_items")),
        orders,
        silver.payments(raw_frame(spark, folder, "payments")),
        _silver_reviews(spark, folder),
        by_customer,
        by_product,
        by_seller,
        by_day,
    )


extended.register_all()
for _build in extended.EXTENDED.values():
    query(_build)
