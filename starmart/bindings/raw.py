"""The given test tables seen as the nine raw marketplace tables.

Each column is an expression that Spark and DuckDB read alike, so one text serves the query and
its SQL check. The tables hold no dirt of their own; nulls, bad timestamps, padding,
repeated rows and values out of range are derived here from the data.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


@dataclass(frozen=True)
class RawTable:
    source: str
    columns: dict[str, str]
    loaded_twice: str | None = None  # rows that the raw table holds as exact copies
    # Rows that the raw table holds again with other text in some columns.
    held_again: tuple[str, dict[str, str]] | None = None


_STATE = (
    "case {0} when 0 then ' sp' when 1 then 'rj ' when 2 then 'MG' when 3 then 'es' "
    "when 4 then 'pr' when 5 then 'Rs' when 6 then ' SC ' else 'ba' end"
)


def cents(expression: str) -> str:
    """A double rounded to cents by the same arithmetic in both engines."""
    return f"floor({expression} * 100 + 0.5) / 100"


RAW = {
    "orders": RawTable(
        "orders",
        {
            "order_id": "o_orderkey",
            "customer_id": "o_custkey",
            "order_status": (
                "case when o_orderstatus = 'P' and o_orderpriority = '5-LOW' "
                "then null else o_orderstatus end"
            ),
            "order_purchase_timestamp": "cast(o_orderdate as string)",
            "order_approved_at": (
                "case when o_orderpriority = '1-URGENT' then 'n/a' "
                "else cast(o_orderdate as string) end"
            ),
            "order_delivered_carrier_date": (
                "case when o_orderstatus = 'O' then null "
                "else cast(cast(o_orderdate as date) + 2 as string) end"
            ),
            "order_delivered_customer_date": (
                "case when o_orderstatus = 'O' then null else cast(cast(o_orderdate as date) "
                "+ cast(floor(o_totalprice / 6000) as int) - 3 as string) end"
            ),
            "order_estimated_delivery_date": "cast(cast(o_orderdate as date) + 60 as string)",
        },
        loaded_twice="o_orderpriority = '1-URGENT'",
        held_again=("o_orderpriority = '1-URGENT'", {"order_approved_at": "'unknown'"}),
    ),
    "order_items": RawTable(
        "lineitem",
        {
            "order_id": "l_orderkey",
            "order_item_id": "l_linenumber",
            "product_id": "l_partkey",
            "seller_id": "nullif(l_suppkey, 3)",
            "shipping_limit_date": (
                "case when l_returnflag = 'R' then 'n/a' else cast(l_shipdate as string) end"
            ),
            "price": (
                "case when l_linenumber = 7 then cast(0 as double) "
                "when l_quantity = 50 then -l_extendedprice else l_extendedprice end"
            ),
            "freight_value": (
                "case when l_quantity = 49 then cast(-1 as double) "
                f"else {cents('l_extendedprice * l_tax')} end"
            ),
        },
        loaded_twice="l_returnflag = 'A'",
        held_again=("l_returnflag = 'R'", {"shipping_limit_date": "'unknown'"}),
    ),
    "payments": RawTable(
        "lineitem",
        {
            "order_id": "nullif(l_orderkey, 7)",
            "payment_sequential": "l_linenumber",
            "payment_type": "concat(' ', l_returnflag, '  ')",
            "payment_installments": "cast(l_quantity as int)",
            "payment_value": (
                "case when l_linenumber = 7 then cast(0 as double) "
                f"else {cents('l_extendedprice / 100')} end"
            ),
        },
        loaded_twice="l_returnflag = 'N'",
    ),
    "reviews": RawTable(
        "events",
        {
            "review_id": "nullif(event_id, 11)",
            # Several reviews per order, with different scores.
            "order_id": "user_id",
            "review_score": "cast(floor(value / 20) as int)",
            "review_comment_title": "event_type",
            "review_comment_message": (
                "case event_type when 'error' then null when 'view' then '   ' else props end"
            ),
            "review_creation_date": "cast(ts as string)",
            "review_answer_timestamp": (
                "case when event_type = 'view' then 'n/a' else cast(cast(ts as date) + 2 as string) end"
            ),
        },
        loaded_twice="event_type = 'click'",
        held_again=("event_type = 'view'", {"review_answer_timestamp": "'unknown'"}),
    ),
    "customers": RawTable(
        "customer",
        {
            "customer_id": "c_custkey",
            "customer_unique_id": "c_name",
            "customer_zip_code_prefix": "concat('0', cast(c_nationkey as string))",
            "customer_city": "concat('  ', c_mktsegment, ' ')",
            "customer_state": _STATE.format("c_nationkey"),
        },
        loaded_twice="c_acctbal < 0",
    ),
    "sellers": RawTable(
        "supplier",
        {
            "seller_id": "nullif(s_suppkey, 5)",
            "seller_zip_code_prefix": "concat('0', cast(s_nationkey as string))",
            "seller_city": "concat('  ', s_name, ' ')",
            "seller_state": _STATE.format("s_nationkey"),
        },
        loaded_twice="s_acctbal < 0",
    ),
    "products": RawTable(
        "part",
        {
            "product_id": "nullif(p_partkey, 9)",
            "product_category_name": (
                "concat('  ', p_type, case when p_brand = 'Brand#2' then ' other ' else ' ' end)"
            ),
            "product_name_lenght": "cast(length(p_name) as int)",
            "product_description_lenght": "p_size",
            "product_photos_qty": "nullif(p_size, 50)",
            "product_weight_g": "case when p_brand = 'Brand#1' then null else p_retailprice * p_size end",
            "product_length_cm": "cast(p_size as double)",
            "product_height_cm": "cast(nullif(p_size, 49) as double)",
            "product_width_cm": "cast(p_size as double)",
        },
        loaded_twice="p_size = 1",
    ),
    "geolocation": RawTable(
        "customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey",
        {
            "geolocation_zip_code_prefix": "concat('0', cast(c_nationkey as string))",
            # Quarters, so that the sums below the means are exact in any order.
            "geolocation_lat": "cast(floor(c_acctbal * 4) as double) / 4",
            "geolocation_lng": "cast(nullif(c_custkey, 13) as double) / 4",
            "geolocation_city": "concat(' ', n_name, c_mktsegment, '  ')",
            "geolocation_state": "case when r_name = 'AFRICA' then null else lower(r_name) end",
        },
    ),
    "category_translation": RawTable(
        "part",
        {
            "product_category_name": "concat(p_type, '  ')",
            "product_category_name_english": "concat(' Type ', p_type)",
        },
    ),
}


@cache
def _schema(spark: SparkSession, path: str) -> StructType:
    return spark.read.parquet(path).schema


def load(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """Scan a table; its schema is read from the file once per session."""
    path = f"{folder}/{table}.parquet"
    return spark.read.schema(_schema(spark, path)).parquet(path)


def _source(spark: SparkSession, folder: str, name: str) -> DataFrame:
    if " join " not in name:
        return load(spark, folder, name)
    nations = load(spark, folder, "nation").join(
        load(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    return load(spark, folder, "customer").join(
        nations, F.col("c_nationkey") == F.col("n_nationkey")
    )


def _selects(spec: RawTable) -> list[tuple[list[str], str | None]]:
    """The parts of a raw table: its select list and the condition of its rows."""

    def listed(columns: dict[str, str]) -> list[str]:
        return [f"{expression} as {column}" for column, expression in columns.items()]

    parts: list[tuple[list[str], str | None]] = [(listed(spec.columns), None)]
    if spec.loaded_twice:
        parts.append((listed(spec.columns), spec.loaded_twice))
    if spec.held_again:
        where, other = spec.held_again
        parts.append((listed(spec.columns | other), where))
    return parts


def raw_frame(spark: SparkSession, folder: str, name: str) -> DataFrame:
    spec = RAW[name]
    source = _source(spark, folder, spec.source)
    parts = [
        (source.where(where) if where else source).selectExpr(*select)
        for select, where in _selects(spec)
    ]
    return reduce(DataFrame.unionAll, parts)


def raw_sql(name: str) -> str:
    spec = RAW[name]
    return " union all ".join(
        f"select {', '.join(select)} from {spec.source}" + (f" where {where}" if where else "")
        for select, where in _selects(spec)
    )
