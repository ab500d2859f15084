"""Data quality metrics in long form."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.functions import text


@dataclass(frozen=True)
class QualitySpec:
    """Primary key and must-have columns of one table."""

    key: tuple[str, ...]
    critical: tuple[str, ...]

    @property
    def duplicate_metric(self) -> str:
        return "duplicate_" + "_".join(self.key)


# The nine raw tables.
SPECS = {
    "orders": QualitySpec(("order_id",), ("order_id", "customer_id", "order_status")),
    "customers": QualitySpec(("customer_id",), ("customer_id", "customer_unique_id")),
    "products": QualitySpec(("product_id",), ("product_id", "product_category_name")),
    "payments": QualitySpec(
        ("order_id", "payment_sequential"), ("order_id", "payment_type", "payment_value")
    ),
    "reviews": QualitySpec(("review_id",), ("review_id", "order_id", "review_score")),
    "sellers": QualitySpec(("seller_id",), ("seller_id", "seller_state")),
    "order_items": QualitySpec(
        ("order_id", "order_item_id"), ("order_id", "product_id", "seller_id")
    ),
    "geolocation": QualitySpec(
        ("geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng"),
        ("geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng"),
    ),
    "category_translation": QualitySpec(
        ("product_category_name",),
        ("product_category_name", "product_category_name_english"),
    ),
}


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def null_counts(df: DataFrame, names: list[str]) -> DataFrame:
    """One row, one pass, whatever the number of columns."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in names])


def duplicate_keys(df: DataFrame, key: list[str]) -> DataFrame:
    """Key groups seen more than once, with their size. Null keys form a group."""
    return df.groupBy(*key).count().filter(F.col("count") > 1)


def quality_row(df: DataFrame, spec: QualitySpec) -> DataFrame:
    """All metrics of a table as one row, from one scan and one shuffle of pre-aggregated keys."""
    nulls = [f"null_{c}" for c in spec.critical]
    groups = df.groupBy(*spec.key).agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in spec.critical],
    )
    return groups.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("row_count"),
        *[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in nulls],
        F.count_if(F.col("_rows") > 1).alias(spec.duplicate_metric),
    )


def _long(names: list[str]) -> Column:
    return F.inline(
        F.array(
            *[
                F.struct(F.lit(n).alias("metric_name"), F.col(n).alias("metric_value"))
                for n in names
            ]
        )
    )


def quality_report(df: DataFrame, spec: QualitySpec) -> DataFrame:
    """``metric_name, metric_value``: row_count, null_<column> …, duplicate_<key columns>."""
    row = quality_row(df, spec)
    return row.select(_long(row.columns))


def quality_report_all(
    tables: dict[str, DataFrame], specs: dict[str, QualitySpec] = SPECS
) -> DataFrame:
    """Reports of several tables with a leading ``table_name``."""
    parts = [
        quality_report(df, specs[name]).select(
            F.lit(name).alias("table_name"), "metric_name", "metric_value"
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionAll, parts)


def malformed_report(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """``metric_name, metric_value, example``: malformed_<column> of a table of text, with the least such text, from one pass.

    Missing and blank text is not malformed; null_<column> counts what is missing.
    """
    found = {name: text.malformed(name, kind) for name, kind in types.items()}
    row = df.agg(
        *[F.count_if(bad).alias(f"n_{name}") for name, bad in found.items()],
        *[F.min(F.when(bad, F.col(name))).alias(f"e_{name}") for name, bad in found.items()],
    )
    metrics = [
        F.struct(F.lit(f"malformed_{n}").alias("metric_name"), F.col(f"n_{n}").alias("metric_value"), F.col(f"e_{n}").alias("example")) for n in types
    ]
    return row.select(F.inline(F.array(*metrics)))


@dataclass(frozen=True)
class ForeignKey:
    """A column of one table whose values are to be found in a column of another."""

    table: str
    column: str
    parent: str
    parent_column: str


# What the star joins on.
FOREIGN_KEYS = (
    ForeignKey("orders", "customer_id", "customers", "customer_id"),
    ForeignKey("order_items", "order_id", "orders", "order_id"),
    ForeignKey("order_items", "product_id", "products", "product_id"),
    ForeignKey("order_items", "seller_id", "sellers", "seller_id"),
    ForeignKey("payments", "order_id", "orders", "order_id"),
    ForeignKey("reviews", "order_id", "orders", "order_id"),
    ForeignKey("products", "product_category_name", "category_translation", "product_category_name"),
)


def orphans(child: DataFrame, parent: DataFrame, fk: ForeignKey) -> DataFrame:
    """Rows whose key the parent doesn't have. A missing key is no orphan."""
    known = parent.select(F.col(fk.parent_column).alias("_known"))
    return child.where(F.col(fk.column).isNotNull()).join(known, F.col(fk.column) == F.col("_known"), "left_anti")


def matched(child: DataFrame, parent: DataFrame, fk: ForeignKey) -> DataFrame:
    """Rows whose key the parent has, each once however often it has it."""
    known = parent.select(F.col(fk.parent_column).alias("_known"))
    return child.join(known, F.col(fk.column) == F.col("_known"), "left_semi")


def orphan_report(child: DataFrame, parent: DataFrame, fk: ForeignKey) -> DataFrame:
    """table_name, key_name, parent_name, n_rows, null_rows, matched_rows, orphan_rows, orphan_keys, joined_rows: one row.

    ``joined_rows`` is what a left join gives: more than ``n_rows`` where the parent repeats a key. Both sides shrink to one row
    per key before they meet, so a hot key is a number.
    """
    mine = child.groupBy(F.col(fk.column).alias("_key")).agg(F.count(F.lit(1)).alias("_rows"))
    theirs = parent.where(F.col(fk.parent_column).isNotNull()).groupBy(F.col(fk.parent_column).alias("_of")).agg(F.count(F.lit(1)).alias("_copies"))
    met = mine.join(theirs, F.col("_key") == F.col("_of"), "left")
    lost = F.col("_key").isNotNull() & F.col("_copies").isNull()

    def rows(where: Column) -> Column:
        return F.coalesce(F.sum(F.when(where, F.col("_rows"))), F.lit(0))

    return met.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("n_rows"),
        rows(F.col("_key").isNull()).alias("null_rows"),
        rows(F.col("_copies").isNotNull()).alias("matched_rows"),
        rows(lost).alias("orphan_rows"),
        F.count_if(lost).alias("orphan_keys"),
        F.coalesce(F.sum(F.col("_rows") * F.coalesce("_copies", F.lit(1))), F.lit(0)).alias("joined_rows"),
    ).select(F.lit(fk.table).alias("table_name"), F.lit(fk.column).alias("key_name"), F.lit(fk.parent).alias("parent_name"), "*")


def orphan_report_all(tables: dict[str, DataFrame], keys: tuple[ForeignKey, ...] = FOREIGN_KEYS) -> DataFrame:
    return reduce(DataFrame.unionAll, [orphan_report(tables[fk.table], tables[fk.parent], fk) for fk in keys])


def repeated_keys(df: DataFrame, key: list[str], table: str) -> DataFrame:
    """table_name, key_name, n_keys, repeated_keys, most_rows, extra_rows of the right side of a join: one row. Rows without a key match nothing."""
    for name in key:
        df = df.where(F.col(name).isNotNull())
    groups = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_rows"))
    return groups.agg(
        F.count(F.lit(1)).alias("n_keys"),
        F.count_if(F.col("_rows") > 1).alias("repeated_keys"),
        F.coalesce(F.max("_rows"), F.lit(0)).alias("most_rows"),
        F.coalesce(F.sum(F.col("_rows") - 1), F.lit(0)).alias("extra_rows"),
    ).select(F.lit(table).alias("table_name"), F.lit("_".join(key)).alias("key_name"), "*")


# Right sides of the star's joins, and the location key, which leaves the city out.
UNIQUE_KEYS = {
    "customers": ["customer_id"],
    "products": ["product_id"],
    "sellers": ["seller_id"],
    "orders": ["order_id"],
    "category_translation": ["product_category_name"],
    "geolocation": ["location_key"],
}


def repeated_keys_all(tables: dict[str, DataFrame], keys: dict[str, list[str]] = UNIQUE_KEYS) -> DataFrame:
    return reduce(DataFrame.unionAll, [repeated_keys(tables[name], key, name) for name, key in keys.items()])
