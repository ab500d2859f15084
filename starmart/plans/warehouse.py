"""Jobs from folder to folder: raw CSV, cleaned Parquet, star schema, reports, exports."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import timedelta
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.operators import keys
from starmart.operators.aggregates import latest, monthly_revenue
from starmart.operators.quality import SPECS, malformed_report, orphan_report_all, quality_report_all, repeated_keys_all
from starmart.operators.synth import mock_orders
from starmart.plans import gold, silver
from starmart.session import run_together
from starmart.sources import readers, schemas, writers
from starmart.streaming import marks
from starmart.streaming.incremental import LoadResult, load_increment
from starmart.streaming.merge import merge_snapshot

# Tables of the star in export order.
STAR = ("dim_customer", "dim_product", "dim_seller", "dim_date", "dim_location", "fact_sales")

REBUILT = {
    "order_items": silver.order_items,
    "payments": silver.payments,
    "customers": silver.customers,
    "sellers": silver.sellers,
    "products": silver.products,
    "geolocation": silver.geolocation,
    "category_translation": silver.category_translation,
}


@dataclass(frozen=True)
class Warehouse:
    """Folders of one warehouse: CSV files (or folders of them) under ``raw``, all else under ``root``.

    ``raw_names`` gives the names of raw files that are not simply ``<table>.csv``.
    """

    spark: SparkSession
    raw: str
    root: str
    raw_names: dict[str, str] = field(default_factory=dict)
    infer_types: bool = False
    multi_line_tables: tuple[str, ...] = schemas.FREE_TEXT_TABLES

    # Paths

    def silver_path(self, table: str) -> str:
        return f"{self.root}/processed/{table}"

    def gold_path(self, table: str) -> str:
        return f"{self.root}/gold/{table}"

    @property
    def control_path(self) -> str:
        return f"{self.root}/metadata/etl_control"

    @property
    def quality_path(self) -> str:
        return f"{self.root}/quality"

    # Tables

    def read_raw(self, table: str) -> DataFrame:
        return readers.read_csv(
            self.spark,
            f"{self.raw}/{self.raw_names.get(table, table + '.csv')}",
            schemas.RAW_COLUMNS[table],
            multi_line=table in self.multi_line_tables,
            infer=self.infer_types,
        )

    def read_silver(self, table: str) -> DataFrame:
        return readers.read_parquet(self.spark, self.silver_path(table))

    def read_gold(self, table: str) -> DataFrame:
        return readers.read_parquet(self.spark, self.gold_path(table))

    # Control

    def init_control(self, keep: bool = False) -> None:
        marks.init_marks(self.spark, self.control_path, keep=keep)

    # Cleaned tables

    def load_orders(self, lookback: timedelta = timedelta(0)) -> LoadResult:
        return load_increment(
            self.spark,
            silver.order_candidates(self.read_raw("orders")),
            silver.finish_orders,
            table="orders",
            key="order_id",
            ts="purchase_ts",
            control_path=self.control_path,
            target_path=self.silver_path("orders"),
            partition_by=("year", "month"),
            lookback=lookback,
        )

    def load_reviews(self, lookback: timedelta = timedelta(0)) -> LoadResult:
        return load_increment(
            self.spark,
            silver.review_candidates(self.read_raw("reviews")),
            silver.finish_reviews,
            table="reviews",
            key=("review_id", "order_id"),
            ts="review_creation_ts",
            control_path=self.control_path,
            target_path=self.silver_path("reviews"),
            lookback=lookback,
        )

    def merge_orders(self, delete_missing: bool = False) -> dict[str, int]:
        """Bring loaded orders to the state of the raw file: rows that changed after their first load, too.

        Orders that the raw file doesn't hold stay, unless ``delete_missing`` says that it is complete. The mark stays.
        """
        return merge_snapshot(
            self.spark,
            silver.orders(self.read_raw("orders"), marks.START),
            key=["order_id"],
            target_path=self.silver_path("orders"),
            partition_by=("year", "month"),
            delete_missing=delete_missing,
        )

    def rebuild_silver(self, table: str) -> int:
        rows, taken = writers.observed(REBUILT[table](self.read_raw(table)), f"silver_{table}")
        writers.overwrite_parquet(rows, self.silver_path(table))
        return writers.logged(table, rows, taken.get["rows"])

    # Star schema

    def key_path(self, table: str) -> str:
        return f"{self.root}/metadata/keys/{table}"

    def _keyed(self, rows: DataFrame, table: str) -> DataFrame:
        """The rows with their surrogate keys. Keys once given stay; new business keys are numbered behind the highest."""
        key, business = gold.KEYS[table]
        path, shape = self.key_path(table), keys.numbered(keys.occurrences(rows, business), key, business)
        writers.create_if_missing(shape, path)
        known = readers.read_parquet(self.spark, path, shape.schema)
        highest = latest(known, key, "highest").first()[0]
        writers.append_parquet(keys.new_keys(rows, key, business, known, highest), path)
        return keys.with_keys(rows, key, business, readers.read_parquet(self.spark, path, shape.schema))

    def build_dimension(self, table: str) -> int:
        if table == "dim_customer":
            df = self._keyed(gold.customer_rows(self.read_silver("customers")), table)
        elif table == "dim_product":
            rows = gold.product_rows(
                self.read_silver("products"), self.read_silver("category_translation")
            )
            df = self._keyed(rows, table)
        elif table == "dim_seller":
            df = self._keyed(gold.seller_rows(self.read_silver("sellers")), table)
        elif table == "dim_date":
            df = gold.dim_date(self.read_silver("orders"))
        elif table == "dim_location":
            df = gold.dim_location(self.read_silver("geolocation"))
        else:
            raise ValueError(f"unknown dimension: {table}")
        return self._write_gold(df, table)

    def build_fact(self) -> int:
        df = gold.fact_sales(
            *[self.read_silver(t) for t in ("order_items", "orders", "payments", "reviews")],
            *[
                self.read_gold(t)
                for t in ("dim_customer", "dim_product", "dim_seller", "dim_date")
            ],
        )
        return self._write_gold(df, "fact_sales")

    def _write_gold(self, df: DataFrame, table: str) -> int:
        rows, taken = writers.observed(df, table)
        writers.overwrite_parquet(rows, self.gold_path(table))
        return writers.logged(table, df, taken.get["rows"])

    # Reports and exports

    def report_quality(self) -> DataFrame:
        """Reports of all raw tables, one directory per table."""
        report = quality_report_all({table: self.read_raw(table) for table in SPECS})
        writers.overwrite_partitioned(report, self.quality_path, "table_name")
        return readers.read_parquet(self.spark, self.quality_path)

    def report_malformed(self) -> DataFrame:
        """Text in typed columns of the raw tables, and in their times, that is no value: one directory per table."""
        parts = []
        for table, columns in schemas.RAW_COLUMNS.items():
            types = {c: kind for c, kind in columns.items() if kind != "string"} | schemas.TIMES.get(table, {})
            if types:
                text = readers.read_csv(
                    self.spark,
                    f"{self.raw}/{self.raw_names.get(table, table + '.csv')}",
                    multi_line=table in self.multi_line_tables,
                )
                parts.append(malformed_report(text, types).withColumn("table_name", F.lit(table)))
        path = f"{self.root}/quality_malformed"
        writers.overwrite_partitioned(reduce(DataFrame.unionAll, parts), path, "table_name")
        return readers.read_parquet(self.spark, path)

    def report_keys(self) -> tuple[DataFrame, DataFrame]:
        """Keys of the cleaned tables that find nothing on the other side of a join, and keys that would repeat rows."""
        tables = {table: self.read_silver(table) for table in ("orders", "reviews", *REBUILT)}
        made = []
        for name, report in (("orphans", orphan_report_all(tables)), ("join_keys", repeated_keys_all(tables))):
            writers.overwrite_parquet(report, f"{self.root}/quality_{name}")
            made.append(readers.read_parquet(self.spark, f"{self.root}/quality_{name}"))
        return made[0], made[1]

    def export_star(self, target: writers.JdbcTarget, tables: tuple[str, ...] = STAR) -> None:
        for table in tables:
            writers.overwrite_jdbc(self.read_gold(table), target, table)

    def write_mock_orders(self, rows: int = 500, seed: int = 1) -> None:
        writers.overwrite_parquet(
            mock_orders(self.spark.range(rows), seed), self.gold_path("orders_mock")
        )

    def report_monthly_revenue(self, path: str, table: str = "orders_mock") -> DataFrame:
        report = monthly_revenue(self.read_gold(table))
        writers.write_csv_report(report, path)
        return report

    # Everything in order

    def run_all(self, lookback: timedelta = timedelta(0)) -> dict[str, int]:
        """Load new rows and rebuild the rest. ``lookback`` reads orders and reviews again from before their marks."""
        self.init_control(keep=True)
        loaded = run_together(
            lambda: self.load_orders(lookback).rows,
            lambda: self.load_reviews(lookback).rows,
            *[partial(self.rebuild_silver, table) for table in REBUILT],
        )
        keyed = run_together(*[partial(self.build_dimension, table) for table in STAR[:-1]])
        counts = dict(zip(("orders", "reviews", *REBUILT, *STAR[:-1]), loaded + keyed, strict=True))
        counts["fact_sales"] = self.build_fact()
        return counts
