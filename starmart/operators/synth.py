"""Made-up orders for trying out the reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values
CATEGORIES = ("electronics", "furniture", "toys", "fashion", "food")
STATES = ("SP", "RJ", "MG", "RS", "PR")
CUSTOMERS = 100
PRODUCTS = 50
MODULUS = 2147483647
YEAR = 2018


def _draw(seed: int, salt: int, size: int) -> Column:
    """A number in 0 … size-1 from the row id and the seed alone, whatever the partitioning."""
    start = F.pmod(F.col("id"), F.lit(MODULUS))
    mixed = F.pmod(start * 48271 + (seed * 7919 + salt * 104729), F.lit(MODULUS))
    mixed = F.pmod(mixed * 16807 + salt, F.lit(MODULUS))
    return F.pmod(mixed, F.lit(size)).cast("int")


def _pick(values: tuple[str, ...], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), index + 1)


def mock_orders(ids: DataFrame, seed: int = 1) -> DataFrame:
    """One order per ``id``: customers and products in turn, the rest drawn from the seed."""
    row = F.col("id")
    return ids.select(
        F.format_string("order_%05d", row).alias("order_id"),
        F.format_string("customer_%04d", row % CUSTOMERS).alias("customer_id"),
        F.format_string("product_%03d", row % PRODUCTS).alias("product_id"),
        _pick(CATEGORIES, _draw(seed, 1, len(CATEGORIES))).alias("category"),
        ((_draw(seed, 2, 48001) + 2000) / F.lit(100.0)).alias("price"),
        (_draw(seed, 3, 30) + 1).alias("delivery_days"),
        (_draw(seed, 4, 5) + 1).alias("review_score"),
        F.lit(YEAR).alias("year"),
        (_draw(seed, 5, 12) + 1).alias("month"),
        _pick(STATES, _draw(seed, 6, len(STATES))).alias("customer_state"),
    )
