"""Numeric features and class labels. In every class rule a null input takes the last label."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Upper bounds (exclusive) with their labels, then the label for the rest.
PAYMENT_BANDS = ([(50, "0-50"), (100, "50-100"), (500, "100-500")], "500+")
WEIGHT_BANDS = ([(1, "Light"), (5, "Medium")], "Heavy")
SIZE_BANDS = ([(5000, "Small"), (20000, "Medium")], "Large")
REGION_STATES = {
    "Southeast": ("SP", "RJ", "MG", "ES"),
    "South": ("PR", "RS", "SC"),
}
REGION_REST = "Other"


def is_late(delivered: str, estimated: str) -> Column:
    """1 if delivered after the estimate; 0 also while undelivered."""
    return F.when(F.col(delivered) > F.col(estimated), 1).otherwise(0)


def line_total(price: str, freight: str) -> Column:
    return F.round(F.col(price) + F.col(freight), 2)


def freight_ratio(freight: str, price: str) -> Column:
    """Expects prices above zero."""
    return F.round(F.col(freight) / F.col(price), 4)


def above(name: str, limit: int) -> Column:
    return F.when(F.col(name) > limit, 1).otherwise(0)


def kilograms(grams: str) -> Column:
    return F.round(F.col(grams) / 1000, 3)


def volume(length: str, height: str, width: str) -> Column:
    """Doubles, because three integer sides can overflow an int."""
    return F.col(length).cast("double") * F.col(height).cast("double") * F.col(width).cast("double")


def banded(name: str, bands: tuple[list[tuple[float, str]], str]) -> Column:
    """Label of the first band whose upper bound lies above the value."""
    steps, rest = bands
    rule = None
    for bound, label in steps:
        below = F.col(name) < bound
        rule = F.when(below, label) if rule is None else rule.when(below, label)
    return rule.otherwise(rest)


def sentiment(score: str) -> Column:
    """The three labels. Scores outside 1 to 5 and nulls take the last one."""
    value = F.col(score)
    return F.when(value >= 4, "positive").when(value == 3, "neutral").otherwise("negative")


def region(
    state: str,
    members: dict[str, tuple] = REGION_STATES,
    rest: str = REGION_REST,
) -> Column:
    rule = None
    for label, states in members.items():
        inside = F.col(state).isin(*states)
        rule = F.when(inside, label) if rule is None else rule.when(inside, label)
    return rule.otherwise(rest)


def money_sum(name: str) -> Column:
    """Sum of a double column in decimal arithmetic, the same for every partitioning.

    Each amount is rounded to six decimals, and their sum is exact. Amounts of 10^22 and more, and those that are not
    finite, are no money and count as missing.
    """
    return F.sum(F.col(name).cast("double").try_cast("decimal(28,6)")).cast("double")
