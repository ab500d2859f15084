"""String and timestamp standardization."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def trim_lower(name: str) -> Column:
    return F.lower(F.trim(F.col(name)))


def trim_upper(name: str) -> Column:
    return F.upper(F.trim(F.col(name)))


def parse_timestamp(name: str) -> Column:
    """Text that is no timestamp gives null, with ANSI mode on or off."""
    return F.try_to_timestamp(F.col(name))


# Text that counts as a value of each type; anything else is malformed.
NUMBERS = {
    "int": r"^[+-]?[0-9]+$",
    "long": r"^[+-]?[0-9]+$",
    "double": r"^([+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?|NaN|[+-]?Inf(inity)?)$",
}


def parse_value(name: str, kind: str) -> Column:
    """Text as a value of ``kind`` (int, long, double, timestamp or string); null where it is none, with ANSI mode on or off.

    A number has nothing around it and an int no fraction, as in a typed CSV scan.
    """
    if kind == "string":
        return F.col(name)
    if kind == "timestamp":
        return parse_timestamp(name)
    return F.when(F.col(name).rlike(NUMBERS[kind]), F.col(name).try_cast(kind))


def malformed(name: str, kind: str) -> Column:
    """Text is present, not blank, and no value of ``kind``."""
    return F.coalesce((F.length(F.trim(F.col(name))) > 0) & parse_value(name, kind).isNull(), F.lit(False))


def location_key(zip_code: str, state: str) -> Column:
    """``zip_state``; a null part is left out together with its separator."""
    return F.concat_ws("_", F.col(zip_code), F.col(state))


def has_text(name: str) -> Column:
    """1 if the message has any character but a space, else 0; a missing message has none."""
    return F.coalesce(F.col(name).rlike("[^ ]"), F.lit(False)).cast("int")
