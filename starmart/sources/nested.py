"""JSON text in a column, with fields that change their type or come new."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def json_fields(df: DataFrame, column: str, fields: dict[str, str]) -> DataFrame:
    """The columns of ``df``, one for each field with its type, ``extra_fields`` and ``malformed``.

    The text is parsed once, into a variant. A field that is missing or has no value of its type is null, and a number in quotes
    is a number. ``extra_fields`` names, sorted, the top-level fields that aren't listed. Text that is no JSON is ``malformed`` and has nulls; missing text
    is not. Arrays are typed like any field (``array<string>``).
    """
    clash = {*fields, "extra_fields", "malformed"} & {*df.columns}
    if clash:
        raise ValueError(f"columns are there already: {sorted(clash)}")
    value = F.try_parse_json(F.col(column))
    known = F.array(*[F.lit(name) for name in fields]).cast("array<string>")
    parsed = df.withColumn("_variant", value)
    return parsed.select(
        *df.columns,
        *[F.try_variant_get("_variant", f"$.{name}", kind).alias(name) for name, kind in fields.items()],
        F.when(F.col("_variant").isNotNull(), F.array_sort(F.array_except(F.coalesce(F.json_object_keys(column), F.array().cast("array<string>")), known))).alias("extra_fields"),
        (F.col(column).isNotNull() & F.col("_variant").isNull()).alias("malformed"),
    )


def clean_labels(column: str) -> Column:
    """An array of labels trimmed, in lower case, without repeats, blanks and nulls, sorted."""
    cleaned = F.transform(column, lambda label: F.lower(F.trim(label)))
    return F.array_sort(F.array_distinct(F.filter(cleaned, lambda label: F.length(label) > 0)))


def label_counts(df: DataFrame, labels: str) -> DataFrame:
    """label, n_rows: rows that hold each label. A row's labels are counted once, and partial counts are shuffled."""
    return df.select(F.explode(F.array_distinct(labels)).alias("label")).groupBy("label").agg(F.count(F.lit(1)).alias("n_rows"))
