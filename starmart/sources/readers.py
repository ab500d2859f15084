"""CSV and Parquet scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.functions.text import parse_value
from starmart.sources.quoted import quoted_records


def read_csv(
    spark: SparkSession,
    path: str,
    types: dict[str, str] | None = None,
    multi_line: bool = False,
    infer: bool = False,
) -> DataFrame:
    """CSV with a header line.

    ``types`` are matched to the header by name (other columns are text), which reads one
    line instead of scanning the data for types; files whose header differs are refused.
    ``infer`` scans the data for types instead. Files are split between tasks, also with ``multi_line``, which line breaks inside
    quotes need: the quotes of every byte range are counted first, one more pass over the text. Only
    ``multi_line`` with ``infer`` reads each file by one task.
    """
    if multi_line and not infer:
        return _read_quoted(spark, path, types or {})
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", multi_line)
    if infer:
        return reader.option("inferSchema", True).csv(path)
    names = reader.csv(path).columns
    return reader.option("enforceSchema", False).schema(_schema(names, types or {})).csv(path)


def _schema(names: list[str], types: dict[str, str]) -> str:
    quoted = {name: name.replace("`", "``") for name in names}
    return ", ".join(f"`{quoted[name]}` {types.get(name, 'string')}" for name in names)


def _read_quoted(spark: SparkSession, path: str, types: dict[str, str]) -> DataFrame:
    names, records = quoted_records(spark, path)
    if names is None:  # files without a line
        return spark.createDataFrame([], _schema(list(types), types))
    parsed = F.from_csv("record", _schema(names, types), {"escape": '"', "multiLine": "true"})
    return records.select(parsed.alias("row")).select("row.*")


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


def with_raw_text(text: DataFrame, types: dict[str, str]) -> DataFrame:
    """A table of text with its columns as values, and the text of each beside it as ``<name>_raw``, so that no unreadable value is lost."""
    return text.withColumnsRenamed({name: f"{name}_raw" for name in types}).select(
        *[parse_value(f"{c}_raw", types[c]).alias(c) if c in types else F.col(c) for c in text.columns],
        *[f"{name}_raw" for name in types],
    )
