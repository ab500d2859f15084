"""Damage that the queries do to given tables, so that there is something to repair. DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import crc_of_id

MARKS = r"[.!?]"


def with_periodic_tails(docs: DataFrame) -> DataFrame:
    """doc_id, text: in a tenth of the documents the words from some place on repeat with some period. Null ids and texts stay."""
    crc = crc_of_id("doc_id")
    chosen = docs.select("doc_id", "text", crc.alias("crc"), F.floor(crc / 10).alias("g")).withColumn(
        "words", F.when(F.col("crc") % 10 == 0, F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)")))
    )
    n = F.size("words").cast("long")
    a = F.col("g") % F.greatest(n, F.lit(1))
    placed = chosen.withColumns({"a": a, "p": 1 + F.floor((n - a) / (3 + F.col("g") % 8))})
    repeated = F.transform(
        "words", lambda word, i: F.when(i < F.col("a"), word).otherwise(F.get("words", (F.col("a") + (i - F.col("a")) % F.col("p")).cast("int")))
    )
    return placed.select("doc_id", F.when(F.size("words") > 0, F.array_join(repeated, " ")).otherwise(F.col("text")).alias("text"))


def damaged_turns(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text: of each twenty rows one is dropped, one emptied, one loses its marks, one stands twice, one is a user's.

    Null roles and texts become one space, as do null ids and turns in the number that decides.
    """
    space = F.lit(" ")
    number = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    lot = F.crc32(number.cast("binary")) % 20
    drawn = rows.select("conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"), lot.alias("lot"))
    text = F.when(F.col("lot") == 1, "").when(F.col("lot") == 2, F.regexp_replace("text", MARKS, "")).otherwise(F.col("text"))
    role = F.when(F.col("lot") == 4, "user").otherwise(F.col("role"))
    times = F.when(F.col("lot") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return drawn.where("lot <> 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(times).alias("copy")).drop("copy")
