"""Connected components of links between long ids, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import discard, staged


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, root: every id of a link between two different ids, with the smallest id that it reaches.

    Each step points ids at the smallest neighbour seen so far and drops repeated links, so hubs shrink
    and no group is ever gathered in one place: minima are partial sums, and the joins with them can be split.
    The links of each step are written to the shared folder. Null ids are left out.
    """
    x, y = F.col(a).cast("long"), F.col(b).cast("long")
    now = links.where(x.isNotNull() & y.isNotNull() & (x != y)).select(F.greatest(x, y).alias("high"), F.least(x, y).alias("low")).distinct()
    now = staged(now, "links")
    state = _state(now)
    while True:
        older, now = now, staged(_small_star(_large_star(now)), "links")
        discard(older)
        before, state = state, _state(now)
        if state == before:
            return with_roots(now)


def with_roots(stars: DataFrame) -> DataFrame:
    roots = stars.select(F.col("low").alias("node"), F.col("low").alias("root")).distinct()
    return stars.select(F.col("high").alias("node"), F.col("low").alias("root")).unionByName(roots)


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("high", "low").cast("decimal(38,0)"))).first())


def _least(links: DataFrame) -> DataFrame:
    return links.groupBy(F.col("node").alias("of")).agg(F.min("other").alias("least"))


def _large_star(links: DataFrame) -> DataFrame:
    """Larger neighbours of each id point at its smallest neighbour or itself."""
    both = links.select(F.col("high").alias("node"), F.col("low").alias("other")).unionByName(
        links.select(F.col("low").alias("node"), F.col("high").alias("other"))
    )
    met = both.join(_least(both), F.col("node") == F.col("of"))
    made = met.where("other > node").select(F.col("other").alias("high"), F.least("node", "least").alias("low"))
    return made.distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Smaller neighbours of each id, and the id itself, point at the smallest of them."""
    down = links.select(F.col("high").alias("node"), F.col("low").alias("other"))
    met = down.join(_least(down), F.col("node") == F.col("of"))
    others = met.where("other <> least").select(F.col("other").alias("high"), F.col("least").alias("low"))
    return others.unionByName(met.select(F.col("node").alias("high"), F.col("least").alias("low"))).distinct()
