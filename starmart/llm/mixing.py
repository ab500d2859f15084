"""Mixing sources to target weights by Pareto order sampling, in DataFrame operations only.

Every source gets a share of the corpus size by weight, at most `cap` times its own size. Of a source with the
rate r = target / size every document is first taken floor(r) times for certain. The rest of the target is drawn by Pareto order
sampling (Rosen 1997): documents are ranked by (u / (1-u)) / (p / (1-p)) with u uniform per document and p its
inclusion probability, and taken in rank order until the words wanted are reached.

p is proportional to the document's measure, the whole part of the square root of its words, so long documents are likelier, but less than in
proportion to their length. p stops at 1 (such documents are certain) and is scaled so that the expected words are those wanted.

The document at which the words wanted would be exceeded is left out. It may be long, so the walk goes on once behind it with the documents
that fit in what is open. Then the last BEFORE sampled and the first AFTER unsampled documents around
the cut are decided anew: of all their subsets the one that comes nearest to the target is taken, of equals the one with fewest changes.
So inclusion probabilities hold up to the documents left out and these twelve of a source.

The rank order is never sorted as a whole: words are summed per (source, slot of the rank scale), which
gives the slot where the sample ends, and only that slot is ranked row by row. What decides on a document beyond its own id, source
and size is a few values per source and measure, so texts stay where they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmart.llm.common import staged

SLOTS = 1 << 16
#: Documents around the cut of a source that are decided by their subsets, 2^12 sums a source.
BEFORE, AFTER = 4, 8
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Number of `[^\\x20\\x09-\\x0D]+` in a text, 0 for null: starts of words, without building them."""
    blanks = " \t\n\x0b\x0c\r"
    one_kind = F.translate(text, blanks[1:], " " * 5)
    trimmed = F.trim(one_kind)
    # What is left of the text when each run of blanks keeps its first blank only.
    single = F.regexp_replace(trimmed, " {2,}", " ")
    words = F.length(single) - F.length(F.replace(single, F.lit(" "), F.lit(""))) + 1
    return F.when(text.isNull() | (F.length(trimmed) == 0), 0).otherwise(words).cast("long")


def uniform(doc_id: Column, seed: int) -> Column:
    """A number in (0, 1) that depends on the id and the seed alone."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"))
    top = F.conv(F.substring(digest, 1, 12), 16, 10).cast("double")
    return (top + F.lit(0.5)) / F.lit(float(1 << 48))


def targets(sources: DataFrame, cap: float, weights: tuple[int, ...]) -> DataFrame:
    """source, source_size -> with weight and target. One row per source comes in, so a window is fine.

    Sources by code point, null last, take the weights in turn. A source is capped if its share by weight
    among those that are not capped would be over cap * size. The capped ones are the first in the order
    of size / weight, so one pass over running sums finds them.
    """
    by_name = Window.orderBy(F.col("source").isNull(), F.encode("source", "utf-8"))
    weight = F.array(*[F.lit(float(w)) for w in weights])
    ranked = sources.withColumn("weight", F.get(weight, (F.row_number().over(by_name) - 1) % len(weights)))
    order = Window.orderBy(F.col("source_size") / F.col("weight"), "weight", F.encode("source", "utf-8").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    total, heavy = F.sum("source_size").over(whole), F.sum("weight").over(whole)
    left = total - F.lit(cap) * F.coalesce(F.sum("source_size").over(before), F.lit(0))
    level = left / (heavy - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    judged = ranked.withColumn("level", level).withColumn("nth", F.row_number().over(order)).withColumn(
        "capped", F.col("source_size") * F.lit(cap) <= F.col("weight") * F.col("level")
    )
    # The level of the first one that is not capped: those behind it have levels that hold only if it were.
    open_level = F.coalesce(F.min(F.when(~F.col("capped"), F.struct("nth", "level"))).over(whole)["level"], F.lit(0.0))
    return judged.select(
        "source",
        "source_size",
        F.when(F.col("capped"), F.col("source_size") * F.lit(cap)).otherwise(F.col("weight") * open_level).cast("double").alias("target"),
    )


def measure(size: Column) -> Column:
    """What a document's inclusion probability is proportional to: few values, so chances are a small table."""
    return F.floor(F.sqrt(size.cast("double"))).cast("long")


def chances(sized: DataFrame, cap: float, weights: tuple[int, ...]) -> DataFrame:
    """of_source, of_measure -> source_size, target, sure (certain copies), need (words to draw), p.

    With documents in the order of measure, largest first, those of measure m are certain if their p would be 1 and more when all larger ones
    are certain: m * (need - words above) >= sum of words * measure from m downwards.
    """
    classes = sized.groupBy("source", measure(F.col("size")).alias("measure")).agg(F.sum("size").alias("words"))
    sources = classes.groupBy("source").agg(F.sum("words").cast("long").alias("source_size"))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    plan = targets(sources, cap, weights).withColumn("sure", F.least(F.floor(rate), F.lit(int(cap))).cast("long"))
    plan = plan.withColumn("need", F.greatest(F.col("target") - F.col("sure") * F.col("source_size"), F.lit(0.0))).withColumnRenamed("source", "of_source")
    met = classes.join(plan, classes["source"].eqNullSafe(F.col("of_source")))
    order = Window.partitionBy("of_source").orderBy(F.col("measure").desc())
    whole = Window.partitionBy("of_source")
    weighed = F.col("words") * F.col("measure")
    above = F.coalesce(F.sum("words").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("double")
    below = F.sum(weighed).over(order.rowsBetween(0, Window.unboundedFollowing)).cast("double")
    judged = met.withColumn("certain", (F.col("measure") > 0) & (F.col("measure").cast("double") * (F.col("need") - above) >= below))
    taken = F.sum(F.when(F.col("certain"), F.col("words")).otherwise(0)).over(whole).cast("double")
    left = F.sum(F.when(F.col("certain"), 0).otherwise(weighed)).over(whole).cast("double")
    p = F.when(F.col("measure") == 0, 0.0).when(F.col("certain"), 1.0).otherwise(
        F.least(F.lit(1.0), F.col("measure").cast("double") * ((F.col("need") - taken) / left))
    )
    return judged.withColumn("p", p).select("of_source", F.col("measure").alias("of_measure"), "source_size", "target", "sure", "need", "p")


def ranked(rows: DataFrame, table: DataFrame, seed: int) -> DataFrame:
    """`rows` (doc_id, source, size and others) with their chances, and key (rank, size, name), slot where p > 0."""
    u = uniform(F.col("doc_id"), seed)
    rank = F.when(F.col("p") > 0, (u / (1 - u)) * ((1 - F.col("p")) / F.col("p")))
    met = rows.join(table, F.col("source").eqNullSafe(F.col("of_source")) & (measure(F.col("size")) == F.col("of_measure")), "left")
    return (
        met.drop("of_source", "of_measure")
        .withColumn("rank", rank)
        .withColumn("key", F.struct("rank", "size", F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("name")))
        # Monotone in the rank; half of the slots lie on either side of rank 1, near which samples end.
        .withColumn("slot", F.floor(F.lit(SLOTS) * F.col("rank") / (1 + F.col("rank"))).cast("long"))
    )


def walk(rows: DataFrame, wanted: str, nth: int) -> DataFrame:
    """of_source, edge, got of rows (source, slot, key, size, and the words wanted): the first key that would exceed what is wanted, and the words before.

    Rows with equal keys go together. edge is null where all rows fit.
    """
    slots = rows.groupBy("source", "slot").agg(F.sum("size").alias("words"), F.first(wanted).alias("wanted"))
    running = F.sum("words").over(Window.partitionBy("source").orderBy("slot"))
    cut = (
        slots.withColumn("upto", running)
        .groupBy(F.col("source").alias("cut_source"))
        .agg(F.min(F.when(F.col("upto") > F.col("wanted"), F.struct("slot", (F.col("upto") - F.col("words")).alias("before")))).alias("cut"), F.max("upto").alias("all"))
    )
    cut = staged(cut, "mix-cut")
    units = (
        rows.join(cut, rows["source"].eqNullSafe(F.col("cut_source")) & (F.col("slot") == F.col("cut.slot")))
        .groupBy("cut_source", "key")
        .agg(F.sum("size").alias("words"), F.first(wanted).alias("wanted"), F.first("cut.before").alias("before"))
    )
    upto = F.col("before") + F.sum("words").over(Window.partitionBy("cut_source").orderBy("key"))
    inner = (
        units.withColumn("upto", upto)
        .groupBy(F.col("cut_source").alias("in_source"))
        .agg(F.min(F.when(F.col("upto") > F.col("wanted"), F.col("key"))).alias("edge"), F.max(F.when(F.col("upto") <= F.col("wanted"), F.col("upto"))).alias("inside"))
    )
    met = cut.join(inner, F.col("cut_source").eqNullSafe(F.col("in_source")), "left")
    return staged(
        met.select(F.col("cut_source").alias(f"source{nth}"), F.col("edge").alias(f"edge{nth}"), F.coalesce("inside", "cut.before", "all").alias(f"got{nth}")), "mix-edge"
    )


FLIPS = """array_min(transform(sequence(0, shiftleft(1, size(pool)) - 1), mask -> struct(
    abs(goal - aggregate(sequence(0, size(pool) - 1), 0L, (t, i) -> t + if((shiftright(mask, i) & 1) = 1, pool[i].words, 0L))) as off,
    bit_count(mask ^ own) as changed, mask as mask)))"""


def first_walk(rows: DataFrame, edge: DataFrame) -> DataFrame:
    """`rows` with what the first walk leaves open of their source, and which of them it takes."""
    met = rows.join(edge, F.col("source").eqNullSafe(F.col("source1")), "left").drop("source1")
    return met.withColumn("open", F.col("need") - F.coalesce("got1", F.lit(0))).withColumn("first", (F.col("p") > 0) & (F.col("edge1").isNull() | (F.col("key") < F.col("edge1"))))


def both_walks(rows: DataFrame, edge: DataFrame) -> DataFrame:
    """`rows` of `first_walk` with which of them either walk takes."""
    met = rows.join(edge, F.col("source").eqNullSafe(F.col("source2")), "left").drop("source2")
    second = behind() & (F.col("edge2").isNull() | (F.col("key") < F.col("edge2")))
    return met.withColumn("kept", F.col("first") | F.coalesce(second, F.lit(False)))


def behind() -> Column:
    return (F.col("p") > 0) & (F.col("key") > F.col("edge1")) & (F.col("size") <= F.col("open"))


def closing(rows: DataFrame) -> DataFrame:
    """flip_source, flips: keys around the cut that change sides, so that the sample comes nearest to the words wanted."""
    units = (
        rows.where((F.col("p") > 0) & (~F.col("kept") | (F.col("p") < 1)))
        .withColumn("goal", F.col("open") - F.coalesce("got2", F.lit(0)))
        .groupBy("source", "kept", "key", "open", "goal")
        .agg(F.sum("size").alias("words"))
    )
    sign = F.when(F.col("kept"), -1).otherwise(1)
    order = (F.when(~F.col("kept"), F.col("key.size") > F.col("open")), sign * F.col("key.rank"), sign * F.col("key.size"), F.col("key.name"))
    near = units.withColumn("nth", F.row_number().over(Window.partitionBy("source", "kept").orderBy(*order))).where(F.col("nth") <= max(BEFORE, AFTER))
    near = near.where(F.col("nth") <= F.when(F.col("kept"), BEFORE).otherwise(AFTER))
    # At most BEFORE + AFTER rows of a source.
    pools = near.groupBy(F.col("source").alias("flip_source")).agg(
        F.array_sort(F.collect_list(F.struct("key", "words", "kept"))).alias("pool"),
        (F.first("goal") + F.sum(F.when(F.col("kept"), F.col("words")).otherwise(0))).alias("goal"),
    )
    own = F.expr("aggregate(sequence(0, size(pool) - 1), 0, (t, i) -> t + if(pool[i].kept, shiftleft(1, i), 0))")
    changed = F.expr("transform(filter(sequence(0, size(pool) - 1), i -> (shiftright(best.mask ^ own, i) & 1) = 1), i -> pool[i].key)")
    return pools.withColumn("own", own).withColumn("best", F.expr(FLIPS)).select("flip_source", changed.alias("flips"))


def keyed(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> list[Column]:
    return [F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"), word_count(F.col(text_col)).alias("size")]


def decide(sized: DataFrame, cap: float, weights: tuple[int, ...], seed: int):
    """A function that adds source_size, target and copies to rows with doc_id, source and size, from the sizes of all documents."""
    sized = staged(sized, "mix-sizes")
    table = staged(chances(sized, cap, weights), "mix-plan")
    rows = ranked(sized, table, seed)
    edge1 = walk(rows.where(F.col("p") > 0), "need", 1)
    edge2 = walk(first_walk(rows, edge1).where(behind()), "open", 2)
    flips = staged(closing(both_walks(first_walk(rows, edge1), edge2)), "mix-flips")

    def apply(other: DataFrame) -> DataFrame:
        met = both_walks(first_walk(ranked(other, table, seed), edge1), edge2).join(flips, F.col("source").eqNullSafe(F.col("flip_source")), "left")
        flipped = F.coalesce(F.array_contains("flips", F.col("key")) & (F.col("p") > 0), F.lit(False))
        copies = F.col("sure") + (F.col("kept") != flipped).cast("long")
        return met.withColumn("copies", copies).select(*other.columns, "source_size", "target", "copies")

    return sized, apply


def pareto_mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    cap: float = 3.0,
    weights: tuple[int, ...] = (1, 2, 3),
    seed: int = 17,
) -> DataFrame:
    """doc_id, source, size, source_size, target, copies, taken: one row per input row.

    Empty and null texts have size 0 and are never drawn; a null source is a source of its own; rows of one source
    with equal ids (null ids are equal) and sizes are taken together; other columns are ignored; very long texts are drawn like
    others, and left out where they alone exceed what is open; an empty table gives an empty result. Reruns agree.
    """
    sized, apply = decide(docs.select(*keyed(docs, id_col, text_col, source_col)), cap, weights, seed)
    return apply(sized).withColumn("taken", F.col("copies") * F.col("size"))


def mixed_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    cap: float = 3.0,
    weights: tuple[int, ...] = (1, 2, 3),
    seed: int = 17,
) -> DataFrame:
    """The rows of `docs`, each as often as the mix takes it, with the columns of `docs`.

    A row's copies depend on its id, source and size and on tables of a few rows a source, so texts are joined where they stand unless
    these tables are too large to be broadcast by Spark's own check.
    """
    _, apply = decide(docs.select(*keyed(docs, id_col, text_col, source_col)), cap, weights, seed)
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *keyed(docs, id_col, text_col, source_col))
    taken = apply(whole).where(F.col("copies") > 0)
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("row.*")
