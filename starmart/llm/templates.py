"""Line dedup by a tree of log templates of fixed depth.

The levels of the tree are the number of tokens of a line and its leading tokens; tokens with a digit are variable fields everywhere.
Under such a node a token at a further place is fixed if several texts have it there; all others are fields. A line with
its fields taken out is its template. A template recurs if enough different texts hold a line of it: the more fixed tokens it
has, the fewer texts it takes. Lines of a recurring template are dropped from all texts but one, so that nothing is lost that copied or
quoting texts share.

Lines of at most one third of fields are compared by template, and every line also as it stands (with fields only for digits), so a long passage that two
texts quote is found whatever else begins like it. Leaves and nodes are hashes, counts of texts per leaf are partial sums, and
only lines under nodes that several texts reach are taken apart into tokens.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import discard, staged

LEADING = 2
FIELD = "<*>"
#: Bits of a node's hash by which lines are chosen that are taken apart into tokens.
SLOT_BITS = 22
_VARIABLE = re.compile(r"\S*\d\S*")


def tokens_of(line: str) -> list[str]:
    """Tokens of a line, those with a digit as fields."""
    return (_VARIABLE.sub(FIELD, line) if any(map(str.isdigit, line)) else line).split()


def hashed(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text) - (1 << 63)


def leaf_of(tokens: list[str]) -> int:
    return hashed("leaf\n" + " ".join(tokens))


def node_of(tokens: list[str]) -> int:
    return hashed(f"node {len(tokens)}\n" + " ".join(tokens[:LEADING]))


def lines_of(text: str | None) -> Iterator[list[str]]:
    """The tokens of each line that has any."""
    return filter(None, map(tokens_of, text.split("\n"))) if text else iter(())


def line_leaves(docs: DataFrame) -> DataFrame:
    """key, leaves, nodes, fixed: the distinct lines of each text, with their nodes and numbers of tokens that are no fields.

    A text that stands in several rows is taken apart once per task.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            rows = []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if key not in seen:
                    seen.add(key)
                    found = {leaf_of(t): (node_of(t), len(t) - t.count(FIELD)) for t in lines_of(text)}
                    rows.append((key, list(found), [x[0] for x in found.values()], [x[1] for x in found.values()]))
            kinds = (pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names=["key", "leaves", "nodes", "fixed"])

    return docs.select("key", "text").mapInArrow(work, "key long, leaves array<long>, nodes array<long>, fixed array<int>")


def busy_slots(nodes: DataFrame) -> np.ndarray:
    """Whether any of the nodes (column ``of_node``) has a hash with these first SLOT_BITS bits. At most 2^SLOT_BITS numbers reach the driver."""
    slots = np.zeros(1 << SLOT_BITS, dtype=bool)
    found = nodes.select(F.shiftrightunsigned("of_node", 64 - SLOT_BITS).cast("int").alias("slot")).distinct().toArrow()
    slots[found.column("slot").to_numpy()] = True
    return slots


def taken_apart(docs: DataFrame, slots: np.ndarray) -> DataFrame:
    """key, leaf, node, tokens: the lines whose node has its slot set, their tokens as hashes, 0 for fields. docs: key, text.

    Other nodes with the same slot come along; they have too few texts for a template.
    """
    shared = docs.sparkSession.sparkContext.broadcast(slots)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        seen: set[int] = set()
        busy = shared.value
        for batch in batches:
            rows = []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if key in seen:
                    continue
                seen.add(key)
                found = {}
                for t in lines_of(text):
                    node = node_of(t)
                    if busy[(node & (1 << 64) - 1) >> 64 - SLOT_BITS]:
                        found[leaf_of(t)] = node, t
                rows += [(key, leaf, node, [0 if x == FIELD else hashed(x) for x in t]) for leaf, (node, t) in found.items()]
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names=["key", "leaf", "node", "tokens"])

    return docs.select("key", "text").mapInArrow(work, "key long, leaf long, node long, tokens array<long>")


def recurring(held: DataFrame, leaf: str, evidence: int, least_texts: int) -> DataFrame:
    """of_leaf, holder: leaves that enough texts hold, and the text that keeps its lines. held: key, leaf, fixed."""
    counts = held.groupBy(F.col(leaf).alias("of_leaf")).agg(F.count_distinct("key").alias("texts"), F.min("key").alias("holder"), F.max("fixed").alias("fixed"))
    return counts.where((F.col("texts") >= least_texts) & (F.col("texts") * F.col("fixed") >= evidence)).select("of_leaf", "holder")


def templates_of(lines: DataFrame, several: int) -> DataFrame:
    """key, leaf, template, fixed: the template of each line with fields beside its digits. lines: key, leaf, node, tokens."""
    spread = lines.select("key", "leaf", "node", F.posexplode("tokens").alias("place", "token"))
    fixed = (
        spread.where((F.col("token") != 0) & (F.col("place") >= LEADING)).groupBy("node", "place", "token").agg(F.count_distinct("key").alias("texts"))
        .where(F.col("texts") >= several).select(F.col("node").alias("of_node"), F.col("place").alias("of_place"), F.col("token").alias("of_token"))
    )
    # One row per token of the distinct lines of a node: the text doesn't matter any more.
    once = spread.select("leaf", "node", "place", "token").distinct()
    same = (F.col("node") == F.col("of_node")) & (F.col("place") == F.col("of_place")) & (F.col("token") == F.col("of_token"))
    stays = (F.col("token") != 0) & ((F.col("place") < LEADING) | F.col("of_node").isNotNull())
    shown = once.join(fixed, same, "left").select("leaf", "node", "place", "token", stays.alias("stays"))
    made = shown.groupBy(F.col("leaf").alias("of_leaf"), "node").agg(
        F.xxhash64(F.array_sort(F.collect_list(F.when(F.col("stays"), F.struct("place", "token"))))).alias("rest"),
        F.count("*").alias("n"), F.count_if("stays").cast("int").alias("fixed"), F.count_if((F.col("token") != 0) & ~F.col("stays")).alias("opened"),
    )
    useful = made.where((F.col("opened") > 0) & ((F.col("n") - F.col("fixed")) * 3 <= F.col("n")))
    return lines.select("key", "leaf").join(useful.select("of_leaf", F.xxhash64("node", "rest").alias("template"), "fixed"), F.col("leaf") == F.col("of_leaf")).drop("of_leaf")


def drop_template_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", evidence: int = 60, several: int = 5
) -> DataFrame:
    """doc_id, text, n_lines, n_dropped: one row per input row, its text without lines of recurring templates.

    A template recurs if the number of different texts with a line of it, times its fixed tokens, reaches ``evidence``: two texts for a line of
    thirty words, twelve for one of five and a field. Templates with fields need ``several`` texts, as does a fixed token. The text with the
    smallest hash of those with the template keeps its lines, so none goes from its last text; equal texts count once and share their fate, and
    within a text lines are not compared. Lines end at a line feed; blank lines are kept and not counted. A null text stays null and has no lines;
    ids may be null or repeat; an empty table gives an empty table; other columns are ignored. Of a very long text a task holds some numbers per line.
    """
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    # Rows are joined by their text, so equal texts share their list and ids do not matter.
    keyed = source.withColumn("key", F.xxhash64("text"))
    made = staged(line_leaves(keyed), "line-leaves")
    found = made.select("key", F.explode(F.arrays_zip("leaves", "nodes", "fixed")).alias("x")).select("key", F.col("x.leaves").alias("leaf"), F.col("x.nodes").alias("node"), F.col("x.fixed").alias("fixed"))
    exact = staged(recurring(found, "leaf", evidence, 2), "line-recurring")

    busy = found.groupBy(F.col("node").alias("of_node")).agg(F.count_distinct("key").alias("texts")).where(F.col("texts") >= several).select("of_node")
    lines = staged(taken_apart(keyed, busy_slots(busy)).dropDuplicates(["key", "leaf"]), "line-tokens")
    general = staged(templates_of(lines, several), "line-templates")
    varied = staged(recurring(general, "template", evidence, several), "line-recurring")

    lists = (
        found.join(exact, F.col("leaf") == F.col("of_leaf")).where("key <> holder").select("key", "leaf")
        .unionByName(general.join(varied, F.col("template") == F.col("of_leaf")).where("key <> holder").select("key", "leaf"))
        .groupBy(F.col("key").alias("of_key")).agg(F.collect_set("leaf").alias("known"))
    )
    dropped = staged(lists, "template-lines")
    discard(made, exact, lines, general, varied)
    met = keyed.join(dropped, F.col("key") == F.col("of_key"), "left").select("doc_id", "text", "known")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            kept, totals, drops = [], [], []
            for text, known in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                lines, gone = (text or "").split("\n"), set(known or ())
                out = [x for x in lines if not (t := tokens_of(x)) or leaf_of(t) not in gone] if gone else lines
                kept.append(None if text is None else "\n".join(out))
                totals.append(sum(bool(x.split()) for x in lines))
                drops.append(len(lines) - len(out))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(kept, pa.string()), pa.array(totals, pa.int64()), pa.array(drops, pa.int64())],
                names=["doc_id", "text", "n_lines", "n_dropped"],
            )

    return met.mapInArrow(work, "doc_id long, text string, n_lines long, n_dropped long")
