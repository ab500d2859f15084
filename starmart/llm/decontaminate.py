"""Benchmark decontamination by spaced seeds.

A mask is a fixed pattern of word positions that count and positions that are ignored, so a substituted word
costs only the seeds in which it counts. Every place of a test item is hashed under every mask; places of
the corpus that have such a hash are kept with the words around them, joined to the test places on
the hash, and each diagonal (document place minus item place) that was hit is verified word by word.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import map_batches, staged

# Fixed values, four words that count: with three quarters of the words equal, at least one of the first two masks is
# met wherever the misses lie in an item of nine words and more, and one of all in an item of five to eight
# (the test tries all places of misses; more than 33 words split into stretches of 17 to 33, one of which has the share).
MASKS = ((0, 1, 2, 4), (0, 3, 4, 5), (0, 1, 2, 3), (0, 1, 3, 4), (0, 2, 3, 4), (0, 1, 2, 5))
LONG_MASKS, LONG_FROM = 2, 9
LEAST_WORDS = 5
#: Test places held by every task at once; a larger benchmark is taken in parts, one scan of the corpus each.
PLACES_AT_ONCE = 2_000_000
_WORD = re.compile(r"[^\W_]+")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def masks_for(n_words: int) -> int:
    """How many of the masks an item of so many words needs."""
    return LONG_MASKS if n_words >= LONG_FROM else len(MASKS)


def seeds(ids: np.ndarray, n_masks: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and places of the first masks over word numbers; 0 is a word that the benchmark does not have."""
    hashes, places = [], []
    for nth, mask in enumerate(MASKS[:n_masks]):
        n = ids.size - mask[-1]
        if n <= 0:
            continue
        full = np.ones(n, dtype=bool)
        for k in mask:
            full &= ids[k : k + n] != 0
        at = np.flatnonzero(full)
        made = np.full(at.size, nth + 1, dtype=np.uint64)
        for k in mask:
            made = (made ^ ids[at + k].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            made ^= made >> np.uint64(29)
        hashes.append(made)
        places.append(at)
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(hashes), np.concatenate(places)


def word_id(word: str) -> int:
    """A number of a word that is the same everywhere and never 0."""
    import xxhash

    return xxhash.xxh3_64_intdigest(word) | 1


def test_items(benchmark: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """item_id, words (word numbers), places (struct of hash and place)."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        words = [[word_id(w) for w in words_of(t.as_py())] for t in batch.column(1)]
        made = [seeds(np.array(w, dtype=np.uint64), masks_for(len(w))) for w in words]
        return pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array([np.array(w, dtype=np.uint64).astype(np.int64) for w in words], pa.list_(pa.int64())),
                pa.array([h.astype(np.int64) for h, _ in made], pa.list_(pa.int64())),
                pa.array([p for _, p in made], pa.list_(pa.int64())),
            ],
            names=["item_id", "words", "hashes", "places"],
        )

    source = benchmark.select(F.col(item_col).cast("long").alias("item_id"), F.col(text_col).cast("string").alias("text")).where("text is not null and item_id is not null")
    return map_batches(source, work, "item_id long, words array<long>, hashes array<long>, places array<long>")


def regions(docs: DataFrame, vocabulary: np.ndarray, hashes: np.ndarray, reach: int, n_masks: int) -> DataFrame:
    """row, doc_id, region, begin, words, seeds: runs of places with hashes of the benchmark, `reach` words wider on each side.

    vocabulary, hashes: sorted numbers of the words and the seeds of this part of the benchmark.
    """
    context = docs.sparkSession.sparkContext
    shared = context.broadcast((vocabulary, hashes))
    numbers: dict[str, int] = {}

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        known, wanted = shared.value
        inside = set(known.tolist())
        rows: list[tuple] = []
        for row, doc_id, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            words = words_of(text)
            if len(numbers) > 1_000_000:
                numbers.clear()
            for w in set(words):
                if w not in numbers:
                    made = word_id(w)
                    numbers[w] = made if made in inside else 0
            ids = np.fromiter(map(numbers.__getitem__, words), dtype=np.uint64, count=len(words))
            found, places = seeds(ids, n_masks)
            if not found.size:
                continue
            at = np.searchsorted(wanted, found)
            hit = wanted[np.minimum(at, wanted.size - 1)] == found
            if not hit.any():
                continue
            order = np.argsort(places[hit], kind="stable")
            found, places = found[hit][order], places[hit][order]
            cuts = np.flatnonzero(np.diff(places) > 2 * reach) + 1
            for k, (h, p) in enumerate(zip(np.split(found, cuts), np.split(places, cuts), strict=True)):
                begin, end = max(0, int(p[0]) - reach), int(p[-1]) + reach
                rows.append((row, doc_id, k, begin, ids[begin:end].astype(np.int64), h.astype(np.int64), p.astype(np.int64)))
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), *[pa.list_(pa.int64())] * 3]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names=["row", "doc_id", "region", "begin", "words", "hashes", "places"])

    return map_batches(docs, work, "row long, doc_id long, region int, begin long, words array<long>, hashes array<long>, places array<long>")


def best_run(same: np.ndarray, share: float) -> tuple[int, int, int]:
    """begin, end, matches of the stretch of a diagonal with most matches of all that have `share` of their words equal.

    Of such stretches the longest has most matches: one more word would take it below the share, or it is the whole
    diagonal. Without the misses around its matches it keeps the share; of equal counts the shortest, then the first, is taken.
    """
    total = np.concatenate([[0], np.cumsum(same)])
    level = total - share * np.arange(total.size)
    # Leftmost begin whose level is not above that of the end, for every end; levels are rounded sums.
    begin = np.searchsorted(-np.minimum.accumulate(level), -(level + 1e-9))
    end = int(np.argmax(np.arange(total.size) - begin))
    matched = int(total[end] - total[begin[end]])
    if not matched:
        return 0, 0, 0
    at = np.flatnonzero(same)
    widths = at[matched - 1 :] - at[: at.size - matched + 1] + 1
    first = int(np.argmin(widths))
    return int(at[first]), int(at[first] + widths[first]), matched


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    least_words: int = 13,
    share: float = 0.75,
    row_col: str | None = None,
) -> DataFrame:
    """row, doc_id, item_id, first_word, n_words, n_matched: the best overlap of each document row and test item.

    An overlap is a stretch of a diagonal with `share` of its words equal and `least_words` equal words, or
    as many as a shorter item has times `share`, whichever is less. Items with fewer than five words or no text or id
    name nothing. Null and empty texts have no overlaps; rows with equal or null ids are told apart by `row`, which
    numbers the rows of a scan unless `row_col` names a number. Other columns are ignored.
    """
    spark = docs.sparkSession
    items = staged(test_items(benchmark, item_col, item_text_col).where(F.size("words") >= LEAST_WORDS), "leak-items")
    source = docs.select(
        (F.col(row_col) if row_col else F.monotonically_increasing_id()).alias("row"),
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(text_col).cast("string").alias("text"),
    )
    stats = items.agg(F.sum(F.size("hashes")), F.max(F.size("words")), F.min(F.size("words"))).first()
    parts, reach, n_masks = -(-(stats[0] or 0) // PLACES_AT_ONCE), stats[1] or 0, masks_for(stats[2] or 0)
    found: DataFrame | None = None
    for part in range(parts):
        own = items if parts == 1 else items.where(F.pmod(F.xxhash64("item_id"), F.lit(parts)) == part)
        # Bounded by PLACES_AT_ONCE per part.
        vocabulary = np.array([r[0] for r in own.select(F.explode("words")).distinct().collect()], dtype=np.int64).astype(np.uint64)
        hashes = np.array([r[0] for r in own.select(F.explode("hashes")).distinct().collect()], dtype=np.int64).astype(np.uint64)
        if hashes.size:
            near = staged(regions(source, np.sort(vocabulary), np.sort(hashes), reach, n_masks), "leak-regions")
            made = overlaps(near, own, least_words, share)
            found = made if found is None else found.unionByName(made)
    if found is None:
        return spark.createDataFrame([], LEAKS)
    best = F.max(F.struct("n_matched", (-F.col("n_words")).alias("n_words"), (-F.col("first_word")).alias("first_word")))
    return found.groupBy("row", "doc_id", "item_id").agg(best.alias("best")).select(
        "row", "doc_id", "item_id", (-F.col("best.first_word")).alias("first_word"), (-F.col("best.n_words")).alias("n_words"), F.col("best.n_matched").alias("n_matched")
    )


LEAKS = "row long, doc_id long, item_id long, first_word long, n_words long, n_matched long"


def overlaps(near: DataFrame, items: DataFrame, least_words: int, share: float) -> DataFrame:
    """Join seeds on their hash, keep distinct diagonals and verify each against the words of both sides."""
    test = items.select("item_id", F.explode(F.arrays_zip("hashes", "places")).alias("s")).select("item_id", F.col("s.hashes").alias("hash"), F.col("s.places").alias("item_place"))
    train = near.select("row", "region", F.explode(F.arrays_zip("hashes", "places")).alias("s")).select("row", "region", F.col("s.hashes").alias("hash"), F.col("s.places").alias("place"))
    diagonals = train.join(test, "hash").select(F.col("row").alias("of_row"), F.col("region").alias("of_region"), "item_id", (F.col("place") - F.col("item_place")).alias("diagonal")).distinct()
    sides = (
        diagonals.join(items.select("item_id", F.col("words").alias("item_words")), "item_id")
        .join(near.select("row", "region", "doc_id", "begin", "words"), (F.col("row") == F.col("of_row")) & (F.col("region") == F.col("of_region")))
        .select("row", "doc_id", "item_id", "diagonal", "begin", "words", "item_words")
    )

    def verify(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for row, doc_id, item_id, diagonal, begin, words, wanted in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            words, wanted = np.array(words, dtype=np.int64), np.array(wanted, dtype=np.int64)
            low, high = max(0, begin - diagonal), min(wanted.size, begin + words.size - diagonal)
            if high <= low:
                continue
            same = words[low + diagonal - begin : high + diagonal - begin] == wanted[low:high]
            a, b, matched = best_run(same, share)
            if matched >= min(least_words, int(np.ceil(share * wanted.size - 1e-9))):
                rows.append((row, doc_id, item_id, low + a + diagonal, b - a, matched))
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(6)], names=["row", "doc_id", "item_id", "first_word", "n_words", "n_matched"])

    return map_batches(sides, verify, LEAKS)


def clean_documents(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of `docs`, with all their columns, that hold no test item.

    Rows are numbered in a staged copy, so a leak takes out its own row and not others with the same id.
    """
    names = docs.columns
    numbered = staged(docs.select(F.monotonically_increasing_id().alias("leak_row"), F.struct(*[F.col(f"`{c}`") for c in names]).alias("leak_doc")), "leak-rows")
    plain = numbered.select("leak_row", F.col(f"leak_doc.`{id_col}`").alias("doc_id"), F.col(f"leak_doc.`{text_col}`").alias("text"))
    leaks = find_leaks(plain, benchmark, row_col="leak_row", **options).select(F.col("row").alias("leak_row")).distinct()
    return numbered.join(leaks, "leak_row", "left_anti").select("leak_doc.*")
