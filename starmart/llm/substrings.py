"""Removal of repeated byte strings by bucket-pointer refinement over sampled suffixes.

Suffixes are sorted into buckets by their first q bytes, and buckets with more than one suffix are refined
by the bucket identifiers that stand q, then 2q bytes later, so that known lengths double with each round and
refined identifiers are used again for the next. An identifier is made from the two identifiers that it joins, so a round
is local to a document; what needs the whole corpus is only which buckets hold more than one suffix.

Not all suffixes are sorted. In every string of LENGTH bytes the place with the smallest q-byte identifier is its
anchor; equal strings have equal anchors. So only anchors are put in the first buckets, each with the
range of strings that it stands for, about one in fifty places. An anchor alone in its bucket is done, and all its strings are unique. The
others are refined by the identifier of all their strings together: members of a refined bucket with several anchors are
repeated as a whole. Where a bucket of q bytes holds several refined ones, the single strings are counted, from
one anchor of each.

Strings are told apart by the 64-bit identifiers of their anchor and of all their bytes together.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import staged
from starmart.llm.tokens import slices

LENGTH = 200
#: First buckets: LENGTH / 2**REFINED bytes; anchors have half of LENGTH.
REFINED = 3
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], dtype=np.uint64)


def joined(first: np.ndarray, later: np.ndarray, nth: int) -> np.ndarray:
    """Identifiers of the strings whose halves have these two."""
    made = (first ^ (first >> np.uint64(31))) * _FACTORS[nth % 4] + later
    made ^= made >> np.uint64(29)
    made *= np.uint64(0xBF58476D1CE4E5B9)
    return made ^ (made >> np.uint64(32))


def identifiers(raw: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """For each place, identifiers of the length / 2 and length bytes that begin there."""
    size = length >> REFINED
    n = raw.size - size + 1
    # The first buckets: a polynomial over `size` bytes, by powers so that it takes few passes.
    known, built = raw.astype(np.uint64) + np.uint64(1), 1
    for bit in bin(size)[3:]:
        known = joined(known[:-built], known[built:], 0)
        built *= 2
        if bit == "1":
            known = joined(known[: raw.size - built], raw[built:].astype(np.uint64) + np.uint64(257), 1)
            built += 1
    assert built == size and known.size == n
    half = known
    for nth in range(REFINED):
        half = known
        known = joined(known[:-size], known[size:], nth + 2)
        size *= 2
    return half, known


def sliding_minimum(keys: np.ndarray, width: int) -> np.ndarray:
    built, least = 1, keys
    while built * 2 <= width:
        least = np.minimum(least[:-built], least[built:])
        built *= 2
    rest = width - built
    return np.minimum(least[: least.size - rest], least[rest:]) if rest else least


def anchors(raw: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """bucket, refined, low, high, strings: per anchor the identifier of its bytes and of all its strings, the range of
    starts of its strings; and the identifiers of all strings of the document.
    """
    if raw.size < length:
        none = np.zeros(0, dtype=np.uint64)
        return none, none, none.astype(np.int64), none.astype(np.int64), none
    half, strings = identifiers(raw, length)
    width = length - length // 2 + 1
    # The upper half of the identifier, then the place: the first of equal minima, in any document alike.
    bits = np.uint64(32)
    keys = ((half >> bits) << bits) | np.arange(half.size, dtype=np.uint64)
    anchor = (sliding_minimum(keys, width) & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    low = np.concatenate([[0], np.flatnonzero(np.diff(anchor)) + 1])
    high = np.concatenate([low[1:] - 1, [anchor.size - 1]])
    at = anchor[low]
    shape = (at - low).astype(np.uint64) * np.uint64(1024) + (high - low).astype(np.uint64)
    refined = joined(joined(strings[low], strings[high], 0), shape, 3)
    return half[at], refined, low, high, strings


def signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def _bytes_of(texts: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer((t or "").encode("utf-8", "surrogatepass"), dtype=np.uint8) for t in texts.to_pylist()]


def all_anchors(docs: DataFrame) -> DataFrame:
    """bucket, refined, row, low, high of every anchor of (row, text)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(pa.compute.binary_length(batch.column(1)).to_pylist()):
                made = [anchors(raw)[:4] for raw in _bytes_of(batch.column(1).slice(a, b - a))]
                rows = np.repeat(batch.column(0).slice(a, b - a).to_numpy(), [x[0].size for x in made])
                bucket, refined, low, high = (np.concatenate(x) for x in zip(*made, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [signed(bucket), signed(refined), pa.array(rows), pa.array(low.astype(np.int32)), pa.array(high.astype(np.int32))],
                    names=["bucket", "refined", "row", "low", "high"],
                )

    return docs.mapInArrow(work, "bucket long, refined long, row long, low int, high int")


def single_strings(docs: DataFrame, ranges: DataFrame) -> DataFrame:
    """bucket, string, row, start of every string in the ranges (bucket, low, high) of a row.

    Repeated rows give their strings once each, and have no string to themselves.
    """
    lists = ranges.groupBy(F.col("row").alias("of_row")).agg(F.collect_list(F.struct("bucket", "low", "high")).alias("ranges"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            for row, text, wanted in zip(*(batch.column(i) for i in range(3)), strict=True):
                _, strings = identifiers(_bytes_of(pa.array([text.as_py()]))[0])
                for begin in range(0, len(wanted), 20_000):
                    some = wanted.values.slice(begin, 20_000)
                    bucket, low, high = (some.field(k).to_numpy() for k in range(3))
                    many = high - low + 1
                    start = np.repeat(low - (np.cumsum(many) - many), many) + np.arange(many.sum())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.repeat(bucket, many)), signed(strings[start]), pa.array(np.full(start.size, row.as_py())), pa.array(start.astype(np.int32))],
                        names=["bucket", "string", "row", "start"],
                    )

    met = docs.join(lists, F.col("row") == F.col("of_row")).select("row", "text", "ranges")
    return met.mapInArrow(work, "bucket long, string long, row long, start int")


def repeated_ranges(docs: DataFrame) -> DataFrame:
    """row, low, high: ranges of starts of strings that also start elsewhere, from (row, text); equal rows have equal numbers."""
    # Read twice, and made anew each time: a written copy would be as large as the corpus is packed.
    found = all_anchors(docs)
    buckets = (
        found.groupBy(F.col("bucket").alias("of_bucket"))
        .agg(F.count("*").alias("n"), F.min("refined").alias("least"), F.max("refined").alias("most"))
        .where("n > 1")
        .select("of_bucket", (F.col("least") != F.col("most")).alias("mixed"))
    )
    shared = staged(found.join(buckets, F.col("bucket") == F.col("of_bucket")).drop("of_bucket"), "anchors-shared")
    whole = shared.where("not mixed").select("row", "low", "high")
    mixed = shared.where("mixed")
    classes = staged(
        mixed.groupBy("bucket", "refined").agg(F.count("*").alias("n"), F.min(F.struct("row", "low", "high")).alias("one")), "anchor-classes"
    )
    several = classes.where("n > 1").select(F.col("bucket").alias("of_bucket"), F.col("refined").alias("of_refined"))
    also_whole = staged(
        mixed.join(several, (F.col("bucket") == F.col("of_bucket")) & (F.col("refined") == F.col("of_refined"))).select("row", "low", "high"),
        "repeat-classes",
    )
    # One anchor of each class gives its strings. Those of classes with several are removed anyway, and only lend their strings.
    strings = staged(single_strings(docs, classes.select("bucket", "one.row", "one.low", "one.high")), "strings")
    twice = strings.groupBy(F.col("bucket").alias("of_bucket"), F.col("string").alias("of_string")).agg(F.count("*").alias("n")).where("n > 1")
    single = staged(
        strings.join(twice, (F.col("bucket") == F.col("of_bucket")) & (F.col("string") == F.col("of_string"))).select("row", F.col("start").alias("low"), F.col("start").alias("high")),
        "repeat-strings",
    )
    return whole.unionByName(also_whole).unionByName(single)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept: one row per input row; kept has the bytes that are left.

    Each byte goes that a string of LENGTH bytes covers which also starts at any other place of any row, the row
    itself included. Null and empty texts have no bytes, and texts shorter than LENGTH lose none. Rows are known
    by a hash of id and text, so ids may be null or repeat; repeated rows remove each other. Other columns are ignored.
    """
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = source.select(F.xxhash64("doc_id", "text").alias("row"), "doc_id", "text")
    ranges = repeated_ranges(rows.select("row", "text"))
    # Repeated rows have the same ranges, so a set has no more of them than one row.
    lists = ranges.groupBy(F.col("row").alias("of_row")).agg(F.collect_set(F.struct("low", "high")).alias("ranges"))
    met = rows.join(staged(lists, "repeat-lists"), F.col("row") == F.col("of_row"), "left").select("doc_id", "text", "ranges.low", "ranges.high")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(pa.compute.binary_length(batch.column(1)).to_pylist()):
                some = batch.slice(a, b - a)
                sizes, removed, spans, kept = [], [], [], []
                for raw, lows, highs in zip(_bytes_of(some.column(1)), some.column(2), some.column(3), strict=True):
                    gone = covered(raw.size, lows, highs)
                    sizes.append(raw.size)
                    removed.append(int(gone.sum()))
                    spans.append(int(np.count_nonzero(gone & ~np.concatenate([[False], gone[:-1]])) if raw.size else 0))
                    kept.append(raw[~gone].tobytes())
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), *(pa.array(x, pa.int64()) for x in (sizes, removed, spans)), pa.array(kept, pa.binary())],
                    names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
                )

    return met.mapInArrow(work, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def covered(size: int, lows: pa.ListScalar, highs: pa.ListScalar) -> np.ndarray:
    """Which bytes lie in a string that starts in one of the ranges."""
    if not lows.is_valid or size == 0:
        return np.zeros(size, dtype=bool)
    steps = np.zeros(size + 1, dtype=np.int64)
    np.add.at(steps, lows.values.to_numpy(), 1)
    np.add.at(steps, np.minimum(highs.values.to_numpy() + LENGTH, size), -1)
    return np.cumsum(steps[:-1]) > 0


def digest(kept: DataFrame) -> DataFrame:
    """The result with the sha256 of the bytes that are left in place of them."""
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
