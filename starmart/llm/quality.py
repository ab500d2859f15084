"""Quality classifier: regularised quadratic discriminant over document statistics.

Each text becomes a short vector of transformed statistics. The class means and covariances come from sums
that Spark adds up over all labelled rows, so fitting has no sample; only these sums (a few hundred
numbers per class) reach the driver. Covariances are shrunk towards their diagonal and towards the pooled one. A score is the
sigmoid of the difference of the two log densities and log priors, from Mahalanobis distances by Cholesky
factors that are computed once.
"""

from __future__ import annotations

import json
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import map_batches, staged

FEATURES = (
    "log_words", "log_word_length", "word_length_spread", "distinct_words", "repeated_neighbours", "top_word",
    "upper_share", "digit_share", "plain_marks", "other_marks", "bars", "log_line_words", "distinct_lines",
    "sentence_ends", "wide_share", "distinct_pairs",
)
_CLASS = np.zeros(256, dtype=np.int64)  # 0 lower and rest, 1 upper, 2 digit, 3 plain mark, 4 other mark, 5 bar, 6 space, 7 wide
_CLASS[ord("A") : ord("Z") + 1] = 1
_CLASS[ord("0") : ord("9") + 1] = 2
_CLASS[[i for i in range(33, 127) if not chr(i).isalnum()]] = 4
_CLASS[[ord(c) for c in ".,;:'\"?-()"]] = 3
_CLASS[ord("|")] = 5
_CLASS[[9, 10, 11, 12, 13, 32]] = 6
_CLASS[128:] = 7


def statistics(text: str | None) -> list[float]:
    """The raw vector of one text; a null or blank text is all zeros."""
    words = (text or "").split()
    if not words:
        return [0.0] * len(FEATURES)
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
    kinds = np.bincount(_CLASS, np.bincount(raw, minlength=256), 8)
    n, solid = len(words), max(1.0, raw.size - kinds[6])
    lengths = np.fromiter(map(len, words), dtype=np.float64, count=n)
    counts = Counter(words)
    lines = [line for line in text.split("\n") if line.strip()]
    capitals = sum(map(str.isupper, words))
    soft = lambda share, at: float(np.log(share + at) - np.log(at))
    return [
        float(np.log1p(n)),
        float(np.log(lengths.mean())),
        float(lengths.std() / lengths.mean()),
        len(counts) / n,
        soft(sum(a == b for a, b in zip(words, words[1:], strict=False)) / n, 0.02),
        soft(max(counts.values()) / n, 0.05),
        soft(capitals / n, 0.02),
        soft(kinds[2] / solid, 0.01),
        soft(kinds[3] / solid, 0.02),
        soft(kinds[4] / solid, 0.005),
        soft(kinds[5] / solid, 0.005),
        float(np.log1p(n / len(lines))),
        len(set(lines)) / len(lines),
        soft(sum(word[-1] in ".!?" for word in words) / n, 0.02),
        float(kinds[7] / solid),
        len(set(zip(words, words[1:], strict=False))) / n,
    ]


def document_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, stats: one row per input row, null ids and texts included; other columns are ignored."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        stats = pa.array([statistics(t.as_py()) for t in batch.column(1)], pa.list_(pa.float64()))
        return pa.RecordBatch.from_arrays([batch.column(0), stats], names=["doc_id", "stats"])

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return map_batches(source, work, "doc_id long, stats array<double>")


@dataclass(frozen=True)
class Discriminant:
    """Prior log odds, and mean, inverse Cholesky factor and log determinant of each class."""

    log_odds: float
    means: np.ndarray
    factors: np.ndarray
    log_dets: np.ndarray

    def scores(self, stats: np.ndarray) -> np.ndarray:
        logs = []
        for mean, factor, log_det in zip(self.means, self.factors, self.log_dets, strict=True):
            scaled = (stats - mean) @ factor.T
            logs.append(-0.5 * (scaled * scaled).sum(axis=1) - 0.5 * log_det)
        return 1 / (1 + np.exp(-np.clip(self.log_odds + logs[1] - logs[0], -500, 500)))


def moments(labelled: DataFrame) -> DataFrame:
    """label, cell, total: sums of 1, x and xx' over rows of (label, stats), added up per task first."""

    def work(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            labels = batch.column(0).to_numpy()
            stats = np.array(batch.column(1).to_pylist(), dtype=float).reshape(-1, len(FEATURES))
            ones = np.hstack([np.ones((len(stats), 1)), stats])
            for label in np.unique(labels):
                some = ones[labels == label]
                sums[int(label)] = sums.get(int(label), 0) + some.T @ some
        for label, total in sums.items():
            cells = total.ravel()
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(cells.size, label, np.int32)), pa.array(np.arange(cells.size, dtype=np.int32)), pa.array(cells)],
                names=["label", "cell", "total"],
            )

    return labelled.mapInArrow(work, "label int, cell int, total double").groupBy("label", "cell").agg(F.sum("total").alias("total"))


def fit(labelled: DataFrame, to_diagonal: float = 0.05, to_pooled: float = 0.3) -> Discriminant | None:
    """From (label 0 or 1, stats); None unless both classes have rows."""
    size = len(FEATURES) + 1
    sums = {0: np.zeros(size * size), 1: np.zeros(size * size)}
    for label, cell, total in moments(labelled).collect():  # 2 * 17 * 17 rows
        sums[label][cell] = total
    if any(s[0] == 0 for s in sums.values()):
        return None
    means, spreads, counts = [], [], []
    for s in sums.values():
        square = s.reshape(size, size)
        mean = square[0, 1:] / square[0, 0]
        means.append(mean)
        counts.append(square[0, 0])
        spreads.append(square[1:, 1:] / square[0, 0] - np.outer(mean, mean))
    pooled = sum(n * s for n, s in zip(counts, spreads, strict=True)) / sum(counts)
    factors, log_dets = [], []
    for spread in spreads:
        mixed = (1 - to_pooled) * spread + to_pooled * pooled
        shrunk = (1 - to_diagonal) * mixed + to_diagonal * np.diag(np.diag(mixed)) + 1e-6 * np.eye(size - 1)
        lower = np.linalg.cholesky(shrunk)
        factors.append(np.linalg.inv(lower))
        log_dets.append(2 * np.log(np.diag(lower)).sum())
    return Discriminant(float(np.log(counts[1] / counts[0])), np.array(means), np.array(factors), np.array(log_dets))


def score(stats: DataFrame, model: Discriminant | None) -> DataFrame:
    """doc_id, score of rows of (doc_id, stats); 0.5 for all without a model."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = np.array(batch.column(1).to_pylist(), dtype=float).reshape(-1, len(FEATURES))
        made = model.scores(rows) if model else np.full(len(rows), 0.5)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(made)], names=["doc_id", "score"])

    return map_batches(stats.select("doc_id", "stats"), work, "doc_id long, score double")


def train(stats: DataFrame, labels: DataFrame, fold: int = 5, id_col: str = "doc_id", label_col: str = "quality") -> Discriminant | None:
    """Fit on labelled rows whose crc32(id as text) mod `fold` is not 0.

    Null ids and labels other than 0 and 1 are left out; an id that is labelled twice counts twice.
    """
    known = labels.select(F.col(id_col).cast("long").alias("label_id"), F.col(label_col).cast("int").alias("label"))
    known = known.where(F.col("label").isin(0, 1) & (F.crc32(F.col("label_id").cast("string").cast("binary")) % fold != 0))
    return fit(stats.join(known, F.col("doc_id") == F.col("label_id")).select("label", "stats"))


def good_documents(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = 0.3
) -> DataFrame:
    """The rows of `docs`, with all their columns, whose score is `least` or more; all without labels of both classes."""
    model = train(staged(document_statistics(docs, id_col, text_col), "quality-stats"), labels)

    def accepted(batches):
        for batch in batches:
            rows = np.array([statistics(t.as_py()) for t in batch.column(batch.schema.get_field_index(text_col))]).reshape(-1, len(FEATURES))
            keep = model.scores(rows) >= least if model else np.ones(len(rows), dtype=bool)
            yield batch.filter(pa.array(keep))

    return docs.mapInArrow(accepted, docs.schema)


def describe(model: Discriminant) -> str:
    """The means of both classes as JSON, to look at."""
    return json.dumps({name: [round(float(m[i]), 3) for m in model.means] for i, name in enumerate(FEATURES)})
