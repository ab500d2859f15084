"""Language identification by the nearest of several centroids per language.

A text is a vector of hashed character n-grams (one to three characters), damped, weighted by inverse document frequency and
normalised. The frequencies come from all training texts. The vectors of a bounded sample of each language are
clustered by spherical k-means; a text gets the language of the centroid with the highest cosine. A text
that is further from its centroid than nearly all sampled training texts of that centroid is rejected.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starmart.llm.common import map_batches

SALTS = 32
BUCKETS = 2048
MULTIPLIERS = np.array([2654435761, 2246822519, 3266489917], dtype=np.uint32)
UNKNOWN = "und"


def grams(text: str) -> np.ndarray:
    """Counts of hashed n-grams of the lower-cased text; runs of what is no letter count as one space."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    letters = points.copy()
    ascii_other = (points < 128) & ~((points >= 97) & (points <= 122))
    letters[ascii_other] = 32
    keep = np.ones(letters.size, dtype=bool)
    keep[1:] = (letters[1:] != 32) | (letters[:-1] != 32)
    c = letters[keep] * MULTIPLIERS[0]
    c ^= c >> np.uint32(15)
    counts = np.bincount(c >> np.uint32(21), minlength=BUCKETS)
    if c.size > 1:
        pair = c[:-1] * MULTIPLIERS[1] + c[1:]
        counts += np.bincount((pair * MULTIPLIERS[0]) >> np.uint32(21), minlength=BUCKETS)
    if c.size > 2:
        triple = pair[:-1] * MULTIPLIERS[2] + c[2:]
        counts += np.bincount((triple * MULTIPLIERS[0]) >> np.uint32(21), minlength=BUCKETS)
    return counts


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def normalised(vectors: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(vectors, axis=-1, keepdims=True)
    return vectors / np.where(length == 0, 1, length)


def vector(text: str, idf: np.ndarray) -> np.ndarray:
    return normalised(np.log1p(grams(text)) * idf)


@dataclass(frozen=True)
class Centroids:
    """Unit centroids, the language and the lowest accepted cosine of each, and the idf weights."""

    languages: tuple[str, ...]
    centres: np.ndarray
    least: np.ndarray
    idf: np.ndarray


def inverse_frequencies(train: DataFrame) -> np.ndarray:
    """ln((1 + n) / (1 + df)) + 1 per bucket over all training texts; partial sums per task."""

    def work(batches):
        found, rows = np.zeros(BUCKETS, dtype=np.int64), 0
        for batch in batches:
            for text in batch.column(0):
                found += grams(text.as_py()) > 0
                rows += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(BUCKETS + 1, dtype=np.int32)), pa.array(np.append(found, rows))], names=["bucket", "n"]
        )

    counts = train.select("text").mapInArrow(work, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    total = np.zeros(BUCKETS + 1)
    for bucket, n in counts.collect():  # BUCKETS + 1 rows
        total[bucket] = n
    return np.log((1 + total[-1]) / (1 + total[:-1])) + 1


def cluster(points: np.ndarray, k: int, rounds: int = 12, seed: int = 5) -> np.ndarray:
    """Spherical k-means; the first centres are points far from each other."""
    rng = np.random.default_rng(seed)
    centres = [points[rng.integers(len(points))]]
    while len(centres) < min(k, len(points)):
        nearest = np.max(points @ np.array(centres).T, axis=1)
        centres.append(points[int(np.argmin(nearest))] if rng.random() < 0.1 else points[rng.choice(len(points), p=_spread(nearest))])
    made = np.array(centres)
    for _ in range(rounds):
        nearest = np.argmax(points @ made.T, axis=1)
        made = np.array([normalised(points[nearest == j].sum(axis=0)) if (nearest == j).any() else made[j] for j in range(len(made))])
    return made


def _spread(nearest: np.ndarray) -> np.ndarray:
    weight = np.clip(1 - nearest, 1e-9, None)
    return weight / weight.sum()


def fit(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    fold: int = 4,
    held_out: int = 2,
    per_language: int = 500,
    centroids: int = 4,
    reject_below: float = 0.002,
    max_sample: int = 20_000,
) -> Centroids | None:
    """Learn from rows with a language, a text with a letter and crc32(id as text) mod `fold` other than `held_out`.

    idf counts all of these rows. Clustering uses the `per_language` rows of each language that come first by a hash of the
    id, `max_sample` rows in all at most (16 kB each on the driver). None if there is no such row. Rows with null ids are not learned from.
    """
    remainder = F.crc32(F.col(id_col).cast("string").cast("binary")) % fold
    train = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & (remainder != held_out)).select(
        F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")
    )
    idf = inverse_frequencies(train)
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    # Ids first, so that the ranking moves no text. A language is ranked in SALTS parts and then as a whole, so the last
    # ranking gets at most SALTS * per_language rows of it, however many tasks read the corpus.
    part = Window.partitionBy("lang", "part").orderBy(F.xxhash64("doc_id"), "doc_id")
    parts = train.select("doc_id", "lang", F.pmod(F.hash("doc_id"), F.lit(SALTS)).alias("part"))
    leading = parts.withColumn("nth", F.row_number().over(part)).where(F.col("nth") <= per_language).select("doc_id", "lang")
    first = leading.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= per_language)
    wanted = first.orderBy("nth", "lang").limit(max_sample).select(F.col("doc_id").alias("sample_id")).distinct()

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [(lang, vector(text, idf)) for lang, text in zip(batch.column(1).to_pylist(), batch.column(0).to_pylist(), strict=True) if has_letter(text)]
        data = pa.array([v.astype(np.float32).tobytes() for _, v in rows], pa.binary())
        return pa.RecordBatch.from_arrays([pa.array([x for x, _ in rows], pa.string()), data], names=["lang", "vector"])

    chosen = train.join(F.broadcast(wanted), F.col("doc_id") == F.col("sample_id")).select("text", "lang")
    sample: dict[str, list[np.ndarray]] = {}
    for lang, data in map_batches(chosen, work, "lang string, vector binary").collect():
        sample.setdefault(lang, []).append(np.frombuffer(bytes(data), dtype=np.float32))
    if not sample:
        return None
    languages, centres, least = [], [], []
    for lang in sorted(sample):
        points = np.array(sorted(sample[lang], key=bytes_of)).astype(float)
        made = cluster(points, centroids)
        cosines = points @ made.T
        nearest = np.argmax(cosines, axis=1)
        for j, centre in enumerate(made):
            own = cosines[nearest == j, j]
            languages.append(lang)
            centres.append(centre)
            least.append(float(np.quantile(own, reject_below)) if own.size else 1.0)
    return Centroids(tuple(languages), np.array(centres), np.array(least), idf)


def bytes_of(point: np.ndarray) -> bytes:
    return point.tobytes()


def predict(docs: DataFrame, model: Centroids | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score, rejected: one row per input row; other columns are ignored.

    score is the cosine of the nearest centroid. A null text and one without a letter get `und` and 0, as
    do all rows without a model. `rejected` marks a text that is too far from its centroid; callers
    who want to drop it or call it unknown can.
    """

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(1).to_pylist()
        known = [model is not None and t is not None and has_letter(t) for t in texts]
        langs, scores, rejected = [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts), dtype=bool)
        rows = [i for i, ok in enumerate(known) if ok]
        for begin in range(0, len(rows), 512):
            some = rows[begin : begin + 512]
            cosines = np.array([vector(texts[i], model.idf) for i in some]) @ model.centres.T
            best = np.argmax(cosines, axis=1)
            for i, j, cosine in zip(some, best, cosines[np.arange(len(some)), best], strict=True):
                langs[i], scores[i], rejected[i] = model.languages[j], min(1.0, max(0.0, float(cosine))), cosine < model.least[j]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(langs, pa.string()), pa.array(scores), pa.array(rejected)],
            names=["doc_id", "lang_pred", "score", "rejected"],
        )

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return map_batches(source, work, "doc_id long, lang_pred string, score double, rejected boolean")


def language_of(docs: DataFrame, **options) -> DataFrame:
    """Fit on `docs` and predict all of them, the held-out rows marked (a null id is not held out)."""
    predicted = predict(docs, fit(docs, **options))
    remainder = F.crc32(F.col("doc_id").cast("string").cast("binary")) % options.get("fold", 4)
    return predicted.withColumn("held_out", F.coalesce(remainder == options.get("held_out", 2), F.lit(False)))
