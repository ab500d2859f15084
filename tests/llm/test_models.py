"""Quality, language and their defined results for awkward rows."""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import functions as F

from starmart.llm import langid, quality
from starmart.llm.queries import QUERIES
from tests.llm import corpus

FOLDER = "/root/testdata/sf0.1"


def test_held_out_quality(spark):
    got = QUERIES["op9_quadratic_discriminant"](spark, FOLDER)
    assert got.count() == 10_000
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").select("doc_id", "quality")
    held = got.where("held_out").join(labels, "doc_id").collect()
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 for r in held)
    assert np.mean([r["predicted"] == r["quality"] for r in held]) > 0.98
    assert np.mean([r["predicted"] for r in held if r["quality"] == 1]) > 0.98
    assert all(0 <= r["score"] <= 1 for r in held)


def test_quality_of_awkward_rows(spark):
    docs = corpus.documents(spark)
    stats = quality.document_statistics(docs)
    assert stats.count() == docs.count()
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"), F.lit("x").alias("stats"))
    model = quality.train(stats, labels)
    scores = [r["score"] for r in quality.score(stats, model).collect()]
    assert len(scores) == docs.count() and all(0 <= s <= 1 for s in scores)
    assert {r["score"] for r in quality.score(stats, None).collect()} == {0.5}
    assert quality.train(stats, labels.where("quality = 1")) is None
    assert quality.good_documents(docs, labels.limit(0)).count() == docs.count()
    assert quality.good_documents(docs, labels).columns == docs.columns
    assert quality.document_statistics(corpus.empty(spark)).count() == 0


def test_held_out_language(spark):
    got = QUERIES["op4_centroid_language"](spark, FOLDER)
    langs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang")
    held = got.where("held_out").join(langs, "doc_id").collect()
    assert got.count() == 10_000 and len(held) > 2000
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2 for r in held)
    assert np.mean([r["lang"] == r["lang_pred"] for r in held]) > 0.99


def test_language_of_awkward_rows(spark):
    docs = corpus.documents(spark)
    got = langid.language_of(docs).collect()
    assert len(got) == docs.count()
    blank = {r["doc_id"] for r in docs.collect() if not any(map(str.isalpha, r["text"] or ""))}
    for row in got:
        assert 0 <= row["score"] <= 1 and row["held_out"] is not None
        if row["doc_id"] is not None:
            assert (row["lang_pred"] == "und") == (row["doc_id"] in blank)
    assert langid.language_of(corpus.empty(spark)).count() == 0
    none = langid.language_of(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {r["lang_pred"] for r in none.collect()} == {"und"}


def test_far_texts_are_rejected(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.fit(docs)
    far = spark.createDataFrame([(1, "жщ " * 200), (2, "zzqx" * 300)], "doc_id long, text string")
    assert all(r["rejected"] for r in langid.predict(far, model).collect())
