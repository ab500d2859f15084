"""The pipeline stage by stage against plain definitions."""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from starmart.llm.common import staged
from starmart.llm.mixing import pareto_mix
from starmart.llm.queries import QUERIES, word_tokenizer
from tests.llm.test_jaccard import brute as components
from tests.llm.test_overlap import brute as leaks

FOLDER = "/root/testdata/sf0.001"


def test_stages_take_effect(spark):
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, steps = docs.columns, dict(corpus_pipeline.STAGES)
    assert len(steps) == 5
    quality, jaccard, decontamination, mixing, tokens = steps.values()
    good = {r["doc_id"] for r in QUERIES["op9_quadratic_discriminant"](spark, FOLDER).where("predicted = 1").collect()}
    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]

    docs = staged(quality(spark, docs, FOLDER), "test-stage")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert docs.columns == columns and {i for i, _ in rows} == good

    docs = staged(jaccard(spark, docs, FOLDER), "test-stage")
    first = {c for _, _, c in components(rows)}
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert docs.columns == columns and sorted(i for i, _ in rows) == sorted(first)

    docs = staged(decontamination(spark, docs, FOLDER), "test-stage")
    bad = {i for i, _ in leaks(rows, items)}
    assert docs.columns == columns and bad
    assert sorted(r["doc_id"] for r in docs.collect()) == sorted(i for i, _ in rows if i not in bad)

    copies = {r["doc_id"]: r["copies"] for r in pareto_mix(docs).collect() if r["copies"]}
    docs = staged(mixing(spark, docs, FOLDER), "test-stage")
    assert docs.columns == columns and Counter(r["doc_id"] for r in docs.collect()) == copies

    library, start = Tokenizer.from_file(word_tokenizer()), 0
    rows = sorted((r["doc_id"], r["text"]) for r in docs.collect())
    wanted = []
    for doc_id, text in rows:
        ids = [*library.encode(text, add_special_tokens=False).ids, 1]
        wanted.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, tokens(spark, docs, FOLDER).collect())) == wanted
    assert sorted(map(tuple, contract.queries()["pipeline"](spark, FOLDER).collect())) == wanted


def folder_of(spark, path, documents, labels, benchmark):
    for name, df in (("documents", documents), ("labels", labels), ("benchmark", benchmark)):
        df.write.parquet(f"{path}/{name}.parquet")
    return str(path)


def test_awkward_rows_pass_all_stages(spark, tmp_path):
    """Null ids and texts, empty and very long texts, repeated rows, and columns named like those that the stages make."""
    given = {name: spark.read.parquet(f"{FOLDER}/{name}.parquet") for name in ("documents", "labels", "benchmark")}
    docs = given["documents"]
    text, doc_id = docs.schema["text"].dataType, docs.schema["doc_id"].dataType
    some = docs.orderBy("doc_id").limit(20)
    awkward = (
        docs.unionByName(some)
        .unionByName(some.withColumn("doc_id", F.lit(None).cast(doc_id)))
        .unionByName(some.limit(3).withColumn("doc_id", F.col("doc_id") + 1_000_000).withColumn("text", F.lit(None).cast(text)))
        .unionByName(some.limit(3).withColumn("doc_id", F.lit(None).cast(doc_id)).withColumn("text", F.lit("")).withColumn("source", F.lit(None).cast("string")))
        .unionByName(some.limit(2).withColumn("doc_id", F.col("doc_id") + 2_000_000).withColumn("text", F.repeat("text", 400)))
    )
    awkward = awkward.withColumns({name: F.lit(value) for name, value in (("row", 7), ("words", "w"), ("size", 2.5), ("score", "x"), ("copies", 1), ("cls", 3))})
    folder = folder_of(spark, tmp_path, awkward, given["labels"], given["benchmark"])
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, before = docs.columns, {tuple(r) for r in docs.collect()}
    steps = [step for _, step in corpus_pipeline.STAGES]
    for nth, step in enumerate(steps[:-1]):
        docs = staged(step(spark, docs, folder), "test-stage")
        rows = [tuple(r) for r in docs.collect()]
        assert docs.columns == columns and rows and set(rows) <= before
        before = set(rows)
        if nth == 1:
            texts = [r["text"] for r in docs.collect() if r["text"] and r["text"].strip()]
            assert len(texts) == len(set(texts)) > 0
    made = steps[-1](spark, docs, folder).collect()
    assert Counter(r["doc_id"] for r in made) == Counter(r["doc_id"] for r in docs.collect())
    spans = sorted((r["start"], r["start"] + r["n_tokens"]) for r in made)
    assert spans[0][0] == 0 and all(a[1] == b[0] for a, b in zip(spans, spans[1:], strict=False))


def test_empty_tables_pass_all_stages(spark, tmp_path):
    empty = [spark.read.parquet(f"{FOLDER}/{name}.parquet").limit(0) for name in ("documents", "labels", "benchmark")]
    made = corpus_pipeline.run(spark, folder_of(spark, tmp_path, *empty))
    assert made.columns[:4] == ["doc_id", "start", "n_tokens", "ids_crc32"] and made.count() == 0


def test_every_operator_has_a_query():
    names = {name.split("_")[0] for name in QUERIES}
    assert names == {f"op{n}" for n in range(1, 14)}
    assert set(QUERIES) | {"pipeline"} <= set(contract.queries())
