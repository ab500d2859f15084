"""A training corpus from documents in stages; each is written as Parquet and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starmart.llm.common import recorded, remove, staged, table
from starmart.llm.decontaminate import clean_documents
from starmart.llm.jaccard import one_of_each
from starmart.llm.mixing import mixed_documents
from starmart.llm.quality import good_documents
from starmart.llm.queries import word_tokenizer
from starmart.llm.tokens import read_index, token_digest, write_tokens


#: Tables that each stage has staged, to be removed when the next one begins: the rows built on them are written by then.
_STAGED: dict[str, list[str]] = {}


def _after(earlier: str | None):
    """A stage that follows another one: what that one staged for itself is removed first, unless ``docs`` is still read from it."""

    def decorate(stage):
        def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
            paths = _STAGED.pop(earlier, [])
            if paths:
                read = docs.inputFiles()
                for path in paths:
                    if not any(path.removeprefix("file://") in file for file in read):
                        remove(spark, path)
            with recorded(_STAGED.setdefault(stage.__name__, [])):
                return stage(spark, docs, sf_dir)

        run_stage.__name__, run_stage.__doc__ = stage.__name__, stage.__doc__
        return run_stage

    return decorate


@_after(None)
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return good_documents(docs, table(spark, sf_dir, "labels"))


@_after("quality")
def jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return one_of_each(docs)


@_after("jaccard")
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark items."""
    return clean_documents(docs, table(spark, sf_dir, "benchmark"))


@_after("decontamination")
def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mixed_documents(docs)


@_after("mixing")
def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in files, and what a reader finds in them."""
    return token_digest(read_index(spark, write_tokens(docs, word_tokenizer())))


STAGES = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", jaccard),
    ("benchmark decontamination", decontamination),
    ("mixing sources to target weights", mixing),
    ("token-ID / binary output", token_output),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), "pipeline")
    return STAGES[-1][1](spark, docs, sf_dir)


#: Trained scores, tokenization and links by shingles can't be written in SQL.
ORACLE_SQL = None
