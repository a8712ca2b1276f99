"""A training corpus from raw documents: filter, deduplicate, decontaminate, mask, pack.

Each stage takes the documents that the one before it kept, and its decisions take effect. Between
stages the documents are written as Parquet in the shared folder and read again. All stages but the
last return the columns of their input. A stage first frees the scratch tables of the one before it,
whose result is written by then. Rows with a null doc_id are rows like others: copies and benchmark
passages among them go too.
"""

from __future__ import annotations

import functools
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.llm import decontamination, jaccard_join, packing, quality, surrogates
from riskweave.llm.common import prepare, read
from riskweave.session import kept_tables, release, shared_folder

#: Where the scratch tables of the last stage begin; empty before the first.
_begun: list[int] = []


def stage(function):
    """A stage that frees what the last stage kept, but for tables that its input still reads."""

    @functools.wraps(function)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        if _begun:
            release(spark, docs, since=min(_begun.pop(), kept_tables()))
        _begun.append(kept_tables())
        return function(spark, docs, sf_dir)

    return run


@stage
def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality classifier: documents that it rejects go."""
    return quality.keep(docs, read(spark, sf_dir, "labels"))


@stage
def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join: of each group, the document with the smallest doc_id stays, once.

    A document without an id gets a number above all ids, by its text, for the time of the stage: it
    joins groups as any other and never takes the place of one with an id.
    """
    return jaccard_join.keep_one(docs)


@stage
def keep_uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: documents with a window like a benchmark item go."""
    return decontamination.clean(docs, read(spark, sf_dir, "benchmark"))


@stage
def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """PII: entities give way to surrogates; n_chars follows the text."""
    out = surrogates.replaced(docs)
    chars = F.when(F.col("_entities") > 0, F.length("text")).otherwise(F.col("n_chars")).cast("long")
    return out.withColumn("n_chars", chars).select(docs.columns)


@stage
def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packing: training sequences with their ids.

    The executors' heaps have grown by now, so the Python workers beside them hold little.
    """
    return packing.pack(docs, lean=True)


STAGES = [
    ("quality classifier", keep_good),
    ("n-gram Jaccard join", keep_one_of_each_group),
    ("benchmark decontamination", keep_uncontaminated),
    ("PII", replace_personal_data),
    ("packing", pack_sequences),
]

#: The first stage is a trained model, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    prepare(spark)
    docs = read(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/corpus-pipeline/{uuid.uuid4().hex}"
    for place, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{place}")
        docs = spark.read.parquet(f"{folder}/{place}")
    return docs
