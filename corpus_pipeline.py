"""A corpus from raw documents: quality, near duplicates, repeated passages, benchmark leaks, mixture.

Every stage takes (spark, docs, sf_dir) and returns documents; it is written as Parquet and read again before the
next one. The last stage adds how often and when a document is taken.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quadweld.llm import decontaminate, line_quality, mixing, recompression, simhash
from quadweld.llm.tables import read
from quadweld.operators import stage

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a quality of at least 0.5; the chain is learned from labelled documents."""
    return line_quality.good_documents(docs.select(*COLUMNS), read(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts of a similarity of 0.8 or more in five-word shingles, that with the least doc_id."""
    return simhash.deduplicate(docs.select(*COLUMNS))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of 20 words and more that stand earlier; documents of nothing else go."""
    return recompression.without_repeats(docs.select(*COLUMNS))


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of ten words and more of a test item; documents that are mostly such go."""
    return decontaminate.decontaminate(docs.select(*COLUMNS), read(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes, with their copies, sorted by when the first one comes."""
    return mixing.mixed_documents(docs.select(*COLUMNS))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality),
    ("SimHash near-dedup", near_duplicates),
    ("substring dedup", repeated_passages),
    ("benchmark decontamination", benchmark_leaks),
    ("mixing sources to target weights", mixture),
]

#: SQL can express neither the learned stage nor what follows from it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of ``sf_dir``; each is written to the shared folder."""
    docs = read(spark, sf_dir, "documents")
    folder = f"{stage.scratch_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (_, apply) in enumerate(STAGES):
        # What a stage writes on its way goes when its result stands.
        with stage.writing_to(f"{folder}/work-{k}"):
            apply(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        stage.remove(spark, f"{folder}/work-{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs
