"""From raw documents to packed training batches: quality filter, near-dedup, decontamination, redaction, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the one before kept. All but the last return the columns
of `documents`; the last returns a row per packed sequence.
"""

from __future__ import annotations

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

import skyherald
from skyherald.llm.common import stored
from skyherald.llm.decontaminate import drop_contaminated
from skyherald.llm.jaccard import drop_near_copies
from skyherald.llm.packing import packed
from skyherald.llm.pii import redact
from skyherald.llm.quality import keep_good
from skyherald.session import SETTINGS

# tasks get the package with the functions they run
cloudpickle.register_pickle_by_value(skyherald)

# Documents whose sets of five-word shingles have a Jaccard similarity of this or more are near copies.
NEAR_SHINGLE, NEAR_LEAST = 5, 0.8


def _small_batches(spark: SparkSession) -> None:
    """Python workers get the Arrow batches of the jobs' sessions, also in a session that somebody else built and that says
    nothing of them: else 10,000 texts at once, held by the worker and by the executor beside its heap. The stages are lazy, so
    it stays set."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, SETTINGS[key])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the weighed votes reject go."""
    return keep_good(docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of copies and near copies, by exact similarity, stays: that with the smallest id."""
    return drop_near_copies(docs, shingle=NEAR_SHINGLE, least=NEAR_LEAST)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, also with a few edits, go."""
    _small_batches(spark)
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pii_redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data give way to the name of their kind in brackets; `n_chars` is that of the new text."""
    _small_batches(spark)
    return redact(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each document, or piece of a long one, goes: bucket, batch and slot."""
    return packed(docs, carry=["doc_id"])


STAGES = [
    ("quality_rules", quality_rules), ("simhash_dedup", simhash_dedup), ("decontamination", decontamination),
    ("pii_redaction", pii_redaction), ("packing", packing),
]
# models fitted by expectation-maximisation are not SQL: the stages are tested against plain versions instead
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written as Parquet below the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
