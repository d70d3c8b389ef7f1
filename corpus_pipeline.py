"""The training-corpus pipeline: five stages over `documents`, each one operator applied to all that the stage before kept.

Every function takes (spark, docs, sf_dir) and gives the columns of `documents` back, the last one the token counts and
digests.  `run` writes each stage below the shared folder and reads it again, so a lost executor costs a stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressloom.llm import chunked_bpe, decontaminate, near_duplicates, personal_data, quality_classifier
from pressloom.llm.common import table
from pressloom.session import StepTables


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality_classifier.accepted(docs, table(spark, sf_dir, "labels"))


def single(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of five-word Jaccard similarity 0.8 or more stays, that with the smallest number.

    SimHash and its BK-trees find the near pairs, an exact search those beyond their radius; each is checked on both sets."""
    return near_duplicates.one_of_each(docs)


def contamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontaminate.remove_documents(docs, table(spark, sf_dir, "benchmark"))


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind; n_chars, where it is known, follows the new text."""
    clean = personal_data.redact(docs)
    if "n_chars" not in docs.columns:
        return clean
    return clean.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.length("text").cast(docs.schema["n_chars"].dataType)))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token count and digests of every document that is left."""
    return chunked_bpe.report(docs)


STAGES = [
    ("quality classifier", quality),
    ("near-dedup", single),
    ("benchmark decontamination", contamination),
    ("personal data", private),
    ("bpe encoding", encoded),
]

#: SQL can express neither the trained stages nor the fingerprints; tests/llm/test_pipeline.py has plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    steps = StepTables(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = steps.save(docs, name.replace(" ", "-"))
    return docs
