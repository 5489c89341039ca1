"""The corpus pipeline: each stage calls one operator on all that the stage before it kept.

Every stage's result is written as Parquet in the shared folder and read again as
the next stage's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarry.llm.exact_dedup import exact_dedup
from quarry.llm.mixing import mixed_rows
from quarry.llm.pieces import encoded
from quarry.llm.quality_trees import accepted
from quarry.llm.queries import piece_model, table
from quarry.llm.simhash import near_dedup
from quarry.operators.staging import collected, remove
from quarry.session import staging_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labelled rows among them, accepts."""
    return accepted(docs, table(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose text is equal but for white space, the longest stays."""
    return exact_dedup(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked over fingerprints at most 2 bits apart, the first stays."""
    return near_dedup(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixed_rows(docs)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids and the text they decode to, beside the documents' other columns."""
    return encoded(docs, piece_model())


STAGES = [
    ("quality classifier", quality),
    ("exact dedup", exact),
    ("simhash near-dedup", near),
    ("mixing sources to target weights", mixing),
    ("sentencepiece encoding and decoding", pieces),
]

# Fingerprints, the classifier's scores and the encoded ids are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``. What a stage staged, and its predecessor's result, is
    deleted once its own result is written."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = staging_path(spark, f"pipeline-{name.replace(' ', '-')}")
        with collected() as held:
            stage(spark, docs, sf_dir).write.parquet(path)
        for staged in held:
            staged.drop()
        if before:
            remove(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
