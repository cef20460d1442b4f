"""From raw documents to a mix of clean ones: five stages, each written to shared storage and read by the next.

``run(spark, sf_dir)`` applies STAGES to the documents of a table folder. The stages keep all columns of the documents,
the last one adds ``copies`` and ``taken``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.llm import mixing, pii, quality, simhash, stages, tiling
from folioscope.llm.common import fold, ready, stored, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality classifier rejects go; it learns from labels outside fold 0 of 5."""
    ready(spark)
    labels = table(spark, sf_dir, "labels").where(fold(F.col("doc_id"), 5) != 0)
    return stages.drop_low_quality(docs, quality.learn_quality(docs, labels, quality.QualityParams()))


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return simhash.drop_near_copies(docs)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return tiling.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and secrets are replaced by their kind; ``n_chars`` follows the new text where it is a column."""
    clean = pii.redact(docs)
    if "n_chars" in clean.columns:
        clean = clean.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return clean


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the mix takes stay, with the number of copies and the words taken."""
    return stages.mixed(docs, mixing.MixParams())


STAGES = [
    ("quality", quality_stage),
    ("simhash", simhash_stage),
    ("decontaminate", decontaminate_stage),
    ("pii", pii_stage),
    ("mix", mix_stage),
]

# no SQL for the fitted classifier and the hashes; tests compare the stages with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
