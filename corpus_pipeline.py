"""A corpus pipeline of the training-data operators.

``STAGES`` holds (name, function) pairs in order. Each function takes
``(spark, docs, sf_dir)`` and returns a frame, which is written as Parquet and
read again as the next one's ``docs``; all but the last return the columns of
``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stationflow.llm.decontaminate import drop_contaminated
from stationflow.llm.jaccard_join import drop_near_copies
from stationflow.llm.mixing import mix_sources
from stationflow.llm.quality_rules import drop_low_quality
from stationflow.llm.secret_scan import redact_secrets
from stationflow.llm.shared import ship_package, stored

#: The stage's near copies (op7's own query compares three-word shingles at 0.9).
NEAR_WORDS, NEAR_PERCENT = 5, 80


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    ship_package(spark)
    return drop_low_quality(docs)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the smallest doc_id. Near is
    a Jaccard of 0.8 or more over five-word shingles."""
    ship_package(spark)
    return drop_near_copies(docs, words=NEAR_WORDS, percent=NEAR_PERCENT)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark items."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, found secrets replaced by a mark."""
    return redact_secrets(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes words of, and how many words."""
    ship_package(spark)
    return mix_sources(docs).where("taken > 0")


STAGES = [
    ("quality_rules", quality_rules),
    ("jaccard_join", jaccard_join),
    ("decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("mixing", mixing),
]

#: Robust estimates, components and seeded blocks are beyond one SQL query; the
#: tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
