"""The corpus pipeline: toxicity, near-duplicates, decontamination, secrets, and the mix of sources.

Each stage takes all documents its predecessor kept, and its decisions take effect in what it returns. All but
the last return the columns of ``documents``; the last returns the mixed corpus with each document as often as
the mix takes it, numbered in ``copy``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from entity_events.llm import decontaminate, language, mixing, ngram_join, secrets, toxicity
from entity_events.llm.common import table, written

#: No SQL: learned scores and component search are not expressible; tests compare with plain versions.
ORACLE_SQL = None

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below the limit. Labels of one fold in five are never learned from."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    return toxicity.without_toxic(docs, labels, ~language.held_out(F.col("doc_id"), 5, 0))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near-duplicates: that with the smallest id."""
    return ngram_join.distinct_documents(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a large share of benchmark passages."""
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mask in place of each secret; ``n_chars`` follows the text where it was right."""
    return secrets.redacted(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixed corpus."""
    return mixing.mix(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secret_scan", mask_secrets),
    ("source_mix", mix_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written in the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
