"""The corpus pipeline: documents are filtered, deduplicated, cleaned and mixed.

Each stage takes ``(spark, docs, sf_dir)`` and works on all its predecessor kept; all but the last
return the columns of the documents. Between stages the documents are written as Parquet.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from llm import decontamination, minhash, mixing, quality, registry, secrets
from llm.common import table, written


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents which the importance resampling draws; the others go."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    scored = written(quality.scores(docs, model), "quality")
    return quality.resampled(docs, model, quality.choose(scored))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of every group of near-duplicates."""
    return minhash.one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which fewer than one word in twenty lies in a benchmark passage."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each secret replaced by its kind."""
    return secrets.without_secrets(docs, secrets.train(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document its size, its source's size and target, and the words the mix takes of it."""
    return mixing.mixed(docs)


STAGES = [
    ("quality_classifier", keep_quality),
    ("minhash_near_dedup", keep_one_of_each),
    ("benchmark_decontamination", decontaminate),
    ("secret_scans", redact_secrets),
    ("source_mixing", mix_sources),
]

#: Models and schedules are not expressible in SQL; the tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {**registry.QUERIES, "pipeline": run}
ORACLES = {**registry.ORACLES, **({"pipeline": ORACLE_SQL} if ORACLE_SQL else {})}
