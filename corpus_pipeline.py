"""Corpus pipeline: language ID, n-gram Jaccard join, benchmark
decontamination, mixing, sharding.

Each stage is a function ``(spark, docs, sf_dir) -> DataFrame`` that works on
all its predecessor kept; all but the last return the columns of ``docs``.
:func:`run` writes every stage's result to the shared checkpoint folder and
reads it again, so a lost executor costs no earlier stage.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridcast.llm import decontaminate, langid, mixing, near_dup, sharding
from gridcast.llm.common import set_aside, table
from gridcast.session import checkpoint_dir

#: A document is rejected if no language has at least this mean word probability.
LEAST_LANGUAGE_SCORE = 0.3


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents in one of the learned languages; ``und`` and texts
    without a main language go."""
    model = langid.train(langid.training_rows(docs))
    base = set_aside(docs, "lang_pred", "lang_score")
    kept = langid.identify(base, model).where((F.col("lang_pred") != "und") & (F.col("lang_score") >= LEAST_LANGUAGE_SCORE))
    return kept.select(*[F.col(f"`{a}`").alias(c) for a, c in zip(base.columns, docs.columns, strict=True)])


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each near-duplicate component."""
    return near_dup.drop_near_duplicates(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Remove documents that hold a benchmark window."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per copy that the mix takes."""
    return mixing.mixed_documents(docs)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The columns of ``docs`` plus ``shard`` and ``slot``."""
    return sharding.shard(docs)


STAGES = [("language_id", language_id), ("ngram_jaccard_join", ngram_jaccard_join),
          ("benchmark_decontamination", benchmark_decontamination), ("source_mixing", source_mixing),
          ("sharding", sharded)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    base = f"{checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        path = f"{base}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


#: Not expressible in SQL (trained model, MinHash, in-memory shuffles); tested against brute force.
ORACLE_SQL = None
