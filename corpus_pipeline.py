"""The corpus pipeline: five stages, each one operator over all its predecessor kept.

``run`` applies them to ``documents``.  Between stages the rows are written as Parquet
to the shared folder and read again, so a lost executor costs one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sillage.llm import decontamination, jaccard_join, line_dedup, mixing, quality
from sillage.llm.common import read
from sillage.session import scratch_path


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality posterior reaches one half stay."""
    return quality.keep_good(docs, read(spark, sf_dir, "labels"))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated line runs go; a document that thereby lost all its words goes too."""
    out = line_dedup.remove_copies(docs)
    rest = F.col("text").rlike("[^\\x20\\x09-\\x0D]")
    return (out.where((F.col("__n_removed") == 0) | rest)
            .withColumn("n_chars", F.when(F.col("__n_removed") == 0, F.col("n_chars")).otherwise(F.length("text")))
            .select(*docs.columns))


def dedup_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays (five-word shingles, Jaccard 0.8)."""
    return jaccard_join.one_of_each(docs, 5, (80, 100))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontamination.clean(docs, read(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words of each remaining document the mix takes."""
    return mixing.mix(docs)


STAGES = [("quality", quality_filter), ("line_dedup", dedup_lines), ("near_copies", dedup_near_copies),
          ("decontamination", decontaminate), ("mixing", mix_sources)]

#: SQL can express neither the fitted classifier nor the near-copy components.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
