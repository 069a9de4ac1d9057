"""Scans of the parquet tables in a data directory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy parquet scan; Catalyst prunes columns and pushes filters into it."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame, key: str) -> DataFrame:
    """Hash-partition ``df`` by ``key`` when the scan yields fewer partitions than the
    cluster has task slots (a single small file is one task).

    Large inputs already split into many partitions and are returned unchanged, so
    this adds no shuffle at scale; hashing on a key keeps recomputation deterministic.
    """
    try:
        slots = df.sparkSession.sparkContext.defaultParallelism
        parts = df.rdd.getNumPartitions()
    except Exception:  # Spark Connect has no RDD view; leave partitioning to AQE
        return df
    if parts < slots:
        return df.repartition(slots, key)
    return df
