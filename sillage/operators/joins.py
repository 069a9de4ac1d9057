"""Join helpers: size-checked broadcast and lineage cuts in the shared folder."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path

# Largest side we hand to a broadcast join: at most this many rows and about this
# many bytes (row width estimated from the schema).  Beyond it, the join stays
# sort-merge and AQE splits skewed partitions.
BROADCAST_MAX_ROWS = 500_000
BROADCAST_MAX_BYTES = 64 * 1024 * 1024

_WIDTH = {"boolean": 1, "tinyint": 1, "smallint": 2, "int": 4, "float": 4, "date": 4,
          "bigint": 8, "double": 8, "timestamp": 8, "timestamp_ntz": 8}


def row_width(df: DataFrame) -> int:
    """Rough bytes per row: fixed sizes for numbers, 32 for strings, 64 for nested."""
    total = 8  # row header
    for f in df.schema.fields:
        t = f.dataType.simpleString()
        if t in _WIDTH:
            total += _WIDTH[t]
        elif t.startswith("decimal"):
            total += 16
        elif t == "string" or t == "binary":
            total += 32
        else:
            total += 64
    return total


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh parquet folder under ``spark.checkpoint.dir`` and read it back.

    This cuts lineage (a lost executor recomputes from the written table, not from
    the source scans) and gives the planner the true size of the result.  The row
    count of the written table (a scan of parquet metadata-sized work) is kept on
    the returned DataFrame as ``_sillage_rows`` for size checks.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    out = spark.read.parquet(path)
    out._sillage_rows = out.count()
    return out


def known_rows(df: DataFrame) -> int | None:
    return getattr(df, "_sillage_rows", None)


def row_count_at_most(df: DataFrame, max_rows: int) -> bool:
    """True when ``df`` has at most ``max_rows`` rows; reads at most max_rows + 1."""
    n = known_rows(df)
    if n is not None:
        return n <= max_rows
    return df.limit(max_rows + 1).count() <= max_rows


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS,
                       max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Broadcast hint only when the (materialised) side is proven small in rows and
    in estimated bytes."""
    limit = min(max_rows, max_bytes // row_width(df))
    return F.broadcast(df) if row_count_at_most(df, limit) else df


#: Rows of a partition of training data: few rows are one task, more go to all cores.
TRAIN_ROWS = 20_000


def right_size(df: DataFrame, rows_per_partition: int = TRAIN_ROWS) -> DataFrame:
    """A materialised table in about ``rows_per_partition`` rows per partition.

    Iterative jobs (model training) pay a task launch per partition per iteration, so a
    small training set in many partitions spends its time scheduling; a large one whose
    compressed files make few scan tasks leaves cores idle in every pass, so it is dealt
    over up to four tasks a core.  Larger tables keep (at least) their partition count.
    """
    n = known_rows(df)
    if n is None:
        return df
    want, have = max(1, math.ceil(n / rows_per_partition)), df.rdd.getNumPartitions()
    most = max(have, 4 * df.sparkSession.sparkContext.defaultParallelism)
    want = min(want, most)
    out = df.coalesce(want) if want < have else df.repartition(want) if want > have else df
    out._sillage_rows = n
    return out
