"""Mixing sources to target weights, in DataFrame operations only.

Targets: the sources share the total size by weight, no source beyond ``max_epochs``
times its size; what a capped source leaves is shared again by weight.  That is a water
level: target = min(weight * level, cap), found with one running sum over the table of
sources (one row per source) ordered by cap / weight.

Selection: every document gets a hash-random key.  Within a source the documents stand
in key order; the key space is cut into ranges of about ``RANGE_ROWS`` documents, the
sizes of the ranges are summed first and the running sum inside a range starts from the
sum of the ranges before it.  A source that holds a third of all rows is thus summed in
many tasks.  ``target`` div ``source_size`` whole epochs are taken of every document and
one more pass in key order is cut at the exact rest: the document on the cut gives part
of its words.

Edge cases: null text has size 0; a null source is a source, last in order; null or
repeated ids and repeated rows are separate rows (ties in key order are cut between
rows in an order that does not change the multiset of results); an empty table gives no
rows; when all sizes are 0, all targets are 0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import broadcast_if_small, materialize
from .common import WORD

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
#: Documents of a source in one range of its keys, on average.
RANGE_ROWS = 20_000


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(id, source, size, key): size in words, key in [0, 1) from a hash of the id."""
    return docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
        F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit(""))).alias("key"))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """(source, source_size, n_docs, target) from rows (source, size)."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    order = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    w = F.get(F.array(*[F.lit(float(x)) for x in weights]), order % len(weights))
    per = per.select("*", w.alias("w"), (F.col("source_size") * F.lit(float(max_epochs))).alias("cap"))
    whole = Window.partitionBy()
    before = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    per = per.select("*", F.sum("source_size").over(whole).alias("total"), F.sum("w").over(whole).alias("all_w"),
                     F.coalesce(F.sum("cap").over(before), F.lit(0.0)).alias("capped"),
                     F.coalesce(F.sum("w").over(before), F.lit(0.0)).alias("capped_w"))
    # the level if exactly the sources before this one are capped; the right one is the
    # first that leaves its own source below the cap
    level = (F.col("total") - F.col("capped")) / (F.col("all_w") - F.col("capped_w"))
    per = per.withColumn("level", F.when(level * F.col("w") <= F.col("cap"), level))
    per = per.withColumn("level", F.min_by("level", F.when(F.col("level").isNotNull(), F.col("capped_w"))).over(whole))
    return per.select("source", "source_size", "n_docs",
                      F.least("cap", F.coalesce(F.col("level") * F.col("w"), F.col("cap"))).alias("target"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS,
        id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(doc_id, source, size, source_size, target, taken) for every row of ``docs``."""
    rows = materialize(sized(docs, id_col, text_col, source_col), "mix-sizes")
    per = materialize(targets(rows, weights, max_epochs), "mix-targets")
    ranges = F.ceil(F.col("n_docs") / F.lit(RANGE_ROWS))
    part = F.conv(F.substring("key", 1, 8), 16, 10).cast("double") / F.lit(2.0**32)
    ranged = (rows.join(broadcast_if_small(per), rows.source.eqNullSafe(per.source))
              .select("doc_id", rows.source, "size", "key", "source_size", "target", F.floor(part * ranges).alias("range")))
    sums = ranged.groupBy("source", "range").agg(F.sum("size").alias("range_size"))
    ahead = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sums = materialize(sums.select(F.col("source").alias("s"), F.col("range").alias("r"),
                                   F.coalesce(F.sum("range_size").over(ahead), F.lit(0)).alias("ahead")), "mix-ranges")
    placed = ranged.join(broadcast_if_small(sums), ranged.source.eqNullSafe(sums.s) & (ranged.range == sums.r))
    inside = Window.partitionBy("source", "range").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("ahead") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    budget = F.floor(F.col("target") + 0.5)
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(F.lit(0))
    rest = budget - epochs * F.col("source_size")
    cut = F.least(F.greatest(rest - F.col("start"), F.lit(0)), F.col("size"))
    return (placed.withColumn("start", start)
            .select("doc_id", "source", "size", "source_size", "target", (epochs * F.col("size") + cut).cast("long").alias("taken")))
