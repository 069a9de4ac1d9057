"""M4: synthetic minority oversampling on a k-nearest-neighbour join.

Every class with fewer rows than the largest gets synthetic rows until it has as many.
Each lies at a random share of the way from a random row of its class to one of that row's
k nearest neighbours in the class.  The draws are md5 numbers of (class, counter), and rows
are addressed by their rank in hash order, so the result is the same on every run and
however the rows are partitioned, and SQL can state it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import materialize
from .neighbours import LEAF, nearest

#: Hexadecimal digits of an md5 that make a number; below 2**53, so exact as a double.
DIGITS = 13


def draw(*parts: Column | str) -> Column:
    """A number below 16**DIGITS from the md5 of ``parts``."""
    text = F.concat_ws("|", *[F.col(p).cast("string") if isinstance(p, str) else p for p in parts])
    return F.conv(F.substring(F.md5(text), 1, DIGITS), 16, 10).cast("long")


def ranked(df: DataFrame, order: list[Column | str], name: str = "rank") -> DataFrame:
    """``df`` with ``name``: each row's place (from 0) in the order of the whole table.

    Range partitions are sorted by themselves; a table of rows per partition, as small as
    the number of tasks, gives each its start.  No task sees more than its range.
    """
    rows = df.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = materialize(rows.withColumn("_at", F.monotonically_increasing_id()), "ranked")
    part = F.shiftrightunsigned("_at", 33)
    sizes = {r["p"]: r["n"] for r in rows.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()}
    starts, total = [], 0
    for p in sorted(sizes):
        starts.append((p, total))
        total += sizes[p]
    table = df.sparkSession.createDataFrame(starts, "_part long, _start long")
    local = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    out = rows.withColumn("_part", part).join(F.broadcast(table), "_part")
    return out.withColumn(name, F.col("_start") + local).drop("_at", "_part", "_start")


def smote(df: DataFrame, label: str, id_col: str, columns: list[str], k: int = 5, seed: int = 42, leaf: int = LEAF) -> DataFrame:
    """Synthetic rows for ``df``: (label, numero, base_id, voisin_id, part, ``columns``).

    ``numero`` counts from 0 within a class; a row is base + part * (neighbour - base) in
    every column, with null as 0.  Rows without label or id are left out; a class of one
    row has no neighbours, so its synthetic rows are that row again.
    """
    spark = df.sparkSession
    values = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in columns]
    rows = df.where(F.col(label).isNotNull() & F.col(id_col).isNotNull())
    rows = materialize(rows.select(F.col(label).alias("_y"), F.col(id_col).cast("long").alias("_id"), *values), "smote")
    counts = {r["_y"]: r["n"] for r in rows.groupBy("_y").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row per class
    most = max(counts.values(), default=0)
    out = None
    for y, n in sorted(counts.items()):
        if n == most:
            continue
        own = rows.where(F.col("_y") == F.lit(y)).drop("_y")
        near = nearest(own, "_id", columns, k, leaf)
        order = [draw("_id", F.lit(str(seed))), "_id"]
        base = materialize(ranked(own, order, "_rank").withColumnRenamed("_id", "base_id"), "smote-base")
        few = min(k, n - 1)
        drawn = spark.range(most - n).select(
            F.col("id").alias("numero"),
            *(draw(F.lit(str(y)), "id", F.lit(f"{what}|{seed}")).alias(f"_{what}") for what in ("base", "voisin", "part")))
        drawn = drawn.select("numero", (F.col("_base") % n).alias("_rank"), (F.col("_voisin") % max(few, 1) + 1).cast("int").alias("rang"),
                             (F.col("_part") / float(16**DIGITS)).alias("part"))
        made = drawn.join(base, "_rank").join(near.select(F.col("id").alias("base_id"), "rang", F.col("neighbour").alias("voisin_id")), ["base_id", "rang"], "left")
        other = base.select(F.col("base_id").alias("voisin_id"), F.struct(*columns).alias("_v"))
        made = made.join(other, "voisin_id", "left")
        moved = [F.coalesce(F.col(c) + F.col("part") * (F.col(f"_v.{c}") - F.col(c)), F.col(c)).alias(c) for c in columns]
        made = made.select(F.lit(y).alias(label), "numero", "base_id", "voisin_id", "part", *moved)
        out = made if out is None else out.unionByName(made)
    if out is None:
        kind = rows.schema["_y"].dataType.simpleString()
        return spark.createDataFrame([], ", ".join([f"`{label}` {kind}", "numero long", "base_id long", "voisin_id long", "part double",
                                                    *(f"`{c}` double" for c in columns)]))
    return out


def balanced(df: DataFrame, label: str, id_col: str, columns: list[str], k: int = 5, seed: int = 42) -> DataFrame:
    """The rows of ``df`` (label, ``columns``) and the synthetic ones: all classes alike."""
    given = df.where(F.col(label).isNotNull()).select(label, *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in columns])
    return given.unionByName(smote(df, label, id_col, columns, k, seed).select(label, *columns))
