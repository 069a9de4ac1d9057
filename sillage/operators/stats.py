"""Distributed descriptive statistics with exact quantiles.

``describe`` matches pandas ``DataFrame.describe()``: count, mean, sample std, min,
25 %, 50 %, 75 % (linear interpolation) and max.  Spark's exact ``percentile``
keeps every distinct value of a group in one aggregation buffer, and
``DataFrame.summary`` is approximate, so exact quantiles are found by bracketing:

1. one aggregate per column gives count, moments and ``percentile_approx`` values
   at ``p ± margin`` — a bracket that must contain the exact order statistics;
2. a pass counts the rows below each bracket and estimates the distinct values
   inside it (about ``6 n / accuracy`` ranks); a bracket with more than
   ``MAX_BRACKET_DISTINCT`` distinct values is narrowed by counting it in 1024
   equal-width buckets and keeping the exact [min, max] of the buckets that hold
   the target ranks (repeat while needed);
3. a window over each (column, quantile) bracket — bounded by the bracket size,
   never by the group size — picks the exact order statistics.

Only tables with one row per column (or per column, quantile and bucket) cross the
driver; no task ever holds a whole column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

QUANTILES = [0.25, 0.5, 0.75]
DEFAULT_ACCURACY = 10_000


def to_long(df: DataFrame, columns: list[str]) -> DataFrame:
    """(colonne, valeur) pairs of the non-null, non-NaN values of ``columns``."""
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("colonne"), F.col(c).cast("double").alias("valeur"))
        for c in columns])).alias("kv")).select("kv.colonne", "kv.valeur")
    return long.filter(F.col("valeur").isNotNull() & ~F.isnan("valeur"))


def _bracket_aggs(probs: list[float], accuracy: int) -> list:
    margin = 3.0 / accuracy
    lows = [max(p - margin, 0.0) for p in probs]
    highs = [min(p + margin, 1.0) for p in probs]
    return [F.count(F.lit(1)).alias("n"),
            F.min("valeur").alias("vmin"), F.max("valeur").alias("vmax"),
            F.percentile_approx("valeur", lows + highs, accuracy).alias("apx")]


def _bracket_cols(probs: list[float], accuracy: int) -> list:
    margin = 3.0 / accuracy
    k = len(probs)
    lows = [max(p - margin, 0.0) for p in probs]
    highs = [min(p + margin, 1.0) for p in probs]
    # in a group of up to ``accuracy`` values the margin is under three ranks, too few to hold
    # both order statistics for sure: its bracket is the whole range
    whole = F.col("n") <= accuracy
    return [
        F.array(*[F.when(whole | F.lit(lows[i] <= 0.0), F.col("vmin")).otherwise(F.col("apx")[i])
                  for i in range(k)]).alias("lo"),
        F.array(*[F.when(whole | F.lit(highs[i] >= 1.0), F.col("vmax")).otherwise(F.col("apx")[k + i])
                  for i in range(k)]).alias("hi"),
    ]


def _brackets(long: DataFrame, probs: list[float], accuracy: int) -> DataFrame:
    """Per column: n, min, max and, per quantile, an approximate [lo, hi] bracket."""
    agg = long.groupBy("colonne").agg(*_bracket_aggs(probs, accuracy))
    return agg.select("colonne", "n", "vmin", "vmax", *_bracket_cols(probs, accuracy))


MAX_BRACKET_DISTINCT = 1_000_000
NARROW_BUCKETS = 1024
MAX_ROUNDS = 8


def _bracket_stats(long: DataFrame, bounds: DataFrame, k: int) -> DataFrame:
    """Per column and quantile: rows below the bracket, approx distinct values inside."""
    j = long.join(F.broadcast(bounds), "colonne")
    v, lo, hi = F.col("valeur"), F.col("lo"), F.col("hi")
    inside = [(v >= lo[i]) & (v <= hi[i]) for i in range(k)]
    agg = j.groupBy("colonne").agg(
        *[F.count_if(v < lo[i]).alias(f"b{i}") for i in range(k)],
        *[F.approx_count_distinct(F.when(inside[i], v)).alias(f"d{i}") for i in range(k)])
    return agg.select("colonne", F.array(*[F.col(f"b{i}") for i in range(k)]).alias("below"),
                      F.array(*[F.col(f"d{i}") for i in range(k)]).alias("distinct"))


def _narrow(long: DataFrame, state: DataFrame, k: int, wide: list[tuple[str, int]]) -> DataFrame:
    """Shrink the wide brackets: equal-width buckets inside each, counted in one pass;
    the new bracket is the exact [min, max] of the buckets holding ranks k0 and k1."""
    spark = long.sparkSession
    nb = NARROW_BUCKETS
    wide_df = spark.createDataFrame(wide, "colonne string, qi int")
    st = state.select("colonne", F.posexplode("lo").alias("qi", "lo"), "hi", "below", "k0", "k1")
    st = st.select("colonne", "qi", "lo", F.col("hi")[F.col("qi")].alias("hi"),
                   F.col("below")[F.col("qi")].alias("below"),
                   F.col("k0")[F.col("qi")].alias("k0"), F.col("k1")[F.col("qi")].alias("k1"))
    st = st.join(F.broadcast(wide_df), ["colonne", "qi"])  # only the wide ones
    v, lo, hi = F.col("valeur"), F.col("lo"), F.col("hi")
    width = hi - lo
    b = F.least(F.floor(F.when(width > 0, (v - lo) / width * nb).otherwise(0.0)),
                F.lit(nb - 1)).cast("int")
    buckets = (long.join(F.broadcast(st), "colonne")
               .filter((v >= lo) & (v <= hi))
               .groupBy("colonne", "qi", b.alias("b"))
               .agg(F.count(F.lit(1)).alias("cnt"), F.min(v).alias("bmin"), F.max(v).alias("bmax")))
    # At most #columns x #quantiles x NARROW_BUCKETS rows from here on.
    w = Window.partitionBy("colonne", "qi").orderBy("b").rowsBetween(Window.unboundedPreceding, 0)
    cum = (buckets.withColumn("cum_in", F.sum("cnt").over(w))
           .join(F.broadcast(st.select("colonne", "qi", "below", "k0", "k1")), ["colonne", "qi"])
           .withColumn("first", F.col("below") + F.col("cum_in") - F.col("cnt"))
           .withColumn("last", F.col("below") + F.col("cum_in")))
    has = lambda r: (F.col("first") <= r) & (r < F.col("last"))
    return cum.groupBy("colonne", "qi").agg(
        F.min(F.when(has(F.col("k0")), F.col("bmin"))).alias("new_lo"),
        F.max(F.when(has(F.col("k1")), F.col("bmax"))).alias("new_hi"))


def exact_quantiles(long: DataFrame, probs: list[float] | None = None,
                    accuracy: int = DEFAULT_ACCURACY, brackets: DataFrame | None = None,
                    max_bracket: int = MAX_BRACKET_DISTINCT) -> DataFrame:
    """Exact linear-interpolation quantiles per ``colonne`` of a (colonne, valeur) table.

    ``brackets`` may be passed when pass 1 was already fused into another aggregate.
    Brackets whose approximate distinct count exceeds ``max_bracket`` are narrowed
    (at most ``MAX_ROUNDS`` rounds; each round divides the value range by 1024) so
    the final sort of a bracket is bounded.  Returns (colonne, qi, p, quantile).
    """
    probs = probs or QUANTILES
    k = len(probs)
    spark = long.sparkSession
    # Pass 1: global counts and approximate brackets (one row per column).
    br = brackets if brackets is not None else _brackets(long, probs, accuracy)
    base = br.select(
        "colonne", "n", "lo", "hi",
        F.array(*[F.floor(F.lit(p) * (F.col("n") - 1)).cast("long") for p in probs]).alias("k0"),
        F.array(*[F.least(F.floor(F.lit(p) * (F.col("n") - 1)).cast("long") + 1, F.col("n") - 1)
                  for p in probs]).alias("k1"),
        F.array(*[(F.lit(p) * (F.col("n") - 1) - F.floor(F.lit(p) * (F.col("n") - 1)))
                  for p in probs]).alias("frac"))
    # The state has one row per column: its size is fixed by the request.
    base_rows = base.collect()
    state = spark.createDataFrame(base_rows, base.schema)
    with_below = StructType(list(base.schema.fields)
                            + [StructField("below", ArrayType(LongType()), True)])
    # percentile_approx misplaces a rank by at most n/accuracy, so a bracket spans at
    # most about 8 n / accuracy ranks: when that is under the limit, no round is needed
    # and the rows below each bracket are counted inside the final plan.
    max_n = max([r["n"] for r in base_rows] or [0])
    if 8 * max_n / accuracy <= max_bracket:
        bounds = state.select("colonne", "lo", "hi")
        below = (long.join(F.broadcast(bounds), "colonne").groupBy("colonne")
                 .agg(F.array(*[F.count_if(F.col("valeur") < F.col("lo")[i])
                                for i in range(k)]).alias("below")))
        state = state.join(below, "colonne", "left")
        return _final_pass(long, state, probs, k)
    for rnd in range(MAX_ROUNDS + 1):
        stats = _bracket_stats(long, state.select("colonne", "lo", "hi"), k).collect()
        below = {r["colonne"]: list(r["below"]) for r in stats}
        wide = [(r["colonne"], i) for r in stats for i in range(k) if r["distinct"][i] > max_bracket]
        rows = []
        for r in state.collect():
            rows.append({**r.asDict(), "below": below.get(r["colonne"], [0] * k)})
        state = spark.createDataFrame(rows, with_below)
        if not wide or rnd == MAX_ROUNDS:
            break  # counts above are for the final bounds
        new = {(r["colonne"], r["qi"]): (r["new_lo"], r["new_hi"])
               for r in _narrow(long, state, k, wide).collect()}
        rows = []
        for r in state.collect():
            d = r.asDict()
            lo, hi = list(d["lo"]), list(d["hi"])
            for i in range(k):
                if (d["colonne"], i) in new and new[(d["colonne"], i)][0] is not None:
                    lo[i], hi[i] = new[(d["colonne"], i)]
            d.update(lo=lo, hi=hi)
            d.pop("below")
            rows.append(d)
        state = spark.createDataFrame(rows, base.schema)
    return _final_pass(long, state, probs, k)


def _final_pass(long: DataFrame, state: DataFrame, probs: list[float], k: int) -> DataFrame:
    """Distinct values inside each bracket, ranked by a window bounded by the bracket."""
    spark = long.sparkSession
    bounds = state.select("colonne", "lo", "hi")
    j = long.join(F.broadcast(bounds), "colonne")
    inside = (j.select("colonne", "valeur", F.explode(F.filter(
        F.sequence(F.lit(0), F.lit(k - 1)),
        lambda i: (F.col("valeur") >= F.col("lo")[i]) & (F.col("valeur") <= F.col("hi")[i])
    )).alias("qi"))
        .groupBy("colonne", "qi", "valeur").agg(F.count(F.lit(1)).alias("cnt")))
    w = Window.partitionBy("colonne", "qi").orderBy("valeur").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    ranks = state.select("colonne", F.posexplode("k0").alias("qi", "k0"), "k1", "frac", "below")
    ranks = ranks.select("colonne", "qi", "k0", F.col("k1")[F.col("qi")].alias("k1"),
                         F.col("frac")[F.col("qi")].alias("frac"),
                         F.col("below")[F.col("qi")].alias("below"))
    x = (inside.withColumn("cum_in", F.sum("cnt").over(w))
         .join(F.broadcast(ranks), ["colonne", "qi"])
         .withColumn("cum", F.col("below") + F.col("cum_in"))
         .withColumn("first", F.col("cum") - F.col("cnt")))
    k0, k1 = F.col("k0"), F.col("k1")
    res = x.groupBy("colonne", "qi", "frac").agg(
        F.min(F.when((F.col("first") <= k0) & (k0 < F.col("cum")), F.col("valeur"))).alias("v0"),
        F.min(F.when((F.col("first") <= k1) & (k1 < F.col("cum")), F.col("valeur"))).alias("v1"),
    )
    pdf = spark.createDataFrame([(i, float(p)) for i, p in enumerate(probs)], "qi int, p double")
    return res.join(F.broadcast(pdf), "qi").select(
        "colonne", "qi", "p", (F.col("v0") + F.col("frac") * (F.col("v1") - F.col("v0"))).alias("quantile"))


def describe(df: DataFrame, columns: list[str], decimals: int | None = 2,
             accuracy: int = DEFAULT_ACCURACY, materialize_input: bool = True) -> DataFrame:
    """pandas-style describe in long form: one row per column with 8 statistics.

    The numeric projection is written once to the shared folder (every pass reads
    it, so the upstream plan is not recomputed); moments and quantile brackets come
    from the same aggregate, whose one-row-per-column result seeds the exact pass.
    """
    spark = df.sparkSession
    narrow = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    if materialize_input:
        from .joins import materialize
        narrow = materialize(narrow, "describe-input")
    long = to_long(narrow, columns)
    first = long.groupBy("colonne").agg(
        F.avg("valeur").alias("mean"), F.stddev_samp("valeur").alias("std"),
        *_bracket_aggs(QUANTILES, accuracy))
    first = first.select("colonne", "mean", "std", "n", "vmin", "vmax",
                         *_bracket_cols(QUANTILES, accuracy))
    first = spark.createDataFrame(first.collect(), first.schema)  # one row per column
    q = exact_quantiles(long, QUANTILES, accuracy,
                        brackets=first.select("colonne", "n", "vmin", "vmax", "lo", "hi"))
    qw = q.groupBy("colonne").agg(*[
        F.max(F.when(F.col("qi") == i, F.col("quantile"))).alias(name)
        for i, name in enumerate(["p25", "p50", "p75"])])
    out = F.broadcast(first).join(qw, "colonne", "left").select(
        "colonne", F.col("n").cast("double").alias("count"), "mean", "std",
        F.col("vmin").alias("min"), "p25", "p50", "p75", F.col("vmax").alias("max"))
    stats = ["count", "mean", "std", "min", "p25", "p50", "p75", "max"]
    if decimals is not None:
        return out.select("colonne", *[F.round(F.col(s), decimals).alias(s) for s in stats])
    return out.select("colonne", *stats)


def _cumulated(weighted: DataFrame) -> DataFrame:
    """(colonne, valeur, poids) of distinct values with ``first`` and ``cum``, the weight
    before and up to each value in its column.

    Range partitions add up their own values; the totals of a column's earlier partitions,
    a row per partition it spans, are carried into the later ones."""
    from .joins import materialize

    ranged = weighted.repartitionByRange("colonne", "valeur").withColumn("_part", F.spark_partition_id())
    ranged = materialize(ranged, "weights")
    earlier = Window.partitionBy("colonne").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = (ranged.groupBy("colonne", "_part").agg(F.sum("poids").alias("s"))
               .select("colonne", "_part", F.coalesce(F.sum("s").over(earlier), F.lit(0)).alias("base")))
    here = Window.partitionBy("colonne", "_part").orderBy("valeur").rowsBetween(Window.unboundedPreceding, 0)
    out = ranged.withColumn("own", F.sum("poids").over(here)).join(F.broadcast(materialize(carried, "carried")), ["colonne", "_part"])
    cum = F.col("base") + F.col("own")
    return out.select("colonne", "valeur", "poids", (cum - F.col("poids")).alias("first"), cum.alias("cum"))


def describe_weighted(weighted: DataFrame, decimals: int | None = 2) -> DataFrame:
    """``describe`` of columns given as (colonne, valeur, poids): each value counts ``poids``
    (a long) times.  Null, NaN and weightless values don't count.

    Values that many rows share are summed into one before anything is sorted, so the work
    after one aggregate is that of the distinct values, whatever their weights.  Quantiles
    are exact: the order statistics are found by the running weight.
    """
    given = weighted.where(F.col("valeur").isNotNull() & ~F.isnan("valeur") & (F.col("poids") > 0))
    distinct = given.groupBy("colonne", (F.col("valeur") + F.lit(0.0)).alias("valeur")).agg(F.sum("poids").alias("poids"))
    cum = _cumulated(distinct)
    v, w = F.col("valeur"), F.col("poids")
    base = cum.groupBy("colonne").agg(F.sum("poids").alias("n"), (F.sum(v * w) / F.sum("poids")).alias("mean"), F.min(v).alias("min"), F.max(v).alias("max"))
    base = cum.sparkSession.createDataFrame(base.collect(), base.schema)  # one row per column
    rows = cum.join(F.broadcast(base.select("colonne", "n", "mean")), "colonne")
    at = {f"p{round(p * 100)}": F.lit(p) * (F.col("n") - 1) for p in QUANTILES}

    def value(rank):
        return F.min(F.when((F.col("first") <= rank) & (rank < F.col("cum")), v))

    found = rows.groupBy("colonne", "n").agg(
        F.sum(w * (v - F.col("mean")) * (v - F.col("mean"))).alias("squares"),
        *[value(F.floor(r)).alias(f"{q}_a") for q, r in at.items()], *[value(F.ceil(r)).alias(f"{q}_b") for q, r in at.items()])
    out = found.join(F.broadcast(base.drop("n")), "colonne").select(
        "colonne", F.col("n").cast("double").alias("count"), "mean",
        F.when(F.col("n") > 1, F.sqrt(F.col("squares") / (F.col("n") - 1))).alias("std"), "min",
        *[(F.col(f"{q}_a") + (r - F.floor(r)) * (F.col(f"{q}_b") - F.col(f"{q}_a"))).alias(q) for q, r in at.items()], "max")
    stats = ["count", "mean", "std", "min", "p25", "p50", "p75", "max"]
    return out.select("colonne", *[(F.round(F.col(s), decimals) if decimals is not None else F.col(s)).alias(s) for s in stats])
