"""Data-quality checks: shape, completeness, duplicates, coherence, stats, shares, histograms.

Each check is one aggregation per table (every per-column figure is an aggregate
expression of the same pass) followed by a small reshaping.  Results are long
tables keyed by (table, column/rule) so any number of tables can be reported.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.columns import no_nan, valid_in


def _union_all(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def shape(tables: dict[str, DataFrame]) -> DataFrame:
    """Q1: rows and columns per table."""
    return _union_all([
        df.agg(F.count(F.lit(1)).alias("nb_lignes"))
        .select(F.lit(name).alias("table"), "nb_lignes",
                F.lit(len(df.columns)).alias("nb_colonnes"))
        for name, df in tables.items()])


def completeness(tables: dict[str, DataFrame], only_missing: bool = True) -> DataFrame:
    """Q2: missing values and share (%) per column; by default only columns with any."""
    out = []
    for name, df in tables.items():
        agg = df.agg(F.count(F.lit(1)).alias("_total"),
                     *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
        long = agg.unpivot("_total", df.columns, "colonne", "nb_manquants")
        out.append(long.select(
            F.lit(name).alias("table"), "colonne", "nb_manquants",
            F.when(F.col("_total") > 0,
                   F.round(F.col("nb_manquants") * 100.0 / F.col("_total"), 1))
             .otherwise(F.lit(0.0)).alias("pct_manquants")))
    res = _union_all(out)
    return res.filter(F.col("nb_manquants") > 0) if only_missing else res


def duplicates(tables: dict[str, DataFrame], key: str = "session_id") -> DataFrame:
    """Q3: rows after the first per key (all columns when the key is absent).

    A null key is one group, as in pandas.  The per-key count is a partial
    aggregate, so a hot key costs one row per input partition in the shuffle.
    """
    out = []
    for name, df in tables.items():
        cols = [key] if key in df.columns else df.columns
        per_key = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))
        out.append(per_key.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("long")
                               .alias("nb_doublons"))
                   .select(F.lit(name).alias("table"),
                           F.lit(key if key in df.columns else "*").alias("cle"),
                           "nb_doublons"))
    return _union_all(out)


@dataclass(frozen=True)
class Rule:
    name: str
    table: str
    column: str
    bad: Column  # true for a defective row (null-safe)


def default_rules() -> list[Rule]:
    """Q4: the six coherence rules (null action and status count as invalid)."""
    price, rating = no_nan(F.col("price")), no_nan(F.col("rating"))
    return [
        Rule("actions_invalides", "clickstream", "action", ~valid_in("action", S.ACTIONS)),
        Rule("prix_negatifs", "clickstream", "price", F.coalesce(price < 0, F.lit(False))),
        Rule("ratings_hors_bornes", "clickstream", "rating",
             F.coalesce((rating < 0) | (rating > 5), F.lit(False))),
        Rule("durees_negatives", "clickstream", "duree_visite",
             F.coalesce(F.col("duree_visite") < 0, F.lit(False))),
        Rule("statuts_invalides", "transactions", "statut_paiement",
             ~valid_in("statut_paiement", S.PAYMENT_STATUSES_VALID)),
        Rule("montants_negatifs", "transactions", "montant_paye",
             F.coalesce(no_nan(F.col("montant_paye")) < 0, F.lit(False))),
    ]


def coherence(tables: dict[str, DataFrame], rules: list[Rule] | None = None) -> DataFrame:
    """Q4: defect count per rule; a rule whose column is missing is skipped."""
    rules = rules or default_rules()
    out = []
    for name, df in tables.items():
        mine = [r for r in rules if r.table == name and r.column in df.columns]
        if not mine:
            continue
        agg = df.agg(*[F.count_if(r.bad).alias(r.name) for r in mine])
        out.append(agg.unpivot([], [r.name for r in mine], "regle", "nb_anomalies")
                   .select(F.lit(name).alias("table"), "regle", "nb_anomalies"))
    return _union_all(out)


def column_stats(tables: dict[str, DataFrame], columns: dict[str, list[str]],
                 decimals: int = 2) -> DataFrame:
    """Q5: min, max, mean and sample std per numeric column (NaN skipped)."""
    out = []
    for name, cols in columns.items():
        df = tables[name]
        cols = [c for c in cols if c in df.columns]
        if not cols:
            continue
        aggs = []
        for c in cols:
            x = no_nan(F.col(c).cast("double"))
            aggs += [F.min(x).alias(f"{c}__min"), F.max(x).alias(f"{c}__max"),
                     F.avg(x).alias(f"{c}__moy"), F.stddev_samp(x).alias(f"{c}__std")]
        row = df.agg(*aggs)
        out.append(row.select(F.explode(F.array(*[
            F.struct(F.lit(c).alias("colonne"),
                     F.round(F.col(f"{c}__min"), decimals).alias("min"),
                     F.round(F.col(f"{c}__max"), decimals).alias("max"),
                     F.round(F.col(f"{c}__moy"), decimals).alias("moyenne"),
                     F.round(F.col(f"{c}__std"), decimals).alias("ecart_type"))
            for c in cols])).alias("s"))
            .select(F.lit(name).alias("table"), "s.*"))
    return _union_all(out)


def distribution(df: DataFrame, columns: list[str], decimals: int = 1) -> DataFrame:
    """Q6: share (%) of each value per column; nulls are left out of the denominator."""
    cols = [c for c in columns if c in df.columns]
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("colonne"), F.col(c).cast("string").alias("valeur"))
        for c in cols])).alias("kv")).select("kv.*").filter(F.col("valeur").isNotNull())
    counts = long.groupBy("colonne", "valeur").agg(F.count(F.lit(1)).alias("nb"))
    # Per-column totals: one row per requested column, so the broadcast is bounded
    # by the request; no task ever holds all values of a column.
    totals = counts.groupBy("colonne").agg(F.sum("nb").alias("_total"))
    return (counts.join(F.broadcast(totals), "colonne")
            .select("colonne", "valeur", "nb",
                    F.round(F.col("nb") * 100.0 / F.col("_total"), decimals).alias("pct")))


def histograms(df: DataFrame, bins: dict[str, int]) -> DataFrame:
    """Q7: equal-width histograms like numpy (last bin closed, zero-width range ±0.5)
    for several columns of one table, in two passes over it.

    Pass 1 finds each column's range (one row per column, so the broadcast of that
    table is bounded by the request); pass 2 counts rows per (column, bin).  Every
    bin is reported, empty ones with 0.
    """
    cols = [c for c in bins if c in df.columns]
    nbins = F.create_map(*[x for c in cols for x in (F.lit(c), F.lit(int(bins[c])))])
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("colonne"), no_nan(F.col(c).cast("double")).alias("v"))
        for c in cols])).alias("kv")).select("kv.*").filter(F.col("v").isNotNull())
    rng = long.groupBy("colonne").agg(F.min("v").alias("vmin"), F.max("v").alias("vmax")).select(
        "colonne",
        F.when(F.col("vmin") == F.col("vmax"), F.col("vmin") - 0.5).otherwise(F.col("vmin")).alias("lo"),
        F.when(F.col("vmin") == F.col("vmax"), F.col("vmax") + 0.5).otherwise(F.col("vmax")).alias("hi"),
        nbins[F.col("colonne")].alias("bins"))
    nb = F.col("bins")
    v, lo, hi = F.col("v"), F.col("lo"), F.col("hi")
    step = (hi - lo) / nb.cast("double")

    def edge(i):  # numpy's linspace edges: i * step + lo, the last one exactly hi
        return F.when(i == nb, hi).otherwise(i.cast("double") * step + lo)

    i0 = F.least(F.floor((v - lo) * (nb.cast("double") / (hi - lo))), nb - 1).cast("int")
    # numpy then moves a value sitting within an ulp of an edge to the side the edge says
    idx = (F.when(v < edge(i0), i0 - 1)
           .when((i0 != nb - 1) & (v >= edge(i0 + 1)), i0 + 1)
           .otherwise(i0))
    counts = (long.join(F.broadcast(rng), "colonne")
              .groupBy("colonne", idx.alias("bin")).agg(F.count(F.lit(1)).alias("nb")))
    all_bins = rng.select("colonne", "lo", "hi", "bins",
                          F.explode(F.sequence(F.lit(0), nb - 1)).alias("bin"))
    b = F.col("bin")
    return (all_bins.join(counts, ["colonne", "bin"], "left")
            .select("colonne", "bin",
                    edge(b).alias("borne_inf"),
                    edge(b + 1).alias("borne_sup"),
                    F.coalesce(F.col("nb"), F.lit(0)).alias("nb")))


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Q7 for one column."""
    return histograms(df, {column: bins})
