"""Dashboard queries: KPIs, funnel, breakdowns, per-minute conversion, alerts, words.

Each is a single aggregation plan.  Global figures over several tables come from
one aggregate over a narrow ``unionByName`` of the tables, so no single-row
cross product is ever planned.

A table may lack columns (S8): a figure that needs a missing column is 0, a breakdown by
one has no rows, and the other figures stand.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.columns import minute_of, money_sum, optional, review_clean


def filter_clicks(clicks: DataFrame, category: str | None = None,
                  source: str | None = None) -> DataFrame:
    """Optional category / source filter; None or "Toutes" means no filter, and a filter
    on a column that the table lacks isn't offered."""
    if category not in (None, "Toutes") and "category" in clicks.columns:
        clicks = clicks.filter(F.col("category") == category)
    if source not in (None, "Toutes") and "source" in clicks.columns:
        clicks = clicks.filter(F.col("source") == source)
    return clicks


def distinct_filters(clicks: DataFrame) -> DataFrame:
    """The values offered by the category and source filters (null kept)."""
    parts = [clicks.select(F.lit(c).alias("filtre"), F.col(c).cast("string").alias("valeur")) for c in ("category", "source") if c in clicks.columns]
    if not parts:
        return clicks.sparkSession.createDataFrame([], "filtre string, valeur string")
    return reduce(DataFrame.unionByName, parts).distinct()


def _narrow_union(clicks: DataFrame, transactions: DataFrame | None,
                  support: DataFrame | None) -> DataFrame:
    nul_s, nul_d = F.lit(None).cast("string"), F.lit(None).cast("double")
    u = clicks.select(F.lit(0).alias("src"), optional(clicks, "action", "string"), nul_d.alias("montant"),
                      nul_s.alias("statut"))
    if transactions is not None:
        u = u.unionByName(transactions.select(
            F.lit(1).alias("src"), nul_s.alias("action"),
            optional(transactions, "montant_paye", "double").cast("double").alias("montant"),
            optional(transactions, "statut_paiement", "string").alias("statut")))
    if support is not None:
        u = u.unionByName(support.select(F.lit(2).alias("src"), nul_s.alias("action"),
                                         nul_d.alias("montant"), nul_s.alias("statut")))
    return u


def kpis(clicks: DataFrame, transactions: DataFrame | None = None,
         support: DataFrame | None = None) -> DataFrame:
    """A1-A2 (+ trap fixes): one row of headline figures.

    ``revenu_total`` sums every payment like the dashboard; ``revenu_succes`` only
    successful ones.  ``nb_echecs_regex`` is the dashboard's regex count (which
    never matches "échoué"); ``nb_echecs`` counts the failed spellings.
    """
    u = _narrow_union(clicks, transactions, support)
    src, act, st = F.col("src"), F.col("action"), F.col("statut")
    agg = u.agg(
        F.count_if(src == 0).alias("nb_evenements"),
        F.count_if((src == 0) & (act == "purchase")).alias("nb_achats"),
        F.count_if((src == 0) & (act == "abandon")).alias("nb_abandons"),
        F.count_if(src == 1).alias("nb_transactions"),
        F.count_if(src == 2).alias("nb_tickets"),
        money_sum("montant").alias("_rev"),
        money_sum(F.when(st == S.SUCCESS_STATUS, F.col("montant"))).alias("_rev_ok"),
        F.count_if((src == 1) & F.coalesce(st.rlike(S.FAILED_STATUS_REGEX), F.lit(False)))
        .alias("nb_echecs_regex"),
        F.count_if((src == 1) & st.isin(*S.FAILED_STATUSES)).alias("nb_echecs"),
    )
    den = F.col("nb_achats") + F.col("nb_abandons")
    return agg.select(
        "nb_evenements", "nb_achats", "nb_abandons", "nb_transactions", "nb_tickets",
        F.when(den > 0, F.round(F.col("nb_achats") * 100.0 / den, 1))
         .otherwise(F.lit(0.0)).alias("taux_conversion"),
        F.round(F.coalesce(F.col("_rev"), F.lit(0.0)), 2).alias("revenu_total"),
        F.round(F.coalesce(F.col("_rev_ok"), F.lit(0.0)), 2).alias("revenu_succes"),
        "nb_echecs_regex", "nb_echecs",
    )


def value_counts(df: DataFrame, column: str, name: str | None = None) -> DataFrame:
    """Count per value, nulls left out, most frequent first."""
    key = name or column
    df = df.select(optional(df, column, "string"))
    return (df.filter(F.col(column).isNotNull())
            .groupBy(F.col(column).alias(key))
            .agg(F.count(F.lit(1)).alias("nb"))
            .orderBy(F.col("nb").desc(), F.col(key)))


def funnel(clicks: DataFrame) -> DataFrame:
    """A3 / L3: count per action in the fixed stage order (unknown actions last)."""
    order = F.array(*[F.lit(a) for a in S.FUNNEL_ORDER])
    pos = F.array_position(order, F.col("action"))
    return (value_counts(clicks, "action")
            .withColumn("etape", F.when(pos > 0, pos.cast("int")))
            .orderBy(F.col("etape").asc_nulls_last(), F.col("nb").desc()))


def category_actions(clicks: DataFrame) -> DataFrame:
    """A4: count per (category, action)."""
    clicks = clicks.select(optional(clicks, "category", "string"), optional(clicks, "action", "string"))
    return (clicks.filter(F.col("category").isNotNull() & F.col("action").isNotNull())
            .groupBy("category", "action").agg(F.count(F.lit(1)).alias("nb")))


def conversion_by_minute(clicks: DataFrame, last_n: int | None = 20) -> DataFrame:
    """Purchases and abandons per minute, the last ``last_n`` minutes.

    The reference's outer join of two per-minute counts is one grouped aggregate
    with two conditional counts; minutes with neither action never appear.
    """
    clicks = clicks.select(optional(clicks, "action", "string"), optional(clicks, "timestamp", "double"))
    out = (clicks.filter(F.col("action").isin("purchase", "abandon")
                         & F.col("timestamp").isNotNull())
           .groupBy(minute_of("timestamp").alias("minute"))
           .agg(F.count_if(F.col("action") == "purchase").alias("achats"),
                F.count_if(F.col("action") == "abandon").alias("abandons")))
    if last_n is not None:
        out = out.orderBy(F.col("minute").desc()).limit(last_n)
    return out.orderBy("minute")


def alerts(kpi_row: DataFrame) -> DataFrame:
    """A10: the three dashboard alerts as rows (alerte, valeur, seuil, declenchee, niveau).

    Conversion fires below 50 (exactly 50 is OK); failed payments fire above 10
    (counted with the real failed spellings, the regex count is kept in kpis);
    abandons fire when they exceed purchases.  Built from the one KPI row with
    ``stack``; no join.
    """
    conv = F.col("taux_conversion") < S.ALERT_CONVERSION_MIN
    fail = F.col("nb_echecs") > S.ALERT_FAILED_PAYMENTS_MAX
    aband = F.col("nb_abandons") > F.col("nb_achats")
    k = kpi_row.select(
        F.col("taux_conversion").cast("double").alias("v1"), conv.alias("d1"),
        F.col("nb_echecs").cast("double").alias("v2"), fail.alias("d2"),
        F.col("nb_abandons").cast("double").alias("v3"), aband.alias("d3"),
        F.col("nb_achats").cast("double").alias("s3"),
        (F.col("nb_transactions") > 0).alias("has_tx"),
    )
    rows = F.expr(
        "stack(3, "
        f"'conversion', v1, CAST({S.ALERT_CONVERSION_MIN} AS DOUBLE), d1, true, "
        f"'paiements_echoues', v2, CAST({S.ALERT_FAILED_PAYMENTS_MAX} AS DOUBLE), d2, has_tx, "
        "'abandons_vs_achats', v3, s3, d3, true"
        ") AS (alerte, valeur, seuil, declenchee, visible)")
    return (k.select(rows).filter("visible")
            .select("alerte", "valeur", "seuil", "declenchee",
                    F.when(F.col("declenchee") & (F.col("alerte") == "conversion"), "error")
                     .when(F.col("declenchee"), "warning").otherwise("success").alias("niveau")))


def review_words(clicks: DataFrame, stop_words: list[str]) -> DataFrame:
    """Words of every review (cleaned, lower case), stop words removed; one row each."""
    clicks = clicks.select(optional(clicks, "review_text", "string"))
    words = F.split(F.trim(review_clean("review_text")), r"\s+")
    stop = F.array(*[F.lit(w) for w in stop_words]) if stop_words else None
    toks = F.filter(words, lambda t: (F.length(t) > 0) & (
        ~F.array_contains(stop, t) if stop is not None else F.lit(True)))
    return (clicks.filter(F.col("review_text").isNotNull())
            .select(F.explode(toks).alias("mot")))


def review_top_words(clicks: DataFrame, stop_words: list[str], top: int = 100) -> DataFrame:
    """The ``top`` most frequent review words (ties by word)."""
    return (review_words(clicks, stop_words).groupBy("mot")
            .agg(F.count(F.lit(1)).alias("nb"))
            .orderBy(F.col("nb").desc(), F.col("mot")).limit(top))
