"""Behaviour profile (P17) and purchase-intent target."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import behaviour_profile


def with_profile(df: DataFrame) -> DataFrame:
    """``profil_comportemental`` from the user features and the review sentiment."""
    return df.withColumn("profil_comportemental", behaviour_profile(
        taux=F.coalesce(F.col("taux_achat_user"), F.lit(0.0)),
        abandons=F.coalesce(F.col("nb_abandons_user"), F.lit(0)),
        achats=F.coalesce(F.col("nb_achats_user"), F.lit(0)),
        actions=F.col("nb_actions_user"),
        score=F.coalesce(F.col("score_engagement_total"), F.lit(0)),
        sentiment=F.coalesce(F.col("sentiment"), F.lit("neutre")),
    ))


def profile_counts(df: DataFrame) -> DataFrame:
    """Rows per profile."""
    return df.groupBy("profil_comportemental").agg(F.count(F.lit(1)).alias("nb"))


def with_target(df: DataFrame) -> DataFrame:
    """Keep purchases and abandons; ``intention_achat`` and ``risque_abandon``.

    ``risque_abandon`` is derived from the target itself (kept for reporting; it is
    not a model feature unless ``legacy_features`` is asked for).
    """
    a = F.col("action")
    return (df.filter(a.isin("purchase", "abandon"))
            .withColumn("intention_achat", (a == "purchase").cast("int"))
            .withColumn("risque_abandon",
                        ((a == "abandon") & (F.col("sentiment") == "negatif")).cast("int")))


def target_distribution(df: DataFrame) -> DataFrame:
    """Class counts and shares, and the abandon-risk count (one row)."""
    y = F.col("intention_achat")
    agg = df.agg(F.count(F.lit(1)).alias("n"), F.sum(y).alias("achats"),
                 F.sum("risque_abandon").alias("risque"))
    n = F.col("n")
    return agg.select(
        F.coalesce(F.col("achats"), F.lit(0)).cast("long").alias("nb_achat"),
        F.when(n > 0, F.round(F.col("achats") * 100.0 / n, 1)).otherwise(0.0).alias("pct_achat"),
        (n - F.coalesce(F.col("achats"), F.lit(0))).cast("long").alias("nb_abandon"),
        F.when(n > 0, F.round((n - F.col("achats")) * 100.0 / n, 1)).otherwise(0.0).alias("pct_abandon"),
        F.coalesce(F.col("risque"), F.lit(0)).cast("long").alias("nb_risque_abandon"),
    )
