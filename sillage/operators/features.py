"""Per-user and per-category features, and the enriched click table.

Shape of the plan for ``enriched_clicks``:

1. clicks, transactions and support are projected to one narrow union and
   aggregated once with grouping sets ``(user_id)`` and ``(category)`` (map-side
   partial aggregation, one shuffle of partial rows; a hot user costs one partial
   row per input partition);
2. the two key tables are written to the shared folder and joined back to the clicks
   with a broadcast when their row count is proven small, else by sort-merge join
   where AQE splits a skewed user.

Null keys are left out of the feature tables (pandas ``groupby`` drops them); clicks
with a null key keep null features, except the columns the reference fills with 0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.columns import action_score, money_avg, money_sum, safe_ratio
from .joins import broadcast_if_small, materialize

USER_CLICK_COLS = ["nb_actions_user", "nb_achats_user", "nb_abandons_user", "duree_moy_user",
                   "taux_achat_user", "score_engagement_total"]
USER_SPEND_COLS = ["montant_total_depense", "nb_transactions_reussies", "panier_moyen"]
USER_SUPPORT_COLS = ["nb_tickets_support", "nb_remboursements"]
CATEGORY_COLS = ["taux_achat_categorie", "prix_moy_categorie"]

# Columns the reference fills with 0 after the joins.
FILL_ZERO = ["nb_achats_user", "nb_abandons_user", "nb_transactions_reussies",
             "nb_tickets_support", "nb_remboursements", "montant_total_depense",
             "panier_moyen", "taux_achat_user", "taux_achat_categorie"]


def _score(clicks: DataFrame):
    return F.col("action_score") if "action_score" in clicks.columns else action_score("action")


def user_features(clicks: DataFrame) -> DataFrame:
    """Actions, purchases, abandons, mean visit, purchase rate, engagement."""
    a = F.col("action")
    return (
        clicks.filter(F.col("user_id").isNotNull())
        .groupBy("user_id")
        .agg(
            F.count(F.lit(1)).alias("nb_actions_user"),
            F.count_if(a == "purchase").alias("nb_achats_user"),
            F.count_if(a == "abandon").alias("nb_abandons_user"),
            F.avg("duree_visite").alias("duree_moy_user"),
            F.sum(_score(clicks)).cast("long").alias("score_engagement_total"),
        )
        .withColumn("taux_achat_user",
                    safe_ratio(F.col("nb_achats_user"), F.col("nb_actions_user")))
        .select("user_id", *USER_CLICK_COLS)
    )


def user_spend(transactions: DataFrame) -> DataFrame:
    """E7-E9 over payments whose status is exactly the success status."""
    return (
        transactions.filter((F.col("statut_paiement") == S.SUCCESS_STATUS)
                            & F.col("user_id").isNotNull())
        .groupBy("user_id")
        .agg(
            money_sum("montant_paye").alias("montant_total_depense"),
            F.count(F.lit(1)).alias("nb_transactions_reussies"),
            money_avg("montant_paye").alias("panier_moyen"),
        )
    )


def user_support(support: DataFrame) -> DataFrame:
    """Tickets and refund requests per user."""
    return (
        support.filter(F.col("user_id").isNotNull())
        .groupBy("user_id")
        .agg(
            F.count(F.lit(1)).alias("nb_tickets_support"),
            F.count_if(F.col("motif_contact") == "remboursement").alias("nb_remboursements"),
        )
    )


def category_features(clicks: DataFrame) -> DataFrame:
    """Purchase rate and mean price per category."""
    return (
        clicks.filter(F.col("category").isNotNull())
        .groupBy("category")
        .agg(
            safe_ratio(F.count_if(F.col("action") == "purchase"), F.count(F.lit(1)))
            .alias("taux_achat_categorie"),
            money_avg("price").alias("prix_moy_categorie"),
        )
    )


def _narrow_union(clicks: DataFrame, transactions: DataFrame | None,
                  support: DataFrame | None) -> DataFrame:
    """The columns the key tables need, from the three tables, in one union."""
    nul_d = F.lit(None).cast("double")
    nul_s = F.lit(None).cast("string")
    parts = [clicks.select(
        F.col("user_id").cast("int").alias("user_id"), F.col("category"), F.lit(0).alias("src"),
        F.col("action"), F.col("duree_visite").cast("double").alias("duree"),
        _score(clicks).cast("long").alias("score"), F.col("price").cast("double").alias("price"),
        nul_d.alias("montant"), nul_s.alias("statut"), nul_s.alias("motif"))]
    if transactions is not None:
        parts.append(transactions.select(
            F.col("user_id").cast("int").alias("user_id"), nul_s.alias("category"),
            F.lit(1).alias("src"), nul_s.alias("action"), nul_d.alias("duree"),
            F.lit(None).cast("long").alias("score"), nul_d.alias("price"),
            F.col("montant_paye").cast("double").alias("montant"),
            F.col("statut_paiement").alias("statut"), nul_s.alias("motif")))
    if support is not None:
        parts.append(support.select(
            F.col("user_id").cast("int").alias("user_id"), nul_s.alias("category"),
            F.lit(2).alias("src"), nul_s.alias("action"), nul_d.alias("duree"),
            F.lit(None).cast("long").alias("score"), nul_d.alias("price"),
            nul_d.alias("montant"), nul_s.alias("statut"), F.col("motif_contact").alias("motif")))
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return u


def _user_aggs() -> list:
    src, ok = F.col("src"), (F.col("statut") == S.SUCCESS_STATUS)
    return [
        F.count_if(src == 0).alias("nb_actions_user"),
        F.count_if((src == 0) & (F.col("action") == "purchase")).alias("nb_achats_user"),
        F.count_if((src == 0) & (F.col("action") == "abandon")).alias("nb_abandons_user"),
        F.avg("duree").alias("duree_moy_user"),
        F.sum("score").alias("score_engagement_total"),
        money_sum(F.when(ok, F.col("montant"))).alias("montant_total_depense"),
        F.count_if(ok).alias("nb_transactions_reussies"),
        money_avg(F.when(ok, F.col("montant"))).alias("panier_moyen"),
        F.count_if(src == 2).alias("nb_tickets_support"),
        F.count_if((src == 2) & (F.col("motif") == "remboursement")).alias("nb_remboursements"),
    ]


def _user_cols() -> list:
    n = F.col("nb_actions_user")
    return [
        "user_id",
        F.when(n > 0, n).alias("nb_actions_user"),
        "nb_achats_user", "nb_abandons_user", "duree_moy_user",
        F.when(n > 0, safe_ratio(F.col("nb_achats_user"), n)).alias("taux_achat_user"),
        "score_engagement_total",
        "montant_total_depense", "nb_transactions_reussies", "panier_moyen",
        "nb_tickets_support", "nb_remboursements",
    ]


def _category_aggs() -> list:
    clk = F.col("src") == 0
    return [
        safe_ratio(F.count_if(clk & (F.col("action") == "purchase")), F.count_if(clk))
        .alias("taux_achat_categorie"),
        money_avg(F.when(clk, F.col("price"))).alias("prix_moy_categorie"),
        F.count_if(clk).alias("nb_clics"),
    ]


def user_table(clicks: DataFrame, transactions: DataFrame | None,
               support: DataFrame | None) -> DataFrame:
    """E1-E11 in one aggregation over a union of the three tables (one shuffle).

    Users that appear only in payments or tickets get a row too; a left join from
    the clicks ignores them.
    """
    u = _narrow_union(clicks, transactions, support)
    agg = u.filter(F.col("user_id").isNotNull()).groupBy("user_id").agg(*_user_aggs())
    return agg.select(*_user_cols())


def _key_rows(clicks: DataFrame, transactions: DataFrame | None, support: DataFrame | None) -> DataFrame:
    """Rows of both key tables: gid 1 by user, gid 2 by category, null keys included."""
    u = _narrow_union(clicks, transactions, support)
    return (u.groupingSets([["user_id"], ["category"]], "user_id", "category")
            .agg(*_user_aggs(), *_category_aggs(), F.grouping_id().alias("gid")))


def feature_weights(clicks: DataFrame, transactions: DataFrame | None = None, support: DataFrame | None = None) -> DataFrame:
    """The 13 features of the enriched clicks as (colonne, valeur, poids): every user's or
    category's value once, with the number of its clicks.

    The clicks are read once and never joined: what follows handles a row per user and
    feature.  Clicks without a user or category hold what the enriched table fills in."""
    rows = materialize(_key_rows(clicks, transactions, support).where("nb_clics > 0"), "key-rows")
    users = rows.filter("gid = 1").select(*_user_cols(), "nb_clics")
    cats = rows.filter("gid = 2").select("category", "taux_achat_categorie", "prix_moy_categorie", "nb_clics")
    out = None
    for table, key in ((users, "user_id"), (cats, "category")):
        names = [c for c in table.columns if c in S.ENRICHED_COLUMNS]
        known = F.col(key).isNotNull()  # nothing is joined to a null key
        values = [F.when(known, F.col(c).cast("double")) for c in names]
        values = [F.coalesce(v, F.lit(0.0)) if c in FILL_ZERO else v for c, v in zip(names, values)]
        long = table.select(F.explode(F.array(*[F.struct(F.lit(c).alias("colonne"), v.alias("valeur")) for c, v in zip(names, values)])).alias("kv"), "nb_clics")
        long = long.select("kv.colonne", "kv.valeur", F.col("nb_clics").alias("poids"))
        out = long if out is None else out.unionByName(long)
    return out


def key_tables(clicks: DataFrame, transactions: DataFrame | None,
               support: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """Per-user (E1-E11) and per-category (E12-E13) tables from one scan and one shuffle.

    A grouping-sets aggregate over the narrow union computes both keys at once
    (map-side partial aggregation for each set); the result is written once to the
    shared folder and read back as two tables, each with its row count for the
    broadcast check.
    """
    agg = _key_rows(clicks, transactions, support)
    # gid 1: grouped by user_id (category rolled up); gid 2: grouped by category.
    both = materialize(agg.filter(((F.col("gid") == 1) & F.col("user_id").isNotNull())
                                  | ((F.col("gid") == 2) & F.col("category").isNotNull())),
                       "key-tables")
    counts = {r["gid"]: r["count"] for r in both.groupBy("gid").count().collect()}
    users = both.filter(F.col("gid") == 1).select(*_user_cols())
    cats = both.filter(F.col("gid") == 2).select("category", "taux_achat_categorie",
                                                 "prix_moy_categorie")
    users._sillage_rows = counts.get(1, 0)
    cats._sillage_rows = counts.get(2, 0)
    return users, cats


def join_features(clicks: DataFrame, users: DataFrame, cats: DataFrame,
                  broadcast_max_rows: int | None = None) -> DataFrame:
    """J1-J2 + fills: attach per-user and per-category feature tables to the clicks.

    Both tables should be materialised (``joins.materialize``) so the broadcast
    decision is made on their true row count.
    """
    kw = {} if broadcast_max_rows is None else {"max_rows": broadcast_max_rows}
    out = (clicks.join(broadcast_if_small(users, **kw), "user_id", "left")
           .join(broadcast_if_small(cats, **kw), "category", "left"))
    out = out.select(*clicks.columns, *S.ENRICHED_COLUMNS)
    return out.na.fill({c: 0 for c in FILL_ZERO})


def enriched_clicks(clicks: DataFrame, transactions: DataFrame | None = None,
                    support: DataFrame | None = None,
                    broadcast_max_rows: int | None = None) -> DataFrame:
    """Every click with its 13 user and category features.

    The two key tables come from one grouping-sets aggregate written to the shared
    folder first, which is what makes the broadcast decision a checked one.
    """
    users, cats = key_tables(clicks, transactions, support)
    return join_features(clicks, users, cats, broadcast_max_rows)
