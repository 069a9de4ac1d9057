"""Feature queries."""

from __future__ import annotations

from .. import schemas as S
from ..operators import asof as AS
from ..operators import features as E
from ..operators import stats as ST
from ..sources import fixtures as FX
from . import oracle as O
from .catalog import register

USER_FEATURES_SQL = f"""
SELECT user_id, count(*) AS nb_actions_user,
  count(*) FILTER (WHERE action = 'purchase') AS nb_achats_user,
  count(*) FILTER (WHERE action = 'abandon') AS nb_abandons_user,
  avg(duree_visite) AS duree_moy_user,
  count(*) FILTER (WHERE action = 'purchase') / count(*) AS taux_achat_user,
  CAST(sum({O.action_score_sql()}) AS BIGINT) AS score_engagement_total
FROM clicks WHERE user_id IS NOT NULL GROUP BY user_id"""

USER_SPEND_SQL = """
SELECT user_id, CAST(sum(CAST(montant_paye AS DECIMAL(38,10))) AS DOUBLE) AS montant_total_depense,
  count(*) AS nb_transactions_reussies,
  CAST(sum(CAST(montant_paye AS DECIMAL(38,10))) AS DOUBLE) / count(montant_paye) AS panier_moyen
FROM transactions WHERE statut_paiement = 'succès' AND user_id IS NOT NULL GROUP BY user_id"""

USER_SUPPORT_SQL = """
SELECT user_id, count(*) AS nb_tickets_support,
  count(*) FILTER (WHERE motif_contact = 'remboursement') AS nb_remboursements
FROM support WHERE user_id IS NOT NULL GROUP BY user_id"""

CATEGORY_SQL = """
SELECT category,
  count(*) FILTER (WHERE action = 'purchase') / count(*) AS taux_achat_categorie,
  CASE WHEN count(price) > 0
       THEN CAST(sum(CAST(price AS DECIMAL(38,10))) AS DOUBLE) / count(price) END AS prix_moy_categorie
FROM clicks WHERE category IS NOT NULL GROUP BY category"""

CLICK_COLS = ["event_id", "session_id", "user_id", "product_id", "product_title", "category",
              "price", "rating", "action", "page_visitee", "duree_visite", "source",
              "review_text", "timestamp"]

ENRICHED_CTE = f"""
enriched AS (
  SELECT {', '.join('c.' + (c if c != 'timestamp' else '"timestamp"') for c in CLICK_COLS)},
    uf.nb_actions_user,
    coalesce(uf.nb_achats_user, 0) AS nb_achats_user,
    coalesce(uf.nb_abandons_user, 0) AS nb_abandons_user,
    uf.duree_moy_user,
    coalesce(uf.taux_achat_user, 0.0) AS taux_achat_user,
    uf.score_engagement_total,
    coalesce(us.montant_total_depense, 0.0) AS montant_total_depense,
    coalesce(us.nb_transactions_reussies, 0) AS nb_transactions_reussies,
    coalesce(us.panier_moyen, 0.0) AS panier_moyen,
    coalesce(ut.nb_tickets_support, 0) AS nb_tickets_support,
    coalesce(ut.nb_remboursements, 0) AS nb_remboursements,
    coalesce(cf.taux_achat_categorie, 0.0) AS taux_achat_categorie,
    cf.prix_moy_categorie
  FROM clicks c
  LEFT JOIN ({USER_FEATURES_SQL}) uf ON uf.user_id = c.user_id
  LEFT JOIN ({USER_SPEND_SQL}) us ON us.user_id = c.user_id
  LEFT JOIN ({USER_SUPPORT_SQL}) ut ON ut.user_id = c.user_id
  LEFT JOIN ({CATEGORY_SQL}) cf ON cf.category = c.category
)"""


def enriched(spark, sf_dir):
    j = FX.journey(spark, sf_dir)
    return E.enriched_clicks(j.clicks, j.transactions, j.support)


register("user_features", O.with_fixtures(USER_FEATURES_SQL))(
    lambda spark, sf_dir: E.user_features(FX.clicks(spark, sf_dir)))
register("user_spend", O.with_fixtures(USER_SPEND_SQL))(
    lambda spark, sf_dir: E.user_spend(FX.transactions(spark, sf_dir)))
register("user_support", O.with_fixtures(USER_SUPPORT_SQL))(
    lambda spark, sf_dir: E.user_support(FX.support(spark, sf_dir)))
register("category_features", O.with_fixtures(CATEGORY_SQL))(
    lambda spark, sf_dir: E.category_features(FX.clicks(spark, sf_dir)))
register("enriched_clicks", O.with_fixtures("SELECT * FROM enriched", ENRICHED_CTE))(enriched)


def _describe_sql(columns: list[str]) -> str:
    parts = []
    for c in columns:
        parts.append(f"""
  SELECT '{c}' AS colonne,
    round(CAST(count({c}) AS DOUBLE), 2) AS "count", round(avg({c}), 2) AS mean,
    round(stddev_samp({c}), 2) AS std, round(min({c}), 2) AS "min",
    round(quantile_cont({c}, 0.25), 2) AS p25, round(quantile_cont({c}, 0.5), 2) AS p50,
    round(quantile_cont({c}, 0.75), 2) AS p75, round(max({c}), 2) AS "max"
  FROM (SELECT CAST({c} AS DOUBLE) AS {c} FROM enriched)""")
    return "\nUNION ALL".join(parts)


register("feature_summary", O.with_fixtures(_describe_sql(S.ENRICHED_COLUMNS), ENRICHED_CTE))(
    lambda spark, sf_dir: ST.describe_weighted(E.feature_weights(*FX.journey(spark, sf_dir).tables())))


_BEFORE = "(PARTITION BY user_id ORDER BY instant RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"


def _so_far(expr: str) -> str:
    return f"coalesce(sum({expr}) OVER w, 0)"


ASOF_CTE = f"""
avant AS (
  SELECT kind, event_id, user_id, CAST({_so_far("CAST(kind = 'c' AS INTEGER)")} AS BIGINT) AS nb_actions_user,
    CAST({_so_far("CAST(action = 'purchase' AS INTEGER)")} AS BIGINT) AS nb_achats_user,
    CAST({_so_far("CAST(action = 'abandon' AS INTEGER)")} AS BIGINT) AS nb_abandons_user,
    sum(duree_visite) OVER w / count(duree_visite) OVER w AS duree_moy_user,
    CAST({_so_far("score")} AS BIGINT) AS score_engagement_total,
    CAST({_so_far("montant")} AS DOUBLE) AS montant_total_depense,
    CAST({_so_far("CAST(kind = 'p' AS INTEGER)")} AS BIGINT) AS nb_transactions_reussies,
    CAST({_so_far("CAST(kind = 't' AS INTEGER)")} AS BIGINT) AS nb_tickets_support,
    CAST({_so_far("CAST(motif_contact = 'remboursement' AS INTEGER)")} AS BIGINT) AS nb_remboursements
  FROM (
    SELECT 'c' AS kind, event_id, user_id, "timestamp", action, duree_visite, {O.action_score_sql()} AS score,
      CAST(NULL AS DECIMAL(38,10)) AS montant, NULL AS motif_contact FROM clicks
    UNION ALL SELECT 'p', event_id, user_id, "timestamp", NULL, NULL, NULL, CAST(montant_paye AS DECIMAL(38,10)), NULL
      FROM transactions WHERE statut_paiement = 'succès'
    UNION ALL SELECT 't', event_id, user_id, "timestamp", NULL, NULL, NULL, NULL, motif_contact FROM support) u,
    LATERAL (SELECT CAST(round(u."timestamp" * 1000000) AS BIGINT) AS instant) i
  WINDOW w AS {_BEFORE})"""

ASOF_SQL = """
SELECT event_id, user_id, nb_actions_user, nb_achats_user, nb_abandons_user, duree_moy_user,
  CASE WHEN nb_actions_user > 0 THEN nb_achats_user / nb_actions_user ELSE 0.0 END AS taux_achat_user, score_engagement_total,
  montant_total_depense, nb_transactions_reussies,
  CASE WHEN nb_transactions_reussies > 0 THEN montant_total_depense / nb_transactions_reussies ELSE 0.0 END AS panier_moyen,
  nb_tickets_support, nb_remboursements
FROM avant WHERE kind = 'c'"""


@register("asof_features", O.with_fixtures(ASOF_SQL, ASOF_CTE))
def asof_features(spark, sf_dir):
    """The user features of every click from strictly earlier events only."""
    j = FX.journey(spark, sf_dir)
    return AS.asof_features(j.clicks, j.transactions, j.support)
