"""Dashboard, scan and count queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schemas as S
from ..operators import analytics as A
from ..sources import fixtures as FX
from . import oracle as O
from .catalog import register

# Fixed parameters of the registered dashboard queries.
FILTER_CATEGORY = "SMALL"
FILTER_SOURCE = "google"
TEST_STOP_WORDS = ["the", "and", "of", "for", "with", "that", "in", "on", "to", "but", "very"]

_KPI_SQL_BODY = """
SELECT nb_evenements, nb_achats, nb_abandons, nb_transactions, nb_tickets,
  CASE WHEN nb_achats + nb_abandons > 0
       THEN round(nb_achats * 100.0 / (nb_achats + nb_abandons), 1) ELSE 0.0 END
    AS taux_conversion,
  round(coalesce(rev, 0.0), 2) AS revenu_total,
  round(coalesce(rev_ok, 0.0), 2) AS revenu_succes,
  nb_echecs_regex, nb_echecs
FROM (
  SELECT
    (SELECT count(*) FROM {clicks}) AS nb_evenements,
    (SELECT count(*) FROM {clicks} WHERE action = 'purchase') AS nb_achats,
    (SELECT count(*) FROM {clicks} WHERE action = 'abandon') AS nb_abandons,
    (SELECT count(*) FROM transactions) AS nb_transactions,
    (SELECT count(*) FROM support) AS nb_tickets,
    (SELECT CAST(sum(CAST(montant_paye AS DECIMAL(38,10))) AS DOUBLE) FROM transactions) AS rev,
    (SELECT CAST(sum(CAST(montant_paye AS DECIMAL(38,10))) AS DOUBLE) FROM transactions
      WHERE statut_paiement = 'succès') AS rev_ok,
    (SELECT count(*) FROM transactions
      WHERE coalesce(regexp_matches(statut_paiement, 'choue|failed', 'i'), false)) AS nb_echecs_regex,
    (SELECT count(*) FROM transactions WHERE statut_paiement IN ('échoué','echoue','failed'))
      AS nb_echecs
)"""


def _kpis(spark, sf_dir, category=None, source=None):
    j = FX.journey(spark, sf_dir)
    return A.kpis(A.filter_clicks(j.clicks, category, source), j.transactions, j.support)


register("kpis", O.with_fixtures(_KPI_SQL_BODY.format(clicks="clicks")))(
    lambda spark, sf_dir: _kpis(spark, sf_dir))

_FILTERED = (f"filtered AS (SELECT * FROM clicks WHERE category = {O._q(FILTER_CATEGORY)} "
             f"AND source = {O._q(FILTER_SOURCE)})")
register("kpis_filtered", O.with_fixtures(_KPI_SQL_BODY.format(clicks="filtered"), _FILTERED))(
    lambda spark, sf_dir: _kpis(spark, sf_dir, FILTER_CATEGORY, FILTER_SOURCE))


@register("alerts", O.with_fixtures(f"""
SELECT alerte, valeur, seuil, declenchee,
  CASE WHEN declenchee AND alerte = 'conversion' THEN 'error'
       WHEN declenchee THEN 'warning' ELSE 'success' END AS niveau
FROM (
  SELECT 'conversion' AS alerte, CAST(taux_conversion AS DOUBLE) AS valeur, 50.0 AS seuil,
         taux_conversion < 50 AS declenchee, true AS visible FROM k
  UNION ALL
  SELECT 'paiements_echoues', CAST(nb_echecs AS DOUBLE), 10.0, nb_echecs > 10,
         nb_transactions > 0 FROM k
  UNION ALL
  SELECT 'abandons_vs_achats', CAST(nb_abandons AS DOUBLE), CAST(nb_achats AS DOUBLE),
         nb_abandons > nb_achats, true FROM k
) WHERE visible""", "k AS (" + _KPI_SQL_BODY.format(clicks="clicks") + ")"))
def _alerts(spark, sf_dir):
    return A.alerts(_kpis(spark, sf_dir))


@register("funnel", O.with_fixtures(f"""
SELECT action, count(*) AS nb, list_position({O.sql_array(S.FUNNEL_ORDER)}, action) AS etape
FROM clicks WHERE action IS NOT NULL GROUP BY action"""))
def _funnel(spark, sf_dir):
    return A.funnel(FX.clicks(spark, sf_dir))


@register("category_actions", O.with_fixtures("""
SELECT category, action, count(*) AS nb FROM clicks
WHERE category IS NOT NULL AND action IS NOT NULL GROUP BY category, action"""))
def _category_actions(spark, sf_dir):
    return A.category_actions(FX.clicks(spark, sf_dir))


_MINUTE_SQL = """
SELECT make_timestamp(CAST(floor("timestamp" / 60) * 60 AS BIGINT) * 1000000) AS minute,
  count(*) FILTER (WHERE action = 'purchase') AS achats,
  count(*) FILTER (WHERE action = 'abandon') AS abandons
FROM clicks WHERE action IN ('purchase', 'abandon') AND "timestamp" IS NOT NULL
GROUP BY 1"""

register("conversion_by_minute", O.with_fixtures(
    f"SELECT * FROM ({_MINUTE_SQL}) ORDER BY minute DESC LIMIT 20"))(
    lambda spark, sf_dir: A.conversion_by_minute(FX.clicks(spark, sf_dir), 20))


def _vc_sql(table: str, column: str) -> str:
    return O.with_fixtures(f"SELECT {column}, count(*) AS nb FROM {table} "
                           f"WHERE {column} IS NOT NULL GROUP BY {column}")


register("by_source", _vc_sql("clicks", "source"))(
    lambda spark, sf_dir: A.value_counts(FX.clicks(spark, sf_dir), "source"))
register("by_status", _vc_sql("transactions", "statut_paiement"))(
    lambda spark, sf_dir: A.value_counts(FX.transactions(spark, sf_dir), "statut_paiement"))
register("by_method", _vc_sql("transactions", "methode_paiement"))(
    lambda spark, sf_dir: A.value_counts(FX.transactions(spark, sf_dir), "methode_paiement"))
register("by_reason", _vc_sql("support", "motif_contact"))(
    lambda spark, sf_dir: A.value_counts(FX.support(spark, sf_dir), "motif_contact"))


@register("distinct_filters", O.with_fixtures("""
SELECT DISTINCT 'category' AS filtre, category AS valeur FROM clicks
UNION SELECT DISTINCT 'source', source FROM clicks"""))
def _distinct_filters(spark, sf_dir):
    return A.distinct_filters(FX.clicks(spark, sf_dir))


@register("review_top_words", O.with_fixtures(f"""
SELECT mot, count(*) AS nb FROM (
  SELECT unnest(string_split_regex(trim({O.REVIEW_CLEAN_SQL}), '\\s+')) AS mot
  FROM clicks WHERE review_text IS NOT NULL)
WHERE length(mot) > 0 AND mot NOT IN {O.sql_list(TEST_STOP_WORDS)}
GROUP BY mot ORDER BY nb DESC, mot LIMIT 100"""))
def _review_top_words(spark, sf_dir):
    return A.review_top_words(FX.clicks(spark, sf_dir), TEST_STOP_WORDS, 100)


# Equality scans, pushed into the parquet reader by Catalyst where possible.
_SCAN_COLS = ["session_id", "user_id", "product_id", "category", "price", "action", "timestamp"]
register("scan_by_action", O.with_fixtures(
    f"SELECT {', '.join(c if c != 'timestamp' else '\"timestamp\"' for c in _SCAN_COLS)} "
    "FROM clicks WHERE action = 'purchase'"))(
    lambda spark, sf_dir: FX.clicks(spark, sf_dir).filter(F.col("action") == "purchase")
    .select(*_SCAN_COLS))
register("scan_by_category", O.with_fixtures(
    f"SELECT {', '.join(c if c != 'timestamp' else '\"timestamp\"' for c in _SCAN_COLS)} "
    f"FROM clicks WHERE category = {O._q(FILTER_CATEGORY)}"))(
    lambda spark, sf_dir: FX.clicks(spark, sf_dir)
    .filter(F.col("category") == FILTER_CATEGORY).select(*_SCAN_COLS))


@register("count_events", O.with_fixtures("""
SELECT (SELECT count(*) FROM clicks) AS nb_clicks,
       (SELECT count(*) FROM transactions) AS nb_transactions,
       (SELECT count(*) FROM support) AS nb_tickets"""))
def _count_events(spark, sf_dir):
    """Each of the three tables is counted as it is stated, with the columns its own
    rows need; the three counts are scalar subqueries of one job."""
    views = {"nb_clicks": FX.clicks(spark, sf_dir, columns=["session_id"]),
             "nb_transactions": FX.transactions(spark, sf_dir, columns=["session_id"]),
             "nb_tickets": FX.support(spark, sf_dir, columns=["session_id"])}
    counts = [v.agg(F.count(F.lit(1))).scalar().alias(n) for n, v in views.items()]
    return spark.range(1).select(*counts)
