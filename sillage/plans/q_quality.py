"""Data-quality queries (Q1-Q7) over the defective clicks, payments and tickets."""

from __future__ import annotations

from .. import schemas as S
from ..operators import quality as Q
from ..sources import fixtures as FX
from . import oracle as O
from .catalog import register

DEFECTIVE_COLS = ["session_id", "user_id", "action", "category", "price", "rating",
                  "duree_visite"]
TX_COLS = ["session_id", "user_id", "product_id", "product_title", "category", "montant_paye",
           "methode_paiement", "statut_paiement", "timestamp"]
SUPPORT_COLS = ["session_id", "user_id", "motif_contact", "canal", "resolu", "timestamp"]
SQL_TABLES = {"clickstream": ("defective", DEFECTIVE_COLS),
              "transactions": ("transactions", TX_COLS),
              "service_client": ("support", SUPPORT_COLS)}
STATS_COLUMNS = {"clickstream": ["price", "rating", "duree_visite"],
                 "transactions": ["montant_paye"]}
HISTOGRAMS = [("clickstream", "price", 30), ("clickstream", "rating", 20),
              ("transactions", "montant_paye", 30)]


def dq_tables(spark, sf_dir):
    return {"clickstream": FX.defective(spark, sf_dir).drop("event_id"),
            "transactions": FX.transactions(spark, sf_dir, with_event_id=False),
            "service_client": FX.support(spark, sf_dir, with_event_id=False)}


def _qc(c: str) -> str:
    return f'"{c}"'


register("dq_shape", O.with_fixtures("\nUNION ALL ".join(
    f"SELECT '{t}' AS \"table\", count(*) AS nb_lignes, {len(cols)} AS nb_colonnes FROM {v}"
    for t, (v, cols) in SQL_TABLES.items())))(lambda spark, sf_dir: Q.shape(dq_tables(spark, sf_dir)))

register("dq_completeness", O.with_fixtures("SELECT * FROM (" + "\nUNION ALL ".join(
    f"SELECT '{t}' AS \"table\", '{c}' AS colonne, "
    f"count(*) FILTER (WHERE {_qc(c)} IS NULL) AS nb_manquants, "
    f"CASE WHEN count(*) > 0 THEN round(count(*) FILTER (WHERE {_qc(c)} IS NULL) * 100.0 / count(*), 1) "
    f"ELSE 0.0 END AS pct_manquants FROM {v}"
    for t, (v, cols) in SQL_TABLES.items() for c in cols) + ") WHERE nb_manquants > 0"))(
    lambda spark, sf_dir: Q.completeness(dq_tables(spark, sf_dir)))

register("dq_duplicates", O.with_fixtures("\nUNION ALL ".join(
    f"SELECT '{t}' AS \"table\", 'session_id' AS cle, "
    f"CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS nb_doublons "
    f"FROM (SELECT session_id, count(*) AS n FROM {v} GROUP BY session_id)"
    for t, (v, _) in SQL_TABLES.items())))(
    lambda spark, sf_dir: Q.duplicates(dq_tables(spark, sf_dir)))

_RULES_SQL = [
    ("clickstream", "actions_invalides",
     f"NOT coalesce(action IN {O.sql_list(S.ACTIONS)}, false)"),
    ("clickstream", "prix_negatifs", "coalesce(price < 0, false)"),
    ("clickstream", "ratings_hors_bornes", "coalesce(rating < 0 OR rating > 5, false)"),
    ("clickstream", "durees_negatives", "coalesce(duree_visite < 0, false)"),
    ("transactions", "statuts_invalides",
     f"NOT coalesce(statut_paiement IN {O.sql_list(S.PAYMENT_STATUSES_VALID)}, false)"),
    ("transactions", "montants_negatifs", "coalesce(montant_paye < 0, false)"),
]
register("dq_coherence", O.with_fixtures("\nUNION ALL ".join(
    f"SELECT '{t}' AS \"table\", '{r}' AS regle, count(*) FILTER (WHERE {cond}) AS nb_anomalies "
    f"FROM {SQL_TABLES[t][0]}" for t, r, cond in _RULES_SQL)))(
    lambda spark, sf_dir: Q.coherence(dq_tables(spark, sf_dir)))

register("dq_stats", O.with_fixtures("\nUNION ALL ".join(
    f"SELECT '{t}' AS \"table\", '{c}' AS colonne, round(min(CAST({c} AS DOUBLE)), 2) AS \"min\", "
    f"round(max(CAST({c} AS DOUBLE)), 2) AS \"max\", round(avg(CAST({c} AS DOUBLE)), 2) AS moyenne, "
    f"round(stddev_samp(CAST({c} AS DOUBLE)), 2) AS ecart_type FROM {SQL_TABLES[t][0]}"
    for t, cols in STATS_COLUMNS.items() for c in cols)))(
    lambda spark, sf_dir: Q.column_stats(dq_tables(spark, sf_dir), STATS_COLUMNS))

DIST_COLUMNS = ["action", "category", "source"]  # source is absent from the defective view
register("dq_distribution", O.with_fixtures("""
SELECT colonne, valeur, nb, round(nb * 100.0 / sum(nb) OVER (PARTITION BY colonne), 1) AS pct
FROM (
  SELECT 'action' AS colonne, action AS valeur, count(*) AS nb FROM defective
  WHERE action IS NOT NULL GROUP BY action
  UNION ALL
  SELECT 'category', category, count(*) FROM defective
  WHERE category IS NOT NULL GROUP BY category
)"""))(lambda spark, sf_dir: Q.distribution(dq_tables(spark, sf_dir)["clickstream"], DIST_COLUMNS))


def _hist_sql(view: str, c: str, bins: int) -> str:
    nb = float(bins)

    def edge(i: str) -> str:
        return f"(CASE WHEN {i} = {bins} THEN hi ELSE CAST({i} AS DOUBLE) * ((hi - lo) / {nb}) + lo END)"

    i0 = f"CAST(least(floor((v - lo) * ({nb} / (hi - lo))), {bins - 1}) AS INTEGER)"
    return f"""
SELECT '{c}' AS colonne, b.bin,
  CASE WHEN b.bin = {bins} THEN r.hi ELSE CAST(b.bin AS DOUBLE) * ((r.hi - r.lo) / {nb}) + r.lo END
    AS borne_inf,
  CASE WHEN b.bin + 1 = {bins} THEN r.hi ELSE CAST(b.bin + 1 AS DOUBLE) * ((r.hi - r.lo) / {nb}) + r.lo END
    AS borne_sup,
  coalesce(cnt.nb, 0) AS nb
FROM (SELECT CASE WHEN min(v) = max(v) THEN min(v) - 0.5 ELSE min(v) END AS lo,
             CASE WHEN min(v) = max(v) THEN max(v) + 0.5 ELSE max(v) END AS hi
      FROM (SELECT CAST({c} AS DOUBLE) AS v FROM {view} WHERE {c} IS NOT NULL)) r
CROSS JOIN (SELECT CAST(unnest(range(0, {bins})) AS INTEGER) AS bin) b
LEFT JOIN (
  SELECT CASE WHEN v < {edge('i0')} THEN i0 - 1
              WHEN i0 <> {bins - 1} AND v >= {edge('i0 + 1')} THEN i0 + 1
              ELSE i0 END AS bin,
         count(*) AS nb
  FROM (SELECT v, lo, hi, {i0} AS i0
        FROM (SELECT CAST({c} AS DOUBLE) AS v FROM {view} WHERE {c} IS NOT NULL),
             (SELECT CASE WHEN min(v) = max(v) THEN min(v) - 0.5 ELSE min(v) END AS lo,
                     CASE WHEN min(v) = max(v) THEN max(v) + 0.5 ELSE max(v) END AS hi
              FROM (SELECT CAST({c} AS DOUBLE) AS v FROM {view} WHERE {c} IS NOT NULL)))
  GROUP BY 1) cnt ON cnt.bin = b.bin"""


def _histograms(spark, sf_dir):
    t = dq_tables(spark, sf_dir)
    per_table: dict[str, dict[str, int]] = {}
    for table, c, bins in HISTOGRAMS:
        per_table.setdefault(table, {})[c] = bins
    out = None
    for table, spec in per_table.items():
        h = Q.histograms(t[table], spec)
        out = h if out is None else out.unionByName(h)
    return out


register("dq_histogram", O.with_fixtures("\nUNION ALL ".join(
    _hist_sql(SQL_TABLES[t][0], c, b) for t, c, b in HISTOGRAMS)))(_histograms)
