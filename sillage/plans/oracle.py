"""DuckDB SQL equivalents of the catalogue queries (the correctness oracle).

Every statement starts from the raw test tables (``events``, ``part``,
``benchmark``) through the same fixture mapping as ``sources.fixtures``.
"""

from __future__ import annotations

from .. import schemas as S
from ..sources import fixtures as FX


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _case(expr: str, values: list, default: str | None = None) -> str:
    parts = " ".join(f"WHEN {i} THEN {_q(v) if v is not None else 'NULL'}"
                     for i, v in enumerate(values))
    return f"CASE {expr} {parts} ELSE {_q(default) if default is not None else 'NULL'} END"


PHRASE_LIST = [FX.PHRASES[0], FX.PHRASES[1], FX.PHRASES[2], None, FX.PHRASES[4], FX.PHRASES[5]]

CLICKS_CTE = f"""
clicks AS (
  SELECT e.event_id,
    lpad(lower(to_hex(e.event_id)), 8, '0') AS session_id,
    CAST(e.user_id AS INTEGER) AS user_id,
    CAST(e.k AS INTEGER) AS product_id,
    p.p_name AS product_title,
    p.p_type AS category,
    CAST(p.p_retailprice AS DOUBLE) AS price,
    CAST(p.p_size % 6 AS DOUBLE) AS rating,
    CASE
      WHEN e.user_id % 4 = 1 AND e.event_type IN ('purchase','click','signup') THEN 'purchase'
      WHEN e.user_id % 4 = 2 AND e.event_type = 'purchase' THEN 'view'
      WHEN e.user_id % 4 = 3 AND e.event_type IN ('purchase','click') THEN 'purchase'
      WHEN e.event_type = 'click' THEN 'add_to_cart'
      WHEN e.event_type = 'signup' THEN 'search'
      WHEN e.event_type = 'error' THEN 'abandon'
      ELSE e.event_type END AS action,
    {_case('e.event_id % 5', FX.PAGE_BY_MOD5)} AS page_visitee,
    CAST(floor(e.value) AS INTEGER) AS duree_visite,
    {_case('e.event_id % 7', FX.SOURCE_BY_MOD7, 'reseaux_sociaux')} AS source,
    CASE WHEN e.event_id % 6 = 3 THEN NULL
         ELSE concat(b.text, ' ', {_case('e.event_id % 6', PHRASE_LIST)}) END
      AS review_text,
    epoch_us(e.ts) / 1e6 AS "timestamp"
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events) e
  LEFT JOIN part p ON p.p_partkey = e.k
  LEFT JOIN benchmark b ON b.item_id = e.event_id % (SELECT count(*) FROM benchmark)
)"""

TX_CTE = f"""
transactions AS (
  SELECT event_id, session_id, user_id, product_id, product_title, category,
    round(price * (0.8 + 0.02 * (event_id % 11)), 2) AS montant_paye,
    {_case('event_id % 3', FX.METHOD_BY_MOD3)} AS methode_paiement,
    CASE WHEN event_id % 5 = 3 THEN 'échoué' WHEN event_id % 5 = 4 THEN 'en_attente'
         ELSE 'succès' END AS statut_paiement,
    "timestamp"
  FROM clicks WHERE action = 'purchase'
)"""

SUPPORT_CTE = f"""
support AS (
  SELECT event_id, session_id, user_id,
    {_case('event_id % 4', FX.REASON_BY_MOD4)} AS motif_contact,
    {_case('event_id % 3', FX.CHANNEL_BY_MOD3)} AS canal,
    (event_id % 2 = 0) AS resolu,
    "timestamp"
  FROM clicks WHERE (event_id * 7) % 10 < 2
)"""

DEFECTIVE_CTE = """
defective AS (
  SELECT event_id, session_id, user_id,
    CASE WHEN event_id % 101 = 0 THEN NULL WHEN event_id % 103 = 0 THEN 'bogus'
         ELSE action END AS action,
    CASE WHEN event_id % 127 = 0 THEN NULL ELSE category END AS category,
    CASE WHEN event_id % 107 = 0 THEN -price ELSE price END AS price,
    CASE WHEN event_id % 109 = 0 THEN 7.0 ELSE rating END AS rating,
    CASE WHEN event_id % 113 = 0 THEN -1 ELSE duree_visite END AS duree_visite
  FROM clicks
  UNION ALL
  SELECT event_id, session_id, user_id, action, category, price, rating, duree_visite
  FROM clicks WHERE event_id < 20
)"""


def with_fixtures(body: str, *extra_ctes: str) -> str:
    ctes = [CLICKS_CTE, TX_CTE, SUPPORT_CTE, DEFECTIVE_CTE, *extra_ctes]
    return "WITH " + ",".join(ctes) + "\n" + body


def sql_list(values: list[str]) -> str:
    return "(" + ", ".join(_q(v) for v in values) + ")"


def sql_array(values: list[str]) -> str:
    return "[" + ", ".join(_q(v) for v in values) + "]"


def action_score_sql(col: str = "action") -> str:
    parts = " ".join(f"WHEN {_q(a)} THEN {s}" for a, s in S.ACTION_SCORES.items())
    return f"CASE {col} {parts} ELSE 0 END"


REVIEW_CLEAN_SQL = ("lower(regexp_replace(review_text, '[^a-zA-Z \\t\\n\\x0B\\f\\r]', '', 'g'))")
