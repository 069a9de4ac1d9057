"""Governance queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schemas as S
from ..operators import governance as G
from ..operators import sinks as K
from ..session import scratch_path
from ..sources import fixtures as FX
from . import oracle as O
from .catalog import register
from .q_features import ENRICHED_CTE, enriched

# Fixed parameters of the registered queries: the erasure request (the reference's
# demo id 999, which matches nobody, and user 7) and the retention reference instant.
ERASE_IDS = [7, 999]
AS_OF = "2024-04-15 00:00:00"


@register("pseudonymise", O.with_fixtures(
    "SELECT event_id, user_id, substr(sha256(CAST(CAST(user_id AS BIGINT) AS VARCHAR)), 1, 12) "
    "AS user_id_anonyme FROM clicks"))
def _pseudonymise(spark, sf_dir):
    return G.pseudonymise(FX.clicks(spark, sf_dir).select("event_id", "user_id"))


register("minimise", O.with_fixtures(
    "SELECT " + ", ".join(c if c != "timestamp" else '"timestamp"' for c in S.NEEDED_COLUMNS)
    + " FROM clicks"))(lambda spark, sf_dir: G.minimise(FX.clicks(spark, sf_dir)))

_IDS = ", ".join(str(i) for i in ERASE_IDS)


@register("erase_user", O.with_fixtures(
    f"SELECT event_id, session_id, user_id FROM clicks "
    f"WHERE user_id IS NULL OR user_id NOT IN ({_IDS})"))
def _erase_user(spark, sf_dir):
    return G.erase(FX.clicks(spark, sf_dir).select("event_id", "session_id", "user_id"), ERASE_IDS)


@register("erase_counts", O.with_fixtures(f"""
SELECT 'clickstream' AS "table", count(*) FILTER (WHERE user_id IN ({_IDS})) AS nb_supprimes FROM clicks
UNION ALL SELECT 'transactions', count(*) FILTER (WHERE user_id IN ({_IDS})) FROM transactions
UNION ALL SELECT 'service_client', count(*) FILTER (WHERE user_id IN ({_IDS})) FROM support
UNION ALL SELECT 'clickstream_enrichi', count(*) FILTER (WHERE user_id IN ({_IDS})) FROM enriched""",
    ENRICHED_CTE))
def _erase_counts(spark, sf_dir):
    j = FX.journey(spark, sf_dir)
    tables = {"clickstream": j.clicks, "transactions": j.transactions,
              "service_client": j.support, "clickstream_enrichi": enriched(spark, sf_dir)}
    report = G.erase_counts(tables, ERASE_IDS)
    return K.write_json_report(report, scratch_path(spark, "rapport-effacement"))


#: For the query: every 50th payment has lost its date.
UNDATED = 50


def _ret_sql(name: str, view: str) -> str:
    years, days = S.RETENTION[name]
    ts = f'CASE WHEN event_id % {UNDATED} = 0 THEN NULL ELSE "timestamp" END' if name == "transactions" else '"timestamp"'
    keep = (f"make_timestamp(CAST(round(({ts}) * 1000000) AS BIGINT)) >= "
            f"TIMESTAMP '{AS_OF}' - INTERVAL {years} YEAR - INTERVAL {days} DAY")
    return (f"SELECT '{name}' AS \"table\", {years} AS annees, {days} AS jours, "
            f"count(*) FILTER (WHERE {keep}) AS nb_conserves, count(*) FILTER (WHERE NOT ({keep})) AS nb_expires, "
            f"count(*) FILTER (WHERE ({ts}) IS NULL) AS nb_sans_date FROM {view}")


@register("retention", O.with_fixtures("\nUNION ALL ".join([
    _ret_sql("clickstream", "clicks"), _ret_sql("transactions", "transactions"),
    _ret_sql("service_client", "support")])))
def _retention(spark, sf_dir):
    j = FX.journey(spark, sf_dir)
    undated = j.transactions.withColumn("timestamp", F.when(F.col("event_id") % UNDATED != 0, F.col("timestamp")))
    return G.retention_report({"clickstream": j.clicks, "transactions": undated,
                               "service_client": j.support}, AS_OF)



@register("erase_applied", O.with_fixtures(f"""
SELECT session_id, user_id FROM clicks WHERE user_id IS NULL OR user_id NOT IN ({_IDS})
UNION ALL SELECT 'late', 7"""))
def _erase_applied(spark, sf_dir):
    """G3 on a live keyed table: two batches, erasure, and one more batch of the stream
    (the erased user comes back with a new session, which must not be lost)."""
    clicks = FX.clicks(spark, sf_dir).select("event_id", "session_id", "user_id")
    table = K.KeyedTable(scratch_path(spark, "erase-live"), ["session_id"])
    for epoch in (0, 1):
        table(clicks.filter(F.col("event_id") % 2 == epoch).drop("event_id"), epoch)
    G.apply_erasure(spark, {"clickstream": table.path}, ERASE_IDS)
    table(spark.createDataFrame([("late", 7)], "session_id string, user_id int"), 2)
    return table.read(spark).select("session_id", "user_id")


@register("pseudonymise_preview", O.with_fixtures(
    "SELECT session_id, user_id, substr(sha256(CAST(CAST(user_id AS BIGINT) AS VARCHAR)), 1, 12) "
    "AS user_id_anonyme FROM clicks ORDER BY \"timestamp\", session_id LIMIT 5"))
def _pseudonymise_preview(spark, sf_dir):
    """S6 + G1: the five-row before/after view, on a defined order (top-n, not a scan cap)."""
    top = FX.clicks(spark, sf_dir).orderBy("timestamp", "session_id").limit(5)
    return G.pseudonymise(top.select("session_id", "user_id"))


def _kept_sql(name: str, view: str) -> str:
    years, days = S.RETENTION[name]
    return (f"SELECT '{name}' AS \"table\", session_id, \"timestamp\" FROM {view} WHERE \"timestamp\" IS NULL OR "
            f"make_timestamp(CAST(round(\"timestamp\" * 1000000) AS BIGINT)) >= TIMESTAMP '{AS_OF}' - INTERVAL {years} YEAR - INTERVAL {days} DAY")


@register("retention_applied", O.with_fixtures("\nUNION ALL ".join([
    _kept_sql("clickstream", "clicks"), _kept_sql("transactions", "transactions"), _kept_sql("service_client", "support")])))
def _retention_applied(spark, sf_dir):
    """G4 on stored tables of all three kinds; what is returned is read from every file left
    below their paths, so a row that retention missed anywhere would show."""
    j = FX.journey(spark, sf_dir)
    columns = ["event_id", "session_id", "user_id", "timestamp"]
    clicks = K.EpochSink(scratch_path(spark, "keep-clicks"), [G.DAY])
    for epoch in (0, 1):
        clicks(G.with_day(j.clicks.select(*columns).where(F.col("event_id") % 2 == epoch)), epoch)
    paid = K.KeyedTable(scratch_path(spark, "keep-tx"), ["session_id", "timestamp"])
    paid(j.transactions.select(*columns), 0)
    tickets = K.VersionedTable(scratch_path(spark, "keep-tickets"))
    tickets.write(j.support.select(*columns))
    paths = {"clickstream": clicks.path, "transactions": paid.path, "service_client": tickets.path}
    G.apply_retention(spark, paths, AS_OF)
    out = None
    for name, path in paths.items():
        rows = spark.read.option("recursiveFileLookup", True).parquet(path).select(F.lit(name).alias("table"), "session_id", "timestamp")
        out = rows if out is None else out.unionByName(rows)
    return out
