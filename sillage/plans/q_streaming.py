"""Streaming, source and sink queries.

Each streaming query lands the test events as JSON lines in the shared folder (a
Spark write, standing in for the topic), runs the streaming plan with an
``availableNow`` trigger into its sink, and returns the sink read back as a table.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schemas as S
from ..operators import sinks as K
from ..session import scratch_path
from ..sources import events as EV
from ..sources import fixtures as FX
from ..streaming import jobs as J
from ..streaming import supervise as V
from ..streaming import windows as W
from . import oracle as O
from .catalog import register
from .q_dashboard import _KPI_SQL_BODY, _MINUTE_SQL


def land_json(df, schema, name: str, partitions: int | None = None) -> str:
    """Write rows as JSON-lines files into a fresh landing folder; return the folder."""
    path = scratch_path(df.sparkSession, f"landing-{name}")
    lines = EV.to_json_lines(df, schema)
    if partitions:
        lines = lines.repartition(partitions)
    lines.write.mode("overwrite").text(path)
    return path


def _stream_to_table(spark, sf_dir, name, schema, builder, sink_cls=K.EpochSink,
                     output_mode="append", files_per_batch=None, **sink_kw):
    frames = {"clickstream": lambda: FX.clicks(spark, sf_dir, with_event_id=False),
              "transactions": lambda: FX.transactions(spark, sf_dir, with_event_id=False),
              "service_client": lambda: FX.support(spark, sf_dir, with_event_id=False)}
    landing = land_json(frames[name](), schema, name)
    sink = sink_cls(scratch_path(spark, f"sink-{name}"), **sink_kw)
    df = builder(spark, {"format": "files", "path": landing,
                         "maxFilesPerTrigger": files_per_batch})
    J.run_once(df, sink, scratch_path(spark, f"ckpt-{name}"), f"{name}_{abs(hash(landing)) % 10**8}",
               output_mode)
    return sink.read(spark)


def _float(c: str) -> str:
    return f"CAST({c} AS FLOAT) AS {c}"


CLICK_STREAM_COLS = ["session_id", "user_id", "product_id", "product_title", "category",
                     _float("price"), _float("rating"), "action", "page_visitee", "duree_visite",
                     "source", "review_text", '"timestamp"']


@register("stream_clicks", O.with_fixtures(
    f"SELECT {', '.join(CLICK_STREAM_COLS)}, {O.REVIEW_CLEAN_SQL} AS review_clean, "
    f"{O.action_score_sql()} AS action_score, "
    f"CASE WHEN action = 'abandon' THEN {O._q(S.RECO_TEXTS['A']['abandon'])} "
    f"WHEN action = 'add_to_cart' THEN {O._q(S.RECO_TEXTS['A']['add_to_cart'])} "
    f"WHEN action = 'purchase' THEN {O._q(S.RECO_TEXTS['A']['purchase'])} "
    f"ELSE {O._q(S.RECO_TEXTS['A']['other'])} END AS recommendation, "
    "CAST(NULL AS VARCHAR) AS _corrupt_record FROM clicks"))
def stream_clicks(spark, sf_dir):
    """T1 + K1: clickstream topic → decode → P1-P3 → epoch-overwrite table."""
    out = _stream_to_table(spark, sf_dir, "clickstream", S.CLICKSTREAM_SCHEMA,
                           lambda sp, src: J.clicks_stream(sp, src, "A"))
    return out.drop("epoch")


@register("stream_tx", O.with_fixtures(
    "SELECT session_id, user_id, product_id, product_title, category, "
    "CAST(montant_paye AS FLOAT) AS montant_paye, methode_paiement, statut_paiement, "
    "\"timestamp\", CAST(NULL AS VARCHAR) AS _corrupt_record FROM transactions"))
def stream_tx(spark, sf_dir):
    """T2 + K1."""
    return _stream_to_table(spark, sf_dir, "transactions", S.TRANSACTION_SCHEMA,
                            J.transactions_stream).drop("epoch")


@register("stream_support", O.with_fixtures(
    "SELECT session_id, user_id, motif_contact, canal, resolu, \"timestamp\", "
    "CAST(NULL AS VARCHAR) AS _corrupt_record FROM support"))
def stream_support(spark, sf_dir):
    """T3 + K1."""
    return _stream_to_table(spark, sf_dir, "service_client", S.SUPPORT_SCHEMA,
                            J.support_stream).drop("epoch")


@register("stream_conversion", O.with_fixtures(_MINUTE_SQL))
def stream_conversion(spark, sf_dir):
    """Per-minute purchases/abandons, added up by minute over several micro-batches."""
    out = _stream_to_table(
        spark, sf_dir, "clickstream", S.CLICKSTREAM_SCHEMA,
        lambda sp, src: J.conversion_stream(J.clicks_stream(sp, src, None)),
        sink_cls=K.CountTable, files_per_batch=3, keys=["minute"])
    return out.select("minute", "achats", "abandons")


@register("stream_windows", O.with_fixtures(_MINUTE_SQL))
def stream_windows(spark, sf_dir):
    """T8 as event-time windows: keyed state with timers and a watermark, update mode, one
    file per trigger.  Each file holds a span of time and they come in any order, so many
    clicks are late; they are in the side table and in the totals."""
    clicks = FX.clicks(spark, sf_dir, with_event_id=False)
    landing = scratch_path(spark, "landing-windows")
    EV.to_json_lines(clicks.repartitionByRange(6, "timestamp"), S.CLICKSTREAM_SCHEMA).write.text(landing)
    stream = J.clicks_stream(spark, {"format": "files", "path": landing, "maxFilesPerTrigger": 1}, None)
    sink = W.WindowSink(scratch_path(spark, "sink-windows"))
    J.run_once(W.conversion_windows(stream), sink, scratch_path(spark, "ckpt-windows"), f"windows_{landing[-12:]}", "update")
    return sink.read(spark).drop("tardifs")


#: For the query: files a topic lands in, and files of a micro-batch.
RUN_FILES, RUN_PER_BATCH = 6, 2


@register("stream_run", O.with_fixtures("\nUNION ALL ".join(
    f"SELECT '{flux}' AS flux, CAST({RUN_FILES // RUN_PER_BATCH} AS BIGINT) AS lots, count(*) AS lignes, "
    f"CAST(0 AS BIGINT) AS redemarrages, 'done' AS etat FROM {view}"
    for flux, view in (("clickstream", "clicks"), ("transactions", "transactions"), ("service_client", "support")))))
def stream_run(spark, sf_dir):
    """The three consumers under the supervisor; its record of batches and rows."""
    topics = {"clickstream": (FX.clicks, S.CLICKSTREAM_SCHEMA, lambda src: J.clicks_stream(spark, src, "A")),
              "transactions": (FX.transactions, S.TRANSACTION_SCHEMA, lambda src: J.transactions_stream(spark, src)),
              "service_client": (FX.support, S.SUPPORT_SCHEMA, lambda src: J.support_stream(spark, src))}
    plans = {}
    for name, (rows, schema, build) in topics.items():
        path = land_json(rows(spark, sf_dir, with_event_id=False), schema, f"run-{name}", RUN_FILES)
        source = {"format": "files", "path": path, "maxFilesPerTrigger": RUN_PER_BATCH}
        spec = J.StreamSpec(f"run_{name}_{path[-12:]}", source, K.EpochSink(scratch_path(spark, f"run-{name}")),
                            scratch_path(spark, f"run-ckpt-{name}"), None)
        plans[name] = (build(source), spec)
    return V.report(spark, plans, V.run_supervised(spark, plans))


@register("json_decode", O.with_fixtures(
    f"SELECT {', '.join(CLICK_STREAM_COLS)}, CAST(NULL AS VARCHAR) AS _corrupt_record FROM clicks"))
def json_decode(spark, sf_dir):
    """S2 on a batch: the clickstream serialised to JSON text and decoded back."""
    lines = EV.to_json_lines(FX.clicks(spark, sf_dir, with_event_id=False), S.CLICKSTREAM_SCHEMA)
    return EV.decode(lines, S.CLICKSTREAM_SCHEMA)


@register("csv_roundtrip", O.with_fixtures(
    "SELECT session_id, user_id, product_id, product_title, category, price, rating, action, "
    "page_visitee, duree_visite, source, review_text, \"timestamp\" FROM clicks"))
def csv_roundtrip(spark, sf_dir):
    """K5 + S7: clickstream exported as CSV with a header and read back with its schema."""
    df = FX.clicks(spark, sf_dir, with_event_id=False)
    path = scratch_path(spark, "csv-clicks")
    EV.write_csv(df, path)
    return EV.read_csv(spark, path, df.schema)


@register("keyed_upsert", O.with_fixtures(
    "SELECT session_id, \"timestamp\", user_id, montant_paye, statut_paiement, "
    "CAST(1 AS BIGINT) AS _epoch FROM transactions"))
def keyed_upsert(spark, sf_dir):
    """K2: payments first arrive as pending (epoch 0) and are re-sent with their final
    status (epoch 1); the keyed table keeps the last write per (session_id, timestamp)."""
    tx = FX.transactions(spark, sf_dir, with_event_id=False).select(
        "session_id", "timestamp", "user_id", "montant_paye", "statut_paiement")
    table = K.KeyedTable(scratch_path(spark, "keyed-tx"), ["session_id", "timestamp"])
    table(tx.withColumn("statut_paiement", F.lit("en_attente")), 0)
    table(tx, 1)
    table(tx, 1)  # replay of a committed epoch: no effect
    return table.read(spark)


_PREVIEW_SQL = """
SELECT * FROM (
  SELECT 'clickstream' AS flux, 'user_' || CAST(user_id AS VARCHAR) AS utilisateur,
    'session_' || substr(session_id, 1, 8) AS session, substr(product_title, 1, 40) AS detail,
    action AS statut, (SELECT count(*) FROM clicks) AS nb_lignes
  FROM clicks ORDER BY "timestamp", session_id LIMIT 5)
UNION ALL SELECT * FROM (
  SELECT 'transactions', 'user_' || CAST(user_id AS VARCHAR), 'session_' || substr(session_id, 1, 8),
    coalesce(printf('%.2f MAD', montant_paye), '- MAD'), statut_paiement,
    (SELECT count(*) FROM transactions)
  FROM transactions ORDER BY "timestamp", session_id LIMIT 3)
UNION ALL SELECT * FROM (
  SELECT 'service_client', 'user_' || CAST(user_id AS VARCHAR), 'session_' || substr(session_id, 1, 8),
    motif_contact, 'résolu: ' || CASE WHEN resolu THEN 'True' WHEN NOT resolu THEN 'False' ELSE 'None' END,
    (SELECT count(*) FROM support)
  FROM support ORDER BY "timestamp", session_id LIMIT 3)"""


@register("batch_preview", O.with_fixtures(_PREVIEW_SQL))
def batch_preview(spark, sf_dir):
    """The console preview of a batch per stream (5/3/3 rows + counts)."""
    j = FX.journey(spark, sf_dir)
    user = F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("utilisateur")
    sess = F.concat(F.lit("session_"), F.substring("session_id", 1, 8)).alias("session")
    order = ["timestamp", "session_id"]
    c = K.preview(j.clicks, 5, order, [F.lit("clickstream").alias("flux"), user, sess,
                                       F.substring("product_title", 1, 40).alias("detail"),
                                       F.col("action").alias("statut")])
    t = K.preview(j.transactions, 3, order, [
        F.lit("transactions").alias("flux"), user, sess,
        F.coalesce(F.format_string("%.2f MAD", F.col("montant_paye")), F.lit("- MAD")).alias("detail"),
        F.col("statut_paiement").alias("statut")])
    s = K.preview(j.support, 3, order, [
        F.lit("service_client").alias("flux"), user, sess,
        F.col("motif_contact").alias("detail"),
        F.concat(F.lit("résolu: "), F.when(F.col("resolu"), "True")
                 .when(~F.col("resolu"), "False").otherwise("None")).alias("statut")])
    return c.unionByName(t).unionByName(s)


@register("stream_clicks_keyed", O.with_fixtures(
    f"SELECT {', '.join(CLICK_STREAM_COLS)}, {O.REVIEW_CLEAN_SQL} AS review_clean, "
    f"{O.action_score_sql()} AS action_score, "
    f"CASE WHEN action = 'abandon' THEN {O._q(S.RECO_TEXTS['B']['abandon'])} "
    f"WHEN action = 'add_to_cart' THEN {O._q(S.RECO_TEXTS['B']['add_to_cart'])} "
    f"WHEN action = 'purchase' THEN {O._q(S.RECO_TEXTS['B']['purchase'])} "
    f"ELSE {O._q(S.RECO_TEXTS['B']['other'])} END AS recommandation, "
    "CAST(NULL AS VARCHAR) AS _corrupt_record FROM clicks"))
def stream_clicks_keyed(spark, sf_dir):
    """T1 + K2 (keyed-store consumer): clickstream with text set B, upserted per
    micro-batch into a table keyed by (session_id, timestamp), two files per batch."""
    out = _stream_to_table(spark, sf_dir, "clickstream", S.CLICKSTREAM_SCHEMA,
                           lambda sp, src: J.clicks_stream(sp, src, "B"),
                           sink_cls=K.KeyedTable, files_per_batch=2,
                           keys=["session_id", "timestamp"])
    return out.drop("_epoch")


#: The topic's schema carries amounts as floats.
_TOPIC_KPI_SQL = _KPI_SQL_BODY.format(clicks="clicks").replace(
    "CAST(montant_paye AS DECIMAL(38,10))", "CAST(CAST(CAST(montant_paye AS FLOAT) AS DOUBLE) AS DECIMAL(38,10))")


@register("stream_kpis", O.with_fixtures(_TOPIC_KPI_SQL))
def stream_kpis(spark, sf_dir):
    """T8 (KPI tiles): a streaming global aggregate over the three topics in update mode,
    over several micro-batches; the keyed sink keeps the latest row."""
    topics = {"clickstream": (FX.clicks, S.CLICKSTREAM_SCHEMA), "transactions": (FX.transactions, S.TRANSACTION_SCHEMA),
              "service_client": (FX.support, S.SUPPORT_SCHEMA)}
    src = {name: {"format": "files", "maxFilesPerTrigger": 3,
                  "path": land_json(rows(spark, sf_dir, with_event_id=False), schema, f"kpis-{name}")}
           for name, (rows, schema) in topics.items()}
    out = J.kpi_stream(J.clicks_stream(spark, src["clickstream"], None),
                       J.transactions_stream(spark, src["transactions"]),
                       J.support_stream(spark, src["service_client"]))
    sink = K.KeyedTable(scratch_path(spark, "sink-kpis"), ["cle"])
    J.run_once(out, sink, scratch_path(spark, "ckpt-kpis"),
               f"kpis_{abs(hash(src['clickstream']['path'])) % 10**8}", "update")
    return sink.read(spark).drop("cle", "_epoch")
