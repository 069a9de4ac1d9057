"""Stream = batch, and restart from the checkpoint does not duplicate rows."""

import datetime as dt
import json
import time

from pyspark.sql import functions as F

from sillage import schemas as S
from sillage.operators import analytics as A
from sillage.operators import sinks as K
from sillage.plans.q_streaming import land_json
from sillage.session import scratch_path
from sillage.sources import fixtures as FX
from sillage.streaming import jobs as J
from sillage.streaming import supervise as V
from sillage.streaming import windows as W
from tests.conftest import SMALL


def test_stream_equals_batch_over_several_epochs_and_restart(spark):
    batch = FX.clicks(spark, SMALL, with_event_id=False)
    landing = land_json(batch, S.CLICKSTREAM_SCHEMA, "t-clicks", partitions=4)
    src = {"format": "files", "path": landing, "maxFilesPerTrigger": 1}
    sink = K.EpochSink(scratch_path(spark, "t-sink"))
    ckpt = scratch_path(spark, "t-ckpt")
    J.run_once(J.clicks_stream(spark, src), sink, ckpt, "t_clicks_a")
    first = sink.read(spark)
    assert first.select("epoch").distinct().count() >= 4
    # restart on the same checkpoint: nothing new, nothing duplicated
    J.run_once(J.clicks_stream(spark, src), sink, ckpt, "t_clicks_b")
    out = sink.read(spark).drop("epoch")
    assert out.count() == batch.count()
    got = out.select("session_id", "action_score").exceptAll(
        batch.select("session_id", F.expr(
            "CASE action WHEN 'purchase' THEN 5 WHEN 'add_to_cart' THEN 3 WHEN 'view' THEN 1 "
            "WHEN 'search' THEN 1 WHEN 'abandon' THEN -1 ELSE 0 END").alias("action_score")))
    assert got.count() == 0


def test_stream_conversion_equals_batch(spark):
    clicks = FX.clicks(spark, SMALL, with_event_id=False)
    landing = land_json(clicks, S.CLICKSTREAM_SCHEMA, "t-conv")
    table = K.CountTable(scratch_path(spark, "t-conv-sink"), ["minute"])
    stream = J.conversion_stream(J.clicks_stream(spark, {"format": "files", "path": landing, "maxFilesPerTrigger": 1}, None))
    J.run_once(stream, table, scratch_path(spark, "t-conv-ckpt"), "t_conv")
    assert len(table.versions(spark)) > 1  # several micro-batches, minutes out of order
    got = table.read(spark).select("minute", "achats", "abandons")
    want = A.conversion_by_minute(clicks, None)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_preview_sink_shows_each_batch(spark):
    clicks = FX.clicks(spark, SMALL, with_event_id=False)
    landing = land_json(clicks, S.CLICKSTREAM_SCHEMA, "t-preview", partitions=3)
    stream = J.clicks_stream(spark, {"format": "files", "path": landing, "maxFilesPerTrigger": 1}, None)
    seen = []
    sink = K.PreviewSink(5, ["timestamp", "session_id"], [F.col("action")], lambda epoch, rows: seen.append((epoch, rows)))
    J.run_once(stream, sink, scratch_path(spark, "t-preview-ckpt"), "t_preview")
    assert [epoch for epoch, _ in seen] == [0, 1, 2] and all(len(rows) == 5 for _, rows in seen)
    assert sum(rows[0]["nb_lignes"] for _, rows in seen) == clicks.count()


def test_three_consumers_side_by_side(spark):
    frames = {"clickstream": (FX.clicks(spark, SMALL, with_event_id=False), S.CLICKSTREAM_SCHEMA),
              "transactions": (FX.transactions(spark, SMALL, with_event_id=False),
                               S.TRANSACTION_SCHEMA),
              "service_client": (FX.support(spark, SMALL, with_event_id=False), S.SUPPORT_SCHEMA)}
    specs = {}
    for topic, (df, schema) in frames.items():
        landing = land_json(df, schema, f"t-{topic}")
        specs[topic] = J.StreamSpec(f"t6_{topic}", {"format": "files", "path": landing},
                                    K.EpochSink(scratch_path(spark, f"t6-{topic}")),
                                    scratch_path(spark, f"t6-ckpt-{topic}"), None)
    qs = J.run_consumers(spark, specs, wait="all")
    assert all(q.exception() is None for q in qs)
    for topic, (df, _) in frames.items():
        got = specs[topic].sink.read(spark)
        assert got.count() == df.count()
        assert got.filter(F.col("_corrupt_record").isNotNull()).count() == 0


def test_stream_scoring_profiles_equal_batch_profiles(spark):
    import __spark_entry__ as entry
    qs = entry.queries()
    streamed = qs["stream_scoring"](spark, SMALL)
    assert streamed.count() == FX.clicks(spark, SMALL).count()
    got = {r["profil_comportemental"]: r["count"]
           for r in streamed.groupBy("profil_comportemental").count().collect()}
    want = {r["profil_comportemental"]: r["nb"] for r in qs["profile_counts"](spark, SMALL).collect()}
    assert got == want
    assert streamed.filter(F.col("proba_achat").isNull() | F.col("recommandation").isNull()).count() == 0


def test_windows_close_and_late_clicks_are_kept(spark, tmp_path):
    """Files one at a time: windows close behind the watermark, later clicks are late, a
    restart goes on from the stored state, and no click is lost or counted twice."""
    base, landing = 1_700_000_040, tmp_path / "landing"
    files = [[(base + 1, "purchase"), (base + 2, "abandon"), (base + 3, "view")],
             [(base + 5, "purchase"), (base + 70, "purchase")],  # both windows are open
             [(base + 600, "abandon"), (None, "purchase")],
             [(base + 6, "purchase"), (base + 601, "purchase")],  # the first is late now
             [(base + 7, "abandon"), (base + 71, "abandon"), (base + 1200, "purchase")],
             [(base + 8, "purchase")]]
    landing.mkdir()
    sink = W.WindowSink(scratch_path(spark, "t-windows"))
    ckpt = scratch_path(spark, "t-windows-ckpt")
    for k, rows in enumerate(files):
        lines = "".join(f'{{"timestamp": {json.dumps(t)}, "action": "{a}", "session_id": "s"}}\n' for t, a in rows)
        (landing / f"{k}.json").write_text(lines)
        if k in (2, 5):  # several files, then the rest after a restart
            stream = J.clicks_stream(spark, {"format": "files", "path": str(landing), "maxFilesPerTrigger": 1}, None)
            J.run_once(W.conversion_windows(stream), sink, ckpt, f"t_windows_{k}", "update")
        time.sleep(0.02)  # file order is by time stamp
    got = {int(r["minute"].replace(tzinfo=dt.timezone.utc).timestamp()) - base: (r["achats"], r["abandons"], r["tardifs"]) for r in sink.read(spark).collect()}
    assert got == {0: (4, 2, 3), 60: (1, 1, 1), 600: (1, 1, 0), 1200: (1, 0, 0)}
    assert sorted(r["timestamp"] - base for r in sink.late.read(spark).collect()) == [6, 7, 8, 71]
    kinds = {(r["window_start"] - base, r["kind"]) for r in sink.windows.read(spark).collect()}
    assert {k for k in kinds if k[0] < 600} == {(0, "closed"), (60, "closed")}


def _two_plans(spark, name, sink):
    plans = {}
    for topic, target in (("a", sink), ("b", K.EpochSink(scratch_path(spark, f"{name}-b")))):
        path = land_json(FX.support(spark, SMALL, with_event_id=False), S.SUPPORT_SCHEMA, f"{name}-{topic}", 4)
        source = {"format": "files", "path": path, "maxFilesPerTrigger": 1}
        plans[topic] = (J.support_stream(spark, source), J.StreamSpec(f"{name}_{topic}", source, target, scratch_path(spark, f"{name}-{topic}-ckpt"), None))
    return plans


def test_supervisor_restarts_a_failed_query(spark):
    inner, failures = K.EpochSink(scratch_path(spark, "t-sup")), []

    def sink(df, epoch):
        if epoch == 2 and len(failures) < 2:
            failures.append(epoch)
            raise RuntimeError("sink down")
        inner(df, epoch)

    records = V.run_supervised(spark, _two_plans(spark, "t_sup", sink), restarts=2)
    n = FX.support(spark, SMALL).count()
    assert {k: (len(r.batches), r.restarts, r.state) for k, r in records.items()} == {"a": (4, 2, "done"), "b": (4, 0, "done")}
    assert all(sum(r.rows.values()) >= n for r in records.values())
    assert inner.read(spark).count() == n and "sink down" in records["a"].error


def test_supervisor_stops_the_siblings(spark):
    def sink(df, epoch):
        raise RuntimeError("sink down")

    plans = _two_plans(spark, "t_stop", sink)
    df, spec = plans["b"]
    spec.trigger = "1 second"  # runs until it is stopped
    records = V.run_supervised(spark, plans)
    assert records["a"].state == "failed" and records["b"].state == "stopped"
    assert not [q for q in spark.streams.active if q.name == spec.name]


def test_command_lines(spark, tmp_path):
    from sillage.plans.__main__ import main as run_query
    from sillage.streaming.__main__ import main as run_consumers_cli

    out = str(tmp_path / "kpis")
    run_query(["kpis", SMALL, "--out", out, "--csv"])
    assert spark.read.parquet(out).count() == 1
    assert spark.read.option("header", True).csv(out + "_csv").count() == 1

    landing = tmp_path / "landing"
    for topic, df, sch in [("clickstream", FX.clicks(spark, SMALL, False), S.CLICKSTREAM_SCHEMA),
                           ("transactions", FX.transactions(spark, SMALL, False), S.TRANSACTION_SCHEMA),
                           ("service_client", FX.support(spark, SMALL, False), S.SUPPORT_SCHEMA)]:
        land = land_json(df, sch, f"t-cli-{topic}")
        spark.read.text(land).write.text(str(landing / topic))
    run_consumers_cli(["--format", "files", "--landing", str(landing), "--out",
                       str(tmp_path / "out"), "--available-now"])
    got = K.EpochSink(str(tmp_path / "out" / "clickstream")).read(spark)
    assert got.count() == FX.clicks(spark, SMALL).count()
    assert "recommendation" in got.columns


def test_windows_of_a_span_share_a_state_key(spark, tmp_path):
    """An hour of clicks, one a minute, is at most one state key per salt, not one per window."""
    landing, base = tmp_path / "landing", 1_700_006_400
    landing.mkdir()
    (landing / "0.json").write_text("".join(f'{{"timestamp": {base + 60 * k}, "action": "purchase", "session_id": "s"}}\n' for k in range(60)))
    sink = W.WindowSink(scratch_path(spark, "t-span"))
    stream = J.clicks_stream(spark, {"format": "files", "path": str(landing)}, None)
    spec = J.StreamSpec("t_span", {}, sink, scratch_path(spark, "t-span-ckpt"), None)
    query = J.start(W.conversion_windows(stream), spec, "update")
    query.awaitTermination()
    held = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert held and max(held) <= W.SALTS
    assert sink.read(spark).count() == 60


def test_a_large_part_is_written_by_several_tasks(spark):
    table = K.KeyedTable(scratch_path(spark, "t-parts"), ["id"], buckets=1)
    size, kept = "spark.sql.adaptive.advisoryPartitionSizeInBytes", spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes", None)
    spark.conf.set(size, "64k")
    try:
        table(spark.range(40_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("v")), 0)
    finally:
        spark.conf.set(size, kept) if kept else spark.conf.unset(size)
    assert table.read(spark).count() == 40_000
    assert table.read(spark).select(F.input_file_name()).distinct().count() > 1
