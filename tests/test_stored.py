"""Stored tables: what a batch, an erasure and a retention run rewrite, and crashes."""

import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from sillage.operators import files as FI
from sillage.operators import governance as G
from sillage.operators import sinks as K
from sillage.session import scratch_path

ROW = "s string, user_id int, timestamp double"
DAY_S = 86_400


def stamps(path):
    return {str(p): p.stat().st_mtime_ns for p in Path(path).rglob("*.parquet")}


def rows_on_disk(spark, path):
    return spark.read.option("recursiveFileLookup", True).parquet(path)


def test_keyed_batch_rewrites_touched_parts_only(spark):
    by = F.floor(F.col("timestamp") / DAY_S)
    t = K.KeyedTable(scratch_path(spark, "t-parts"), ["s", "timestamp"], by=by)
    t(spark.createDataFrame([(f"s{i}", i, i * DAY_S / 4) for i in range(40)], ROW), 0)
    before = stamps(t.path)
    t(spark.createDataFrame([("s1", 99, DAY_S / 4), ("new", 1, 3.0 * DAY_S + 5)], ROW), 1)
    after = stamps(t.path)
    assert before.items() <= after.items()  # nothing rewritten in place; old parts stay for readers of the last manifest
    fresh = set(after) - set(before)
    assert {p.split("part=")[1].split("/")[0] for p in fresh} == {"0", "3"}
    got = {r["s"]: r["user_id"] for r in t.read(spark).collect()}
    assert got == {f"s{i}": i for i in range(40)} | {"s1": 99, "new": 1}
    for e in range(2, 7):  # parts that no kept manifest lists go
        t(spark.createDataFrame([("s1", e, DAY_S / 4)], ROW), e)
    assert len(t.versions(spark)) == K.KEEP
    assert rows_on_disk(spark, t.path).where("s = 's1'").count() == K.KEEP
    assert t.read(spark).where("s = 's1'").first()["user_id"] == 6


def test_keyed_table_remembers_every_query(spark, monkeypatch):
    """A commits 5, B commits 0; a replay of A's epoch 5 must not be applied again."""
    t = K.CountTable(scratch_path(spark, "t-two"), ["k"])
    one = spark.createDataFrame([("x", 1)], "k string, n long")
    for query, epoch in (("A", 5), ("B", 0), ("A", 5), ("A", 4), ("B", 0)):
        monkeypatch.setattr(K, "query_id", lambda s, q=query: q)
        t(one, epoch)
    assert [tuple(r) for r in t.read(spark).collect()] == [("x", 2)]


def test_keyed_table_with_odd_part_names_and_no_rows(spark):
    t = K.KeyedTable(scratch_path(spark, "t-odd"), ["k"], by=F.col("k"))
    names = ["a/b", "c=d", "é ü", "100%", None, "x:y"]
    t(spark.createDataFrame([(n, 1) for n in names], "k string, user_id int"), 0)
    assert {r["k"] for r in t.read(spark).collect()} == set(names)
    assert {r["table"]: r["nb_supprimes"] for r in G.apply_erasure(spark, {"t": t.path}, [1]).collect()} == {"t": 6}
    assert t.read(spark).count() == 0
    t(spark.createDataFrame([], "k string, user_id int"), 1)
    t(spark.createDataFrame([("a/b", 2)], "k string, user_id int"), 2)
    assert [tuple(r) for r in t.read(spark).select("k", "user_id").collect()] == [("a/b", 2)]


def _tables(spark):
    epochs = K.EpochSink(scratch_path(spark, "t-sel-e"), ["g"])
    versions = K.VersionedTable(scratch_path(spark, "t-sel-v"))
    keyed = K.KeyedTable(scratch_path(spark, "t-sel-k"), ["s"], buckets=8)
    df = spark.range(400).select(F.concat(F.lit("s"), F.col("id")).alias("s"), (F.col("id") % 100).cast("int").alias("user_id"),
                                 F.concat(F.lit("g/"), F.col("id") % 4).alias("g"))
    for e in range(3):
        epochs(df.where(F.col("user_id") % 3 == e), e)
    versions.write(df.limit(0))
    versions.write(df.repartitionByRange(5, "user_id"))
    keyed(df, 0)
    return {"e": epochs, "v": versions, "k": keyed}


@pytest.mark.parametrize("as_table", [False, True])
def test_erasure_rewrites_only_files_that_hold_the_user(spark, as_table):
    tables = _tables(spark)
    old = {n: {p: s for p, s in stamps(t.path).items() if n != "v" or "/v=1/" in p} for n, t in tables.items()}  # v=0 goes as a whole
    held = {n: rows_on_disk(spark, t.path).where("user_id = 7").select(F.col("_metadata.file_path")).distinct().count() for n, t in tables.items()}
    ids = spark.createDataFrame([(7,), (7,), (1000,)], "id long") if as_table else [7, 1000]
    rep = {r["table"]: r["nb_supprimes"] for r in G.apply_erasure(spark, {n: t.path for n, t in tables.items()}, ids).collect()}
    assert rep == {"e": 4, "v": 4, "k": 4}
    for n, t in tables.items():
        out = rows_on_disk(spark, t.path)
        assert out.count() == 396 and out.where("user_id = 7").count() == 0 and t.read(spark).count() == 396
        kept = {(Path(p).name, s) for p, s in stamps(t.path).items()} & {(Path(p).name, s) for p, s in old[n].items()}
        assert len(kept) == len(old[n]) - held[n] and held[n] < len(old[n]), n
    assert set(tables["e"].read(spark).select("g").distinct().toPandas().g) == {f"g/{i}" for i in range(4)}


def test_user_column_has_a_bloom_filter(spark):
    """A file whose users span the id but don't hold it is skipped by its Bloom filter."""
    sink = K.EpochSink(scratch_path(spark, "t-bloom"))
    many = spark.range(60_000).select((F.col("id") * 2).cast("int").alias("user_id")).coalesce(1)
    sink(many, 0)
    plan = sink.read(spark).where("user_id = 30001")
    rows = plan._jdf.queryExecution().executedPlan()
    assert plan.count() == 0
    scan = plan.where("user_id >= 0")
    read = [0]

    def seen(p):
        if "Scan" in p.nodeName():
            read[0] += p.metrics().apply("numOutputRows").value()
        for i in range(p.children().size()):
            seen(p.children().apply(i))

    jdf = scan._jdf
    jdf.collectToPython()
    node = jdf.queryExecution().executedPlan()
    seen(node.executedPlan() if "Adaptive" in node.getClass().getName() else node)
    assert rows is not None and read[0] == 0


def test_rewrite_survives_crashes(spark, monkeypatch):
    tables = _tables(spark)
    sink = tables["e"]
    files = FI.holders(sink.files(spark), F.col("user_id") == 7)
    done = FI._swap
    monkeypatch.setattr(FI, "_swap", lambda *a: (_ for _ in ()).throw(RuntimeError("died after the journal")))
    with pytest.raises(RuntimeError):
        sink.rewrite(spark, files, lambda r: G.erase(r, [7]))
    monkeypatch.setattr(FI, "_swap", done)
    assert sink.read(spark).count() == 400  # nothing swapped yet
    assert sink.files(spark).count() == 396  # opening the table ends the work
    assert not [p for p in os.listdir(sink.path) if p.startswith("_")]
    monkeypatch.setattr(FI, "put", lambda *a: (_ for _ in ()).throw(RuntimeError("died before the journal")))
    with pytest.raises(RuntimeError):
        sink.rewrite(spark, FI.holders(sink.files(spark), F.col("user_id") == 8), lambda r: G.erase(r, [8]))
    assert sink.files(spark).count() == 396 and not [p for p in os.listdir(sink.path) if p.startswith("_")]


def test_retention_drops_days_and_filters_the_boundary(spark):
    """Expired days go as folders, the cutoff's day is filtered, others are not touched."""
    base = 1_700_006_400  # midnight
    rows = [(f"s{d}-{h}", d, float(base + d * DAY_S + h * 3600)) for d in range(10) for h in range(24)] + [("undated", 1, None)]
    sink = K.EpochSink(scratch_path(spark, "t-days"), [G.DAY])
    df = spark.createDataFrame(rows, ROW)
    for e in (0, 1):
        sink(G.with_day(df.where(F.pmod(F.hash("s"), F.lit(2)) == e)), e)
    old = stamps(sink.path)
    as_of = (base + 8 * DAY_S + 12 * 3600)
    from datetime import datetime, timezone
    text = datetime.fromtimestamp(as_of, timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
    report = G.apply_retention(spark, {"t": sink.path}, text, {"t": (0, 3)}).first()
    assert report["jours_supprimes"] == 10  # five days in two epochs
    kept = rows_on_disk(spark, sink.path)
    assert sorted(r["s"] for r in kept.collect()) == sorted(s for s, _, t in rows if t is None or t >= as_of - 3 * DAY_S)
    assert sink.read(spark).count() == kept.count()
    untouched = {p for p in old if any(f"{G.DAY}={d}" in p for d in ("2023-11-21", "2023-11-22", "2023-11-23", "2023-11-24", "__HIVE"))}
    now = stamps(sink.path)
    assert untouched and all(now[p] == old[p] for p in untouched)
    with pytest.raises(ValueError):
        G.apply_retention(spark, {"t": scratch_path(spark, "t-none")}, text, {"t": (0, 3)})
