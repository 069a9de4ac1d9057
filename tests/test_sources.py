"""The landing folder as a topic; CSV files that can be split."""

import json

import pytest

from sillage.operators import sinks as K
from sillage.session import scratch_path
from sillage.sources import events as EV
from sillage.streaming import jobs as J


def _land(folder, name, ids):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("".join(json.dumps({"session_id": f"s{i}"}) + "\n" for i in ids))


def _run(spark, source, sink, ckpt, name):
    J.run_once(J.support_stream(spark, source), sink, ckpt, name)
    return sorted(int(r["session_id"][1:]) for r in sink.read(spark, "session_id string").select("session_id").collect())


@pytest.mark.parametrize("starting, first, all_", [
    ("earliest", [1, 2, 3], [1, 2, 3, 4, 5, 6]), ("latest", [], [4, 5, 6]), ('{"0": 1, "1": -1}', [2], [2, 4, 5, 6]), ('{"0": -1}', [3], [3, 4, 5, 6])])
def test_topic_starts_and_restarts_at_its_offsets(spark, tmp_path, starting, first, all_):
    topic = tmp_path / "topic"
    _land(topic / "p=0", "000.json", [1])
    _land(topic / "p=0", "001.json", [2])
    _land(topic / "p=1", "000.json", [3])
    source = {"format": "topic", "path": str(topic), "startingOffsets": starting, "group": "g"}
    sink, ckpt = K.EpochSink(scratch_path(spark, "t-topic")), scratch_path(spark, "t-topic-ckpt")
    assert _run(spark, source, sink, ckpt, f"t_topic_{tmp_path.name}_1") == first
    _land(topic / "p=0", "002.json", [4])  # lands while no stream runs
    _land(topic / "p=2", "000.json", [5])  # a new partition
    assert _run(spark, source, sink, ckpt, f"t_topic_{tmp_path.name}_2") == sorted({*all_} - {6})
    _land(topic / "p=1", "001.json", [6])
    _land(topic / "p=1", "_002.json", [99])  # still being written
    assert _run(spark, source, sink, ckpt, f"t_topic_{tmp_path.name}_3") == all_


def test_a_second_group_has_its_own_start(spark, tmp_path):
    topic = tmp_path / "topic"
    _land(topic, "000.json", [1])
    source = {"format": "topic", "path": str(topic), "startingOffsets": "latest"}
    sink = K.EpochSink(scratch_path(spark, "t-g1"))
    assert _run(spark, source | {"group": "a"}, sink, scratch_path(spark, "t-g1-ckpt"), "t_g1") == []
    _land(topic, "001.json", [2])
    sink = K.EpochSink(scratch_path(spark, "t-g2"))
    assert _run(spark, source | {"group": "b"}, sink, scratch_path(spark, "t-g2-ckpt"), "t_g2") == []
    sink = K.EpochSink(scratch_path(spark, "t-g3"))
    assert _run(spark, source | {"group": "a"}, sink, scratch_path(spark, "t-g3-ckpt"), "t_g3") == [2]


def test_sources_that_cannot_be_had_are_errors(spark, tmp_path):
    with pytest.raises(ValueError):
        EV.read_stream(spark, {"format": "files", "path": str(tmp_path), "startingOffsets": "latest"})
    with pytest.raises(ValueError):
        EV.read_stream(spark, {"format": "fax", "path": str(tmp_path)})


def test_csv_with_line_breaks_is_split_over_tasks(spark):
    texts = ["plain", "two\nlines", "a\r\nb", "back\\slash", "\\n as text", "\\\\", 'quote " and, comma', "é\n\n", " spaced ", "\\\n"]
    df = spark.createDataFrame([(t, i) for i, t in enumerate(texts * 200)], "t string, n int").coalesce(1)
    path = scratch_path(spark, "t-csv")
    EV.write_csv(df, path)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        back = EV.read_csv(spark, path, df.schema)
        assert back.rdd.getNumPartitions() > 3
        assert sorted(map(tuple, back.collect()), key=lambda r: r[1]) == [(t, i) for i, t in enumerate(texts * 200)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_csv_of_others_with_quoted_line_breaks(spark, tmp_path):
    (tmp_path / "x.csv").write_text('t,n\n"two\nlines \\n",1\n"q ""x""",2\n')
    got = EV.read_csv(spark, str(tmp_path), spark.createDataFrame([], "t string, n int").schema, multi_line=True)
    assert [tuple(r) for r in got.orderBy("n").collect()] == [("two\nlines \\n", 1), ('q "x"', 2)]
