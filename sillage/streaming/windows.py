"""Conversion by event-time window with keyed state, a watermark and timers.

State is one pair of counts per open window (and salt), updated by every micro-batch and
dropped by a timer once the watermark has passed the window's end.  The open windows of a
span (``SPAN`` windows and a salt) are one state key, as a call of Python per key and batch
costs far more than a window's few clicks; its timer is that of the window that ends first.  A click that comes
after that is late: it goes to a side table instead of being dropped, and the reading adds
it to its window, so totals never lose a click whatever order the files come in.

Spark drops rows behind the watermark in front of a stateful operator.  Here the watermark
is carried by *tick* rows: each click is sent as a tick that holds its time in the
watermark column and as a data row with a null there; the ticks advance the watermark
where they are read and are filtered out before the shuffle, and null is never late.

A hot window is spread over ``SALTS`` keys, so a minute with a third of all clicks is
counted by as many tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions.columns import event_time
from ..operators.sinks import EpochSink, KeyedTable

#: Keys of a hot window; windows of a state key.
SALTS, SPAN = 8, 1440
DELAY, WINDOW = "2 minutes", 60

#: ``kind``: ``open`` (counts so far), ``closed`` (last counts of a window) or ``late`` (one click).
OUTPUT = "kind string, window_start bigint, salt int, timestamp double, achats bigint, abandons bigint"


STATE = "starts array<bigint>, achats array<bigint>, abandons array<bigint>"


def _window(seconds: int):
    def update(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        salt, watermark = int(key[1]), state.getCurrentWatermarkMs()
        held = pd.DataFrame(dict(zip(("achats", "abandons"), state.get[1:])), index=pd.Index(state.get[0], dtype="int64"), dtype="int64") if state.exists \
            else pd.DataFrame({"achats": [], "abandons": []}, index=pd.Index([], dtype="int64"), dtype="int64")

        def rows(kind: str, counts: pd.DataFrame) -> pd.DataFrame:
            return pd.DataFrame({"kind": kind, "window_start": counts.index.to_numpy(), "salt": salt, "timestamp": np.nan,
                                 "achats": counts["achats"].to_numpy(), "abandons": counts["abandons"].to_numpy()})

        touched = []
        for batch in () if state.hasTimedOut else batches:
            bought = (batch["action"] == "purchase").astype("int64")
            late = (batch["window_start"] + seconds) * 1000 <= watermark
            if late.any():
                yield pd.DataFrame({"kind": "late", "window_start": batch["window_start"][late], "salt": salt, "timestamp": batch["timestamp"][late],
                                    "achats": bought[late], "abandons": 1 - bought[late]})
            new = pd.DataFrame({"achats": bought, "abandons": 1 - bought})[~late].groupby(batch["window_start"][~late]).sum()
            held = held.add(new, fill_value=0).astype("int64")
            touched.append(new.index)
        over = (held.index + seconds) * 1000 <= watermark  # their timer is due
        if over.any():
            yield rows("closed", held[over])
        held = held[~over]
        if touched:
            fresh = held[held.index.isin(np.concatenate(touched))]
            if len(fresh):
                yield rows("open", fresh)
        if not len(held):
            if state.exists:
                state.remove()
            return
        state.update((held.index.tolist(), held["achats"].tolist(), held["abandons"].tolist()))
        state.setTimeoutTimestamp((int(held.index.min()) + seconds) * 1000)

    return update


def conversion_windows(clicks: DataFrame, delay: str = DELAY, seconds: int = WINDOW, salts: int = SALTS) -> DataFrame:
    """Updates of the conversion windows of a click stream (``OUTPUT`` columns, update mode).

    Clicks other than purchases and abandons, or without a time, count in no window."""
    start = (F.floor(F.col("timestamp") / seconds) * seconds).cast("long")
    counted = clicks.where(F.col("action").isin("purchase", "abandon") & F.col("timestamp").isNotNull())
    salt = F.pmod(F.xxhash64("timestamp", "action"), F.lit(salts)).cast("int")
    row = F.struct(start.alias("window_start"), salt.alias("salt"), "timestamp", "action")
    none = F.lit(None)
    both = F.array(F.struct(event_time("timestamp").alias("tick"), F.lit(None).cast("struct<window_start:bigint,salt:int,timestamp:double,action:string>").alias("row")),
                   F.struct(none.cast("timestamp").alias("tick"), row.alias("row")))
    rows = counted.select(F.explode(both).alias("r")).select("r.tick", "r.row").withWatermark("tick", delay)
    rows = rows.where("tick is null").select("tick", "row.*")
    rows = rows.withColumn("span", F.floor(F.col("window_start") / (SPAN * seconds)).cast("long"))
    return rows.groupBy("span", "salt").applyInPandasWithState(
        _window(seconds), OUTPUT, STATE, "update", GroupStateTimeout.EventTimeTimeout)


class WindowSink:
    """``foreachBatch`` target: windows into a keyed table, late clicks into a side table."""

    def __init__(self, path: str):
        self.windows = KeyedTable(f"{path.rstrip('/')}/windows", ["window_start", "salt"])
        self.late = EpochSink(f"{path.rstrip('/')}/late")

    def __call__(self, df: DataFrame, epoch_id: int) -> None:
        df = df.persist()  # one run of the stateful operator for both tables
        try:
            self.windows(df.where("kind != 'late'").select("window_start", "salt", "kind", "achats", "abandons"), epoch_id)
            self.late(df.where("kind = 'late'").drop("kind"), epoch_id)
        finally:
            df.unpersist()

    def read(self, spark: SparkSession) -> DataFrame:
        """(minute, achats, abandons, tardifs): windows with their late clicks added."""
        empty = spark.createDataFrame([], OUTPUT)
        counted = self.windows.read(spark)
        counted = (empty if counted is None else counted).select("window_start", "achats", "abandons", F.lit(0).cast("long").alias("tardifs"))
        late = self.late.read(spark, empty.drop("kind").schema).select("window_start", "achats", "abandons", F.lit(1).cast("long").alias("tardifs"))
        sums = [F.sum(c).alias(c) for c in ("achats", "abandons", "tardifs")]
        return (counted.unionByName(late).groupBy("window_start").agg(*sums)
                .select(F.timestamp_seconds("window_start").cast("timestamp_ntz").alias("minute"), "achats", "abandons", "tardifs"))
