"""The consumers side by side under a listener that keeps their record.

The listener keeps the batches of every query, and the rows that Spark reports as read (a
sink that looks at a batch twice reads some rows twice); the report counts stored rows.  When a
query fails, the supervisor starts it again from its checkpoint up to ``restarts`` times;
after that, or with none, it stops the siblings, so no topic runs on alone unnoticed.
"""

from __future__ import annotations

import time
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from .jobs import StreamSpec, start


@dataclass
class Record:
    """What is known of one query over all its runs."""

    runs: set[str] = field(default_factory=set)
    ended: set[str] = field(default_factory=set)
    batches: set[int] = field(default_factory=set)
    rows: dict[int, int] = field(default_factory=dict)
    restarts: int = 0
    state: str = "running"
    error: str | None = None


class Recorder(StreamingQueryListener):
    """Progress by query name.  A batch that is run again after a failure counts once."""

    def __init__(self, names: list[str]):
        self.records = {n: Record() for n in names}
        self.by_run: dict[str, str] = {}

    def onQueryStarted(self, event) -> None:
        if event.name in self.records:
            self.by_run[str(event.runId)] = event.name
            self.records[event.name].runs.add(str(event.runId))

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if p.name in self.records and p.numInputRows > 0:
            record = self.records[p.name]
            record.batches.add(p.batchId)
            record.rows[p.batchId] = p.numInputRows

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        name = self.by_run.get(str(event.runId))
        if name:
            self.records[name].ended.add(str(event.runId))


def run_supervised(spark: SparkSession, plans: dict[str, tuple[DataFrame, StreamSpec]], restarts: int = 0,
                   poll_s: float = 0.2, settle_s: float = 30.0) -> dict[str, Record]:
    """Run the streaming plans until all have ended (``trigger=None``: everything available
    now) or one has failed more than ``restarts`` times, and return their records.

    ``plans`` maps a name to (streaming DataFrame, spec); names must be unique among the
    session's queries.  Only these queries are watched or stopped.
    """
    recorder = Recorder([spec.name for _, spec in plans.values()])
    spark.streams.addListener(recorder)
    try:
        live: dict[str, StreamingQuery] = {name: start(df, spec) for name, (df, spec) in plans.items()}
        runs = {name: [str(q.runId)] for name, q in live.items()}
        while live:
            for name, q in list(live.items()):
                if q.isActive:
                    continue
                df, spec = plans[name]
                record = recorder.records[spec.name]
                failure = q.exception()
                del live[name]
                if failure is None:
                    record.state = "done"
                elif record.restarts < restarts:
                    record.restarts += 1
                    record.error = str(failure)
                    live[name] = start(df, spec)
                    runs[name].append(str(live[name].runId))
                else:
                    record.state, record.error = "failed", str(failure)
                    for other, sibling in live.items():
                        sibling.stop()
                        recorder.records[plans[other][1].name].state = "stopped"
                    live = {}
                    break
            time.sleep(poll_s)
        # events come later than the queries end
        until = time.time() + settle_s
        while time.time() < until and any(not set(runs[n]) <= recorder.records[spec.name].ended for n, (_, spec) in plans.items()):
            time.sleep(poll_s)
    finally:
        spark.streams.removeListener(recorder)
    return {name: recorder.records[spec.name] for name, (_, spec) in plans.items()}


def report(spark: SparkSession, plans: dict[str, tuple[DataFrame, StreamSpec]], records: dict[str, Record]) -> DataFrame:
    """(flux, lots, lignes, redemarrages, etat): a row per query; ``lignes`` are the rows its
    sink holds."""
    rows = [(n, len(r.batches), plans[n][1].sink.read(spark).count(), r.restarts, r.state) for n, r in records.items()]
    return spark.createDataFrame(rows, "flux string, lots long, lignes long, redemarrages long, etat string")
