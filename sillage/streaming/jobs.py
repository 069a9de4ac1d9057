"""Structured Streaming jobs.

The three consumers of the reference become three streaming queries over the same
operators as the batch code: decode (S2) → derive (P1-P4) → ``foreachBatch`` sink.
Each query has its own checkpoint folder inside the shared folder, a processing-
time trigger in production and ``availableNow`` in tests.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import schemas as S
from ..functions.columns import minute_of
from ..operators.analytics import kpis
from ..operators.sinks import CountTable, EpochSink, KeyedTable
from ..sources import events as EV


@dataclass
class StreamSpec:
    name: str
    source: dict
    sink: object
    checkpoint: str
    trigger: str | None = "10 seconds"  # None = availableNow


def clicks_stream(spark: SparkSession, source: dict, variant: str | None = "A") -> DataFrame:
    """Decoded, cleaned and scored clickstream events."""
    return EV.derive_clicks(EV.decode(EV.read_stream(spark, source), S.CLICKSTREAM_SCHEMA), variant)


def transactions_stream(spark: SparkSession, source: dict) -> DataFrame:
    """Decoded payments."""
    return EV.decode(EV.read_stream(spark, source), S.TRANSACTION_SCHEMA)


def support_stream(spark: SparkSession, source: dict) -> DataFrame:
    """Decoded support tickets."""
    return EV.decode(EV.read_stream(spark, source), S.SUPPORT_SCHEMA)


def start(df: DataFrame, spec: StreamSpec, output_mode: str = "append") -> StreamingQuery:
    """T4/T5: start ``df`` into ``spec.sink`` (a foreachBatch callable)."""
    w = (df.writeStream.queryName(spec.name).outputMode(output_mode)
         .option("checkpointLocation", spec.checkpoint)
         .foreachBatch(spec.sink))
    w = w.trigger(availableNow=True) if spec.trigger is None else w.trigger(processingTime=spec.trigger)
    return w.start()


def run_consumers(spark: SparkSession, specs: dict[str, StreamSpec], variant: str = "A",
                  wait: str = "any") -> list[StreamingQuery]:
    """The three queries side by side; ``wait="any"`` returns when one stops
    (like the reference), ``"all"`` when all have stopped, ``"none"`` at once."""
    builders = {"clickstream": lambda s: clicks_stream(spark, s, variant),
                "transactions": lambda s: transactions_stream(spark, s),
                "service_client": lambda s: support_stream(spark, s)}
    queries = [start(builders[topic](spec.source), spec) for topic, spec in specs.items()]
    if wait == "any":
        spark.streams.awaitAnyTermination()
    elif wait == "all":
        for q in queries:
            q.awaitTermination()
    return queries


def conversion_stream(clicks: DataFrame) -> DataFrame:
    """Purchases and abandons with their event-time minute, one row per click.

    A ``CountTable`` keyed by minute adds them up batch by batch.  No watermark: a click
    that comes late is added to its minute whenever it comes, and the stream holds no state.
    """
    a = F.col("action")
    return (clicks.filter(a.isin("purchase", "abandon"))
            .select(minute_of("timestamp").alias("minute"),
                    (a == "purchase").cast("long").alias("achats"),
                    (a == "abandon").cast("long").alias("abandons")))


def kpi_stream(clicks: DataFrame, transactions: DataFrame | None = None,
               support: DataFrame | None = None) -> DataFrame:
    """T8 (KPI tiles): the figures of ``analytics.kpis`` over the three streams, kept current.

    A global aggregate over their union: its state is one row whatever the volume, so no
    watermark is needed; each update replaces the single row of the sink.
    """
    return kpis(clicks, transactions, support).select(F.lit("global").alias("cle"), "*")


def run_once(df: DataFrame, sink, checkpoint: str, name: str,
             output_mode: str = "append") -> None:
    """Run a streaming plan over everything available now, then stop."""
    q = start(df, StreamSpec(name, {}, sink, checkpoint, None), output_mode)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


__all__ = ["StreamSpec", "EpochSink", "KeyedTable", "CountTable", "clicks_stream", "transactions_stream",
           "support_stream", "conversion_stream", "kpi_stream", "run_once", "run_consumers",
           "start"]
