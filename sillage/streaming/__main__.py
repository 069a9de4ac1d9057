"""Run the three consumers: ``python -m sillage.streaming --help``.

Examples::

    python -m sillage.streaming --format kafka --servers host:9092 --out /shared/ecommerce
    python -m sillage.streaming --format files --landing /shared/landing --out /shared/ecommerce \\
        --sink keyed --variant B --available-now
"""

from __future__ import annotations

import argparse

from ..operators.sinks import EpochSink, KeyedTable
from ..session import get_session
from .jobs import StreamSpec, run_consumers

TOPICS = ["clickstream", "transactions", "service_client"]


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(description="clickstream / payment / support consumers")
    ap.add_argument("--format", choices=["kafka", "files"], default="kafka")
    ap.add_argument("--servers", default="localhost:9092", help="Kafka bootstrap servers")
    ap.add_argument("--landing", help="folder with one JSON-lines sub-folder per topic")
    ap.add_argument("--out", required=True, help="shared folder for tables and checkpoints")
    ap.add_argument("--sink", choices=["epoch", "keyed"], default="epoch",
                    help="epoch: replay-safe append; keyed: last write wins on (session_id, timestamp)")
    ap.add_argument("--variant", choices=["A", "B"], default="A", help="recommendation text set")
    ap.add_argument("--trigger", default="10 seconds")
    ap.add_argument("--available-now", action="store_true", help="process what is there, then stop")
    ap.add_argument("--master", default=None)
    a = ap.parse_args(argv)

    spark = get_session(a.master, app_name="sillage-consumers")
    specs = {}
    for topic in TOPICS:
        source = ({"format": "kafka", "servers": a.servers, "topic": topic} if a.format == "kafka"
                  else {"format": "files", "path": f"{a.landing.rstrip('/')}/{topic}"})
        table = f"{a.out.rstrip('/')}/{topic}"
        sink = EpochSink(table) if a.sink == "epoch" else KeyedTable(table, ["session_id", "timestamp"])
        specs[topic] = StreamSpec(f"{topic}_{a.sink}", source, sink,
                                  f"{a.out.rstrip('/')}/_checkpoints/{topic}",
                                  None if a.available_now else a.trigger)
    run_consumers(spark, specs, a.variant, wait="all" if a.available_now else "any")


if __name__ == "__main__":
    main()
