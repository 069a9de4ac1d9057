"""Run a named query over a data folder: ``python -m sillage.plans --help``.

Example (the enrichment job, written as parquet and CSV)::

    python -m sillage.plans enriched_clicks /data/sf1 --out /shared/clickstream_enrichi --csv
"""

from __future__ import annotations

import argparse

from ..session import get_session
from ..sources.events import write_csv
from .catalog import queries


def main(argv: list[str] | None = None) -> None:
    qs = queries()
    ap = argparse.ArgumentParser(description="run one catalogue query")
    ap.add_argument("query", choices=sorted(qs))
    ap.add_argument("data_dir", help="folder with the input parquet tables")
    ap.add_argument("--out", help="write the result here (parquet, overwrite)")
    ap.add_argument("--csv", action="store_true", help="also write <out>_csv with a header")
    ap.add_argument("--show", type=int, default=0, help="print the first N rows")
    ap.add_argument("--master", default=None)
    a = ap.parse_args(argv)

    spark = get_session(a.master, app_name=f"sillage-{a.query}")
    df = qs[a.query](spark, a.data_dir)
    if a.out:
        df.write.mode("overwrite").parquet(a.out)
        if a.csv:
            write_csv(spark.read.parquet(a.out), f"{a.out.rstrip('/')}_csv")
    if a.show:
        df.show(a.show, truncate=False)
    if not a.out and not a.show:
        df.write.format("noop").mode("overwrite").save()


if __name__ == "__main__":
    main()
