"""Privacy operators: pseudonymisation, minimisation, erasure, retention.

``apply_erasure`` and ``apply_retention`` work on stored tables: they look up the files
that hold such rows, rewrite those and no others (``operators/files.py``), and delete older
versions, so that the rows are in no file afterwards.  Days that have expired as a whole
are deleted without being read.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.columns import event_time, pseudonym
from .joins import broadcast_if_small


def pseudonymise(df: DataFrame, column: str = "user_id", salt: str | None = None,
                 out: str | None = None, drop: bool = False) -> DataFrame:
    """G1: ``<column>_anonyme`` = first 12 hex chars of SHA-256 of the id (salted if given)."""
    name = out or f"{column}_anonyme"
    res = df.withColumn(name, pseudonym(column, salt))
    return res.drop(column) if drop else res


def minimise(df: DataFrame, needed: list[str] | None = None) -> DataFrame:
    """Keep only the needed columns that exist (sensitive ones are dropped)."""
    needed = needed or S.NEEDED_COLUMNS
    return df.select(*[c for c in needed if c in df.columns])


def _ids_frame(spark, ids: Iterable[int] | DataFrame, column: str) -> DataFrame:
    if isinstance(ids, DataFrame):
        return ids.select(F.col(ids.columns[0]).cast("int").alias(column)).distinct()
    return spark.createDataFrame([(int(i),) for i in ids], f"{column} int")


def erase(df: DataFrame, ids: Iterable[int] | DataFrame, column: str = "user_id") -> DataFrame:
    """Rows of ``df`` whose ``column`` is not in the erasure list.

    A literal list is an ``IN`` filter pushed to the scan.  A list given as a
    DataFrame is a left anti join: broadcast when its row count is proven small,
    else sort-merge.  Rows with a null id are kept (they belong to nobody).
    """
    if not isinstance(ids, DataFrame):
        # A literal list is a filter: pushed into the scan, no join at all.
        ids = [int(i) for i in ids]
        return df.filter(F.col(column).isNull() | ~F.col(column).isin(ids))
    lst = _ids_frame(df.sparkSession, ids, column)
    return df.join(broadcast_if_small(lst), column, "left_anti")


def erase_counts(tables: Mapping[str, DataFrame], ids: Iterable[int] | DataFrame,
                 column: str = "user_id") -> DataFrame:
    """G3 report: rows that erasure removes, per table (left semi join + count)."""
    out = None
    for name, df in tables.items():
        if column not in df.columns:
            continue
        if isinstance(ids, DataFrame):
            hit = df.join(broadcast_if_small(_ids_frame(df.sparkSession, ids, column)),
                          column, "left_semi")
        else:
            hit = df.filter(F.col(column).isin([int(i) for i in ids]))
        c = (hit.agg(F.count(F.lit(1)).alias("nb_supprimes"))
             .select(F.lit(name).alias("table"), "nb_supprimes"))
        out = c if out is None else out.unionByName(c)
    return out


def _cutoff(as_of: str, period: tuple[int, int]) -> Column:
    """``as_of`` less (calendar years, days)."""
    years, days = period
    return F.to_timestamp(F.lit(as_of)) - F.make_interval(years=F.lit(years), days=F.lit(days))


def retention_filter(df: DataFrame, as_of: str, period: int | tuple[int, int],
                     ts_seconds: str | Column = "timestamp") -> DataFrame:
    """Rows not older than ``period`` (days, or (calendar years, days)) before ``as_of``
    (an explicit instant, never now()).  Rows without a date are kept: nothing says they
    have expired; the report counts them."""
    when = event_time(ts_seconds)
    return df.filter(when.isNull() | (when >= _cutoff(as_of, (0, period) if isinstance(period, int) else period)))


def retention_report(tables: Mapping[str, DataFrame], as_of: str,
                     periods: Mapping[str, tuple[int, int]] | None = None) -> DataFrame:
    """G4 report: kept, expired and undated rows per table under its retention period."""
    periods = periods or S.RETENTION
    out = None
    for name, df in tables.items():
        when = event_time("timestamp")
        keep = when >= _cutoff(as_of, periods[name])
        r = df.agg(F.count_if(keep).alias("nb_conserves"), F.count_if(~keep).alias("nb_expires"),
                   F.count_if(when.isNull()).alias("nb_sans_date")).select(
            F.lit(name).alias("table"), F.lit(periods[name][0]).alias("annees"),
            F.lit(periods[name][1]).alias("jours"), "nb_conserves", "nb_expires", "nb_sans_date")
        out = r if out is None else out.unionByName(r)
    return out


def _stored(spark, path: str):
    """The stored table at ``path`` with its files; a path that holds none is an error."""
    from .sinks import EpochSink, KeyedTable, VersionedTable

    for table in (VersionedTable(path), EpochSink(path), KeyedTable(path, [])):
        rows = table.files(spark)
        if rows is not None:
            return table, rows
    raise ValueError(f"no stored table at {path}")


def _wanted(rows: DataFrame, ids: Iterable[int] | DataFrame, column: str) -> Column | None:
    """Filter for the rows of the listed ids; None if the list is a table."""
    return None if isinstance(ids, DataFrame) else F.col(column).isin([int(i) for i in ids])


def apply_erasure(spark, tables: Mapping[str, str], ids: Iterable[int] | DataFrame,
                  column: str = "user_id") -> DataFrame:
    """G3 applied: the files of every stored table that hold an erased id are rewritten
    without it, older versions are deleted, and the count of removed rows per table is
    returned.  Stop the streams that write these tables first: a batch in flight would be
    built on the rows before.  A path that holds no stored table is an error, not a table
    without the user."""
    from .files import named

    stored = {name: _stored(spark, path) for name, path in tables.items()}
    report = []
    for name, (table, rows) in stored.items():
        if column not in rows.columns:
            continue
        wanted = _wanted(rows, ids, column)
        if wanted is None:
            hit = rows.withColumn("_file", F.col("_metadata.file_path")).join(
                broadcast_if_small(_ids_frame(spark, ids, column)), column, "left_semi")
        else:
            hit = rows.where(wanted).withColumn("_file", F.col("_metadata.file_path"))
        per = hit.groupBy("_file").agg(F.count(F.lit(1)).alias("n")).collect()  # a row per file that holds an id
        table.rewrite(spark, [named(r["_file"]) for r in per], lambda r: erase(r, ids, column))
        report.append((name, sum(r["n"] for r in per)))
    return spark.createDataFrame(report, "table string, nb_supprimes long")


#: Partition column of tables laid out by event date.
DAY = "jour"


def with_day(df: DataFrame, ts_seconds: str | Column = "timestamp") -> DataFrame:
    """``df`` with its event date, the partition column of a table that retention prunes."""
    return df.withColumn(DAY, F.to_date(event_time(ts_seconds)))


def apply_retention(spark, tables: Mapping[str, str], as_of: str,
                    periods: Mapping[str, tuple[int, int]] | None = None) -> DataFrame:
    """G4 applied: no file of the stored tables holds an expired row afterwards.

    In a table laid out by day (``with_day``) folders of days before the cutoff are deleted
    unread and only the cutoff's day is looked at; in others the files with expired rows are
    found by their statistics.  Undated rows stay.  Returns (table, jours_supprimes,
    fichiers_reecrits) per table; a path that holds no stored table is an error."""
    from .files import filesystem, holders, named

    periods = periods or S.RETENTION
    stored = {name: _stored(spark, path) for name, path in tables.items()}
    report = []
    for name, (table, rows) in stored.items():
        cutoff = _cutoff(as_of, periods[name])
        at, day = spark.range(1).select(F.unix_micros(cutoff), F.to_date(cutoff)).first()
        expired = F.col("timestamp") < F.lit(at / 1e6)
        days = 0
        if DAY in rows.columns:
            old = rows.inputFiles()
            fs, _, jvm = filesystem(spark, tables[name])
            folders = {named(f).rpartition("/")[0] for f in old}
            for folder in sorted(folders):
                value = folder.rpartition(f"{DAY}=")[2]
                if value[:4].isdigit() and value < day.isoformat():
                    fs.delete(jvm.org.apache.hadoop.fs.Path(folder), True)
                    days += 1
            rows = table.files(spark)
            if rows is None:
                report.append((name, days, 0))
                continue
            files = holders(rows, (F.col(DAY) == F.lit(day)) & expired)
        else:
            files = holders(rows, expired)
        table.rewrite(spark, files, lambda r: retention_filter(r, as_of, periods[name]))
        report.append((name, days, len(files)))
    return spark.createDataFrame(report, "table string, jours_supprimes long, fichiers_reecrits long")
