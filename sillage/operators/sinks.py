"""Sinks: replay-safe micro-batch appends, keyed upserts, batch previews.

The reference appends every micro-batch to a document store (a replayed batch is
inserted twice) and upserts into a keyed store row by row from the driver.  Here
every write is a Spark job on the executors into the shared folder:

* ``EpochSink``  – each micro-batch overwrites its own folder; replaying an epoch
  rewrites the same folder, so the table holds it once.
* ``KeyedTable`` – last-write-wins on a key.  Rows lie in parts (buckets of the key's
  hash, or a function of the key such as its day).  A batch rewrites the parts it touches
  into new folders and commits them with a small manifest that lists every part's folder;
  a crash midway leaves the last manifest readable, and parts that no recent manifest
  lists are deleted.
* ``CountTable`` – the same, adding each batch's counts by key.
"""

from __future__ import annotations

import re
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .files import BLOOM, BLOOM_COLUMN, filesystem as _fs
from .files import get, put, recover, rewrite


def _options(df: DataFrame) -> dict[str, str]:
    return BLOOM if BLOOM_COLUMN in df.columns else {}


def query_id(spark: SparkSession) -> str:
    """Short id of the streaming query a ``foreachBatch`` call belongs to (it lives in the
    checkpoint, so a new checkpoint is a new id); ``""`` outside a stream."""
    return (spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "")[:8]


class EpochSink:
    """K1/T5: ``foreachBatch`` target writing each non-empty batch to its own folder.

    The folder carries the checkpoint's query id, so a stream restarted with a new
    checkpoint appends beside the old epochs instead of writing over them."""

    def __init__(self, path: str, partition_cols: list[str] | None = None):
        self.path = path.rstrip("/")
        self.partition_cols = partition_cols or []

    def __call__(self, df: DataFrame, epoch_id: int) -> None:
        if df.isEmpty():
            return
        self._write(df, f"epoch={epoch_id}-{query_id(df.sparkSession)}".rstrip("-"))

    def _write(self, df: DataFrame, folder: str) -> None:
        w = df.write.mode("overwrite").options(**_options(df))
        if self.partition_cols:
            w = w.partitionBy(*self.partition_cols)
        w.parquet(f"{self.path}/{folder}")

    def epochs(self, spark: SparkSession) -> list[str]:
        """Folders of committed epochs (``_SUCCESS`` marker present)."""
        fs, base, jvm = _fs(spark, self.path)
        if not fs.exists(base):
            return []
        paths = [st.getPath() for st in fs.listStatus(base)]
        return sorted(p.getName() for p in paths if p.getName().startswith("epoch=")
                      and fs.exists(jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")))

    def read(self, spark: SparkSession, schema: str | StructType | None = None) -> DataFrame:
        """All committed epochs; with none yet, an empty frame of ``schema``."""
        folders = self.epochs(spark)
        if not folders:
            return spark.createDataFrame([], schema or StructType())
        return spark.read.option("basePath", self.path).parquet(*[f"{self.path}/{f}" for f in folders])

    def files(self, spark: SparkSession) -> DataFrame | None:
        """All committed epochs as a plain read of their files, or None."""
        recover(spark, self.path)
        return self.read(spark) if self.epochs(spark) else None

    def rewrite(self, spark: SparkSession, files: list[str], change) -> None:
        rewrite(spark, self.path, files, change)


def latest_per_key(df: DataFrame, keys: list[str], order_col: str = "_epoch") -> DataFrame:
    """Keep one row per key: the highest ``order_col``; ties broken by row content.

    ``max_by`` over a struct is a mergeable aggregate, so a hot key is reduced
    map-side before the shuffle.
    """
    data_cols = [c for c in df.columns if c not in keys and c != order_col]
    row = F.struct(*[F.col(c) for c in data_cols])
    order = F.struct(F.col(order_col).alias("o"), row.alias("r"))
    best = df.groupBy(*keys).agg(F.max_by(order, order).alias("_best"))
    return best.select(*keys, F.col("_best.o").alias(order_col),
                       *[F.col("_best.r").getField(c).alias(c) for c in data_cols])


def upsert(current: DataFrame | None, batch: DataFrame, keys: list[str], epoch_id: int,
           order_col: str = "_epoch") -> DataFrame:
    """K2: current table + batch, last write wins per key (later write, then content).

    Rows without a complete key (undecodable lines) replace nothing and are all kept."""
    b = batch.withColumn(order_col, F.lit(int(epoch_id)).cast("long"))
    u = b if current is None else current.unionByName(b)
    whole = reduce(and_, [F.col(k).isNotNull() for k in keys])
    return latest_per_key(u.filter(whole), keys, order_col).unionByName(u.filter(~whole))


class VersionedTable:
    """A table stored as version folders; the highest committed version (``_SUCCESS``
    marker present) is current.  Writers never touch the folder they read, so a failed
    job leaves the current version intact (K4, G3, G4).

    A folder is named ``v=<n>`` or, when a stream writes it, ``v=<n>.e=<epoch>.q=<query>``:
    version numbers and epochs are apart, and both are committed by one marker."""

    def __init__(self, path: str):
        self.path = path.rstrip("/")

    def _entries(self, spark: SparkSession) -> list[tuple[int, int | None, str, str]]:
        """(version, last epoch, query id, folder) of committed versions, ascending."""
        fs, base, jvm = _fs(spark, self.path)
        if not fs.exists(base):
            return []
        out = []
        for st in fs.listStatus(base):
            name = st.getPath().getName()
            m = re.fullmatch(r"v=(\d+)(?:\.e=(\d+)\.q=(.*))?", name)
            if m and fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
                out.append((int(m[1]), int(m[2]) if m[2] else None, m[3] or "", name))
        return sorted(out)

    def versions(self, spark: SparkSession) -> list[int]:
        return [e[0] for e in self._entries(spark)]

    def read(self, spark: SparkSession, before: int | None = None) -> DataFrame | None:
        es = [e for e in self._entries(spark) if before is None or e[0] < before]
        return spark.read.parquet(f"{self.path}/{es[-1][3]}") if es else None

    def write(self, df: DataFrame, epoch: int | None = None, query: str = "") -> int:
        """Store ``df`` as the next version and return its number; without ``epoch`` the
        last epoch written by a stream stays on record."""
        es = self._entries(df.sparkSession)
        version = es[-1][0] + 1 if es else 0
        if epoch is None and es:
            _, epoch, query, _ = es[-1]
        name = f"v={version}" if epoch is None else f"v={version}.e={epoch}.q={query}"
        df.write.mode("overwrite").options(**_options(df)).parquet(f"{self.path}/{name}")
        return version

    def files(self, spark: SparkSession) -> DataFrame | None:
        """The current version as a plain read of its files, or None."""
        es = self._entries(spark)
        if es:
            recover(spark, f"{self.path}/{es[-1][3]}")
        return self.read(spark)

    def rewrite(self, spark: SparkSession, files: list[str], change) -> None:
        """Rewrite ``files`` of the current version, which becomes the next one; the versions
        before it go, as they hold the rows that were to leave."""
        version, epoch, query, folder = self._entries(spark)[-1]
        self.drop_before(spark, version)
        if not files:
            return
        rewrite(spark, f"{self.path}/{folder}", files, change)
        fs, old, jvm = _fs(spark, f"{self.path}/{folder}")
        fs.rename(old, jvm.org.apache.hadoop.fs.Path(f"{self.path}/{folder.replace(f'v={version}', f'v={version + 1}', 1)}"))

    def drop_before(self, spark: SparkSession, version: int) -> None:
        """Delete the versions before ``version`` (erased rows must not stay on disk)."""
        fs, base, jvm = _fs(spark, self.path)
        for st in fs.listStatus(base):
            m = re.match(r"v=(\d+)", st.getPath().getName())
            if m and int(m[1]) < version:
                fs.delete(st.getPath(), True)


#: Parts of a keyed table by default; manifests (and the parts they list) that are kept.
BUCKETS, KEEP = 16, 3


class KeyedTable:
    """K2: ``foreachBatch`` target keeping the latest row per key, rewriting touched parts.

    ``by`` places a row: a column expression of the keys with few values, such as the day
    of a key's timestamp (then a stream of recent events touches recent days only); by
    default the key's hash in ``buckets``.  It must not change over the table's life.

    A batch is skipped as a replay if its query (checkpoint) has committed that epoch or a
    later one, whatever other queries wrote in between."""

    def __init__(self, path: str, keys: list[str], buckets: int = BUCKETS, by: Column | None = None, keep: int = KEEP):
        self.path = path.rstrip("/")
        self.keys, self.keep = keys, keep
        self.part = by.cast("string") if by is not None else F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("string")

    def versions(self, spark: SparkSession) -> list[int]:
        fs, base, _ = _fs(spark, f"{self.path}/_versions")
        if not fs.exists(base):
            return []
        found = (re.fullmatch(r"v=(\d+)[.]json", st.getPath().getName()) for st in fs.listStatus(base))
        return sorted(int(m[1]) for m in found if m)

    def _manifest(self, spark: SparkSession) -> dict:
        """version, parts (name -> folder), epochs (query -> last one) and schema."""
        vs = self.versions(spark)
        return get(spark, f"{self.path}/_versions/v={vs[-1]}.json") if vs else {"version": -1, "parts": {}, "epochs": {}, "schema": None}

    def _read(self, spark: SparkSession, manifest: dict, parts: list[str]) -> DataFrame:
        import json

        schema = StructType.fromJson(json.loads(manifest["schema"]))
        folders = [f"{self.path}/{manifest['parts'][p]}" for p in parts]
        return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)

    def read(self, spark: SparkSession) -> DataFrame | None:
        manifest = self._manifest(spark)
        return None if manifest["schema"] is None else self._read(spark, manifest, sorted(manifest["parts"]))

    def __call__(self, df: DataFrame, epoch_id: int) -> None:
        spark = df.sparkSession
        query = query_id(spark)
        manifest = self._manifest(spark)
        if epoch_id <= manifest["epochs"].get(query, -1):
            return  # this epoch is already committed (replay)
        df = df.persist()  # read for its parts and for its rows
        try:
            touched = [r["p"] for r in df.select(F.coalesce(self.part, F.lit("none")).alias("p")).distinct().collect()]
            if not touched:
                return
            version = manifest["version"] + 1
            known = [p for p in touched if p in manifest["parts"]]
            current = self._read(spark, manifest, known) if known else None
            merged = self.merged(current, df, version).withColumn("part", F.coalesce(self.part, F.lit("none")))
            data = f"data/v={version}"
            # by part, and a large part over several tasks
            writer = merged.hint("rebalance", F.col("part")).write.mode("overwrite")
            writer.options(**_options(merged)).partitionBy("part").parquet(f"{self.path}/{data}")
            parts = manifest["parts"] | {p: f"{data}/part={_escaped(p)}" for p in touched}
            self._commit(spark, version, parts, manifest["epochs"] | {query: epoch_id}, merged.drop("part").schema.json())
        finally:
            df.unpersist()

    def _commit(self, spark: SparkSession, version: int, parts: dict, epochs: dict, schema: str) -> None:
        put(spark, f"{self.path}/_versions/v={version}.json", {"version": version, "parts": parts, "epochs": epochs, "schema": schema})
        self._drop(spark, self.keep)

    def _drop(self, spark: SparkSession, keep: int) -> None:
        """Delete manifests but the last ``keep``, and the parts that none of those lists."""
        vs = self.versions(spark)
        listed = {f for v in vs[-keep:] for f in get(spark, f"{self.path}/_versions/v={v}.json")["parts"].values()}
        fs, _, jvm = _fs(spark, self.path)
        path = jvm.org.apache.hadoop.fs.Path
        for v in vs[:-keep]:
            fs.delete(path(f"{self.path}/_versions/v={v}.json"), False)
        if not fs.exists(path(f"{self.path}/data")):
            return
        for st in fs.listStatus(path(f"{self.path}/data")):
            name = st.getPath().getName()
            m = re.fullmatch(r"v=(\d+)", name)
            if not m or int(m[1]) > vs[-1]:
                continue  # a version being written
            rest = [p for p in fs.listStatus(st.getPath()) if p.isDirectory()]
            gone = [p for p in rest if f"data/{name}/{p.getPath().getName()}" not in listed]
            for p in gone:
                fs.delete(p.getPath(), True)
            if len(gone) == len(rest):
                fs.delete(st.getPath(), True)

    def files(self, spark: SparkSession) -> DataFrame | None:
        """The current parts as a plain read of their files, or None."""
        recover(spark, f"{self.path}/data")
        return self.read(spark)

    def rewrite(self, spark: SparkSession, files: list[str], change) -> None:
        """Rewrite ``files`` in their parts; older manifests' parts go, as they hold the rows
        that were to leave."""
        self._drop(spark, 1)
        rewrite(spark, f"{self.path}/data", files, change)

    def merged(self, current: DataFrame | None, batch: DataFrame, version: int) -> DataFrame:
        """New rows of the touched parts, from their current rows and the batch."""
        return upsert(current, batch, self.keys, version)


def _escaped(name: str) -> str:
    """A partition value as Spark names its folder."""
    return re.sub(r'["#%\'*/:=?\\{\[\]^\x00-\x1f\x7f]', lambda m: f"%{ord(m[0]):02X}", name)


class CountTable(KeyedTable):
    """Running totals by key: each batch's partial sums are added to the table.

    The totals need no streaming state and no watermark, so no row is ever too late."""

    def merged(self, current: DataFrame | None, batch: DataFrame, version: int) -> DataFrame:
        u = batch if current is None else current.unionByName(batch)
        return u.groupBy(*self.keys).agg(*[F.sum(c).alias(c) for c in batch.columns if c not in self.keys])


def preview(df: DataFrame, n: int, order_cols: list[str], columns: list) -> DataFrame:
    """The first ``n`` rows by ``order_cols`` plus the batch row count.

    ``orderBy().limit()`` plans a per-partition top-n and a merge of n rows per
    partition, and the count is a scalar subquery; the batch is never collected.
    """
    total = df.agg(F.count(F.lit(1))).scalar()
    top = df.orderBy(*order_cols).limit(n)
    return top.select(*columns, total.alias("nb_lignes"))


class PreviewSink:
    """K3: ``foreachBatch`` target handing each non-empty batch's preview to ``show``: at
    most ``n`` rows, so a batch of any size sends no more than that to the driver."""

    def __init__(self, n: int, order_cols: list[str], columns: list, show=print):
        self.n, self.order_cols, self.columns, self.show = n, order_cols, columns, show

    def __call__(self, df: DataFrame, epoch_id: int) -> None:
        rows = preview(df, self.n, self.order_cols, self.columns).collect()
        if rows:
            self.show(epoch_id, [r.asDict() for r in rows])


def write_json_report(df: DataFrame, path: str) -> DataFrame:
    """K6: a results table written as JSON lines (executor-side) and read back with
    its own schema."""
    df.write.mode("overwrite").json(path)
    return df.sparkSession.read.schema(df.schema).json(path)
