"""Rewriting only the files of a stored table that hold certain rows.

``holders`` lists the files with at least one matching row: the filter reaches the Parquet
reader, which skips row groups by their statistics, dictionaries and Bloom filters (the
sinks write one for ``user_id``), so files without such rows are hardly read.
``rewrite`` makes one Spark job of all of them, whatever folders they lie in, and swaps the
new files in under a journal: a crash before the journal leaves the table as it was, and
after it ``recover`` ends the work.  Other files are not touched.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Parquet options of stored tables: a Bloom filter on the column that erasure looks for.
BLOOM_COLUMN = "user_id"
BLOOM = {f"parquet.bloom.filter.enabled#{BLOOM_COLUMN}": "true", "parquet.bloom.filter.adaptive.enabled": "true",
         "parquet.bloom.filter.max.bytes": str(128 * 1024)}


def filesystem(spark: SparkSession, path: str):
    """(Hadoop file system, Path, JVM) of ``path``."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def put(spark: SparkSession, path: str, value: dict) -> None:
    """A small JSON file, complete or not there."""
    fs, target, jvm = filesystem(spark, path)
    part = jvm.org.apache.hadoop.fs.Path(f"{path}.tmp-{uuid.uuid4().hex[:8]}")
    out = fs.create(part, True)
    out.write(bytearray(json.dumps(value).encode()))
    out.close()
    if fs.exists(target):
        fs.delete(target, False)
    fs.rename(part, target)


def get(spark: SparkSession, path: str) -> dict:
    fs, target, jvm = filesystem(spark, path)
    source = fs.open(target)
    try:
        return json.loads(bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(source)).decode())
    finally:
        source.close()


#: Scheme and host of a file's URI.
_SCHEME = "^[a-z0-9]+:(//[^/]*)?(?=/)"


def named(uri: str) -> str:
    """The path that a ``_metadata.file_path`` URI means, as readers take it."""
    return unquote(uri)


def _plain(path: str) -> str:
    """``path`` without its scheme, as stored names compare."""
    return re.sub(_SCHEME, "", path)


def holders(rows: DataFrame, condition: Column) -> list[str]:
    """Paths of the files of ``rows`` (a plain read of stored files) with a matching row."""
    found = rows.where(condition).select(F.col("_metadata.file_path").alias("f")).distinct().collect()
    return sorted(named(r["f"]) for r in found)


def recover(spark: SparkSession, root: str) -> None:
    """End or undo rewrites that a crash interrupted."""
    fs, base, jvm = filesystem(spark, root)
    if not fs.exists(base):
        return
    names = [st.getPath().getName() for st in fs.listStatus(base)]
    for name in names:
        if name.startswith("_journal-") and name.endswith(".json"):
            _swap(spark, root, name.removeprefix("_journal-").removesuffix(".json"))
    for name in names:
        if name.startswith("_rewrite-"):  # no journal: nothing of it counts
            fs.delete(jvm.org.apache.hadoop.fs.Path(f"{root}/{name}"), True)


def _swap(spark: SparkSession, root: str, work: str) -> None:
    """Move the new files in, delete the old ones; safe to do again."""
    fs, journal, jvm = filesystem(spark, f"{root}/_journal-{work}.json")
    path = jvm.org.apache.hadoop.fs.Path
    plan = get(spark, f"{root}/_journal-{work}.json")
    for new, target in plan["new"]:
        if fs.exists(path(new)):
            fs.rename(path(new), path(target))
    for old in plan["old"]:
        fs.delete(path(old), False)
    fs.delete(path(f"{root}/_rewrite-{work}"), True)
    fs.delete(journal, False)


def rewrite(spark: SparkSession, root: str, files: list[str], change: Callable[[DataFrame], DataFrame]) -> None:
    """Replace ``files`` (paths below ``root``) by ``change`` of their rows, each in its folder."""
    if not files:
        return
    fs, base, jvm = filesystem(spark, root)
    root_plain = _plain(fs.makeQualified(base).toString())
    work = uuid.uuid4().hex[:12]
    staged = f"{root}/_rewrite-{work}"
    # folders are numbered, so names with any characters stay out of partition values
    folders = sorted({_plain(f).rpartition("/")[0] for f in files})
    numbers = spark.createDataFrame(list(enumerate(folders)), "_folder int, _path string")
    rows = spark.read.option("recursiveFileLookup", True).parquet(*files)
    where = F.regexp_replace(F.regexp_replace(F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))), _SCHEME, ""), "/[^/]*$", "")
    columns = rows.columns
    kept = change(rows.withColumn("_path", where).join(F.broadcast(numbers), "_path").drop("_path"))
    kept.select(*columns, "_folder").write.partitionBy("_folder").options(**BLOOM).parquet(staged)
    new = []
    for k, folder in enumerate(folders):
        made = jvm.org.apache.hadoop.fs.Path(f"{staged}/_folder={k}")
        relative = folder.removeprefix(root_plain).strip("/")
        for st in fs.listStatus(made) if fs.exists(made) else []:
            name = st.getPath().getName()
            new.append([f"{staged}/_folder={k}/{name}", "/".join(x for x in (root, relative, name) if x)])
    put(spark, f"{root}/_journal-{work}.json", {"new": new, "old": files})
    _swap(spark, root, work)
