"""Embedding near-duplicates: random-hyperplane signs, exact cosine, connected components.

Equal vectors are one entity, so copies cost nothing below.  Each entity gets one sign
signature per table; entities that share a signature in some table are compared exactly
in double precision.  The bits per signature follow the number of entities (a bucket of
unrelated vectors holds about ``BUCKET`` of them) and the number of tables follows from
the bits, so that a pair at the threshold meets in some table with probability
``RECALL``; nearer pairs meet with higher probability.

A bucket beyond ``CHUNK`` entities is dealt into chunks, and every pair of chunks is one
task: memory per task is bounded and no pair is left out.  A pair is counted in the first
table where it meets, so no list of pairs is built or made distinct: each task returns
the number of links of each entity and a spanning forest of the links it found.

Edge cases: vectors that are null, empty, zero or hold null or non-finite numbers link
with nothing; vectors of different lengths don't link; null ids are kept as rows and
never become a component's id unless it has no other; repeated ids are separate rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import materialize
from .common import connected_components, grouped, small_batches

THRESHOLD = 0.9
RECALL = 0.9995
BUCKET = 256
CHUNK = 2048
MIN_BITS, MAX_BITS = 4, 30
SEED = 20


def plan(entities: int, threshold: float = THRESHOLD, recall: float = RECALL) -> tuple[int, int]:
    """(bits, tables) for so many entities."""
    same = 1 - math.acos(threshold) / math.pi  # one hyperplane leaves a pair on one side
    bits = min(MAX_BITS, max(MIN_BITS, math.ceil(math.log2(max(entities, 2) / BUCKET))))
    return bits, math.ceil(math.log(1 - recall) / math.log(1 - same**bits))


def hyperplanes(dim: int, count: int) -> np.ndarray:
    return np.random.default_rng([SEED, dim]).standard_normal((dim, count))


def units(vectors: list) -> list[np.ndarray | None]:
    """Unit vectors in double precision; None where a vector links with nothing."""
    out: list[np.ndarray | None] = []
    for v in vectors:
        x = None
        if v and None not in v:
            x = np.array(v, np.float64)
            top = np.abs(x).max() if np.isfinite(x).all() else 0.0
            x = x / top if top > 0 else None  # no overflow or underflow in the norm
            x = None if x is None else x / np.sqrt(x @ x) + 0.0
        out.append(x)
    return out


def matrix(raw: list[bytes], kind: str) -> np.ndarray:
    """Unit vectors, one a row, from their stored numbers."""
    x = np.stack([np.frombuffer(v, kind) for v in raw]).astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None] + 0.0


def _entities(rows: DataFrame, kind: str) -> DataFrame:
    """(vec_id, uid, vec): vec keeps the numbers in their own precision, ``kind``."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column(1).to_pylist()
            found = units(vectors)
            uids = [None if x is None else hashlib.blake2b(x.tobytes(), digest_size=16).digest() for x in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(uids, pa.binary()),
                                              pa.array([None if x is None else np.array(v, kind).tobytes() for x, v in zip(found, vectors)], pa.binary())],
                                             ["vec_id", "uid", "vec"])

    id_type = rows.schema["vec_id"].dataType.simpleString()
    return rows.mapInArrow(scan, f"vec_id {id_type}, uid binary, vec binary")


def _signed(entities: DataFrame, kind: str, bits: int, tables: int) -> DataFrame:
    """(uid, mult, vec, signs): one signature a table, as 32-bit numbers."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        weights = (np.int64(1) << np.arange(bits, dtype=np.int64))
        for batch in batches:
            signs = []
            for raw in batch.column("vec").to_pylist():
                x = matrix([raw], kind)[0]
                p = planes.get(len(x))
                if p is None:
                    p = planes[len(x)] = hyperplanes(len(x), bits * tables)
                signs.append(((x @ p > 0).reshape(tables, bits) @ weights).astype(np.int32).tolist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(signs, pa.list_(pa.int32()))], [*batch.schema.names, "signs"])

    return entities.mapInArrow(scan, "uid binary, mult bigint, vec binary, signs array<int>")


def _compare(threshold: float, kind: str):
    """Task groups -> rows (uid, links, other): link counts, and forest edges."""

    def links(table: pa.Table) -> tuple[list, list, list]:
        uid = table.column("uid").to_pylist()
        x = matrix(table.column("vec").to_pylist(), kind)
        mult = table.column("mult").to_numpy()
        side = table.column("side").to_numpy()
        signs = np.array(table.column("signs").to_pylist(), np.int32)
        at = int(table.column("tab")[0].as_py())
        n = len(uid)
        total, label = np.zeros(n, np.int64), np.arange(n)
        out_a, out_b = [], []
        cross = bool(table.column("cross")[0].as_py())
        for low in range(0, n, 256):
            high = min(n, low + 256)
            i, j = np.nonzero(x[low:high] @ x.T >= threshold)
            i = i + low
            use = (i < j) & (side[i] != side[j]) if cross else i < j
            i, j = i[use], j[use]
            if at:  # counted in the first table where the two meet
                first = ~(signs[i, :at] == signs[j, :at]).any(axis=1)
                i, j = i[first], j[first]
            np.add.at(total, i, mult[j])
            np.add.at(total, j, mult[i])
            for a, b in zip(i.tolist(), j.tolist()) if len(i) < 64 else _spanning(i, j, label):
                if label[a] != label[b]:
                    out_a.append(uid[a])
                    out_b.append(uid[b])
                    label[label == label[b]] = label[a]
        hit = np.flatnonzero(total)
        return ([uid[k] for k in hit] + out_a, total[hit].tolist() + [0] * len(out_a), [None] * len(hit) + out_b)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in grouped(batches, "task"):
            if table.num_rows > 1:
                a, n, b = links(table)
                if a:
                    yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(n, pa.int64()), pa.array(b, pa.binary())],
                                                     ["uid", "links", "other"])

    return run


def _spanning(i: np.ndarray, j: np.ndarray, label: np.ndarray) -> Iterator[tuple[int, int]]:
    """Links whose ends differ, looked up anew after each union, in whole-array steps."""
    while True:
        apart = label[i] != label[j]
        if not apart.any():
            return
        i, j = i[apart], j[apart]
        # of every start one link; at least one of them joins two trees
        _, first = np.unique(i, return_index=True)
        yield from zip(i[first].tolist(), j[first].tolist())


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                    threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors``."""
    spark = vectors.sparkSession
    small_batches(spark)
    kind = "<f4" if vectors.schema[vector_col].dataType.elementType.simpleString() == "float" else "<f8"
    rows = materialize(_entities(vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).alias("v")), kind), "vectors")
    ents = rows.where("uid is not null").groupBy("uid").agg(F.count(F.lit(1)).alias("mult"), F.min("vec").alias("vec"))
    ents = materialize(ents.select("uid", "mult", "vec"), "vector-entities")
    bits, tables = plan(ents._sillage_rows, threshold, recall)
    signed = materialize(_signed(ents, kind, bits, tables), "vector-signs")
    # narrow first: bucket sizes, and how many chunks a bucket needs
    cells = signed.select("uid", F.length("vec").alias("dim"), F.posexplode("signs").alias("tab", "sign"))
    sizes = cells.groupBy("dim", "tab", "sign").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    sizes = sizes.select("dim", "tab", "sign", F.ceil(F.col("n") / CHUNK).alias("chunks"))
    placed = cells.join(sizes, ["dim", "tab", "sign"]).withColumn("own", F.pmod(F.xxhash64("uid"), F.col("chunks")))
    placed = placed.withColumn("mate", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    lo, hi = F.least("own", "mate"), F.greatest("own", "mate")
    placed = placed.select("uid", "tab", F.xxhash64("dim", "tab", "sign", lo, hi).alias("task"), (F.col("own") > lo).cast("int").alias("side"), (lo != hi).alias("cross"))
    work = (placed.join(signed, "uid").select("task", "tab", "side", "cross", "uid", "mult", "vec", "signs")
            .repartition("task").sortWithinPartitions("task"))
    found = materialize(work.mapInArrow(_compare(threshold, kind), "uid binary, links bigint, other binary"), "vector-links")
    counts = found.where("other is null").groupBy("uid").agg(F.sum("links").alias("links"))
    roots = connected_components(found.where("other is not null").select(F.col("uid").alias("a"), F.col("other").alias("b")), "vector-cc")
    state = (ents.select("uid", "mult").join(counts, "uid", "left").join(roots.withColumnRenamed("id", "uid"), "uid", "left")
             .select("uid", (F.col("mult") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("root", "uid").alias("root")))
    known = materialize(rows.select("vec_id", "uid").join(state, "uid", "left").select("vec_id", "n_links", "root"), "vector-state")
    least = known.where("root is not null").groupBy("root").agg(F.min("vec_id").alias("component"))
    out = known.join(least, "root", "left")
    component = F.when(F.col("root").isNull(), F.col("vec_id")).otherwise(F.col("component"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      F.col("vec_id").eqNullSafe(component).alias("kept"))
