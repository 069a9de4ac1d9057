"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import materialize

#: White space of the contracts: U+0020 and U+0009..U+000D.
WORD = "[^\\x20\\x09-\\x0D]+"
#: Rows per Arrow batch handed to Python; texts may be long, so batches stay small.
ARROW_ROWS = 128


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of at most ARROW_ROWS rows, so one batch of long texts fits a worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))


def bind(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, although ``body`` uses it often."""
    return F.element_at(F.transform(F.array(value), body), 1)


def row_key(*cols: str) -> list[Column]:
    """Two 64-bit hashes of the named columns: the same for equal rows, null-safe."""
    parts = [p for c in cols for p in (F.col(c).isNull(), F.col(c))]
    return [F.xxhash64(F.lit(1), *parts).alias("k1"), F.xxhash64(F.lit(2), *parts).alias("k2")]


#: Which bytes of UTF-8 belong to words: all but white space; or ASCII letters and digits
#: and everything beyond ASCII.
NOT_SPACE = np.array([c not in (32, 9, 10, 11, 12, 13) for c in range(256)])
LETTERS = np.array([c >= 128 or chr(c).isalnum() for c in range(256)])

#: A random odd number per byte value; A-Z as a-z.
_BYTES = np.random.default_rng(64).integers(0, 1 << 64, 256, np.uint64) | np.uint64(1)
_BYTES[65:91] = _BYTES[97:123]
_BASE = 0x9E3779B97F4A7C15
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> list[np.ndarray]:
    """Powers of an odd base modulo 2**64, and of its inverse; kept for the next batch."""
    while len(_POWERS[0]) < n:
        size = len(_POWERS[0])
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            _POWERS[k] = np.concatenate((_POWERS[k], _POWERS[k] * np.uint64(pow(base, size, 1 << 64))))
    return _POWERS


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def distinct(x: np.ndarray) -> np.ndarray:
    """Sorted distinct values (sorting beats ``np.unique``'s hashing at these sizes)."""
    x = np.sort(x)
    return x[np.concatenate((np.ones(min(len(x), 1), bool), x[1:] != x[:-1]))]


class Words:
    """Word hashes of all texts of an Arrow column at once, A-Z as a-z.

    A word is a run of bytes that ``table`` allows; its hash is a polynomial in the
    base's powers over its bytes, so one pass over the column's buffer hashes every word.
    ``hashes`` has the words of all texts in order, ``at`` where each text's words start.
    """

    def __init__(self, column: pa.Array, table: np.ndarray, stem: int = 0):
        column = column.fill_null("").cast(pa.large_string())
        n = len(column)
        ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1]
        data = np.frombuffer(column.buffers()[2], np.uint8)[ends[0] : ends[-1]] if ends[-1] > ends[0] else np.empty(0, np.uint8)
        ends = ends - ends[0]
        self.raw, self.ends = data, ends
        inside = table[data]
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        begins = ends[:-1][ends[:-1] < ends[1:]]
        first[begins] = inside[begins]  # a text's first word doesn't go on from the text before
        starts = np.flatnonzero(first)
        self.at = np.searchsorted(starts, ends)
        up, down = _powers(len(data) + 1)
        parts = np.where(table, _BYTES, np.uint64(0))[data] * up[: len(data)]
        self.stems = self.hashes = np.empty(0, np.uint64)
        if len(starts):
            back = down[starts]
            self.hashes = mix64(np.add.reduceat(parts, starts) * back)
            if stem:
                ends_ = np.minimum(starts + stem, np.append(starts[1:], len(data)))
                pairs = np.stack((starts, ends_), axis=1).ravel()
                self.stems = mix64(np.add.reduceat(np.append(parts, np.uint64(0)), pairs)[::2] * back + np.uint64(stem))

    def shingles(self, width: int) -> list[np.ndarray]:
        """Per text: the hash of every run of ``width`` words; fewer words make one run."""
        out = shingles(self.hashes, width) if len(self.hashes) >= width else self.hashes[:0]
        at = self.at.tolist()
        return [out[a : b - width + 1] if b - a >= width else shingles(self.hashes[a:b], width) for a, b in zip(at, at[1:])]


def shingles(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` words in order; fewer words make one shingle."""
    n = len(hashes)
    if n == 0:
        return hashes
    size = min(width, n)
    out = hashes[: n - size + 1] + np.uint64(size)
    for j in range(1, size):
        out = (out ^ (out >> np.uint64(29))) * np.uint64(_BASE) + hashes[j : n - size + 1 + j]
    return mix64(out)


def grouped(batches: Iterable[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Consecutive rows of equal ``key`` (batches sorted by it) as one table each."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), n]
        for a, b in zip(cuts, cuts[1:]):
            if held and keys[a] != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = keys[a]
    if held:
        yield pa.Table.from_batches(held)


#: Nodes of a partition's links held at once while they are contracted.
HELD_NODES = 300_000
#: So many contracted links end in one task; more go through star rounds first.
LOCAL_LINKS = 300_000


def _forest(held: int | None, id_type: pa.DataType):
    """Links (a, b) -> (id, root) stars with the same components, in bounded memory: after
    ``held`` nodes the stars so far are handed on and the search starts afresh."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        up: dict = {}

        def find(x):
            top = x
            while up[top] != top:
                top = up[top]
            while up[x] != top:
                up[x], x = top, up[x]
            return top

        def stars(loops: bool) -> pa.RecordBatch:
            ids = [x for x in up if loops or up[x] != x]
            return pa.RecordBatch.from_arrays([pa.array(ids, id_type), pa.array([find(x) for x in ids], id_type)], ["id", "root"])

        for batch in batches:
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if a is None or b is None:
                    continue
                up.setdefault(a, a)
                up.setdefault(b, b)
                x, y = find(a), find(b)
                if x != y:
                    up[max(x, y)] = min(x, y)
            if held and len(up) > held:
                yield stars(False)
                up.clear()
        yield stars(not held)

    return run


def connected_components(edges: DataFrame, name: str = "cc", local_links: int = LOCAL_LINKS) -> DataFrame:
    """(id, root) for every id in ``edges`` (a, b): root is the least id that links reach.

    Every partition first contracts its own links to stars.  While more than
    ``local_links`` are left, a round of alternating star operations hangs every node under
    the least neighbour seen, so chains shrink geometrically and no component meets in one
    task (a hub's links are joined, not grouped, so they are split when skewed).  What is
    left, a bounded number of links, is finished in one task.  Each step is written to the
    shared folder.  Ids may be long, string or binary; null ends and loops are ignored.
    """
    kind = edges.schema["a"].dataType.simpleString()
    arrow = {"binary": pa.binary(), "string": pa.string(), "int": pa.int32()}.get(kind, pa.int64())
    schema = f"id {kind}, root {kind}"

    def contract(links: DataFrame) -> DataFrame:
        return materialize(links.mapInArrow(_forest(HELD_NODES, arrow), schema), name)

    now = contract(edges.select("a", "b").where("a != b"))
    sign = None
    while now._sillage_rows > local_links:
        rows = now.select(F.col("id").alias("u"), F.col("root").alias("v")).distinct()
        both = rows.unionByName(rows.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        rest = large.join(low, "u").where("v != m").select("v", "m")
        now = contract(rest.unionByName(low.select(F.col("u").alias("v"), "m")))
        seen = now.distinct().agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("id", "root"))).first()
        if seen == sign:  # stars already
            roots = now.distinct()
            return materialize(roots.unionByName(roots.select(F.col("root").alias("id"), "root").distinct()), name)
        sign = seen
    return materialize(now.coalesce(1).mapInArrow(_forest(None, arrow), schema), name)
