"""Exact k-nearest-neighbour join of a table with itself (Euclidean), without all pairs.

* **Copies.**  Of equal vectors only the k + 1 smallest ids take part in the search: they
  are each other's nearest and the only ones another vector can need.  A row beyond them
  has the k smallest ids of its copies for neighbours.  Copies are ranked in salted groups
  first, so a vector with a third of all rows never meets in one task.
* **Leaves.**  The rest is cut into leaves of up to ``LEAF`` rows, always across the column
  that varies most in the part at hand.  Parts of more than ``LEAVES`` leaves are cut at the
  ``FAN``-quantiles by grouped aggregates, the smaller ones (nodes) each in one task, in halves.
  Ties in the column are cut along a fixed direction, so any different vectors come apart.
* **Own leaf, then every leaf in reach.**  Each row first takes its k best within its leaf.
  No true neighbour can be farther than the k-th of these, so the row then visits every
  other leaf whose bounding box meets the ball of that radius, and no other.  Boxes of nodes,
  then of leaves, are compared with the widest ball of a leaf first, then with each row's.
  The k best of all visits are exact, not approximate.
* **Bounds.**  A task holds one leaf's vectors and a batch of visitors; visitors of a busy
  leaf are salted over several copies of it.  The k best of a row are kept by a grouped
  top-k that Spark applies before the shuffle as well.

Equal distances are ordered by id, so results don't depend on the partitioning.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .joins import broadcast_if_small, materialize

#: Rows of a leaf at most, leaves of a node, parts a larger one is split into, visitors of a leaf per task.
LEAF, LEAVES, FAN, VISITORS = 1024, 64, 8, 50_000
#: Salts for ranking equal vectors; rows compared with a leaf at once; numbers of a node's leaves.
SALTS, CHUNK, PLACES = 64, 256, 1 << 16
#: Weight of the direction that tells ties in a column apart.
TIE = 1e-3


def _direction(width: int) -> np.ndarray:
    r = np.random.default_rng(1000).normal(size=width)
    return TIE * r / np.linalg.norm(r)


def _below(value: Column) -> Column:
    """How many of a node's ``cuts`` are at most ``value``."""
    return F.size(F.filter("cuts", lambda c: c <= value))


def _nodes(rows: DataFrame, width: int, levels: int) -> DataFrame:
    """``rows`` (id, x) with their node: ``levels`` times cut at quantiles."""
    rows = rows.withColumn("node", F.lit(0).cast("long"))
    terms = [F.col("x")[i] * F.lit(w) for i, w in enumerate(_direction(width).tolist())]
    for _ in range(levels):
        spread = F.array(*[F.var_pop(F.col("x")[i]) for i in range(width)])
        axes = rows.groupBy("node").agg(spread.alias("s")).select("node", F.array_position("s", F.array_max("s")).cast("int").alias("axis"))
        placed = rows.join(broadcast_if_small(materialize(axes, "axes")), "node")
        placed = placed.withColumn("p", sum(terms, F.element_at("x", F.col("axis"))))
        at = [k / FAN for k in range(1, FAN)]
        cuts = materialize(placed.groupBy("node").agg(F.percentile_approx("p", at, 1000).alias("cuts")), "cuts")
        placed = placed.join(broadcast_if_small(cuts), "node")
        rows = materialize(placed.select("id", "x", (F.col("node") * FAN + _below(F.col("p"))).alias("node")), "nodes")
    return rows


def _leaves(nodes: DataFrame, width: int, leaf: int) -> DataFrame:
    """(id, x, node, leaf): every node cut in halves until no part has over ``leaf`` rows."""
    tie = _direction(width)

    def cut(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by("id")
        x = table["x"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
        place, number, parts = np.zeros(len(x), np.int64), 0, [np.arange(len(x))]
        while parts:
            rows = parts.pop()
            if len(rows) <= leaf:
                place[rows] = number
                number += 1
                continue
            own = x[rows]
            order = rows[np.argsort(own[:, own.var(axis=0).argmax()] + own @ tie, kind="stable")]
            parts += [order[: len(rows) // 2], order[len(rows) // 2 :]]
        return table.append_column("leaf", pa.array(table["node"].to_numpy() * PLACES + place))

    return nodes.groupBy("node").applyInArrow(cut, "id bigint, x array<double>, node bigint, leaf bigint")


def _best(points: np.ndarray, ids: np.ndarray, asked: np.ndarray, asked_ids: np.ndarray, reach: np.ndarray,
          k: int) -> Iterator[tuple[int, list[float], list[int]]]:
    """The k nearest points (squared distance, then id) of each row of ``asked``."""
    for at in range(0, len(asked), CHUNK):
        q = asked[at : at + CHUNK]
        d = np.zeros((len(q), len(points)))
        for c in range(points.shape[1]):  # term by term, so that sums round alike everywhere
            d += (q[:, c, None] - points[:, c]) ** 2
        d[asked_ids[at : at + CHUNK, None] == ids] = np.inf
        d[d > reach[at : at + CHUNK, None]] = np.inf
        few = min(k, len(points))
        edge = np.partition(d, few - 1, axis=1)[:, few - 1]
        for i, row in enumerate(d):
            near = np.flatnonzero((row <= edge[i]) & np.isfinite(row))
            near = near[np.lexsort((ids[near], row[near]))][:k]
            yield int(asked_ids[at + i]), row[near].tolist(), ids[near].tolist()


def _meet(rows: DataFrame, answer, schema: str) -> DataFrame:
    """Batches of ``answer(points, ids, asked, asked_ids, reach)`` on rows (bin, visitor, id, x,
    reach): in every ``bin`` the rows that are not visitors are the points; visitors ask, or
    the points if there are none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, points, ids, held, held_ids, alone = None, None, None, [], [], True

        def ready() -> None:
            nonlocal points, ids, held, held_ids
            if held:
                points, ids, held, held_ids = np.concatenate(held), np.concatenate(held_ids), [], []

        def close() -> Iterator[pa.RecordBatch]:
            ready()
            if points is not None and alone:
                yield from answer(points, ids, points, ids, np.full(len(ids), np.inf))

        for batch in batches:
            bins, visitor, row_ids, reach = (batch.column(c).to_numpy(zero_copy_only=False) for c in (0, 1, 2, 4))
            flat = batch.column(3).flatten().to_numpy(zero_copy_only=False)
            x = flat.reshape(len(bins), -1)
            edges = np.flatnonzero(np.append(True, (bins[1:] != bins[:-1]) | (visitor[1:] != visitor[:-1])))
            for a, b in zip(edges, [*edges[1:], len(bins)]):
                if bins[a] != own:
                    yield from close()
                    own, points, ids, held, held_ids, alone = bins[a], None, None, [], [], True
                if visitor[a]:
                    ready()
                    alone = False
                    if points is not None:
                        yield from answer(points, ids, x[a:b], row_ids[a:b], reach[a:b])
                else:
                    held.append(x[a:b])
                    held_ids.append(row_ids[a:b])
        yield from close()

    ordered = rows.select("bin", "visitor", "id", "x", "reach").repartition("bin").sortWithinPartitions("bin", "visitor", "id")
    return ordered.mapInArrow(run, schema)


def _search(rows: DataFrame, k: int) -> DataFrame:
    """(id, distance, neighbour): the k best points of each row that asks (``_meet``)."""

    def answer(points, ids, asked, asked_ids, reach) -> Iterator[pa.RecordBatch]:
        out: tuple[list, list, list] = ([], [], [])
        for i, distance, near in _best(points, ids, asked, asked_ids, reach, k):
            out[0].extend([i] * len(near))
            out[1].extend(distance)
            out[2].extend(near)
        yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.float64()), pa.array(out[2], pa.int64())],
                                         ["id", "distance", "neighbour"])

    return _meet(rows, answer, "id bigint, distance double, neighbour bigint")


def _gap(a: str, b: str, width: int) -> Column:
    """Squared distance of the boxes ``a`` and ``b`` (structs of lo and hi).  It is summed in
    the order of ``_best``, so rounding never takes it above that of two rows in them."""
    lows, highs = ([F.col(f"{s}.{e}") for s in (a, b)] for e in ("lo", "hi"))
    sides = [F.greatest(lows[1][i] - highs[0][i], lows[0][i] - highs[1][i], F.lit(0.0)) for i in range(width)]
    return sum((s * s for s in sides[1:]), sides[0] * sides[0])


def _in_reach(a: str, b: str, width: int) -> Column:
    """Whether a ball of ``a`` may meet ``b``; boxes that hold NaN meet all."""
    gap = _gap(a, b, width)
    return F.isnan(gap) | (gap <= F.col(f"{a}.r"))


def _visits(asking: DataFrame, width: int) -> DataFrame:
    """(leaf, id, x, reach): rows of ``asking`` (id, x, node, leaf, reach) with every other
    leaf that their ball meets."""
    ends = [F.array(*[f(F.col("x")[i]) for i in range(width)]).alias(e) for e, f in (("lo", F.min), ("hi", F.max))]
    leaves = materialize(asking.groupBy("node", "leaf").agg(*ends, F.max("reach").alias("r")), "boxes")
    ends = [F.array(*[f(F.col(e)[i]) for i in range(width)]).alias(e) for e, f in (("lo", F.min), ("hi", F.max))]
    nodes = materialize(leaves.groupBy("node").agg(*ends, F.max("r").alias("r")), "node-boxes")

    def named(boxes: DataFrame, name: str, *keys: str) -> DataFrame:
        return boxes.select(*[F.col(c).alias(f"{name}_{c}") for c in keys], F.struct("lo", "hi", "r").alias(name))

    here, there = named(leaves, "a", "node", "leaf"), named(leaves, "b", "node", "leaf")
    near = named(nodes, "m", "node").crossJoin(broadcast_if_small(named(nodes, "n", "node"))).where(_in_reach("m", "n", width))
    near = here.join(near.select(F.col("m_node").alias("a_node"), "n_node", "n"), "a_node").where(_in_reach("a", "n", width))
    near = near.select("a_leaf", "a", F.col("n_node").alias("b_node")).join(there, "b_node")
    near = near.where((F.col("a_leaf") != F.col("b_leaf")) & _in_reach("a", "b", width))
    boxes = near.select(F.col("a_leaf").alias("bin"), F.lit(False).alias("visitor"), F.col("b_leaf").alias("id"),
                        F.concat("b.lo", "b.hi").alias("x"), F.lit(0.0).alias("reach"))
    rows = asking.join(boxes.select(F.col("bin").alias("leaf")).distinct(), "leaf", "left_semi")
    rows = rows.select(F.col("leaf").alias("bin"), F.lit(True).alias("visitor"), "id", F.concat("x", "x").alias("x"), "reach")

    def answer(points, ids, asked, asked_ids, reach) -> Iterator[pa.RecordBatch]:
        for at in range(0, len(asked), CHUNK):
            q = asked[at : at + CHUNK]
            d = np.zeros((len(q), len(points)))
            for c in range(width):
                d += np.maximum(np.maximum(points[:, c] - q[:, c, None], q[:, c, None] - points[:, width + c]), 0) ** 2
            i, j = np.nonzero(~(d > reach[at : at + CHUNK, None]))
            x = pa.ListArray.from_arrays(pa.array(np.arange(len(i) + 1, dtype=np.int32) * width), pa.array(q[i, :width].ravel()))
            yield pa.RecordBatch.from_arrays([pa.array(ids[j]), pa.array(asked_ids[at + i]), x, pa.array(reach[at + i])], ["leaf", "id", "x", "reach"])

    return _meet(boxes.unionByName(rows), answer, "leaf bigint, id bigint, x array<double>, reach double")


def _top(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("id").orderBy("distance", "neighbour")
    return found.withColumn("rang", F.row_number().over(order)).where(F.col("rang") <= k)


def nearest(df: DataFrame, id_col: str, columns: list[str], k: int = 5, leaf: int = LEAF, visitors: int = VISITORS) -> DataFrame:
    """(id, rang 1..k, neighbour, distance): each row's k nearest other rows of ``df`` by
    the squared Euclidean distance of ``columns`` (doubles, null as 0); fewer rows than
    that give fewer neighbours.  ``id_col`` is a unique integer; rows without one are left out.
    """
    x = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) + F.lit(0.0) for c in columns])
    rows = materialize(df.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), x.alias("x")), "vectors")

    salted = rows.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)))
    for_salt = Window.partitionBy("x", "salt").orderBy("id")
    for_all = Window.partitionBy("x").orderBy("id")
    first = salted.withColumn("n", F.row_number().over(for_salt)).where(F.col("n") <= k + 1)
    first = first.withColumn("n", F.row_number().over(for_all)).where(F.col("n") <= k + 1).select("id", "x", "n")
    kept = materialize(first, "copies")
    full = kept.groupBy("x").agg(F.max("n").alias("m"), F.slice(F.array_sort(F.collect_list("id")), 1, k).alias("near")).where(F.col("m") > k)
    rest = (rows.join(kept.select("id"), "id", "left_anti").join(broadcast_if_small(materialize(full, "full")), "x")
            .select("id", F.posexplode("near").alias("p", "neighbour"))
            .select("id", F.lit(0.0).alias("distance"), "neighbour", (F.col("p") + 1).alias("rang")))

    width = len(columns)
    levels = max(0, math.ceil(math.log(max(kept._sillage_rows, 1) / (LEAVES * leaf), FAN)))
    points = materialize(_leaves(_nodes(kept.select("id", "x"), width, levels), width, leaf), "leaves")
    home = points.select(F.col("leaf").alias("bin"), F.lit(False).alias("visitor"), "id", "x", F.lit(0.0).alias("reach"))
    own = materialize(_top(_search(home, k), k), "own-leaf")
    if kept._sillage_rows <= leaf:
        return own.unionByName(rest)

    reach = own.groupBy("id").agg(F.max("distance").alias("d"), F.count(F.lit(1)).alias("n"))
    ball = F.when(F.coalesce("n", F.lit(0)) == k, F.col("d")).otherwise(F.lit(math.inf))
    asking = materialize(points.join(reach, "id", "left").select("id", "x", "node", "leaf", ball.alias("reach")), "asking")
    visits = materialize(_visits(asking, width), "visits")
    if not visits._sillage_rows:
        return own.unionByName(rest)
    busy = visits.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / visitors).cast("int").alias("tasks"))
    busy = broadcast_if_small(materialize(busy, "busy"))
    salt = F.pmod(F.xxhash64("id"), F.col("tasks")).cast("int")
    guests = visits.join(busy, "leaf").select(F.struct("leaf", salt.alias("salt")).alias("b"), F.lit(True).alias("visitor"), "id", "x", "reach")
    hosts = points.join(busy, "leaf").select("leaf", "id", "x", F.explode(F.sequence(F.lit(0), F.col("tasks") - 1)).alias("salt"))
    hosts = hosts.select(F.struct("leaf", "salt").alias("b"), F.lit(False).alias("visitor"), "id", "x", F.lit(0.0).alias("reach"))
    abroad = _search(guests.unionByName(hosts).withColumn("bin", F.col("b.leaf") * 1_000_000 + F.col("b.salt")), k)
    return _top(abroad.unionByName(own.select("id", "distance", "neighbour")), k).unionByName(rest)
