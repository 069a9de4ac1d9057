"""Prefix trie of conversations, built as a z-fast trie in batches.

A turn is a symbol; the hash of a prefix is the exclusive-or of 128-bit hashes of its
(depth, role, text), so all prefix hashes of a conversation are one running window and no
step handles texts again.  The trie is a table of compacted nodes.  A node's extent is its
longest sequence, its edge reaches from its parent's extent (``top``, excluded) to its own
(``ext``); its handle is the prefix of two-fattest length in (top, ext], the one length
there with the most trailing zero bits.

Batches grow by ``GROW``.  Each conversation of a batch looks for its exit node by fat
binary search: it asks the handle table for its prefix of two-fattest length in the
interval still open; a hit moves the lower end to the node's extent, a miss moves the upper
end below the handle.  So log2(turns) rounds find the node, each round one join of one row
per conversation still searching.  Rows below the exit and the edges that are left there
are then cut anew together: prefixes where sequences part or end become nodes, and their
handles are set.  Work below an exit is grouped by prefix hash with partial sums.

At the end members are counted at the compacted nodes only, and each edge is expanded along
the turns of its smallest member.  ``saved_tokens`` counts, for every member and turn, the
bytes of turns whose node belongs to a smaller member; suffix sums along a conversation and
one grouped sum give the sums over subtrees without walking the trie.

Windows run along one conversation and stream with spill; hot nodes meet only in partial
aggregates and in joins that AQE can split; the ids of a node's ends are joined to bounded
strings before they meet, and hashed one after another.  All steps are written tables.

Edge cases: null turns come first, rows of equal turn are ordered by role and text, null
role and text are empty; rows without conv_id belong to no conversation and are left out.
Conversations without turns end at the root.  No conversation: no node.  Equal sequences
share all their nodes; other columns of the input are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import materialize

#: Conversations of the first batch; each next batch brings the trie to so many times as many.
FIRST, GROW = 2000, 16
#: Ids of a node's ends joined to one string.
IDS = 20_000

KEY = ["k1", "k2"]


def symbols(rows: DataFrame) -> DataFrame:
    """(conv_id, pos, s1, s2, bytes): the turns of each conversation in order, hashed."""
    text = {c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text")}
    rows = rows.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", *(v.alias(c) for c, v in text.items()))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    return rows.select("conv_id", F.row_number().over(order).cast("long").alias("pos"),
                       *(F.xxhash64(F.lit(k), "role", F.lit(k), "text").alias(f"s{k}") for k in (1, 2)),
                       F.octet_length("text").cast("long").alias("bytes"))


def _prefixes(given: DataFrame) -> DataFrame:
    """(conv_id, d, k1, k2, n1, n2, bytes, cum): prefix hashes and the next ones."""
    along = Window.partitionBy("conv_id").orderBy("pos")
    rows = given.withColumn("d", F.row_number().over(along).cast("long"))
    rows = rows.select("conv_id", "pos", "d", "bytes", F.sum("bytes").over(along).alias("cum"),
                       *(F.bit_xor(F.xxhash64(F.lit(2 + k), "d", "s1", "s2")).over(along).alias(f"k{k}") for k in (1, 2)))
    return rows.select("conv_id", "d", *KEY, *(F.lead(f"k{k}").over(along).alias(f"n{k}") for k in (1, 2)), "bytes", "cum")


def _fattest(a: str, b: str) -> Column:
    """The number in (a, b] with the most trailing zero bits, of two columns."""
    return F.expr(f"{b} & shiftleft(-1L, cast(length(bin({a} ^ {b})) - 1 as int))")


def _locate(search: DataFrame, prefix: DataFrame, trie: DataFrame) -> DataFrame:
    """Exit of each conversation (conv_id, len): depth and hash above which all is known.

    Fat binary search over the handle table, (a, b] being the interval still open and
    (ext, e1, e2), (top, p1, p2) the extent and the parent's of the last node found.
    """
    zero = [F.lit(0).cast("long").alias(c) for c in ("a", "ext", "e1", "e2", "top", "p1", "p2")]
    now = search.select("conv_id", F.col("len").alias("b"), "len", *zero)
    handles = trie.select("h1", "h2", F.col("f").alias("hf"), F.struct("ext", "e1", "e2", "top", "p1", "p2").alias("hit"))
    found = []
    while True:
        asked = now.withColumn("f", _fattest("a", "b"))
        asked = asked.join(prefix.select("conv_id", F.col("d").alias("f"), F.col("k1").alias("h1"), F.col("k2").alias("h2")), ["conv_id", "f"])
        asked = asked.join(handles, ["h1", "h2"], "left")
        hit = F.col("hit").isNotNull()
        kept = [F.when(hit, F.col(f"hit.{c}")).otherwise(F.col(c)).alias(c) for c in ("ext", "e1", "e2", "top", "p1", "p2")]
        step = materialize(asked.select("conv_id", "len", F.when(hit, F.col("hit.ext")).otherwise(F.col("a")).alias("a"),
                                        F.when(hit, F.col("b")).otherwise(F.col("f") - 1).alias("b"), *kept), "search")
        found.append(step.where("a >= b"))
        now = step.where("a < b")
        if now.isEmpty():
            break
    ends = reduce(DataFrame.unionByName, found)
    at = prefix.select("conv_id", F.col("d").alias("ext"), F.col("k1").alias("x1"), F.col("k2").alias("x2"))
    ends = ends.join(at, ["conv_id", "ext"], "left")
    whole = F.expr("ext = 0 or coalesce(x1 = e1 and x2 = e2, false)")
    return ends.select("conv_id", "len", *(F.when(whole, F.col(a)).otherwise(F.col(b)).alias(c)
                                           for a, b, c in (("ext", "top", "base"), ("e1", "p1", "b1"), ("e2", "p2", "b2"))))


def _insert(batch: DataFrame, prefix: DataFrame, trie: DataFrame | None) -> DataFrame:
    """The trie's table with the conversations (conv_id, len) of ``batch`` in it."""
    if trie is None:
        exits = batch.select("conv_id", "len", *(F.lit(0).cast("long").alias(c) for c in ("base", "b1", "b2")))
    else:
        exits = materialize(_locate(batch, prefix, trie), "exits")
    columns = ["conv_id", "d", *KEY, "n1", "n2", "base", "b1", "b2"]
    fresh = prefix.join(exits.where("base < len"), "conv_id").where("d > base").select(*columns, F.col("n1").isNull().alias("stop"))
    rest = None
    if trie is not None:
        first = fresh.where("d = base + 1").select(F.col("k1").alias("c1"), F.col("k2").alias("c2")).distinct()
        cut = trie.join(first, ["c1", "c2"], "left_semi").select(F.col("rep").alias("conv_id"), F.col("top").alias("base"), F.col("p1").alias("b1"), F.col("p2").alias("b2"), F.col("ext").alias("to"))
        rest = trie.join(first, ["c1", "c2"], "left_anti")
        # an edge's turns: a conversation may lend its turns to many edges, so its rows look up theirs
        lent = materialize(cut, "cut")
        bottoms = lent.select("conv_id", F.col("to").alias("d"), F.struct("base", "b1", "b2", "to").alias("edge"))
        up = Window.partitionBy("conv_id").orderBy(F.col("d").desc())
        rows = prefix.join(lent.select("conv_id").distinct(), "conv_id", "left_semi").join(bottoms, ["conv_id", "d"], "left")
        rows = rows.withColumn("edge", F.last("edge", True).over(up)).where("d > edge.base and d <= edge.to")
        old = rows.select("conv_id", "d", *KEY, "n1", "n2", "edge.base", "edge.b1", "edge.b2", (F.col("d") == F.col("edge.to")).alias("stop"))
        fresh = fresh.unionByName(old)
    fresh = materialize(fresh, "open")
    beyond = F.struct("n1", "n2")
    nodes = fresh.groupBy(*KEY, "d").agg(F.min("conv_id").alias("rep"), F.max("stop").alias("stop"), F.min(beyond).alias("least"), F.max(beyond).alias("most"))
    nodes = nodes.where("stop or least != most").select(*KEY, F.col("d"), "rep")
    along = Window.partitionBy("conv_id").orderBy("d")
    rows = fresh.select("conv_id", "d", *KEY, "base", "b1", "b2").join(nodes, [*KEY, "d"])
    rows = rows.select("conv_id", "rep", F.col("d").alias("ext"), F.col("k1").alias("e1"), F.col("k2").alias("e2"),
                       *(F.when(F.lag("d").over(along) > F.col("base"), F.lag(c).over(along)).otherwise(F.col(b)).alias(n)
                         for c, b, n in (("d", "base", "top"), ("k1", "b1", "p1"), ("k2", "b2", "p2"))))
    edges = rows.where("conv_id = rep").drop("conv_id").withColumn("f", _fattest("top", "ext"))
    at = fresh.select(F.col("conv_id").alias("rep"), F.col("d"), *KEY)
    edges = edges.join(at.select("rep", F.col("d").alias("f"), F.col("k1").alias("h1"), F.col("k2").alias("h2")), ["rep", "f"])
    edges = edges.withColumn("d", F.col("top") + 1).join(at.select("rep", "d", F.col("k1").alias("c1"), F.col("k2").alias("c2")), ["rep", "d"]).drop("d")
    return materialize(edges if rest is None else edges.unionByName(rest), "trie")


def build(given: DataFrame, first: int = FIRST, grow: int = GROW) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """Prefixes, ends (conv_id, len, k1, k2) and compacted nodes of ``symbols`` rows."""
    prefix = materialize(_prefixes(given), "prefixes")
    ends = materialize(prefix.where("n1 is null").select("conv_id", F.col("d").alias("len"), *KEY), "ends")
    count, low, trie = ends._sillage_rows, 0.0, None
    share = F.expr("pmod(xxhash64(conv_id), 1048576) / 1048576D")
    size = first
    while low < 1 and count:
        high = min(1.0, size / count)
        trie = _insert(ends.where((share >= low) & (share < high)).select("conv_id", "len"), prefix, trie)
        low, size = high, size * grow
    return prefix, ends, trie


def _ends_digest(ends: DataFrame) -> DataFrame:
    """(k1, k2, ends_sha256): ids joined in runs of ``IDS``, the runs hashed in order."""
    by = [*KEY, "conv_id"]

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, run, held, last = TaskContext.get().partitionId(), 0, [], None

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"k1": [last[0]], "k2": [last[1]], "part": [part], "run": [run], "ids": [",".join(held)]})

        for batch in batches:
            for k1, k2, c in zip(*(x.to_pylist() for x in batch.columns)):
                if held and ((k1, k2) != last or len(held) >= IDS):
                    yield out()
                    run, held = run + 1, []
                last = (k1, k2)
                held.append(str(c))
        if held:
            yield out()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, sha = None, None

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"k1": [last[0]], "k2": [last[1]], "ends_sha256": [sha.hexdigest()]})

        for batch in batches:
            for k1, k2, _, _, ids in zip(*(x.to_pylist() for x in batch.columns)):
                if (k1, k2) != last:
                    if last:
                        yield out()
                    last, sha = (k1, k2), hashlib.sha256(ids.encode())
                else:
                    sha.update(f",{ids}".encode())
        if last:
            yield out()

    runs = (ends.select(*by).repartitionByRange(*by).sortWithinPartitions(*by)
            .mapInArrow(join, "k1 bigint, k2 bigint, part bigint, run bigint, ids string"))
    return (runs.repartition(*KEY).sortWithinPartitions(*KEY, "part", "run")
            .mapInArrow(digest, "k1 bigint, k2 bigint, ends_sha256 string"))


def nodes(given: DataFrame, members: DataFrame | None = None, first: int = FIRST, grow: int = GROW) -> DataFrame:
    """All depth nodes of the trie of ``symbols`` rows; ``members`` (conv_id) adds
    conversations that may have no turns."""
    prefix, ends, trie = build(given, first, grow)
    everyone = ends.select("conv_id")
    if members is not None:
        everyone = everyone.unionByName(members.select(F.col("conv_id").cast("long"))).where("conv_id is not null").distinct()
    if trie is None:
        trie = prefix.sparkSession.createDataFrame([], "rep long, f long, ext long, e1 long, e2 long, top long, p1 long, p2 long, h1 long, h2 long, c1 long, c2 long")
    edges = trie.select(F.col("e1").alias("k1"), F.col("e2").alias("k2"), "ext", "top", "p1", "p2")

    at = prefix.select("conv_id", F.col("d").alias("ext"), *KEY, "cum", "bytes").join(edges, [*KEY, "ext"])
    at = materialize(at, "members")
    owned = at.groupBy(*KEY, "ext").agg(F.min("conv_id").alias("owner"), F.count(F.lit(1)).alias("n_convs"))
    children = edges.groupBy(F.col("p1").alias("k1"), F.col("p2").alias("k2"), F.col("top").alias("ext")).agg(F.count(F.lit(1)).alias("n_children"))
    owned = materialize(owned.join(children, [*KEY, "ext"], "left").fillna(0, ["n_children"]), "owners")

    along = Window.partitionBy("conv_id").orderBy("ext")
    rows = at.join(owned, [*KEY, "ext"])
    lost = F.when(F.col("owner") != F.col("conv_id"), F.col("cum") - F.coalesce(F.lag("cum").over(along), F.lit(0))).otherwise(F.lit(0))
    leaf = ((F.col("owner") == F.col("conv_id")) & (F.col("n_children") == 0)).cast("long")
    back = Window.partitionBy("conv_id").orderBy(F.col("ext").desc())
    rows = rows.withColumn("lost", lost).withColumn("leaf", leaf)
    rows = rows.withColumn("below", F.sum("lost").over(back) - F.col("lost")).withColumn("leaf", F.sum("leaf").over(back))
    sums = rows.groupBy(*KEY, "ext").agg(F.sum("below").alias("below"), F.sum("leaf").alias("n_leaves"))
    table = owned.join(sums, [*KEY, "ext"]).join(edges, [*KEY, "ext"])
    table = table.join(_ends_digest(ends), KEY, "left")
    above = owned.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("ext").alias("top"), F.col("owner").alias("above"))
    table = materialize(table.join(above, ["p1", "p2", "top"], "left"), "nodes")

    total = everyone.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).first()
    if not total["n_convs"]:
        return prefix.sparkSession.createDataFrame([], "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string")
    figures = F.struct("ext", "top", "n_convs", "n_children", "n_leaves", "below", "ends_sha256", "above")
    bottoms = table.select(F.col("owner").alias("conv_id"), F.col("ext").alias("d"), figures.alias("edge"))
    owners = prefix.select("conv_id", "d", "bytes", "cum").join(bottoms, ["conv_id", "d"], "left")
    up = Window.partitionBy("conv_id").orderBy(F.col("d").desc())
    owners = owners.withColumn("reach", F.last(F.when(F.col("edge").isNotNull(), F.col("cum")), True).over(up)).withColumn("edge", F.last("edge", True).over(up))
    bottom, none = F.col("d") == F.col("edge.ext"), hashlib.sha256(b"").hexdigest()
    upper = F.when(F.col("d") > F.col("edge.top") + 1, F.col("conv_id")).otherwise(F.coalesce("edge.above", F.lit(total["conv_id"])))
    inner = owners.where("d > edge.top and d <= edge.ext").select(
        "conv_id", F.col("d").alias("depth"), upper.alias("parent_conv_id"), "edge.n_convs",
        F.when(bottom, F.col("edge.n_children")).otherwise(F.lit(1)).cast("long").alias("n_children"), "edge.n_leaves",
        ((F.col("edge.n_convs") - 1) * (F.col("reach") - F.col("cum") + F.col("bytes")) + F.col("edge.below")).alias("saved_tokens"),
        F.when(bottom, F.coalesce("edge.ends_sha256", F.lit(none))).otherwise(F.lit(none)).alias("ends_sha256"))

    tops = table.agg(F.coalesce(F.sum((F.col("top") == 0).cast("long")), F.lit(0)).alias("n_children"),
                     F.greatest(F.coalesce(F.sum((F.col("n_children") == 0).cast("long")), F.lit(0)), F.lit(1)).alias("n_leaves"))
    saved = rows.agg(F.coalesce(F.sum("lost"), F.lit(0)).alias("saved_tokens"))
    turnless = everyone.join(ends, "conv_id", "left_anti").select(*(F.lit(0).cast("long").alias(k) for k in KEY), "conv_id")
    silent = _ends_digest(turnless).agg(F.coalesce(F.max("ends_sha256"), F.lit(none)).alias("ends_sha256"))
    root = {**tops.first().asDict(), **saved.first().asDict(), **silent.first().asDict()}
    top = prefix.sparkSession.range(1).select(
        F.lit(total["conv_id"]).cast("long").alias("conv_id"), F.lit(0).cast("long").alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"),
        F.lit(total["n_convs"]).cast("long").alias("n_convs"), *(F.lit(root[c]).cast("long").alias(c) for c in ("n_children", "n_leaves", "saved_tokens")),
        F.lit(root["ends_sha256"]).alias("ends_sha256"))
    return inner.unionByName(top)


def rebuilt(given: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations that share beginnings, from ``symbols`` rows: each takes the first h
    turns of the conversation whose id ends its run of five, then its own after its h-th."""
    given = materialize(given, "symbols")
    h = F.crc32(F.col("conv_id").cast("string")) % 9
    everyone = given.select("conv_id").distinct()
    lend = given.where("conv_id % 5 = 0 and pos <= 8").withColumnRenamed("conv_id", "lender")
    takers = everyone.select("conv_id", (F.col("conv_id") - F.col("conv_id") % 5).alias("lender"), h.alias("h"))
    taken = takers.join(lend, "lender").where("pos <= h").select("conv_id", "pos", "s1", "s2", "bytes")
    own = given.where(F.col("pos") > h).select("conv_id", (F.col("pos") + 8).alias("pos"), "s1", "s2", "bytes")
    return taken.unionByName(own), everyone
