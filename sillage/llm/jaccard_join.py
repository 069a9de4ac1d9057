"""N-gram Jaccard join by signature trees.

A text's set is its distinct word shingles (64-bit hashes); texts with equal sets are one
entity.  Two entities link when intersection / union reaches the threshold.

Routing.  A tree over a whole corpus would have saturated bitmaps, so entities are first
split into clusters that no link crosses.  Sets are indexed by size class; in a class at
most D hashes differ between two linked sets, so of k > D ranges of the hash space at least
one holds the same hashes in both.  Each set emits a key per range (a digest of its hashes
there); ranges with fewer than two hashes are keys only three together, and short sets that
may differ in one hash or none have keys of their own, so that no key stands for an empty
range (``route_keys``).  Sets that share a key are routed
together if their parity maps, a bit a hash, allow a link: the XOR of two maps bounds the
sets' difference from below.  The connected components of these routes are the clusters.
Links found: all; only the routes may be in vain.

Signature trees.  The sets of a cluster, sorted by size, are leaves of a tree whose nodes
hold the OR of their sets' token bitmaps, their size range and the most tokens that
shared a bit in one set.  A dual traversal compares nodes with nodes: a pair is cut when
the size ranges are too far apart, when the largest possible overlap (bits in common plus
the shared-bit slack) is too small, or when all sets below are already connected.  At the
leaves the bitmaps' XOR bounds the difference, and what is left is verified on the hashes.

Large clusters.  A task holds at most about ``CHUNK`` sets and ``CHUNK_TOKENS`` hashes.
A larger cluster is dealt into chunks: first each chunk by itself, then one set of each
component of each chunk, then those pairs of chunks that still hold unconnected sets.
Every pair of sets is thus compared or known to be connected; nothing is capped.

Only spanning links leave a task, so a group of n copies costs O(n) rows.

Edge cases: null, empty and wordless texts have an empty set and link with nothing; with
fewer words than a shingle the whole sequence is one shingle; null ids are rows and name
a component only if all its ids are null; rows that repeat id and text are one member.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import broadcast_if_small, materialize
from .common import NOT_SPACE, Words, connected_components, distinct, grouped, mix64, row_key, small_batches

WIDTH, THRESHOLD = 3, (90, 100)
CHUNK, CHUNK_TOKENS = 4096, 4_000_000
LEAF, FANOUT = 32, 4
#: 64-bit words of two leaves' bitmaps compared at once.
LEAF_WORDS = 1 << 19
MAX_BITS = 1 << 17
#: Sets whose keys a partition remembers having given.
HELD_SETS = 500_000
#: Weak ranges that make a key together in classes of up to so many ranges.
WEAK, FEW_RANGES = 3, 24
#: Sets of one key that are compared with each other before clusters are formed.
GROUP_SETS = 4096


# -- sets, size classes and routing keys ------------------------------------------------

@lru_cache(64)
def class_starts(num: int, den: int) -> np.ndarray:
    """Least sizes of the classes: sizes of linked sets lie in one class or two neighbours."""
    out = [1]
    while out[-1] < 1 << 40:
        out.append(out[-1] * den // num + 1)
    return np.array(out, np.int64)


def class_of(size: int, starts: np.ndarray) -> int:
    return int(np.searchsorted(starts, size, side="right")) - 1


def most_different(num: int, den: int, sizes: int) -> int:
    """Largest symmetric difference of two linked sets whose sizes sum to ``sizes``."""
    return (den - num) * sizes // (den + num)


@lru_cache(512)
def _differ(c: int, num: int, den: int) -> int:
    """Hashes in which linked sets may differ whose larger one is of class ``c``."""
    return most_different(num, den, 2 * (int(class_starts(num, den)[c + 1]) - 1))


@lru_cache(512)
def _ranges(c: int, num: int, den: int) -> tuple[int, np.ndarray, np.ndarray]:
    """Of a class: how many ranges must agree, the ranges' inner bounds, and their marks."""
    differ = _differ(c, num, den)
    # half as many ranges more: a third must agree then, and of large sets' ranges fewer are weak
    k = differ + WEAK + differ // 2
    places = np.arange(1, k, dtype=np.uint64) * np.uint64((1 << 64) // k)
    return k - differ, places, mix64(np.arange(k, dtype=np.uint64) + np.uint64((c + 1) << 40))


def route_keys(tokens: np.ndarray, num: int, den: int) -> np.ndarray:
    """Keys of a sorted set: two linked sets share at least one.

    Where linked sets may not differ at all, the set's digest is its only key.  Where they
    may in one hash, one set is the other less a hash: keys are the set's digest and its
    digests less each hash.  Else the ranges give keys.  A range of fewer than two hashes, often
    none or a common shingle's, says little and would be a hot key, so such weak ranges are
    keys only as far as all ranges that agree could be weak: those with a hash come first,
    and where there are few ranges they are keys ``WEAK`` at a time.  Where there are many, so
    few are empty that the list never reaches those.
    """
    own = class_of(len(tokens), class_starts(num, den))
    # sums of scrambled hashes wrap around; a range's sum is a difference of two of them
    scrambled = mix64(tokens)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(scrambled)))
    out = []
    if _differ(own, num, den) == 1 or _differ(own + 1, num, den) < 2:
        out.append(sums[-1:])
        if _differ(own, num, den) == 1:
            out.append(sums[-1] - scrambled)
    for c in (own, own + 1):  # as the larger or as the smaller set of a pair
        if _differ(c, num, den) < 2:
            continue
        agree, places, marks = _ranges(c, num, den)
        bounds = np.concatenate(([0], np.searchsorted(tokens, places), [len(tokens)]))
        keys = mix64(np.diff(sums[bounds]) + marks)
        held = bounds[1:] - bounds[:-1]
        weak = np.concatenate((np.flatnonzero(held == 1), np.flatnonzero(held == 0)))
        # at least ``agree`` ranges agree; if all of these are weak, the first of them have as
        # many behind them in both sets' lists, so the last ones need not be kept
        together = WEAK if len(marks) <= FEW_RANGES else 1
        if len(weak) >= agree:
            few = weak[: len(weak) - agree + together]
            if together == 1:
                out.append(keys[few])
            else:
                out.extend(mix64(keys[list(x)].cumsum()[-1:] + np.uint64(WEAK)) for x in combinations(few.tolist(), together))
        out.append(np.delete(keys, weak))
    return mix64(np.concatenate(out)).view(np.int64) if out else np.empty(0, np.int64)


def sets_of(column: pa.Array, width: int) -> list[np.ndarray]:
    """Per text: its sorted distinct shingle hashes."""
    return [distinct(s) for s in Words(column, NOT_SPACE).shingles(width)]


def set_id(tokens: np.ndarray) -> bytes | None:
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).digest() if len(tokens) else None


def _features(rows: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """``rows`` (k1, k2, doc_id, text) -> (k1, k2, doc_id, n, uid, rid, keys, map).

    ``rid`` is the first half of ``uid``: a short name for routing, where one name for two
    sets would only join two clusters.  A set's keys are given once per partition, so a
    text copied into a third of all rows adds one list per partition."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            if len(seen) > HELD_SETS:
                seen.clear()
            n, uid, keys, ends, maps = [], [], [], [0], []
            for tokens in sets_of(batch.column("text"), width):
                n.append(len(tokens))
                uid.append(set_id(tokens))
                new = uid[-1] is not None and uid[-1] not in seen
                if new:
                    seen.add(uid[-1])
                    keys.append(route_keys(tokens, num, den))
                ends.append(ends[-1] + (len(keys[-1]) if new else 0))
                maps.append(parity_map(tokens) if new else None)
            rid = [None if u is None else int.from_bytes(u[:8], "little", signed=True) for u in uid]
            flat = np.concatenate(keys) if keys else np.empty(0, np.int64)
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("k1", "k2", "doc_id")), pa.array(n, pa.int64()),
                                              pa.array(uid, pa.binary()), pa.array(rid, pa.int64()), lists, pa.array(maps, pa.binary())], ["k1", "k2", "doc_id", "n", "uid", "rid", "keys", "map"])

    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(scan, f"k1 bigint, k2 bigint, doc_id {id_type}, n bigint, uid binary, rid bigint, keys array<bigint>, map binary")


def parity_map(tokens: np.ndarray) -> bytes:
    """Per bit whether an odd number of the hashes fall on it; about a bit a hash."""
    bits = 64
    while bits < min(len(tokens), MAX_BITS):
        bits *= 2
    place = (mix64(tokens) & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits(np.bincount(place, minlength=bits) & 1, bitorder="little").tobytes()


def _folded(raw: bytes, size: int) -> int:
    """A map as a number of ``size`` bytes: the halves of a longer one XORed."""
    while len(raw) > size:
        half = len(raw) // 2
        raw = (int.from_bytes(raw[:half], "little") ^ int.from_bytes(raw[half:], "little")).to_bytes(half, "little")
    return int.from_bytes(raw, "little")


def route_forest(group: list[tuple[int, int, bytes]], num: int, den: int) -> list[tuple[int, int]]:
    """Of sets (rid, n, map) that share a key: a spanning forest of the pairs that may link,
    as the XOR of two parity maps never has more bits than the sets' difference."""
    size = min(len(g[2]) for g in group)
    group = sorted({g[0]: (g[1], g[0], _folded(g[2], size)) for g in group}.values())
    label, out = list(range(len(group))), []
    for j, (n, rid, bits) in enumerate(group):
        for i in range(j - 1, -1, -1):
            m = group[i][0]
            if m * den < n * num:
                break  # sorted by size: all before are smaller still
            if label[i] != label[j] and (bits ^ group[i][2]).bit_count() * (num + den) <= (den - num) * (n + m):
                out.append((group[i][1], rid))
                old, new = label[j], label[i]
                label = [new if x == old else x for x in label]
    return out


def _routes(num: int, den: int):
    """Rows (key, rid, n, map) sorted by key -> routes (a, b).  A key of more than
    ``GROUP_SETS`` sets routes them all to one cluster, in blocks of bounded memory."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, last, large = [], None, False
        out: list[tuple[int, int]] = []

        def flush() -> None:
            if large:
                out.extend((held[k][0], held[k + 1][0]) for k in range(len(held) - 1))
            elif len(held) > 1:
                out.extend(route_forest(held, num, den))

        for batch in batches:
            for key, *row in zip(*(batch.column(c).to_pylist() for c in ("key", "rid", "n", "map"))):
                if key != last:
                    flush()
                    held, last, large = [], key, False
                held.append(row)
                if len(held) > GROUP_SETS:
                    large = True
                    flush()
                    held = held[-1:]
            yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in out], pa.int64()) for k in (0, 1)], ["a", "b"])
            out.clear()
        flush()
        yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in out], pa.int64()) for k in (0, 1)], ["a", "b"])

    return run


def _sets(rows: DataFrame, width: int) -> DataFrame:
    """``rows`` (text) -> (uid, tokens)."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = sets_of(batch.column("text"), width)
            yield pa.RecordBatch.from_arrays([pa.array([set_id(s) for s in sets], pa.binary()),
                                              pa.array([s.tobytes() for s in sets], pa.binary())], ["uid", "tokens"])

    return rows.select("text").mapInArrow(scan, "uid binary, tokens binary")


# -- signature trees ---------------------------------------------------------------------

def bitmaps(sets: list[np.ndarray]) -> np.ndarray:
    """One row of bits per set, as 64-bit words; about four bits a token of the largest set."""
    bits = 64
    while bits < min(4 * max(len(s) for s in sets), MAX_BITS):
        bits *= 2
    out = np.zeros((len(sets), bits // 64), np.uint64)
    shift = np.uint64(64 - (bits.bit_length() - 1))
    for row, tokens in zip(out, sets):
        flags = np.zeros(bits, bool)
        flags[mix64(tokens) >> shift] = True
        row[:] = np.packbits(flags).view(np.uint64)
    return out


class Tree:
    """Nodes over sets sorted by size: [low, high) of the order, OR bitmap, slack, children."""

    def __init__(self, sizes: np.ndarray, maps: np.ndarray):
        self.sizes, self.maps = sizes, maps
        slack = sizes - np.bitwise_count(maps).sum(axis=1, dtype=np.int64)
        self.low, self.high, self.union, self.slack, self.kids = [], [], [], [], []
        level = []
        for a in range(0, len(sizes), LEAF):
            b = min(len(sizes), a + LEAF)
            level.append(self._add(a, b, np.bitwise_or.reduce(maps[a:b], axis=0), int(slack[a:b].max()), ()))
        while len(level) > 1:
            above = []
            for a in range(0, len(level), FANOUT):
                kids = tuple(level[a : a + FANOUT])
                above.append(self._add(self.low[kids[0]], self.high[kids[-1]],
                                       np.bitwise_or.reduce([self.union[k] for k in kids], axis=0), max(self.slack[k] for k in kids), kids))
            level = above
        self.root = level[0]

    def _add(self, low: int, high: int, union: np.ndarray, slack: int, kids: tuple) -> int:
        self.low.append(low)
        self.high.append(high)
        self.union.append(union)
        self.slack.append(slack)
        self.kids.append(kids)
        return len(self.low) - 1

    def possible(self, x: int, y: int, num: int, den: int) -> bool:
        """Whether some set below x and some set below y may link (x not after y)."""
        least_x, most_x = self.sizes[self.low[x]], self.sizes[self.high[x] - 1]
        least_y = self.sizes[self.low[y]]
        if x != y and most_x * den < least_y * num:
            return False
        common = int(np.bitwise_count(self.union[x] & self.union[y]).sum()) + min(self.slack[x], self.slack[y])
        return (num + den) * min(common, most_x) >= num * (least_x + least_y)


def _linked_sets(a: np.ndarray, b: np.ndarray, num: int, den: int) -> bool:
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    common = int((b[at] == a).sum())
    return den * common >= num * (len(a) + len(b) - common)


def tree_links(sets: list[np.ndarray], label: np.ndarray, side: np.ndarray | None, num: int, den: int) -> list[tuple[int, int]]:
    """Verified links that join what ``label`` has apart; with ``side``, only across sides.

    ``label`` is the component each set is known to be in."""
    order = np.argsort([len(s) for s in sets], kind="stable")
    sizes = np.array([len(sets[k]) for k in order], np.int64)
    label = label[order].copy()
    side = None if side is None else side[order]
    maps = bitmaps([sets[k] for k in order])
    tree, out = Tree(sizes, maps), []

    rows = max(1, LEAF_WORDS // (maps.shape[1] * LEAF))

    def leaves(x: int, y: int) -> None:
        js = slice(tree.low[y], tree.high[y])
        for low in range(tree.low[x], tree.high[x], rows):
            here = slice(low, min(low + rows, tree.high[x]))
            size, other = sizes[here, None], sizes[None, js]
            open_ = (label[here, None] != label[None, js]) & (other * num <= size * den) & (other * den >= size * num)
            if side is not None:
                open_ &= side[here, None] != side[None, js]
            if x == y:
                open_ &= np.arange(here.start, here.stop)[:, None] < np.arange(js.start, js.stop)
            if not open_.any():
                continue
            apart = np.bitwise_count(maps[here, None] ^ maps[None, js]).sum(axis=2, dtype=np.int64)
            open_ &= apart * (num + den) <= (den - num) * (size + other)
            for i, j in np.argwhere(open_).tolist():
                i, j = i + here.start, j + js.start
                if label[i] != label[j] and _linked_sets(sets[order[i]], sets[order[j]], num, den):
                    out.append((int(order[i]), int(order[j])))
                    label[label == label[j]] = label[i]

    todo = [(tree.root, tree.root)]
    while todo:
        x, y = todo.pop()
        known = label[tree.low[x]]
        if (label[tree.low[x] : tree.high[x]] == known).all() and (label[tree.low[y] : tree.high[y]] == known).all():
            continue
        if not tree.possible(x, y, num, den):
            continue
        xs, ys = tree.kids[x] or (x,), tree.kids[y] or (y,)
        if xs == (x,) and ys == (y,):
            leaves(x, y)
        elif x == y:  # a node with itself first, then its children with each other
            todo.extend((p, q) for k, p in enumerate(xs) for q in xs[k + 1 :])
            todo.extend((p, p) for p in xs)
        else:
            todo.extend((p, q) for p in xs for q in ys)
    return out


def _tasks(num: int, den: int):
    """Groups (task, uid, comp, side, cross, tokens) -> links (a, b)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in grouped(batches, "task"):
            uid = table.column("uid").to_pylist()
            names: dict[bytes, int] = {}
            label = np.array([names.setdefault(c, len(names)) for c in table.column("comp").to_pylist()], np.int64)
            if len(names) < 2:
                continue
            sets = [np.frombuffer(t, np.uint64) for t in table.column("tokens").to_pylist()]
            side = table.column("side").to_numpy() if table.column("cross")[0].as_py() else None
            found = tree_links(sets, label, side, num, den)
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([uid[i] for i, _ in found], pa.binary()), pa.array([uid[j] for _, j in found], pa.binary())], ["a", "b"])

    return run


def _linked(members: DataFrame, sets: DataFrame, num: int, den: int, name: str) -> DataFrame:
    work = (members.join(sets, "uid").select("task", "uid", "comp", "side", "cross", "tokens")
            .repartition("task").sortWithinPartitions("task"))
    return materialize(work.mapInArrow(_tasks(num, den), "a binary, b binary"), name)


def links(features: DataFrame, texts: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """Verified spanning links (a, b) between the entities of ``features``; ``texts`` has
    (k1, k2, text) of the same rows."""
    # which keys are shared: one shuffle of two numbers a row, and looking one row back and
    # ahead needs no memory however many sets share a key
    keyed = features.select("rid", F.explode("keys").alias("key"))
    place = Window.partitionBy("key").orderBy("rid")
    keyed = keyed.withColumn("last", F.lag("rid").over(place)).withColumn("next", F.lead("rid").over(place))
    shared = materialize(keyed.where("rid != last or rid != next").select("key", "rid"), "shared")
    maps = features.where("map is not null").select("uid", "rid", "n", "map").dropDuplicates(["uid"])
    work = (shared.join(maps, "rid").select("key", "rid", "n", "map")
            .repartition("key").sortWithinPartitions("key"))
    clusters = connected_components(work.mapInArrow(_routes(num, den), "a bigint, b bigint"), "routes")
    one = features.where("uid is not null").groupBy("uid", "rid").agg(
        F.min(F.struct("k1", "k2")).alias("row"), F.max("n").alias("n"))
    members = materialize(clusters.withColumnRenamed("id", "rid").join(one, "rid")
                          .select("uid", "root", "n", F.col("row.k1").alias("k1"), F.col("row.k2").alias("k2")), "members")
    # the sets of cluster members only, from their own rows' texts
    wanted = members.select("k1", "k2")
    wanted._sillage_rows = members._sillage_rows
    picked = texts.join(broadcast_if_small(wanted), ["k1", "k2"], "left_semi")
    sets = materialize(_sets(picked, width).dropDuplicates(["uid"]), "sets")
    sizes = members.groupBy("root").agg(F.count(F.lit(1)).alias("sets"), F.sum("n").alias("tokens"))
    chunks = F.greatest(F.ceil(F.col("sets") / CHUNK), F.ceil(F.col("tokens") / CHUNK_TOKENS))
    placed = members.select("uid", "root", "n").join(sizes.select("root", chunks.alias("chunks")), "root")
    placed = materialize(placed.withColumn("chunk", F.pmod(F.xxhash64("uid"), F.col("chunks"))), "chunks")
    alone = placed.select("uid", F.col("uid").alias("comp"), F.xxhash64("root", "chunk").alias("task"), F.lit(0).alias("side"), F.lit(False).alias("cross"))
    found = _linked(alone, sets, num, den, "links")
    if placed.where("chunks > 1").isEmpty():
        return found
    return found.unionByName(_across(placed.where("chunks > 1"), found, sets, num, den))


def _with_comp(placed: DataFrame, found: DataFrame) -> DataFrame:
    roots = connected_components(found, "links-cc").select(F.col("id").alias("uid"), F.col("root").alias("comp"))
    return placed.join(roots, "uid", "left").withColumn("comp", F.coalesce("comp", "uid"))


def _across(placed: DataFrame, found: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Links between the chunks of large clusters: representatives first, then the pairs of
    chunks that still hold unconnected sets."""
    now = _with_comp(placed, found)
    reps = now.groupBy("root", "chunk", "comp").agg(F.min(F.struct("uid", "n")).alias("first")).select("root", "chunk", "comp", "first.*")
    many = reps.groupBy("root").agg(F.greatest(F.ceil(F.count(F.lit(1)) / CHUNK), F.ceil(F.sum("n") / CHUNK_TOKENS)).alias("parts"))
    reps = reps.join(many, "root").withColumn("chunk", F.pmod(F.xxhash64("uid", F.lit(3)), F.col("parts")))
    reps = reps.select("uid", "comp", F.xxhash64("root", "chunk", F.lit(1)).alias("task"), F.lit(0).alias("side"), F.lit(False).alias("cross"))
    more = found.unionByName(_linked(reps, sets, num, den, "rep-links"))
    now = materialize(_with_comp(placed, more), "chunk-state")
    ends = now.groupBy("root", "chunk").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"))
    left, right = ends.alias("l"), ends.alias("r")
    apart = left.join(right, F.col("l.root") == F.col("r.root")).where(
        (F.col("l.chunk") != F.col("r.chunk")) & ~((F.col("l.lo") == F.col("l.hi")) & (F.col("r.lo") == F.col("r.hi")) & (F.col("l.lo") == F.col("r.lo"))))
    apart = apart.select(F.col("l.root").alias("root"), F.col("l.chunk").alias("chunk"), F.col("r.chunk").alias("mate"))
    lo, hi = F.least("chunk", "mate"), F.greatest("chunk", "mate")
    pairs = now.join(apart, ["root", "chunk"]).select("uid", "comp", F.xxhash64("root", lo, hi, F.lit(2)).alias("task"),
                                                      (F.col("chunk") > lo).cast("int").alias("side"), F.lit(True).alias("cross"))
    return more.unionByName(_linked(pairs, sets, num, den, "pair-links"))


def join(docs: DataFrame, width: int = WIDTH, threshold: tuple[int, int] = THRESHOLD,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(k1, k2, doc_id, n_shingles, component, component_id) for every row of ``docs``;
    ``threshold`` is a fraction, ``component`` is null for an empty set, k1 and k2 are the
    row's key (``row_key``)."""
    num, den = threshold
    small_batches(docs.sparkSession)
    rows = docs.select(*row_key(id_col, text_col), F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    feats = materialize(_features(rows, width, num, den), "features")
    found = links(feats, rows.select("k1", "k2", "text"), width, num, den)
    roots = connected_components(found, "jaccard-cc").select(F.col("id").alias("uid"), "root")
    known = feats.select("k1", "k2", "doc_id", "n", "uid").join(roots, "uid", "left")
    known = materialize(known.select("k1", "k2", "doc_id", "n", F.coalesce("root", "uid").alias("root")), "jaccard-state")
    least = known.where("root is not null").groupBy("root").agg(F.min("doc_id").alias("least"))
    out = known.join(least, "root", "left")
    return out.select("k1", "k2", "doc_id", F.col("n").alias("n_shingles"), F.col("root").alias("component"),
                      F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("least")).alias("component_id"))


def one_of_each(docs: DataFrame, width: int = 5, threshold: tuple[int, int] = (80, 100),
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that open their group: the least id of each
    component (ties: least key).  Rows with an empty set are groups of their own."""
    state = join(docs, width, threshold, id_col, text_col).where("component is not null")
    state = materialize(state.groupBy("component", "doc_id", "k1", "k2").agg(F.count(F.lit(1)).alias("times")), "groups")
    first = state.groupBy("component").agg(F.count(F.lit(1)).alias("rows"), F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "k1", "k2")).alias("keep"))
    gone = state.join(first.where("rows > 1"), "component").where(~((F.col("k1") == F.col("keep.k1")) & (F.col("k2") == F.col("keep.k2"))))
    gone = materialize(gone.select(F.col("k1").alias("__k1"), F.col("k2").alias("__k2")), "copies")
    k1, k2 = row_key(id_col, text_col)

    def without(rows: DataFrame, keys: DataFrame) -> DataFrame:
        return rows.join(broadcast_if_small(keys), (k1 == F.col("__k1")) & (k2 == F.col("__k2")), "left_anti")

    again = materialize(state.where("times > 1").select(F.col("k1").alias("__k1"), F.col("k2").alias("__k2")), "repeats")
    if again._sillage_rows == 0:
        return without(docs, gone)
    # rows that repeat id and text: one stays; only they are dealt out by key
    repeated = docs.join(broadcast_if_small(again), (k1 == F.col("__k1")) & (k2 == F.col("__k2")), "left_semi")
    single = repeated.withColumn("__k1", k1).withColumn("__k2", k2).dropDuplicates(["__k1", "__k2"]).drop("__k1", "__k2")
    return without(without(docs, again).unionByName(single), gone)
