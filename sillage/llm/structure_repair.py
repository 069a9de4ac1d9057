"""Repair of conversation structure: cheapest edits, then the least of the cheapest audits.

A repaired conversation is empty or reads an optional system turn and then user and
assistant turns in pairs.  Edits are Keep, Delete, Insert (a turn without text) and Rerole
(to user or assistant) with the costs below; blank and duplicate turns must go, and a
truncated turn that stays costs extra.  Nodes are (turn, state of the grammar); the cost DP
runs backwards over them, and arcs that reach a node's cost are its optimal arcs.  Optimal
nodes are then ranked by their least audits of 1, 2, 4, ... letters: a rank of twice the
length is the rank of (own rank, rank of the node that the doubled pointer reaches).  With
ranks of full length each node's least arc is known, and the doubled pointers give every
step of the least path without walking it.

Rows are range-sorted by conversation and turn and packed into segments of at most
``SEGMENT_ROWS`` turns (and about ``SEGMENT_CHARS`` characters) of one conversation, so a
conversation with a third of all rows is spread over tasks like any others.  Conversations
in one segment, nearly all, are done where they lie.  For the others each segment gives its
min-plus cost matrix (4 x 4), one backward scan over these gives the cost behind every
segment, each segment then gives the state in which it is left for each state it may be
entered in, and a forward scan picks the states; only such small rows meet in a scan, which
streams them.  The segments are a written table in the shared folder.

Edge cases: null role and text are one space (a blank turn); null turns come first; a null
conv_id is a conversation of its own; rows of equal turn are ordered by role and text.
Roles count by their first letter; a role with another or none is kept in no repair.
Repeated rows are duplicates.  An empty table gives no rows.  Other columns are left out.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import materialize
from .common import small_batches

#: Costs of the edits, and of leaving a truncated turn.
DELETE, INSERT, REROLE, TRUNCATED = 4, 3, 3, 3
SEGMENT_ROWS, SEGMENT_CHARS = 1024, 4_000_000

#: States: nothing yet, after system, after user, after assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
#: Where a user or assistant turn that the grammar wants next leads.
NEXT = np.array([USER, USER, ASSISTANT, USER])
ROLE = {USER: "user", ASSISTANT: "assistant"}
#: Edits in ASCII order of their initials; rank 0 is the end of an audit.
EDITS = "DIKR"
FAR = 1 << 40

SPACE = " \t\n\x0b\x0c\r"
SEGMENT = "conv_id {id}, part int, seg int, turns array<bigint>, roles array<string>, texts array<string>"
PIECE = ("conv_id {id}, part int, seg int, low bigint, high bigint, turns_seen bigint, blank bigint, duplicate bigint, "
         "truncated bigint, illegal bigint, head string, tail string, cost bigint, audit string, roles array<string>, texts array<string>")


def _pack(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Sorted rows -> segments of ``most`` rows."""
    part, seg = TaskContext.get().partitionId(), 0
    names = ["conv_id", "part", "seg", "turns", "roles", "texts"]
    held: list[tuple] = []
    chars, last = 0, None

    def out(schema: pa.Schema) -> pa.RecordBatch:
        turns, roles, texts = ([r[k] for r in held] for k in (1, 2, 3))
        return pa.RecordBatch.from_arrays([
            pa.array([held[0][0]], schema.field("conv_id").type), pa.array([part], pa.int32()), pa.array([seg], pa.int32()),
            pa.array([turns], pa.list_(pa.int64())), pa.array([roles], pa.list_(pa.string())), pa.array([texts], pa.list_(pa.string()))], names)

    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if held and (row[0] != last or len(held) >= most or chars > SEGMENT_CHARS):
                yield out(batch.schema)
                seg, held, chars = seg + 1, [], 0
            held.append(row)
            last, chars = row[0], chars + len(row[3])
        schema = batch.schema
    if held:
        yield out(schema)


def segments(rows: DataFrame, most: int = SEGMENT_ROWS) -> DataFrame:
    """Conversations cut into segments, whose order is (part, seg)."""
    small_batches(rows.sparkSession)
    by = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "text"]
    rows = rows.select("conv_id", F.col("turn").cast("long").alias("turn"),
                       *(F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")))
    kind = rows.schema["conv_id"].dataType.simpleString()
    packed = rows.repartitionByRange(*by).sortWithinPartitions(*by).mapInArrow(lambda b: _pack(b, most), SEGMENT.format(id=kind))
    return materialize(packed, "turns")


def _key(role: str, text: str) -> bytes:
    return hashlib.blake2b(f"{len(role)}:{role}{text}".encode(), digest_size=16).digest()


def _faults(roles: list[str], texts: list[str], seen: set[bytes]) -> str:
    """First fault of each turn: blank, duplicate, truncated or none (``-``)."""
    out, seen = [], set(seen)
    for role, text in zip(roles, texts):
        end = text.rstrip(SPACE)
        key = _key(role, text)
        out.append("b" if not end else "d" if key in seen else "t" if end[-1] not in ".!?" else "-")
        seen.add(key)
    return "".join(out)


def _arcs(role: str, fault: str) -> tuple[list[tuple[int, int, int]], int]:
    """(from, to, cost) of Keep for a turn, and the cost of Rerole (FAR if it must go)."""
    if fault in "bd":
        return [], FAR
    extra = TRUNCATED * (fault == "t")
    keep = {"s": [(START, SYSTEM)], "u": [(START, USER), (SYSTEM, USER), (ASSISTANT, USER)], "a": [(USER, ASSISTANT)]}
    return [(a, b, extra) for a, b in keep.get(role[:1], [])], REROLE + extra


def costs(roles: list[str], faults: str, after: list[int], last: bool) -> list[list[int]]:
    """Cost to go from each (turn, state), the end of the segment included.

    ``after`` holds the costs behind the segment; the ``last`` one may still insert there.
    """

    def inserted(b: list[int]) -> list[int]:
        u, a = min(b[USER], INSERT + b[ASSISTANT]), min(b[ASSISTANT], INSERT + b[USER])
        return [min(b[START], INSERT + u), min(b[SYSTEM], INSERT + u), u, a]

    now = inserted(after) if last else list(after)
    out = [now]
    known: dict[tuple, tuple] = {}
    for role, fault in zip(reversed(roles), reversed(faults)):
        k = (role[:1], fault)
        if k not in known:
            known[k] = _arcs(role, fault)
        keep, rerole = known[k]
        u, a = rerole + now[USER], rerole + now[ASSISTANT]
        b = [min(DELETE + now[START], u), min(DELETE + now[SYSTEM], u), min(DELETE + now[USER], a), min(DELETE + now[ASSISTANT], u)]
        for s, t, c in keep:
            if c + now[t] < b[s]:
                b[s] = c + now[t]
        now = inserted(b)
        out.append(now)
    return out[::-1]


def least_paths(roles: list[str], faults: str, f: list[list[int]], last: bool) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """(label, rank, pointers) of the nodes ``4 * turn + state`` of a segment.

    ``label`` is a node's first edit on its least optimal path (0 at the end), ``pointers[k]``
    the node 2**k edits on.
    """
    n = len(roles)
    cost = np.array(f, np.int64)
    state = np.arange(4)
    node = np.arange(4 * (n + 1)).reshape(n + 1, 4)
    to = np.full((n + 1, 4, 4), -1)  # by turn, state, edit
    here, then = cost[:-1], cost[1:]
    to[:-1, :, 0] = np.where(here == DELETE + then, node[1:], -1)
    to[:, :, 1] = np.where(cost == INSERT + cost[:, NEXT], node[:, NEXT], -1)
    if not last:
        to[-1, :, 1] = -1
    must = np.array([c in "bd" for c in faults], bool)[:, None]
    extra = np.array([TRUNCATED * (c == "t") for c in faults])[:, None]
    initial = np.array([{"s": 0, "u": 1, "a": 2}.get(r[:1], 3) for r in roles])[:, None]
    kept = np.where((initial == 0) & (state == START), SYSTEM, np.where(((initial == 1) & (state != USER)) | ((initial == 2) & (state == USER)), NEXT, -1))
    target = np.take_along_axis(then, np.maximum(kept, 0), 1)
    to[:-1, :, 2] = np.where(~must & (kept >= 0) & (here == extra + target), node[1:, :1] + kept, -1)
    to[:-1, :, 3] = np.where(~must & (here == REROLE + extra + then[:, NEXT]), node[1:][:, NEXT], -1)
    to = to.reshape(-1, 4)

    some = (to >= 0).any(1)
    label = np.where(some, 1 + (to >= 0).argmax(1), 0)  # edits of a node differ, so the least is one arc
    step = np.where(some, to[np.arange(len(to)), np.maximum(label - 1, 0)], np.arange(len(to)))
    rank, pointers = label, [step]
    while some[pointers[-1]].any():
        p = pointers[-1]
        rank = np.unique(rank * (rank.max() + 1) + rank[p], return_inverse=True)[1]
        pointers.append(p[p])
    return label, rank, pointers


def walk(label: np.ndarray, pointers: list[np.ndarray], node: int) -> np.ndarray:
    """The nodes of the least path from ``node``, its end included, by doubled pointers."""
    at, length = node, 0
    for k in reversed(range(len(pointers))):
        if label[pointers[k][at]]:
            at, length = pointers[k][at], length + (1 << k)
    length += bool(label[at])
    steps = np.arange(length + 1)
    nodes = np.full(length + 1, node)
    for k, p in enumerate(pointers):
        nodes = np.where(steps >> k & 1, p[nodes], nodes)
    return nodes


def _each(batches: Iterator[pa.RecordBatch], body: Callable[[dict], dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():  # a segment at a time: its texts are what is held
            yield pa.RecordBatch.from_pylist([body(row)], schema)


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "smallint": pa.int16()}

    def kind(k: str) -> pa.DataType:
        m = re.fullmatch(r"array<(\w+)>", k)
        return pa.list_(kinds[m[1]]) if m else kinds[k]

    return pa.schema([(c.split(" ")[0], kind(c.split(" ")[1])) for c in ddl.split(", ")])


def _map(df: DataFrame, ddl: str, body: Callable[[dict], dict]) -> DataFrame:
    ddl = ddl.format(id=df.schema["conv_id"].dataType.simpleString())
    return df.mapInArrow(lambda batches: _each(batches, body, _arrow(ddl)), ddl)


def _scan(df: DataFrame, ddl: str, forward: bool, body: Callable[[dict, object], tuple[dict, object]]) -> DataFrame:
    """``body(row, carried) -> (row, carried)`` over the segments of each conversation in
    order or backwards; ``carried`` starts as None.  Rows stream; none are gathered."""
    ddl = ddl.format(id=df.schema["conv_id"].dataType.simpleString())
    order = [F.col(c).asc() if forward else F.col(c).desc() for c in ("part", "seg")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, carried, schema = (), None, _arrow(ddl)
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if (row["conv_id"],) != last:
                    last, carried = (row["conv_id"],), None
                made, carried = body(row, carried)
                out.append(made)
            yield pa.RecordBatch.from_pylist(out, schema)

    return df.repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), *order).mapInArrow(run, ddl)


def _piece(row: dict) -> dict:
    """Counts, audit and repaired turns of a segment entered in ``entry``."""
    roles, texts, turns = row["roles"], row["texts"], [t for t in row["turns"] if t is not None]
    after, entry = row.get("after"), row.get("entry") or START
    last = after is None
    faults = _faults(roles, texts, set(bytes.fromhex(k) for k in row.get("seen") or []))
    f = costs(roles, faults, [0, FAR, FAR, 0] if last else after, last)
    label, _, pointers = least_paths(roles, faults, f, last)
    nodes = walk(label, pointers, entry).tolist()
    edits = [EDITS[k - 1] for k in label[nodes[:-1]]]
    out_roles, out_texts = [], []
    for edit, a, b in zip(edits, nodes, nodes[1:]):
        if edit != "D":
            out_roles.append(roles[a // 4] if edit == "K" else ROLE[b % 4])
            out_texts.append("" if edit == "I" else texts[a // 4])
    pairs = [a[:1] + b[:1] for a, b in zip(roles, roles[1:])]
    return {"conv_id": row["conv_id"], "part": row["part"], "seg": row["seg"],
            "low": turns[0] if turns else None, "high": turns[-1] if turns else None, "turns_seen": len(set(turns)),
            "blank": faults.count("b"), "duplicate": faults.count("d"), "truncated": faults.count("t"),
            "illegal": sum(p not in ("su", "ua", "au") for p in pairs), "head": roles[0][:1], "tail": roles[-1][:1],
            "cost": f[0][entry] - (0 if last else after[nodes[-1] % 4]), "audit": "".join(edits), "roles": out_roles, "texts": out_texts}


def _spread(segs: DataFrame) -> DataFrame:
    """Segments of conversations that have several: what lies before and behind each."""
    keys = ["conv_id", "part", "seg"]

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                own = sorted({_key(r, t).hex() for r, t in zip(row["roles"], row["texts"])})
                yield pa.RecordBatch.from_pylist([{**{c: row[c] for c in keys}, "key": k} for k in own], schema)

    ddl = "conv_id {id}, part int, seg int, key string".format(id=segs.schema["conv_id"].dataType.simpleString())
    schema = _arrow(ddl)
    own = segs.mapInArrow(digests, ddl)
    first = own.groupBy("conv_id", "key").agg(F.min(F.struct("part", "seg")).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    again = own.alias("o").join(first.alias("f"), F.col("o.conv_id").eqNullSafe(F.col("f.conv_id")) & (F.col("o.key") == F.col("f.key")))
    again = again.where(F.struct("o.part", "o.seg") > F.col("first"))
    seen = again.groupBy("o.conv_id", "o.part", "o.seg").agg(F.collect_list("o.key").alias("seen"))  # a segment's own keys at most
    segs = materialize(_beside(segs, seen), "spread")

    def matrix(row: dict) -> dict:
        faults = _faults(row["roles"], row["texts"], set(bytes.fromhex(k) for k in row["seen"] or []))
        unit = [[0 if t == s else FAR for t in range(4)] for s in range(4)]
        columns = [costs(row["roles"], faults, u, False)[0] for u in unit]
        return {**{c: row[c] for c in keys}, "matrix": [min(columns[t][s], FAR) for s in range(4) for t in range(4)]}

    def behind(row: dict, after: list[int] | None) -> tuple[dict, list[int]]:
        made = {**{c: row[c] for c in keys}, "after": after}
        then = after or costs([], "", [0, FAR, FAR, 0], True)[0]  # behind the last turn only inserts are left
        m = row["matrix"]
        return made, [min(m[4 * s + t] + then[t] for t in range(4)) for s in range(4)]

    after = _scan(_map(segs, "conv_id {id}, part int, seg int, matrix array<bigint>", matrix),
                  "conv_id {id}, part int, seg int, after array<bigint>", False, behind)
    segs = materialize(_beside(segs, after), "behind")

    def exits(row: dict) -> dict:
        faults = _faults(row["roles"], row["texts"], set(bytes.fromhex(k) for k in row["seen"] or []))
        last = row["after"] is None
        f = costs(row["roles"], faults, [0, FAR, FAR, 0] if last else row["after"], last)
        label, _, pointers = least_paths(row["roles"], faults, f, last)
        return {**{c: row[c] for c in keys}, "exits": [int(pointers[-1][s]) % 4 for s in range(4)]}

    def enter(row: dict, state: int | None) -> tuple[dict, int]:
        state = state or START
        return {**{c: row[c] for c in keys}, "entry": state}, row["exits"][state]

    entry = _scan(_map(segs, "conv_id {id}, part int, seg int, exits array<int>", exits),
                  "conv_id {id}, part int, seg int, entry int", True, enter)
    return _beside(segs, entry)


def _beside(segs: DataFrame, more: DataFrame) -> DataFrame:
    """``more``'s columns beside the segments; (part, seg) is unique."""
    return segs.join(more.drop("conv_id"), ["part", "seg"], "left")


def repair(rows: DataFrame, most: int = SEGMENT_ROWS) -> DataFrame:
    """Repaired pieces of the conversations in ``rows`` (conv_id, turn, role, text).

    One row per segment: counts of its faults, ``cost``, ``audit``, repaired ``roles`` and
    ``texts``; (part, seg) orders a conversation's pieces and ``whole`` marks the only one.
    ``most``: turns of a segment.
    """
    segs = segments(rows, most)
    several = segs.groupBy("conv_id").count().where("count > 1")
    several = materialize(several.select(F.col("conv_id").alias("several")), "several")
    if not several._sillage_rows:
        return _map(segs, PIECE, _piece).withColumn("whole", F.lit(True))
    same = segs["conv_id"].eqNullSafe(several["several"])
    alone = _map(segs.join(several, same, "left_anti"), PIECE, _piece).withColumn("whole", F.lit(True))
    spread = _map(_spread(segs.join(several, same, "left_semi")), PIECE, _piece).withColumn("whole", F.lit(False))
    return alone.unionByName(spread)


REPORT = ("conv_id {id}, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, "
          "audit string, repaired_sha256 string")


def report(pieces: DataFrame) -> DataFrame:
    """One row per conversation: counts, cost, audit and the digest of its repaired lines."""
    sums = ["blank", "duplicate", "truncated", "illegal", "cost"]
    lines = F.array_join(F.zip_with("roles", "texts", lambda r, t: F.concat(r, F.lit(":"), t)), "\n")
    gaps = F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns_seen"), F.lit(0))
    alone = pieces.where("whole").select("conv_id", gaps.cast("long").alias("gaps"), *sums, "audit", F.sha2(lines, 256).alias("repaired_sha256"))

    ddl = REPORT.format(id=pieces.schema["conv_id"].dataType.simpleString())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, last, now = _arrow(ddl), (), None

        def done() -> pa.RecordBatch:
            span = now["high"] - now["low"] + 1 - now["turns_seen"] if now["low"] is not None else 0
            return pa.RecordBatch.from_pylist([{"conv_id": last[0], "gaps": span, **{c: now[c] for c in sums},
                                                "audit": "".join(now["audit"]), "repaired_sha256": now["sha"].hexdigest()}], schema)

        for batch in batches:
            for row in batch.to_pylist():
                if (row["conv_id"],) != last:
                    if now:
                        yield done()
                    last, now = (row["conv_id"],), {**dict.fromkeys(sums, 0), "low": None, "high": None, "turns_seen": 0,
                                                    "audit": [], "sha": hashlib.sha256(), "any": False, "tail": None}
                for c in sums:
                    now[c] += row[c]
                now["illegal"] += now["tail"] is not None and now["tail"] + row["head"] not in ("su", "ua", "au")
                now["turns_seen"] += row["turns_seen"] - (row["low"] is not None and row["low"] == now["high"])
                now["low"] = row["low"] if now["low"] is None else now["low"]
                now["high"] = now["high"] if row["high"] is None else row["high"]
                now["tail"] = row["tail"]
                now["audit"].append(row["audit"])
                for role, text in zip(row["roles"], row["texts"]):
                    now["sha"].update((("\n" if now["any"] else "") + f"{role}:{text}").encode())
                    now["any"] = True
        if now:
            yield done()

    by = [F.col("conv_id").asc_nulls_first(), "part", "seg"]
    return alone.unionByName(pieces.where("not whole").repartition("conv_id").sortWithinPartitions(*by).mapInArrow(run, ddl))


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows of ``conversations`` with reproducible faults (a repair's test input)."""
    space = {c: F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")}
    fault = F.crc32(F.concat(space["conv_id"], F.lit(":"), space["turn"])) % 20
    rows = conversations.select("conv_id", "turn", space["role"].alias("role"), space["text"].alias("text"), fault.alias("fault"))
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.explode(F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return (rows.where("fault != 0")
            .select("conv_id", "turn", F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), copies.alias("copy"))
            .drop("copy"))
