"""Conversation operators against plain-Python forms of their contracts."""

import hashlib
import heapq
import random
import re
import zlib
from collections import defaultdict

import pytest

from sillage.llm import prefix_trie, queries, structure_repair

SMALL = "/root/testdata/sf0.001"
CONV = "conv_id long, turn long, role string, text string, k1 long, part int"


def best_edits(rows):
    """Cheapest edits with the least audit, by Dijkstra over (cost, audit)."""
    seen, faults = set(), []
    for role, text in rows:
        body = text.strip(" \t\n\x0b\x0c\r")
        faults.append("b" if not body else "d" if (role, text) in seen else "t" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, got, out = heapq.heappop(heap)
        if (i, got[-1:]) in done and not (i == len(rows) and re.fullmatch("(s?(ua)+)?", got)):
            continue
        done.add((i, got[-1:]))
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", got):
            return cost, audit, out, faults
        want = "assistant" if got[-1:] == "u" else "user"
        heapq.heappush(heap, (cost + 3, audit + "I", i, got + want[0], out + (f"{want}:",)))
        if i < len(rows):
            role, text = rows[i]
            heapq.heappush(heap, (cost + 4, audit + "D", i + 1, got, out))
            if faults[i] not in ("b", "d"):
                more = 3 if faults[i] else 0
                heapq.heappush(heap, (cost + 3 + more, audit + "R", i + 1, got + want[0], out + (f"{want}:{text}",)))
                if role[:1] == want[0] or role[:1] == "s" and not got:
                    heapq.heappush(heap, (cost + more, audit + "K", i + 1, got + role[0], out + (f"{role}:{text}",)))


def repaired(rows):
    """Expected report row of a conversation's (turn, role, text) rows."""
    rows = sorted(((t, r if r is not None else " ", x if x is not None else " ") for t, r, x in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    turns = [t for t, _, _ in rows if t is not None]
    cost, audit, out, faults = best_edits([(r, x) for _, r, x in rows])
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count("b"), faults.count("d"), faults.count("t"),
            sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest())


def damage(rows):
    out = []
    for c, t, role, text in rows:
        role, text = (" " if v is None else v for v in (role, text))
        k = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if k == 0:
            continue
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        out += [(c, t, "user" if k == 4 else role, text)] * (2 if k == 3 else 1)
    return out


def conversations(n, longest, seed):
    rnd = random.Random(seed)
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", "uX", None]
    texts = ["a.", "b!", "c", "", " \t", "d? ", None, "e.", "long " * 50 + "."]
    rows = []
    for c in range(n):
        for k in range(rnd.randint(1, longest)):
            rows.append((c if c else None, rnd.choice([None, k, k, k, k + 2]), rnd.choice(roles), rnd.choice(texts + [f"{k}." for _ in range(8)])))
    return rows


@pytest.mark.parametrize("cut", [1024, 3])
def test_repair_equals_search(spark, cut):
    """``cut`` = 3: conversations over many segments."""
    rows = conversations(150, 7, 5) + [(900, k, "user" if k % 2 else "assistant", f"{k}.") for k in range(40)] + [(901, 1, "user", "x.")] * 5
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], CONV)
    pieces = structure_repair.repair(df, cut)
    by = defaultdict(list)
    for c, *r in rows:
        by[c].append(r)
    got = {r["conv_id"]: tuple(r)[1:] for r in structure_repair.report(pieces).collect()}
    assert got == {c: repaired(r) for c, r in by.items()}
    if cut == 3:
        assert pieces.where("not whole").count() > 50


def test_ranks_are_those_of_audits():
    """Ranks of full length order all nodes by their least audits."""
    rnd = random.Random(8)
    for _ in range(50):
        roles = [rnd.choice(["system", "user", "assistant", "tool"]) for _ in range(rnd.randint(0, 9))]
        faults = "".join(rnd.choice("--tbd") for _ in roles)
        f = structure_repair.costs(roles, faults, [0, structure_repair.FAR, structure_repair.FAR, 0], True)
        label, rank, pointers = structure_repair.least_paths(roles, faults, f, True)
        audits = ["".join(structure_repair.EDITS[label[v] - 1] for v in structure_repair.walk(label, pointers, s)[:-1]) for s in range(len(label))]
        assert sorted(range(len(label)), key=lambda v: (audits[v], v)) == sorted(range(len(label)), key=lambda v: (rank[v], v))


def test_repair_of_edge_tables(spark):
    empty = spark.createDataFrame([], CONV)
    assert structure_repair.report(structure_repair.repair(empty)).count() == 0
    blank = spark.createDataFrame([(1, None, None, None, 0, 0), (2, 5, "user", "x " * 300_000 + ".", 0, 0)], CONV)
    got = {r["conv_id"]: r["audit"] for r in structure_repair.report(structure_repair.repair(blank)).collect()}
    assert got == {1: "D", 2: "KI"}


def test_repair_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    by = defaultdict(list)
    for c, *r in damage(rows):
        by[c].append(r)
    got = {r["conv_id"]: tuple(r[c] for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"))
           for r in queries.QUERIES["op12_structure_repair"](spark, SMALL).collect()}
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert got == {c: repaired(by[c]) if c in by else nothing for c in {r[0] for r in rows}}


def trie_of(convs):
    """Expected nodes of {conv_id: [(role, text), ...]}."""
    members = defaultdict(list)
    for c in sorted(convs):
        for d in range(len(convs[c]) + 1):
            members[tuple(convs[c][:d])].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[q] for q in children[p]) or 1
        saved[p] = sum(saved[q] for q in children[p]) + ((len(members[p]) - 1) * len(p[-1][1].encode()) if p else 0)
    out = set()
    for p, m in members.items():
        ends = ",".join(str(c) for c in m if len(convs[c]) == len(p))
        out.add((m[0], len(p), members[p[:-1]][0] if p else None, len(m), len(children[p]), leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return out


def ordered(rows):
    by = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            by[c].append((t is not None, t or 0, r or "", x or ""))
    return {c: [r[2:] for r in sorted(v)] for c, v in by.items()}


def shared(rows):
    own = ordered(rows)
    out = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = own.get(c - c % 5, [])[:h] + own[c][h:]
    return out


def node_set(df):
    return [tuple(r[c] for c in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")) for r in df.collect()]


@pytest.mark.parametrize("first, grow", [(2000, 16), (3, 4)])
def test_trie_equals_plain_python(spark, first, grow):
    """``first`` = 3: many small batches are inserted one after another."""
    rnd = random.Random(first)
    rows, base = [], [("user", "a"), ("assistant", "bé"), ("user", ""), (None, "a"), ("user", None)]
    for c in range(60):
        n = rnd.choice([1, 2, 3, 5, 9, 30])
        turns = [base[0]] * n if c % 3 == 0 else [rnd.choice(base[: 1 + k % 5]) for k in range(n)]
        rows += [(c * 3 % 61, k if k % 7 else None, *t) for k, t in enumerate(turns) if k or rnd.random() < 0.9]
    rows += [(200 + c, k, "user", f"{min(k, 17)}{k // 40 * c}") for c in range(6) for k in range(50)] + [(None, 1, "user", "x")]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], CONV)
    got = node_set(prefix_trie.nodes(prefix_trie.symbols(df), None, first, grow))
    assert len(got) == len(set(got)) and set(got) == trie_of(ordered(rows))
    got = node_set(prefix_trie.nodes(*prefix_trie.rebuilt(prefix_trie.symbols(df)), first, grow))
    assert len(got) == len(set(got)) and set(got) == trie_of(shared(rows))


def test_trie_of_edge_tables(spark):
    empty = spark.createDataFrame([], CONV)
    assert prefix_trie.nodes(*prefix_trie.rebuilt(prefix_trie.symbols(empty))).count() == 0
    one = spark.createDataFrame([(4, None, None, None, 0, 0)] * 2, CONV)
    assert set(node_set(prefix_trie.nodes(prefix_trie.symbols(one)))) == trie_of({4: [("", "")] * 2})
    silent = spark.createDataFrame([(9,), (7,), (None,)], "conv_id long")
    assert set(node_set(prefix_trie.nodes(prefix_trie.symbols(empty), silent))) == trie_of({7: [], 9: []})


def test_trie_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert set(node_set(queries.QUERIES["op11_prefix_trie"](spark, SMALL))) == trie_of(shared(rows))
