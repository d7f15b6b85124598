"""Conversation repair and prefix trie against plain versions, row by row."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

import cases
from claimlake.llm import prefix_trie, queries, structure_repair

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
NONE = hashlib.sha256(b"").hexdigest()
KEEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
NEXT = (2, 2, 3, 2)


def plain_repair(turns):
    """(cost, edits) by trying every edit at every place."""
    n, memo = len(turns), {}

    def go(i, q, inserted):
        if (i, q, inserted) in memo:
            return memo[i, q, inserted]
        options = [(0, "")] if i == n and q in (0, 3) else []
        if inserted < 4:
            options += [(c + 2, "I" + e) for c, e in [go(i, NEXT[q], inserted + 1)] if e is not None]
        if i < n:
            initial, fault = turns[i]
            more = fault == 3
            moves = [("D", 3, q)]
            if fault not in (1, 2):
                moves += [("R", 2 + more, NEXT[q])] + ([("K", more, KEEP[q, initial])] if (q, initial) in KEEP else [])
            for name, cost, p in moves:
                c, e = go(i + 1, p, 0)
                if e is not None:
                    options.append((c + cost, name + e))
        memo[i, q, inserted] = min(options, default=(10**9, None))
        return memo[i, q, inserted]
    for i in range(n, -1, -100):  # from the end, so that no call goes deep
        [go(i, q, 0) for q in range(4)]
    return go(0, 0, 0)


def plain_op11(rows):
    blank = lambda v: " " if v is None else str(v)
    convs = {}
    for c, t, role, text in rows:
        role, text, kind = blank(role), blank(text), zlib.crc32(f"{blank(c)}:{blank(t)}".encode()) % 20
        here = convs.setdefault(c, [])
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        here += [] if kind == 0 else [(t, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    out = {}
    for c, here in convs.items():
        here.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.md5(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest()))
        seen, turns = set(), []
        for _, role, text in here:
            body = text.rstrip(" \t\n\x0b\x0c\r")
            turns.append((role[:1], 1 if not body else 2 if (role, text) in seen else 3 if body[-1] not in ".!?" else 0))
            seen.add((role, text))
        cost, edits = plain_repair(turns)
        lines, rest, q = [], list(here), 0
        for e in edits:
            role, text = (None, "") if e == "I" else rest.pop(0)[1:]
            if e in "IR":
                role = ("user", "user", "assistant", "user")[q]
            if e != "D":
                lines.append(f"{role}:{text}")
                q = KEEP[q, role[0]]
        ts = [r[0] for r in here if r[0] is not None]
        faults = [f for _, f in turns]
        out[c] = (max(ts) - min(ts) + 1 - len(set(ts)) if ts else 0, faults.count(1), faults.count(2), faults.count(3),
                  sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:])), cost, edits, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def plain_op12(rows):
    own = {}
    for c, t, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((t, role or "", text or ""))
    for v in own.values():
        v.sort(key=lambda r: (r[0] is not None, r[0] or 0, hashlib.md5(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest()))
    own = {c: tuple(r[1:] for r in v) for c, v in own.items()}
    members, ends = {}, {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        turns = own.get(c - c % 100, ())[:h] + own[c][h:]
        ends.setdefault(turns, []).append(c)
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    kids = {}
    for p in members:
        if p:
            kids.setdefault(p[:-1], []).append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[k] for k in kids.get(p, ())) or 1
        saved[p] = sum(saved[k] for k in kids.get(p, ())) + ((len(members[p]) - 1) * len(p[-1][1]) if p else 0)
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids.get(p, ())), leaves[p], saved[p],
                   hashlib.sha256(",".join(map(str, sorted(ends.get(p, ())))).encode()).hexdigest()) for p, m in members.items())


def edge_conversations():
    rng = random.Random(7)
    say = lambda: rng.choice(("Yes.", "No!", "", " \n", "and then", "é日本?", "Why? ", "a.b", "ok.\x0b"))
    rows = []
    for c in [*range(60), *range(100, 112), 205, 307]:
        for t in range(rng.randrange(0, 9)):
            rows.append((c, t * rng.choice((1, 1, 2)), rng.choice(("user", "assistant", "user", "assistant", "system", "User", "", "tool")), say()))
    rows += [(1000, None, "user", "Hi."), (1000, None, None, None), (1000, 3, "assistant", None), (1000, 3, "assistant", None), (1000, 3, "user", "Tie."), (None, 0, "user", "Lost."), (None, None, None, None),
             (1001, -5, "system", "Be kind."), (1001, 9, "user", "x" * 100_000 + "."), (1001, 10**6, "assistant", "Far.")]
    rows += [(1002, t, ("user", "assistant")[t % 2], f"Line {t}.") for t in range(300)] + [(1003, t, "user", "Again.") for t in range(200)]
    rows += [(1100 + k, t, ("user", "assistant")[t % 2], f"Line {t}.") for k in range(5) for t in range(10 + 20 * k)]
    return rows


def same(got, want):
    assert sorted(got, key=str) == sorted(want, key=str)


def test_search_against_every_edit():
    rng = random.Random(2)
    for _ in range(600):
        turns = [(rng.choice("suuaa?"), rng.choice((0, 0, 0, 1, 2, 3))) for _ in range(rng.randrange(0, 12))]
        want = plain_repair(turns)
        for piece in (48, 3, 1):
            assert structure_repair.cheapest(turns, piece) == want


@pytest.fixture(scope="module")
def convs(spark):
    df = spark.createDataFrame(edge_conversations(), SCHEMA).repartition(3)
    return df.withColumns({c: F.lit("clash") for c in (*cases.CLASH, "stretch", "n_own", "h", "base", "absent_", "fault", "kind", "owner", "depth")})


def test_repair_edge_cases(spark, convs):
    got = structure_repair.audited(structure_repair.damaged(convs)).collect()
    same([tuple(r) for r in got], [(c, *v) for c, v in plain_op11(edge_conversations()).items()])
    empty = spark.createDataFrame([], SCHEMA)
    assert structure_repair.audited(structure_repair.damaged(empty)).count() == 0


def test_repair_gives_whole_conversations(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "user", "Hi."), (1, 2, "tool", "So."), (1, 3, "user", "Bye.")]
    turns = spark.createDataFrame(rows, SCHEMA)
    audit = structure_repair.audits(turns)
    assert [tuple(r) for r in audit.collect()] == [(1, 0, 0, 1, 0, 3, 7, "KDRKI")]
    got = [tuple(r) for r in structure_repair.repaired(turns, audit).orderBy("seq").collect()]
    assert got == [(1, 0, "K", "user", "Hi."), (1, 1, "R", "assistant", "So."), (1, 2, "K", "user", "Bye."), (1, 3, "I", "assistant", "")]


def test_repair_whole_table(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = queries.op11_structure_repair(spark, sf_dir)
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    same([tuple(r) for r in got.collect()], [(c, *v) for c, v in plain_op11(rows).items()])


def trie_rows(convs):
    return [tuple(r) for r in prefix_trie.trie(*prefix_trie.spliced(prefix_trie.numbered(prefix_trie.turn_digests(convs)))).collect()]


def test_trie_edge_cases(spark, convs, monkeypatch):
    same(trie_rows(convs), plain_op12(edge_conversations()))
    assert trie_rows(spark.createDataFrame([], SCHEMA)) == []
    monkeypatch.setattr(prefix_trie, "STRETCH", 4)  # windows and runs in many stretches
    same(trie_rows(convs), plain_op12(edge_conversations()))


def test_trie_of_broken_chains(spark):
    """Each conversation is a prefix of the next, then a spine whose side branches outlive it."""
    rows = [(10_000 + k, t, "user", f"t{t}") for k in range(40) for t in range(k)]
    rows += [(20_000 + k, t, "user", f"t{t}" if t < 100 - k else f"branch {k} {t}") for k in range(40) for t in range(100 + 3 * k)]
    same(trie_rows(spark.createDataFrame(rows, SCHEMA)), plain_op12(rows))


def test_trie_whole_table(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = queries.op12_prefix_trie(spark, sf_dir)
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    same([tuple(r) for r in got.collect()], plain_op12(rows))
