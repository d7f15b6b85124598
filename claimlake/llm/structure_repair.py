"""Conversation structure repair by iterative-deepening A*.

A conversation is whole when its role initials read ``(s?(ua)+)?``.  Edits, in
the order they are tried: D(elete) 3, I(nsert an empty user or assistant turn)
2, K(eep) 0, R(erole) 2; blank and repeated turns must be deleted, a truncated
turn that stays costs 1 more.  Which role an insert or a rerole gives follows
from the turns before it, so the edits' initials are the whole answer.

Two passes.  The first takes 16-byte digests in place of texts, finds faults
and searches: one task holds one byte a turn of one conversation, as its own
result row does.  The second streams the texts past the edits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from claimlake.llm import common

PIECE = 48  # turns searched at once; pieces of a longer conversation are joined by their exit costs
BLANKS = " \t\n\x0b\x0c\r"
BLANK, REPEATED, TRUNCATED, ABSENT = 1, 2, 3, 4
_NEVER = 1 << 60

# Automaton of the role initials: 0 start, 1 after the system turn, 2 after user, 3 after assistant (0 and 3 may end).
_KEEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
_NEXT = (2, 2, 3, 2)
_ROLE = ("user", "user", "assistant", "user")
_PAIRS = ("su", "ua", "au")


class Search:
    """One piece of a conversation: (initial, fault) per turn, and what it costs to go on from each exit state.

    ``low`` is the failed-state table: a state that failed with r left costs more than r, whatever
    the bound or the entry, so it is kept between rounds.  The first estimate of a state is admissible: each
    blank or repeated turn costs 3, each truncated one 1, and each illegal neighbourhood of the others 1
    (a rerole mends at most two for 2, a delete two for 3, an insert one for 2).
    """

    def __init__(self, turns: list[tuple[str, int]], exits: list[int], last: bool):
        self.turns, self.exits, self.last, self.low = turns, exits, last, {}
        self.least_exit = min(exits)
        n = len(turns)
        self.rest, self.following = [0] * (n + 1), [None] * (n + 1)
        for i in range(n - 1, -1, -1):
            initial, fault = turns[i]
            after = self.following[i + 1]
            if fault in (BLANK, REPEATED):
                self.rest[i], self.following[i] = self.rest[i + 1] + 3, after
            else:
                self.rest[i] = self.rest[i + 1] + (fault == TRUNCATED) + (after is not None and initial + after not in _PAIRS)
                self.following[i] = initial

    def estimate(self, i: int, q: int) -> int:
        nxt = self.following[i]
        return max(self.low.get((i, q), 0), self.rest[i] + self.least_exit + (nxt is not None and (q, nxt) not in _KEEP))

    def steps(self, i: int, q: int):
        """(initial, cost, next turn, next state) of the edits at turn i, in ASCII order."""
        n = len(self.turns)
        initial, fault = self.turns[i] if i < n else ("", 0)
        out = []
        if i < n:
            out.append(("D", 3, i + 1, q))
        if i < n or self.last:
            out.append(("I", 2, i, _NEXT[q]))
        if i < n and fault not in (BLANK, REPEATED):
            more = int(fault == TRUNCATED)
            if (q, initial) in _KEEP:
                out.append(("K", more, i + 1, _KEEP[q, initial]))
            out.append(("R", 2 + more, i + 1, _NEXT[q]))
        return out

    def descend(self, i: int, q: int, left: int) -> tuple[str, int] | None:
        """Edits from (i, q) and the exit state, for at most ``left``; the first such path in ASCII order."""
        if i == len(self.turns) and self.exits[q] <= left:
            return "", q
        lowest = self.exits[q] if i == len(self.turns) else _NEVER
        for name, cost, j, p in self.steps(i, q):
            need = cost + self.estimate(j, p)
            if need <= left:
                found = self.descend(j, p, left - cost)
                if found is not None:
                    return name + found[0], found[1]
                need = cost + self.estimate(j, p)
            lowest = min(lowest, need)
        self.low[i, q] = max(self.low.get((i, q), 0), lowest, left + 1)
        return None

    def best(self, q: int) -> tuple[int, str, int]:
        """Least cost from entry state q to the end of the conversation, with the edits and the exit state of this piece."""
        bound = self.estimate(0, q)
        while True:
            found = self.descend(0, q, bound)
            if found is not None:
                return bound, *found
            bound = self.estimate(0, q)


def cheapest(turns: list[tuple[str, int]], piece: int = PIECE) -> tuple[int, str]:
    """(cost, edits) of one conversation given as (role initial, fault) per turn; work grows in proportion to it."""
    cuts = list(range(0, len(turns), piece)) or [0]
    exits, searches = [0, _NEVER, _NEVER, 0], []
    for a in reversed(cuts):
        s = Search(turns[a:a + piece], exits, a == cuts[-1])
        searches.append(s)
        if a:
            exits = [s.best(q)[0] for q in range(4)]
    q, total, edits = 0, None, []
    for s in reversed(searches):
        cost, path, q = s.best(q)
        total = cost if total is None else total
        edits.append(path)
    return total, "".join(edits)


def _spelled(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(" "))


def damaged(convs: DataFrame) -> DataFrame:
    """Planted faults by crc32(``conv_id:turn``) % 20: 0 drops the turn (it stays as a row marked ``absent``, so that
    its conversation is known), 1 empties its text, 2 removes its ``.!?``, 3 repeats it, 4 makes it a user turn.

    Nulls, in the key too, are one blank.  Returns conv_id, turn, role, text, absent, whatever the columns given.
    """
    kind = F.crc32(F.concat_ws(":", _spelled("conv_id"), _spelled("turn")).cast("binary")) % 20
    rows = convs.select("conv_id", "turn", _spelled("role").alias("role"), _spelled("text").alias("text"), kind.alias("__kind"))
    text = F.when(F.col("__kind") == 1, "").when(F.col("__kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.when(F.col("__kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.select("conv_id", "turn", F.when(F.col("__kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
                       (F.col("__kind") == 0).alias("absent"), F.explode(copies).alias("__copy")).drop("__copy")


def _digest() -> Column:
    return F.unhex(F.md5(F.concat(F.char_length("role").cast("string"), F.lit(":"), "role", "text").cast("binary")))


_AUDIT = "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string"


def _audit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in _AUDIT.split(", ")]
    known: dict = {}

    def row(conv, codes, first, last, turns):
        key = bytes(codes)
        if key not in known:
            if len(known) > 50_000:
                known.clear()
            seq = [("sua?"[c >> 3], c & 7) for c in codes]
            cost, edits = cheapest(seq)
            known[key] = (*(sum(f == k for _, f in seq) for k in (BLANK, REPEATED, TRUNCATED)), sum(x[0] + y[0] not in _PAIRS for x, y in zip(seq, seq[1:])), cost, edits)
        return conv, 0 if first is None else last - first + 1 - turns, *known[key]

    def columns(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, pa.string() if n == "audit" else pa.int64()) for n, c in zip(names, zip(*rows))], names)

    begun, conv, out = False, None, []
    codes, first, last, turns = bytearray(), None, None, 0
    for b in batches:
        for c, turn, initial, fault in zip(*(b.column(n).to_pylist() for n in ("conv_id", "turn", "initial", "fault"))):
            if not begun or c != conv:
                if begun:
                    out.append(row(conv, codes, first, last, turns))
                begun, conv, codes, first, last, turns = True, c, bytearray(), None, None, 0
            if fault == ABSENT:
                continue
            codes.append(("sua".index(initial) if initial in ("s", "u", "a") else 3) << 3 | fault)
            if turn is not None:
                if turn != last:
                    turns += 1
                first, last = turn if first is None else first, turn
        if len(out) >= 4096:
            yield columns(out)
            out = []
    if begun:
        out.append(row(conv, codes, first, last, turns))
    if out:
        yield columns(out)


def _order() -> list[Column]:
    return [F.asc_nulls_first("turn"), F.asc("role"), F.asc("__digest")]


def audits(turns: DataFrame) -> DataFrame:
    """Faults and cheapest edits per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit.

    ``turns`` has conv_id, turn, role, text and may have ``absent`` (a row that only names its conversation).
    Turns follow ``turn``, nulls first; equal ones follow role and a digest of the text.  A null role or text is
    one blank.  Null conv_ids are one conversation.  An empty table gives an empty result; other columns are ignored.
    Texts of any length move as digests; a conversation costs its task one byte a turn.
    """
    absent = F.coalesce("absent", F.lit(False)) if "absent" in turns.columns else F.lit(False)
    bare = F.rtrim("text", F.lit(BLANKS))
    fault = (F.when(F.col("absent"), ABSENT).when(bare == "", BLANK).when(~F.substring(bare, -1, 1).isin(".", "!", "?"), TRUNCATED).otherwise(0))
    rows = turns.select(F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), _spelled("role").alias("role"), _spelled("text").alias("text"), absent.alias("absent"))
    light = rows.select("conv_id", "turn", "role", F.when(~F.col("absent"), _digest()).alias("__digest"), fault.alias("fault"))
    seen = F.row_number().over(Window.partitionBy("conv_id", "__digest").orderBy(F.asc_nulls_first("turn")))
    light = light.withColumn("__seen", seen).withColumn("fault", F.when(F.col("fault").isin(0, TRUNCATED) & (F.col("__seen") > 1), REPEATED).otherwise(F.col("fault")))
    light = light.select("conv_id", "turn", "role", "__digest", "__seen", F.substring("role", 1, 1).alias("initial"), "fault")
    dealt = light.repartition(common.shuffle_width(turns.sparkSession), "conv_id").sortWithinPartitions("conv_id", *_order(), "__seen")
    return dealt.select("conv_id", "turn", "initial", "fault").mapInArrow(_audit, _AUDIT)


_TURNS = "conv_id bigint, seq bigint, edit string, role string, text string"


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names, kinds = ["conv_id", "seq", "edit", "role", "text"], [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
    conv, edits, at, q, seq, out = None, "", 0, 0, 0, []

    def put(edit, role, text):
        nonlocal seq
        out.append((conv, seq, edit, role, text))
        seq += 1

    def inserts():
        nonlocal at, q
        while at < len(edits) and edits[at] == "I":
            put("I", _ROLE[q], "")
            at, q = at + 1, _NEXT[q]

    for b in batches:
        for c, audit, role, text in zip(*(b.column(n).to_pylist() for n in ("conv_id", "audit", "role", "text"))):
            if audit is not None:  # the edits come before the turns of their conversation
                inserts()
                conv, edits, at, q, seq = c, audit, 0, 0, 0
                continue
            inserts()
            edit, at = edits[at], at + 1
            if edit == "K":
                put("K", role, text)
                q = _KEEP[q, role[:1]]
            elif edit == "R":
                put("R", _ROLE[q], text)
                q = _NEXT[q]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out), kinds)], names)
            out = []
    inserts()
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out), kinds)], names)


def repaired(turns: DataFrame, audit: DataFrame) -> DataFrame:
    """The repaired turns: conv_id, seq (from 0), edit (K, R or I), role, text; ``audit`` is what ``audits`` gave for ``turns``.

    Each conversation's rows are in one partition, in order; texts pass one Arrow batch at a time.  A conversation
    that ends empty has no row.
    """
    here = turns.filter(~F.coalesce("absent", F.lit(False))) if "absent" in turns.columns else turns
    rows = here.select(F.col("conv_id").cast("bigint").alias("conv_id"), F.lit(1).alias("__kind"), F.col("turn").cast("bigint").alias("turn"), _spelled("role").alias("role"),
                       _spelled("text").alias("text"), F.lit(None).cast("string").alias("audit")).withColumn("__digest", _digest())
    heads = audit.select("conv_id", F.lit(0).alias("__kind"), F.lit(None).cast("bigint").alias("turn"), F.lit("").alias("role"), F.lit("").alias("text"), "audit",
                         F.lit(None).cast("binary").alias("__digest"))
    dealt = rows.unionByName(heads).repartition(common.shuffle_width(turns.sparkSession), "conv_id").sortWithinPartitions("conv_id", "__kind", *_order())
    return dealt.select("conv_id", "audit", "role", "text").mapInArrow(_apply, _TURNS)


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    begun, conv, h, out = False, None, None, []
    for b in batches:
        for c, role, text in zip(*(b.column(n).to_pylist() for n in ("conv_id", "role", "text"))):
            if not begun or c != conv:
                if begun:
                    out.append((conv, h.hexdigest()))
                begun, conv, h = True, c, hashlib.sha256()
            else:
                h.update(b"\n")
            h.update(f"{role}:{text}".encode())
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.int64()), pa.array([r[1] for r in out])], ["conv_id", "sha256"])
            out = []
    if begun:
        yield pa.RecordBatch.from_arrays([pa.array([conv], pa.int64()), pa.array([h.hexdigest()])], ["conv_id", "sha256"])


def digests(rows: DataFrame) -> DataFrame:
    """(conv_id, sha256) of ``role:text`` lines; ``rows`` as ``repaired`` gives them (same partitions, same order)."""
    return rows.mapInArrow(_hashes, "conv_id bigint, sha256 string")


def audited(turns: DataFrame) -> DataFrame:
    """``audits`` with ``repaired_sha256``, the digest of the repaired turns (of the empty text if none is left)."""
    audit = common.stored(audits(turns), "audits")
    done = digests(repaired(turns, audit)).withColumnRenamed("conv_id", "__conv")
    empty = F.lit(hashlib.sha256(b"").hexdigest())
    return (audit.join(done, F.col("conv_id").eqNullSafe(F.col("__conv")), "left")
            .select(*audit.columns, F.coalesce("sha256", empty).alias("repaired_sha256")))
