"""Trie of conversation prefixes, its subtree totals by parallel tree contraction.

Turns move as digests and lengths, never as texts.  A prefix is named by sums of digests salted with the
position, which windows over bounded stretches of a conversation add up.  The
totals come from rounds over a written table: rake (leaves give their totals to their parents and
go), compress (runs of nodes with one child become their last node, with
the totals between kept as an offset), until the root is a leaf; then the
rounds are undone last to first, which gives every compressed node its total
from its run's last node.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from claimlake.llm import common

STRETCH = 4096  # turns of one conversation, or nodes of one chain, in one window
SPLICED = 6  # a rebuilt conversation borrows up to SPLICED - 1 turns
FAMILY = 100
_SUMS = ("s1", "s2", "s3", "s4")
_NODE = ("depth", *_SUMS)


def turn_digests(convs: DataFrame) -> DataFrame:
    """conv_id, turn, key (128 bits of role and text), size (code points of the text).

    Null roles and texts are empty; rows without a conv_id belong to no conversation.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    key = F.unhex(F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text).cast("binary")))
    return convs.filter("conv_id is not null").select(F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
                                                      key.alias("key"), F.char_length(text).cast("bigint").alias("size"))


def _offsets(df: DataFrame, sums: list[Column]) -> DataFrame:
    """Totals of the stretches of the same conversation before each: one row per stretch, summed up by a window."""
    w = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("stretch")).rowsBetween(Window.unboundedPreceding, -1)
    totals = df.groupBy("conv_id", "stretch").agg(*sums)
    return totals.select("conv_id", "stretch", *[F.coalesce(F.sum(c).over(w), F.lit(0)).alias(f"before_{c}") for c in totals.columns[2:]])


def numbered(turns: DataFrame) -> DataFrame:
    """Adds ``pos`` (from 1): the place of a turn in its conversation, by turn (nulls first), then digest."""
    df = turns.withColumn("stretch", F.floor(F.coalesce(F.col("turn"), F.lit(-(2**62))) / F.lit(STRETCH)))
    w = Window.partitionBy("conv_id", "stretch").orderBy(F.asc_nulls_first("turn"), "key")
    return (df.withColumn("pos", F.row_number().over(w)).join(_offsets(df, [F.count(F.lit(1)).alias("n")]), ["conv_id", "stretch"])
            .withColumn("pos", F.col("pos") + F.col("before_n")).drop("stretch", "before_n"))


def spliced(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations that share openings: c starts with the first h turns of c - c % 100, then goes on with its own after its first h;
    h = crc32(decimal c) % 6.  Of ``numbered`` turns; returns (conv_id, pos, key, size) and (conv_id, n turns), turnless ones too."""
    borrowed = F.crc32(F.col("conv_id").cast("string").cast("binary")) % SPLICED
    own = turns.groupBy("conv_id").agg(F.max("pos").alias("n_own")).withColumn("h", borrowed).withColumn("base", F.col("conv_id") - F.col("conv_id") % FAMILY)
    first = own.select(F.col("conv_id").alias("base"), F.col("n_own").alias("n_base"))
    convs = (own.join(first, "base", "left").withColumn("taken", F.least("h", F.coalesce("n_base", F.lit(0))))
             .withColumn("n", F.col("taken") + F.greatest(F.col("n_own") - F.col("h"), F.lit(0))))
    convs = common.stored(convs.select("conv_id", "base", "h", "taken", "n"), "spliced")
    head = turns.filter((F.col("pos") < SPLICED) & (F.col("conv_id") % FAMILY == 0)).select(F.col("conv_id").alias("base"), "pos", "key", "size")
    heads = convs.filter("taken > 0").join(head, "base").filter("pos <= taken").select("conv_id", "pos", "key", "size")
    tails = (turns.withColumn("__h", borrowed).filter("pos > __h").join(convs.select("conv_id", "taken"), "conv_id")
             .select("conv_id", (F.col("pos") - F.col("__h") + F.col("taken")).alias("pos"), "key", "size"))
    return heads.unionByName(tails), convs.select("conv_id", "n")


def prefixes(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, s1..s4, own1..own4, size): each turn with the name of the prefix that it ends and its own part of that name."""
    a, b = F.xxhash64("pos", "key"), F.xxhash64("key", "pos", F.lit("second"))
    low = F.lit(0xFFFFFFFF).cast("bigint")
    parts = [a.bitwiseAND(low), F.shiftrightunsigned(a, 32), b.bitwiseAND(low), F.shiftrightunsigned(b, 32)]
    own = [f"own{i}" for i in range(1, 5)]
    df = turns.withColumns(dict(zip(own, parts))).withColumn("stretch", F.floor(F.col("pos") / F.lit(STRETCH)))
    w = Window.partitionBy("conv_id", "stretch").orderBy("pos")
    sums = df.select("conv_id", F.col("pos").alias("depth"), "size", "stretch", *own, *[F.sum(o).over(w).alias(s) for o, s in zip(own, _SUMS)])
    before = _offsets(df, [F.sum(o).alias(s) for o, s in zip(own, _SUMS)])
    return (sums.join(before, ["conv_id", "stretch"])
            .select("conv_id", F.col("depth").cast("bigint").alias("depth"), *[(F.col(s) + F.col(f"before_{s}")).alias(s) for s in _SUMS], *own, "size"))


def _digest_members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names, at, h, out = list(_NODE), None, None, []

    def columns():
        cols = list(zip(*out))
        return pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in cols[:-1]], pa.array(cols[-1])], [*names, "ends_sha256"])
    for b in batches:
        for conv, *node in zip(*(b.column(c).to_pylist() for c in ("conv_id", *names))):
            if node != at:
                if at is not None:
                    out.append((*at, h.hexdigest()))
                at, h = node, hashlib.sha256(str(conv).encode())
            else:
                h.update(f",{conv}".encode())
        if out:
            yield columns()
            out = []
    if at is not None:
        out.append((*at, h.hexdigest()))
        yield columns()


def trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """One row per distinct prefix of the conversations, the empty one (root) included.

    ``turns``: conv_id, pos (1, 2, ... in each conversation), key, size; ``convs``: conv_id, n turns.  Returns conv_id (smallest
    member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.  No conversations: no
    rows.  Only the digest of the members that end at a node is taken in one task, streamed in order, as a SHA-256 must be.
    """
    spark = turns.sparkSession
    rows = prefixes(turns).join(convs, "conv_id")
    longest = F.max(F.struct(F.col("n"), (-F.col("conv_id")).alias("minus"))).alias("longest")
    inner = rows.groupBy(*_NODE).agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), longest, F.max("size").alias("size"),
                                     *[F.max(F.col(s) - F.col(f"own{i}")).alias(f"up{i}") for i, s in enumerate(_SUMS, 1)])
    zero = F.lit(0).cast("bigint")
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), longest).filter("n_convs > 0")
    root = root.select(*[zero.alias(c) for c in _NODE], "conv_id", "n_convs", "longest", zero.alias("size"), *[zero.alias(f"up{i}") for i in range(1, 5)])
    nodes = common.stored(inner.unionByName(root).withColumn("owner", -F.col("longest.minus")).drop("longest"), "trie-nodes")
    up = nodes.select((F.col("depth") + 1).alias("depth"), *[F.col(s).alias(f"up{i}") for i, s in enumerate(_SUMS, 1)], F.col("conv_id").alias("parent_conv_id"))
    nodes = common.stored(nodes.join(up, ["depth", *[f"up{i}" for i in range(1, 5)]], "left").select("conv_id", *_NODE, "parent_conv_id", "n_convs", "size", "owner"), "trie")

    totals = contract(nodes.select("conv_id", "depth", F.col("parent_conv_id").alias("up_conv"), (F.col("depth") - 1).alias("up_depth"), "owner",
                                   ((F.col("n_convs") - 1) * F.col("size")).alias("saved")))
    children = nodes.filter("depth > 0").groupBy(F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth")).agg(F.count(F.lit(1)).alias("n_children"))
    ends = rows.filter("depth = n").select("conv_id", *_NODE).unionByName(convs.filter("n = 0").select("conv_id", *[zero.alias(c) for c in _NODE]))
    ends = ends.repartition(common.shuffle_width(spark), *_NODE).sortWithinPartitions(*_NODE, "conv_id").mapInArrow(_digest_members, ", ".join(f"{c} bigint" for c in _NODE) + ", ends_sha256 string")
    return (nodes.join(totals, ["conv_id", "depth"]).join(children, ["conv_id", "depth"], "left").join(ends, list(_NODE), "left")
            .select("conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", zero).alias("n_children"), F.col("leaves").alias("n_leaves"),
                    F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256")))


def _coin(owner: Column, turn: int) -> Column:
    return F.xxhash64(owner, F.lit(turn)).bitwiseAND(F.lit(1).cast("bigint")) == 1


def _round(live: DataFrame, gone: DataFrame, number: int) -> DataFrame:
    """One round over the nodes still there, as a table of rows by ``kind``: ``done`` (raked leaves, with their
    totals), ``live``, and ``run`` (compressed nodes: their run's last node and what lies between).

    A run is looked for along one owner's path (the longest member of a
    prefix, so a chain of the first tree is one path) in stretches that widen with each round; a chain
    that raking made of several owners' paths is put together by coins: one in four neighbours takes the other's owner.
    """
    pick = ["up_conv", "up_depth"]
    raked = gone.select(*pick, F.lit(0).alias("one"), (F.col("leaves") + F.col("edge_leaves")).alias("l"), (F.col("saved") + F.col("edge_saved")).alias("s"), F.lit(None).cast("bigint").alias("below"))
    still = live.select(*pick, F.lit(1).alias("one"), F.lit(0).cast("bigint").alias("l"), F.lit(0).cast("bigint").alias("s"), F.col("owner").alias("below"))
    kids = (raked.unionByName(still).filter("up_conv is not null").groupBy(*pick)
            .agg(F.sum("one").alias("kids"), F.sum("l").alias("l"), F.sum("s").alias("s"), F.max("below").alias("below"))
            .withColumnsRenamed({"up_conv": "conv_id", "up_depth": "depth"}))
    now = live.join(kids, ["conv_id", "depth"], "left").withColumn("leaves", F.col("leaves") + F.coalesce("l", F.lit(0))).withColumn("saved", F.col("saved") + F.coalesce("s", F.lit(0)))
    if number == 1:
        now = now.withColumn("leaves", F.when(F.col("kids").isNull(), F.lit(1)).otherwise(F.col("leaves")))
    now = now.withColumn("kids", F.coalesce("kids", F.lit(0)))
    base = ["conv_id", "depth", "up_conv", "up_depth", "owner", "leaves", "saved", "edge_leaves", "edge_saved"]
    nothing = [F.lit(None).cast("bigint").alias(c) for c in ("to_conv", "to_depth")]

    part = Window.partitionBy("owner", F.floor(F.col("depth") / F.lit(STRETCH**min(number, 4)))).orderBy("depth")
    lone = F.col("kids") == 1
    # nodes without a single child end runs: a window over all of them would be no dearer, but only chains need it
    chain = now.filter(lone).withColumn("__cut", F.when((F.lag("conv_id").over(part) == F.col("up_conv")) & (F.lag("depth").over(part) == F.col("up_depth")), 0).otherwise(1))
    chain = chain.withColumn("run", F.sum("__cut").over(part)).withColumn("stretch", F.floor(F.col("depth") / F.lit(STRETCH**min(number, 4))))
    down = Window.partitionBy("owner", "stretch", "run").orderBy(F.desc("depth"))
    last = {c: F.first(c).over(down) for c in ("conv_id", "depth")}
    # what lies between a node and its run's last one: its own total and the edge below it
    chain = chain.withColumns({"to_conv": last["conv_id"], "to_depth": last["depth"], "__below_l": F.lag("edge_leaves").over(down), "__below_s": F.lag("edge_saved").over(down)})
    between = {c: F.when(F.col("depth") == F.col("to_depth"), F.lit(0)).otherwise(F.col(c) + F.col(b)) for c, b in (("leaves", "__below_l"), ("saved", "__below_s"))}
    chain = chain.withColumns({"__l": between["leaves"], "__s": between["saved"]}).withColumns({"off_l": F.sum("__l").over(down), "off_s": F.sum("__s").over(down)})
    whole = Window.partitionBy("owner", "stretch", "run").orderBy("depth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    top = {c: F.first(c).over(whole) for c in ("up_conv", "up_depth", "edge_leaves", "edge_saved")}
    chain = chain.withColumns({"top_conv": top["up_conv"], "top_depth": top["up_depth"], "top_l": top["edge_leaves"] + F.sum("__l").over(whole), "top_s": top["edge_saved"] + F.sum("__s").over(whole)})

    hooks = (F.col("below") != F.col("owner")) & _coin(F.col("owner"), number) & ~_coin(F.col("below"), number)
    stays = (chain.filter((F.col("conv_id") == F.col("to_conv")) & (F.col("depth") == F.col("to_depth")))
             .select(F.lit("live").alias("kind"), "conv_id", "depth", F.col("top_conv").alias("up_conv"), F.col("top_depth").alias("up_depth"),
                     F.when(hooks, F.col("below")).otherwise(F.col("owner")).alias("owner"), "leaves", "saved", F.col("top_l").alias("edge_leaves"), F.col("top_s").alias("edge_saved"), *nothing))
    runs = (chain.filter((F.col("conv_id") != F.col("to_conv")) | (F.col("depth") != F.col("to_depth")))
            .select(F.lit("run").alias("kind"), "conv_id", "depth", "up_conv", "up_depth", "owner", F.col("off_l").alias("leaves"), F.col("off_s").alias("saved"), "edge_leaves", "edge_saved", "to_conv", "to_depth"))
    rest = now.filter(~lone).select(F.when(F.col("kids") == 0, "done").otherwise("live").alias("kind"), *base, *nothing)
    return rest.unionByName(stays).unionByName(runs)


def contract(tree: DataFrame) -> DataFrame:
    """Subtree totals (conv_id, depth, leaves, saved) of a tree of nodes (conv_id, depth) with up_conv, up_depth (null at the
    root), owner (labels that make paths) and saved (a node's own)."""
    zero = F.lit(0).cast("bigint")
    live = tree.select("conv_id", "depth", "up_conv", "up_depth", "owner", zero.alias("leaves"), "saved", zero.alias("edge_leaves"), zero.alias("edge_saved"))
    gone, rounds = live.limit(0), []
    while True:
        seen = Observation()
        counts = [F.count(F.when(F.col("kind") == k, 1)).alias(k) for k in ("live", "run")]
        table = common.stored(_round(live, gone, len(rounds) + 1).observe(seen, *counts), "round")
        left = seen.get
        rounds.append((table, left["run"]))
        live, gone = (table.filter(F.col("kind") == k).drop("kind", "to_conv", "to_depth") for k in ("live", "done"))
        if not left["live"]:
            break
    known = None
    for table, runs in reversed(rounds):
        parts = [table.filter("kind = 'done'").select("conv_id", "depth", "leaves", "saved")]
        if runs:
            end = known.select(F.col("conv_id").alias("to_conv"), F.col("depth").alias("to_depth"), F.col("leaves").alias("l"), F.col("saved").alias("s"))
            undone = (table.filter("kind = 'run'").join(end, ["to_conv", "to_depth"])
                      .select("conv_id", "depth", (F.col("leaves") + F.col("l")).alias("leaves"), (F.col("saved") + F.col("s")).alias("saved")))
            parts.append(common.stored(undone, "undone"))
        for p in parts:
            known = p if known is None else known.unionByName(p)
    return known
