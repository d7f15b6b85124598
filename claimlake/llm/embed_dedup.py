"""Near-duplicate vectors by an inverted multi-index.

Unit vectors are cut in halves; each half has a codebook of its own (k-means on
a bounded sample), and the product of the two is a grid of cells.  Every vector
is in the cell of its nearest codewords.  A query walks the cells of its label
in the order of the summed distances (multi-sequence: a heap over two sorted
lists) until the slack at which the target share of pairs at the threshold is
found; the slack comes from sampled vectors turned by exactly the threshold's
angle in random directions, the hardest links there are.  What the cells hold
is verified by the cosine in double precision.

Equal vectors are one class with a count.  A crowded cell is split into blocks
and its queries into as many parts; a task holds one block at a time.  A block
gives back counts and a spanning forest of its links, never all pairs.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlake.llm import common
from claimlake.llm.components import components

THRESHOLD = 0.93
RECALL = 0.995       # of pairs exactly at the threshold
MAX_SAMPLE = 10_000  # vectors that codebooks and slack are fitted on, at most
MAX_WORDS = 64       # codewords of a half, at most
BLOCK = 1_024        # vectors of a cell that a task holds at a time
SEED = 11


def _doubles(col) -> list[np.ndarray | None]:
    """Each row's components in double precision; None for null, empty, zero and non-finite vectors."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    values = col.values.to_numpy(zero_copy_only=False).astype(np.float64)
    offsets, valid = col.offsets.to_numpy(), col.is_valid().to_numpy(zero_copy_only=False)
    out = []
    for i, ok in enumerate(valid):
        v = values[offsets[i]:offsets[i + 1]] if ok else values[:0]
        out.append(v if len(v) and np.isfinite(v).all() and v.any() else None)
    return out


def unit(v: np.ndarray) -> np.ndarray:
    v = v / np.abs(v).max()  # no overflow or underflow of squares
    return v / np.sqrt(v @ v)


def _prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        labels = b.column("label").to_pylist()
        vecs = [v if l is not None else None for v, l in zip(_doubles(b.column("embedding")), labels)]
        raw = [None if v is None else v.tobytes() for v in vecs]
        cls = [None if r is None else int(np.uint64(xxhash.xxh3_64_intdigest(r + str(l).encode())).astype(np.int64)) for r, l in zip(raw, labels)]
        yield pa.RecordBatch.from_arrays([b.column("vec_id").cast(pa.int64()), b.column("label").cast(pa.int64()), pa.array([0 if v is None else len(v) for v in vecs], pa.int32()),
                                          pa.array(cls, pa.int64()), pa.array([None if v is None else unit(v).tobytes() for v in vecs], pa.binary())],
                                         ["vec_id", "label", "dim", "cls", "vec"])


def _distances(x: np.ndarray, words: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] - 2 * x @ words.T + (words * words).sum(1)[None, :], 0)


def codebook(x: np.ndarray, k: int, rng, rounds: int = 10) -> np.ndarray:
    words = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        near = _distances(x, words).argmin(1)
        for i in range(len(words)):
            if (near == i).any():
                words[i] = x[near == i].mean(0)
    return words


def walk(d1: np.ndarray, d2: np.ndarray, slack: float) -> list[tuple[int, int]]:
    """Cells in ascending order of d1[i] + d2[j], until the sum is more than ``slack`` over the least."""
    o1, o2 = d1.argsort(kind="stable"), d2.argsort(kind="stable")
    s1, s2 = d1[o1], d2[o2]
    stop = s1[0] + s2[0] + slack
    heap, out = [(s1[0] + s2[0], 0, 0)], []
    while heap:
        s, i, j = heapq.heappop(heap)
        if s > stop:
            break
        out.append((int(o1[i]), int(o2[j])))
        if j + 1 < len(s2):
            heapq.heappush(heap, (s1[i] + s2[j + 1], i, j + 1))
        if j == 0 and i + 1 < len(s1):
            heapq.heappush(heap, (s1[i + 1] + s2[0], i + 1, 0))
    return out


def fit(x: np.ndarray, total: int, threshold: float = THRESHOLD, recall: float = RECALL, seed: int = SEED) -> dict:
    """Codebooks of the two halves and the slack, from a sample of the ``total`` unit vectors of one length."""
    rng = np.random.default_rng(seed)
    half = x.shape[1] // 2
    k = int(min(MAX_WORDS, max(1, round(total ** 0.25))))
    w1, w2 = codebook(x[:, :half], k, rng), codebook(x[:, half:], k, rng)
    turn = rng.normal(size=x.shape)
    turn -= (turn * x).sum(1)[:, None] * x
    size = np.sqrt((turn * turn).sum(1))[:, None]
    y = threshold * x + np.sqrt(1 - threshold ** 2) * np.where(size > 1e-12, turn / np.maximum(size, 1e-12), 0)
    d1, d2 = _distances(x[:, :half], w1), _distances(x[:, half:], w2)
    i, j = _distances(y[:, :half], w1).argmin(1), _distances(y[:, half:], w2).argmin(1)
    over = d1[np.arange(len(x)), i] + d2[np.arange(len(x)), j] - d1.min(1) - d2.min(1)
    return {"half": half, "w1": w1, "w2": w2, "slack": float(np.quantile(over, recall)) + 1e-9}


def _walked(v: np.ndarray, m: dict) -> list[tuple[int, int]]:
    """The cells that a unit vector visits, its own first."""
    v = v[None, :]
    return walk(_distances(v[:, :m["half"]], m["w1"])[0], _distances(v[:, m["half"]:], m["w2"])[0], m["slack"])


def _cells(models):
    """Index rows (visit 0: the own cell) and query rows (visit 1: each cell of the walk)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, at, cell, visit = b.num_rows, [], [], []
            vecs, dims = b.column("vec").to_pylist(), b.column("dim").to_pylist()
            for r in range(rows):
                m = models.value.get(dims[r])
                if m is None:  # a length that the sample has none of: one cell
                    found = [(0, 0)]
                else:
                    found = _walked(np.frombuffer(vecs[r]), m)
                at += [r] * (len(found) + 1)
                cell += [found[0][0] * 65536 + found[0][1], *(i * 65536 + j for i, j in found)]
                visit += [0, *([1] * len(found))]
            t = pa.Table.from_batches([b]).take(pa.array(at, pa.int64())).append_column("cell", pa.array(cell, pa.int64())).append_column("visit", pa.array(visit, pa.int32()))
            yield from t.combine_chunks().to_batches(max_chunksize=10_000)
    return run


def _verify(threshold: float, models):
    """Rows sorted by key, then visit: a block's vectors, then its queries in parts."""
    def one_sided(key, near, qx, bx):
        """near, but only the links that the block's vector does not find by its own walk."""
        m = models.value.get(key[0])
        out = np.zeros_like(near)
        if m is None:
            return out
        own = {int(i): _walked(qx[i], m)[0] for i in np.flatnonzero(near.any(1))}
        away = np.array([i for i, c in own.items() if c[0] * 65536 + c[1] != key[2]], int)
        if len(away):
            cells = sorted({own[i] for i in away.tolist()})
            at = np.array([cells.index(own[i]) for i in away.tolist()])
            for j in np.flatnonzero(near[away].any(0)):
                reach = set(_walked(bx[j], m))
                out[away, j] = near[away, j] & ~np.array([c in reach for c in cells])[at]
        return out

    def links(key, block, queries):
        if not block or not queries:
            return None
        bid, bm, bx = np.array([r[0] for r in block]), np.array([r[1] for r in block]), np.stack([r[2] for r in block])
        qid, qx = np.array([r[0] for r in queries]), np.stack([r[2] for r in queries])
        near = (qx @ bx.T >= threshold) & (qid[:, None] != bid[None, :])
        q = np.flatnonzero(near.any(1))
        counts = near[q] @ bm
        # a vector whose own walk does not lead back has the link counted here
        back = one_sided(key, near, qx, bx)
        b = np.flatnonzero(back.any(0))
        returned = np.array([r[1] for r in queries]) @ back[:, b]
        # spanning forest of the block's links: a query joins the groups of what it finds
        group = np.arange(len(bid))
        forest = []
        for i in q:
            found = np.flatnonzero(near[i])
            groups, at = np.unique(group[found], return_index=True)
            forest += [(int(qid[i]), int(bid[j])) for j in found[at]]
            if len(groups) > 1:
                group[np.isin(group, groups[1:])] = groups[0]
        return [(int(i), None, int(n)) for i, n in [*zip(qid[q], counts), *zip(bid[b], returned)]] + [(a, c, None) for a, c in forest]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, block, queries = None, [], []

        def flush():
            got = links(key, block, queries)
            if got:
                cols = list(zip(*got))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["cls", "other", "n"])
        for b in batches:
            for *k, visit, cls, m, vec in zip(*(b.column(c).to_pylist() for c in ("dim", "label", "cell", "block", "part", "visit", "cls", "m", "vec"))):
                if k != key:
                    yield from flush()
                    key, block, queries = k, [], []
                if visit:
                    queries.append((cls, m, np.frombuffer(vec)))
                    if len(queries) >= BLOCK:
                        yield from flush()
                        queries = []
                else:
                    block.append((cls, m, np.frombuffer(vec)))
        yield from flush()
    return run


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, sample: int = MAX_SAMPLE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) per row of (vec_id, embedding, label, ...).

    Vectors link with vectors of their label and length only.  Null, empty,
    zero and non-finite vectors, and those without a label, link with nothing
    and are components of their own.  Equal vectors link with each other; rows
    that share a vec_id count as several vectors; a null vec_id never names a
    component that has another; an empty table gives an empty result.
    """
    spark = vectors.sparkSession
    width = common.shuffle_width(spark)
    rows = common.stored(vectors.select("vec_id", "embedding", "label").mapInArrow(_prepare, "vec_id bigint, label bigint, dim int, cls bigint, vec binary"), "vectors")
    good = rows.filter(F.col("cls").isNotNull())
    classes = common.stored(good.groupBy("cls").agg(F.count(F.lit(1)).alias("m"), F.min("vec_id").alias("least"), F.first("label").alias("label"),
                                                    F.first("dim").alias("dim"), F.first("vec").alias("vec")), "classes")
    totals = {r["dim"]: r["count"] for r in classes.groupBy("dim").count().orderBy(F.desc("count"), "dim").limit(100).collect()}  # lengths with a codebook
    drawn = classes.orderBy(F.xxhash64("cls"), "cls").limit(sample).select("dim", "vec").collect()
    models = {}
    for dim, total in totals.items():
        x = sorted(bytes(r["vec"]) for r in drawn if r["dim"] == dim)
        if x and dim > 1:
            models[dim] = fit(np.array([np.frombuffer(v) for v in x]), total, threshold, recall)
    models = spark.sparkContext.broadcast(models)
    placed = classes.select("cls", "m", "label", "dim", "vec").mapInArrow(_cells(models), "cls bigint, m bigint, label bigint, dim int, vec binary, cell bigint, visit int")
    cell = ["dim", "label", "cell"]
    crowd = placed.filter("visit = 0").groupBy(*cell).agg(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK)).cast("int").alias("blocks"))
    dealt = placed.join(crowd, cell)  # cells without a vector are not visited
    mine = lambda n: F.pmod(F.xxhash64("cls", F.lit(n)), F.col("blocks")).cast("int")
    each = F.sequence(F.lit(0), F.col("blocks") - 1)
    index = dealt.filter("visit = 0").withColumn("block", mine(1)).withColumn("part", F.explode(each))
    queries = dealt.filter("visit = 1").withColumn("part", mine(2)).withColumn("block", F.explode(each))
    key = [*cell, "block", "part"]
    dealt = index.unionByName(queries).repartition(width, *key).sortWithinPartitions(*key, "visit", "cls")
    found = common.stored(dealt.mapInArrow(_verify(threshold, models), "cls bigint, other bigint, n bigint"), "links")
    counts = found.filter(F.col("n").isNotNull()).groupBy("cls").agg(F.sum("n").alias("n"))
    label = components(found.filter(F.col("n").isNull()), "cls", "other")
    named = (classes.select("cls", "m", "least").join(label, F.col("cls") == F.col("node"), "left").join(counts, "cls", "left")
             .select("cls", "least", F.coalesce("component", "cls").alias("c"), (F.col("m") - 1 + F.coalesce("n", F.lit(0))).alias("n_links")))
    ids = named.groupBy("c").agg(F.min("least").alias("component_id"))
    named = common.stored(named.join(ids, "c").select(F.col("cls").alias("__cls"), "n_links", "component_id"), "named")
    out = rows.select("vec_id", "cls").join(named, F.col("cls") == F.col("__cls"), "left")
    component = F.when(F.col("cls").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))
