"""Severity grades by cumulative-link ordinal regression on words.

Grade 0 is a text marked not toxic; texts marked toxic are split at the median
of their density of marker words (words much more frequent in toxic texts of
the sample) into grade 1 and grade 2, as the labels know one grade only.
P(grade >= k) = sigmoid(w.x - theta_k): one weight vector for all thresholds,
which are kept in order.  x holds log(1 + count) of hashed words.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlake.llm import common, labelled

MAX_ROWS = 10_000   # labelled rows that are fitted on, at most
BITS = 22           # hashed words and word beginnings
BEGINNINGS = (5, 6, 7, 8, 9, 10)  # so that compounds and endings of a word count too
REMEMBERED = 300_000  # distinct words a task remembers the features of
MAX_FEATURES = 1_000
GRADES = 3
_WORD = re.compile(r"[^\W_]+")


def _hash(s: str) -> int:
    return xxhash.xxh32_intdigest(s.encode("utf-8", "replace")) >> (32 - BITS)


def hashed(word: str) -> list[int]:
    """Features of a word: itself, and its beginnings of some lengths."""
    return [_hash(word), *(_hash("^" + word[:k]) for k in BEGINNINGS if len(word) >= k)]


def words(text: str) -> Counter:
    """Words of a whole text, lower-cased, without marks."""
    return Counter(_WORD.findall(text.lower()))


def features(text: str) -> Counter:
    out: Counter = Counter()
    for w, n in words(text).items():
        for f in hashed(w):
            out[f] += n
    return out


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts of either label that hold a feature, summed up within a batch."""
    for b in batches:
        df: tuple[Counter, Counter] = (Counter(), Counter())
        for label, t in zip(b.column("label").to_pylist(), b.column("text").to_pylist()):
            df[int(label > 0)].update(features(t).keys())
        ids = list(df[0].keys() | df[1].keys())
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *(pa.array([d[i] for i in ids], pa.int64()) for d in df)], ["feature", "df0", "df1"])


def _restricted(chosen: list[int]):
    """Counts of the chosen features of each text, and of all its features."""
    at = {f: i for i, f in enumerate(chosen)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [features(t) for t in b.column("text").to_pylist()]
            held = [sorted((at[f], n) for f, n in c.items() if f in at) for c in rows]
            yield pa.RecordBatch.from_arrays([
                b.column("doc_id"), b.column("label"), pa.array([[i for i, _ in h] for h in held], pa.list_(pa.int32())),
                pa.array([[n for _, n in h] for h in held], pa.list_(pa.int32())), pa.array([sum(c.values()) for c in rows], pa.int64())],
                ["doc_id", "label", "ids", "counts", "total"])
    return run


def cumulative(w: np.ndarray, theta: np.ndarray, x: np.ndarray) -> np.ndarray:
    """P(grade >= k) for k = 1.. per row of x."""
    return 1 / (1 + np.exp(-np.clip((x @ w)[:, None] - theta[None, :], -30, 30)))


def fit_ordinal(x: np.ndarray, y: np.ndarray, grades: int = GRADES, ridge: float = 2e-4, steps: int = 400, rate: float = 0.1):
    """Weights and ordered thresholds: thresholds are the first one plus positive gaps; Adam on the log-likelihood."""
    n, d = x.shape
    w, base, gaps = np.zeros(d), np.zeros(1), np.zeros(grades - 2)
    state = [[np.zeros_like(p), np.zeros_like(p)] for p in (w, base, gaps)]
    for t in range(1, steps + 1):
        theta = np.concatenate([base, base + np.cumsum(np.exp(gaps))])
        c = cumulative(w, theta, x)
        full = np.concatenate([np.ones((n, 1)), c, np.zeros((n, 1))], axis=1)
        p = np.maximum(full[np.arange(n), y] - full[np.arange(n), y + 1], 1e-9)
        dc = np.concatenate([np.zeros((n, 1)), c * (1 - c), np.zeros((n, 1))], axis=1)
        up, down = dc[np.arange(n), y] / p, dc[np.arange(n), y + 1] / p
        g_w = x.T @ ((up - down) / n) - ridge * w
        g_theta = np.array([(-(up * (y == k)) + down * (y + 1 == k)).sum() / n for k in range(1, grades)])
        g_base = np.array([g_theta.sum()])
        g_gaps = np.array([g_theta[i + 1:].sum() * np.exp(gaps[i]) for i in range(grades - 2)])
        for q, g, s in zip((w, base, gaps), (g_w, g_base, g_gaps), state):
            s[0] = 0.9 * s[0] + 0.1 * g
            s[1] = 0.999 * s[1] + 0.001 * g * g
            q += rate * (s[0] / (1 - 0.9 ** t)) / (np.sqrt(s[1] / (1 - 0.999 ** t)) + 1e-8)
    return w, np.concatenate([base, base + np.cumsum(np.exp(gaps))])


def fit(docs: DataFrame, labels: DataFrame, rows: int = MAX_ROWS) -> dict:
    """The model from at most ``rows`` labelled rows. Without both labels among them it finds nothing toxic.

    The features that tell the labels apart best are chosen by counts over the
    sample; the driver gets those, and their counts in each sampled row.
    """
    none = {"features": np.zeros(0, np.int64), "w": np.zeros(0), "theta": np.array([5.0, 6.0])}
    drawn = common.stored(labelled.sample(docs, labels, "toxic", rows), "toxic-sample")
    n = {int(r["toxic"]): r["count"] for r in drawn.groupBy((F.col("label") > 0).alias("toxic")).count().collect()}
    if len(n) < 2:
        return none
    df = drawn.mapInArrow(_frequencies, "feature bigint, df0 bigint, df1 bigint").groupBy("feature").agg(F.sum("df0").alias("df0"), F.sum("df1").alias("df1"))
    ratio = ((F.col("df1") + 0.5) / (n[1] + 1)) / ((F.col("df0") + 0.5) / (n[0] + 1))
    z = F.log(ratio) / F.sqrt(1 / (F.col("df1") + 0.5) + 1 / (F.col("df0") + 0.5))
    best = (df.filter(F.col("df0") + F.col("df1") >= 5).select("feature", ratio.alias("ratio"), z.alias("z"))
            .orderBy(F.abs("z").desc(), "feature").limit(MAX_FEATURES).collect())
    if not best:
        return none
    best.sort(key=lambda r: r["feature"])
    chosen = [r["feature"] for r in best]
    marker = np.array([r["z"] > 4 and r["ratio"] > 3 for r in best])
    got = drawn.mapInArrow(_restricted(chosen), "doc_id bigint, label int, ids array<int>, counts array<int>, total bigint").collect()
    got.sort(key=lambda r: r["doc_id"])  # the order of arrival must not matter
    y = np.array([int(r["label"] > 0) for r in got])
    x, density = np.zeros((len(y), len(chosen))), np.zeros(len(y))
    for i, r in enumerate(got):
        ids, counts = np.array(r["ids"], dtype=int), np.array(r["counts"], dtype=float)
        x[i, ids] = np.log1p(counts)
        density[i] = counts[marker[ids]].sum() / max(r["total"], 1)
    middle = np.median(density[y == 1])
    w, theta = fit_ordinal(x, np.where(y == 0, 0, np.where(density > middle, 2, 1)))
    return {"features": np.array(chosen, dtype=np.int64), "w": w, "theta": theta}


def _scorer(model: dict):
    weight = dict(zip(model["features"].tolist(), model["w"].tolist()))
    theta = model["theta"]
    known: dict[str, tuple] = {}

    def linear(text: str) -> float:
        counts: Counter = Counter()
        for w, n in words(text).items():
            f = known.get(w)
            if f is None:
                if len(known) >= REMEMBERED:
                    known.clear()
                f = known[w] = tuple(i for i in hashed(w) if i in weight)
            for i in f:
                counts[i] += n
        return sum(weight[i] * np.log1p(n) for i, n in sorted(counts.items()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = np.array([linear(t or "") for t in b.column("text").to_pylist()], dtype=float)
            c = 1 / (1 + np.exp(-np.clip(s[:, None] - theta[None, :], -30, 30)))
            p = -np.diff(np.concatenate([np.ones((len(s), 1)), c, np.zeros((len(s), 1))], axis=1), axis=1)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(c.sum(1), pa.float64()), pa.array(p.argmax(1).astype("int32")), pa.array(c[:, 0], pa.float64())],
                                             ["doc_id", "severity", "grade", "p_toxic"])
    return run


def grade(docs: DataFrame, model: dict) -> DataFrame:
    """(doc_id, severity, grade, p_toxic) per row of ``docs``: the expected grade, the likeliest one, P(grade >= 1).

    Null and empty texts have no words and get the grade of none; repeated rows
    get equal results; other columns are not used.
    """
    return docs.select("doc_id", "text").mapInArrow(_scorer(model), "doc_id bigint, severity double, grade int, p_toxic double")


def graded(docs: DataFrame, labels: DataFrame, rows: int = MAX_ROWS) -> DataFrame:
    return grade(docs, fit(docs, labels, rows))
