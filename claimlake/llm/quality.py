"""Quality scores by Bradley-Terry ranking.

Features describe a text's form (shares of kinds of characters, words, repeated
lines); documents marked good are preferred over documents marked bad, and the
weights maximise the likelihood of drawn preference pairs: logistic loss on the
difference of features.  The cut is a quantile of the training scores (the one
with the fewest training errors); scores are put on 0..1 so that the cut falls
on ``CUT``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlake.llm import labelled

MAX_ROWS = 20_000   # labelled rows that are fitted on, at most
PAIRS = 100_000     # preference pairs drawn from them
CUT = 0.3
RIDGE = 1e-2
SEED = 7

_KINDS = [bytes(range(48, 58)), bytes(range(65, 91)), bytes(range(97, 123)), b".", b",", b"!", b"?", b"#$%&*@^~", b"|", b"<>{}[]()=;\\/_+", b"'\"`-:", b"\n", b" \t\r\x0b\f",
          bytes(range(128, 256)), bytes([*range(0, 9), *range(14, 32), 127])]


def _group() -> np.ndarray:
    g = np.zeros((256, len(_KINDS)))
    for i, k in enumerate(_KINDS):
        g[list(k), i] = 1
    return g


_GROUP = _group()
_MARKS = bytes(c for c in range(33, 127) if not chr(c).isalnum())
N_FEATURES = 2 * len(_KINDS) + 10


def features(text: str) -> np.ndarray:
    """Numbers on the form of one whole text; all of them are finite, also for an empty one."""
    b = text.encode("utf-8", "replace")
    n = max(len(b), 1)
    shares = np.bincount(np.frombuffer(b, np.uint8), minlength=256) @ _GROUP / n
    words = b.split()
    w = max(len(words), 1)
    distinct = set(words)
    lines = [x for x in b.split(b"\n") if x.strip()]
    m = max(len(lines), 1)
    ends = sum(not (x[-1:].isalnum() or x[-1] >= 128) for x in distinct) / max(len(distinct), 1)
    caps = sum(len(x) > 1 and x.isupper() for x in distinct) / max(len(distinct), 1)
    bare = sum(not x.strip(_MARKS) for x in distinct) / max(len(distinct), 1)
    more = [np.log1p(len(words)) / 10, len(distinct) / w, min(len(b) / w, 40) / 10, 1 - len(set(lines)) / m, min(w / m, 200) / 100,
            ends, caps, bare, np.log1p(len(lines)) / 5, float(not words)]
    return np.concatenate([shares, np.sqrt(shares), more])


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        x = [features(t).astype("<f8").tobytes() for t in b.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column("label"), pa.array(x, pa.binary())], ["label", "x"])


def fit_pairs(x: np.ndarray, y: np.ndarray, pairs: int = PAIRS, ridge: float = RIDGE, seed: int = SEED) -> dict:
    """Weights from preference pairs (Newton steps), and the cut and slope of the 0..1 scale."""
    mean, std = x.mean(0) if len(x) else np.zeros(N_FEATURES), x.std(0) if len(x) else np.ones(N_FEATURES)
    std = np.where(std > 1e-9, std, 1.0)
    z = np.clip((x - mean) / std, -8, 8)
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    w = np.zeros(N_FEATURES)
    if not len(good) or not len(bad):  # nothing to prefer: every score is the same, on the side of what there is
        return {"mean": mean, "std": std, "w": w, "cut": -1.0 if len(good) or not len(x) else 1.0, "slope": 1.0}
    rng = np.random.default_rng(seed)
    d = z[rng.choice(good, pairs)] - z[rng.choice(bad, pairs)]
    for _ in range(25):
        p = 1 / (1 + np.exp(np.clip(d @ w, -30, 30)))
        grad = d.T @ p / pairs - ridge * w
        hess = (d * (p * (1 - p))[:, None]).T @ d / pairs + ridge * np.eye(N_FEATURES)
        step = np.linalg.solve(hess, grad)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    s = z @ w
    order = np.argsort(s, kind="stable")
    below_bad, below_good = np.cumsum(y[order] == 0), np.cumsum(y[order] == 1)
    errors = np.concatenate([[len(bad)], len(bad) - below_bad + below_good])
    q = int(np.flatnonzero(errors == errors.min())[0])
    v = s[order]
    cut = v[0] - 1 if q == 0 else v[-1] + 1 if q == len(v) else (v[q - 1] + v[q]) / 2
    a, t = 1.0, s - cut
    for _ in range(50):  # the slope that fits the labels best, with the cut fixed at CUT
        p = 1 / (1 + np.exp(-np.clip(a * t + np.log(CUT / (1 - CUT)), -30, 30)))
        g, h = (t * (y - p)).sum(), (t * t * p * (1 - p)).sum() + 1e-6
        a = float(np.clip(a + np.clip(g / h, -0.5, 0.5), 0.05, 20))
    return {"mean": mean, "std": std, "w": w, "cut": float(cut), "slope": a}


def fit(docs: DataFrame, labels: DataFrame, rows: int = MAX_ROWS) -> dict:
    """The model from at most ``rows`` labelled rows; the driver gets their features only."""
    got = labelled.sample(docs, labels, "quality", rows).select("label", "text").mapInArrow(_featured, "label int, x binary").collect()
    got.sort(key=lambda r: (r["label"], bytes(r["x"])))  # the order of arrival must not matter
    x = np.array([np.frombuffer(r["x"], "<f8") for r in got]).reshape(-1, N_FEATURES)
    return fit_pairs(x, np.array([r["label"] for r in got], dtype=int))


def score_of(model: dict, x: np.ndarray) -> np.ndarray:
    z = np.clip((x - model["mean"]) / model["std"], -8, 8) @ model["w"]
    return 1 / (1 + np.exp(-np.clip(model["slope"] * (z - model["cut"]) + np.log(CUT / (1 - CUT)), -30, 30)))


def _scorer(model: dict, text: str, out: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.array([features(t or "") for t in b.column(text).to_pylist()]).reshape(-1, N_FEATURES)
            keep = [i for i, n in enumerate(b.schema.names) if n != out]
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in keep), pa.array(score_of(model, x), pa.float64())],
                                             [*(b.schema.names[i] for i in keep), out])
    return run


def score(docs: DataFrame, model: dict, text: str = "text", out: str = "score") -> DataFrame:
    """All rows and columns with a score of 0 to 1 (a column of that name is replaced).

    Null and empty texts get the score of an empty text; equal texts get equal
    scores; labels, ids, language and source have no part in it.
    """
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != out), f"`{out}` double"])
    return docs.mapInArrow(_scorer(model, text, out), schema)


def scored(docs: DataFrame, labels: DataFrame, rows: int = MAX_ROWS) -> DataFrame:
    return score(docs, fit(docs, labels, rows))


def keep_good(docs: DataFrame, labels: DataFrame, cut: float = CUT, rows: int = MAX_ROWS) -> DataFrame:
    """The rows whose score reaches the cut, with their own columns."""
    return score(docs, fit(docs, labels, rows), out="__score").filter(F.col("__score") >= cut).drop("__score")
