"""The fits written once more as plain loops, and near-duplicate vectors against all pairs."""

import math
import random

import numpy as np

import cases
from claimlake.llm import embed_dedup, labelled, quality, queries, toxicity


def sigmoid(v):
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, v))))


def test_ordinal_fit_against_plain_loops():
    """Adam on the log-likelihood of P(grade = y) = s(xw - t_y) - s(xw - t_{y+1}), one row and one weight at a time."""
    rng = random.Random(3)
    x = [[rng.gauss(0, 1) for _ in range(4)] for _ in range(60)]
    y = [min(2, max(0, round(1 + a[0] - 0.5 * a[1] + rng.gauss(0, 0.3)))) for a in x]
    steps, ridge, rate = 60, 2e-4, 0.1
    p = [0.0] * 4 + [0.0, 0.0]  # weights, first threshold, log of the gap
    m, v = [0.0] * 6, [0.0] * 6
    for t in range(1, steps + 1):
        theta = [p[4], p[4] + math.exp(p[5])]
        g = [-ridge * w for w in p[:4]] + [0.0, 0.0]
        for a, grade in zip(x, y):
            z = sum(w * f for w, f in zip(p, a))
            c = [1.0, *(sigmoid(z - th) for th in theta), 0.0]
            d = [0.0, *(s * (1 - s) for s in c[1:3]), 0.0]
            like = max(c[grade] - c[grade + 1], 1e-9)
            for i in range(4):
                g[i] += a[i] * (d[grade] - d[grade + 1]) / like / len(x)
            for k in (1, 2):  # the derivative by each threshold; the second moves with the first and with the gap
                by_theta = (-d[grade] * (grade == k) + d[grade + 1] * (grade + 1 == k)) / like / len(x)
                g[4] += by_theta
                if k == 2:
                    g[5] += by_theta * math.exp(p[5])
        for i in range(6):
            m[i], v[i] = 0.9 * m[i] + 0.1 * g[i], 0.999 * v[i] + 0.001 * g[i] ** 2
            p[i] += rate * (m[i] / (1 - 0.9 ** t)) / (math.sqrt(v[i] / (1 - 0.999 ** t)) + 1e-8)
    w, theta = toxicity.fit_ordinal(np.array(x), np.array(y), grades=3, ridge=ridge, steps=steps, rate=rate)
    assert np.allclose(w, p[:4], atol=1e-9) and np.allclose(theta, [p[4], p[4] + math.exp(p[5])], atol=1e-9)


def test_pair_fit_against_plain_loops():
    """The preference weights are the zero of the regularised logistic gradient; the cut makes the fewest errors."""
    rng = np.random.default_rng(1)
    x = rng.normal(size=(80, quality.N_FEATURES))
    y = (x[:, 0] - x[:, 1] + 0.8 * rng.normal(size=80) > 0).astype(int)
    model = quality.fit_pairs(x, y, pairs=500)
    draw = np.random.default_rng(quality.SEED)
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    a, b = draw.choice(good, 500), draw.choice(bad, 500)
    z = [[max(-8.0, min(8.0, (v - mu) / sd)) for v, mu, sd in zip(row, model["mean"], model["std"])] for row in x]
    for f in range(quality.N_FEATURES):
        slope = 0.0
        for i, j in zip(a, b):
            margin = sum((z[i][k] - z[j][k]) * model["w"][k] for k in range(quality.N_FEATURES))
            slope += (z[i][f] - z[j][f]) * (1 - sigmoid(margin)) / 500
        assert abs(slope - quality.RIDGE * model["w"][f]) < 1e-6
    s = [sum(v * w for v, w in zip(row, model["w"])) for row in z]
    errors = lambda cut: sum((v >= cut) != label for v, label in zip(s, y))
    assert errors(model["cut"]) == min(errors(c) for c in [*s, max(s) + 1])
    scores = quality.score_of(model, x)
    assert all((score >= quality.CUT) == (v >= model["cut"]) for score, v in zip(scores, s))


def test_quality_query_against_one_document_at_a_time(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.fit(docs, labels)
    want = {r.doc_id: (labelled.is_held_out(r.doc_id), float(quality.score_of(model, quality.features(r.text or "")[None, :])[0])) for r in docs.collect()}
    got = {r.doc_id: r for r in queries.op7_quality(spark, sf_dir).collect()}
    assert got.keys() == want.keys()
    for i, (held, score) in want.items():
        assert got[i].held_out == held and abs(got[i].score - score) < 1e-9 and got[i].predicted == int(got[i].score >= quality.CUT)


def test_near_duplicate_vectors_against_all_pairs(spark, tmp_path):
    """Planted links of many strengths and chains of them in a table of ten thousand: links, components and survivors."""
    rng = np.random.default_rng(9)
    base = rng.normal(size=(8000, 32))
    base /= np.linalg.norm(base, axis=1, keepdims=True)

    def near(v, c):
        t = rng.normal(size=v.shape)
        t -= (t * v).sum(-1, keepdims=True) * v
        return c * v + math.sqrt(1 - c * c) * t / np.linalg.norm(t, axis=-1, keepdims=True)
    chain = [base[:100]]
    for _ in range(4):
        chain.append(near(chain[-1], 0.95))
    x = np.concatenate([base, *chain[1:], near(base[100:1100], 0.96), near(base[1100:1700], 0.99)])
    ids, label = rng.permutation(len(x)) + 5, [0] * len(x)
    for i in rng.choice(len(x), 500, replace=False):
        label[i] = 1
    df = spark.createDataFrame([(int(i), (3 * v).tolist(), l) for i, v, l in zip(ids, x, label)], "vec_id bigint, embedding array<double>, label int").repartition(4)
    got = {r.vec_id: r for r in queries.op5_embedding_dedup(spark, cases.table_dir(spark, str(tmp_path), embeddings=df)).collect()}
    links, root = np.zeros(len(x), int), list(range(len(x)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i
    label, found, every = np.array(label), 0, 0
    for i in range(len(x)):
        for j in np.flatnonzero((x[i + 1:] @ x[i] >= 0.93) & (label[i + 1:] == label[i])) + i + 1:
            links[i] += 1
            links[j] += 1
            root[max(top(i), top(j), key=lambda k: ids[k])] = min(top(i), top(j), key=lambda k: ids[k])
    assert links.sum() > 3000
    for i, v in enumerate(ids):
        r = got[int(v)]
        assert r.n_links <= links[i] and r.kept == (r.component_id == v)
        found, every = found + r.n_links, every + links[i]
    same = sum(got[int(v)].component_id == ids[top(i)] for i, v in enumerate(ids))
    assert found >= 0.99 * every and same >= 0.995 * len(x)
