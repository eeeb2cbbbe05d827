"""The two classifiers against plain-Python versions of their fits."""

import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from basketry.llm import common as C
from basketry.llm import quality_qda as qda
from basketry.llm import toxicity_weak as tox
from tests.llm.test_text_operators import labelled


def inverse_and_log_det(a):
    """By elimination with row exchanges."""
    n = len(a)
    m = [list(map(float, row)) + [float(i == k) for i in range(n)] for k, row in enumerate(a)]
    log = 0.0
    for c in range(n):
        p = max(range(c, n), key=lambda r: abs(m[r][c]))
        m[c], m[p] = m[p], m[c]
        log += math.log(abs(m[c][c]))
        m[c] = [v / m[c][c] for v in m[c]]
        for r in range(n):
            if r != c and m[r][c]:
                f = m[r][c]
                m[r] = [v - f * w for v, w in zip(m[r], m[c])]
    return [row[n:] for row in m], log


def plain_qda(rows, x, pooled=0.5, diagonal=0.1):
    """Scores of ``x`` from labelled ``rows (features, label)``: moments, shrinkage, log densities, all by loops."""
    d = len(rows[0][0])
    of = {k: [f for f, y in rows if y == k] for k in (0, 1)}
    mean = {k: [sum(f[i] for f in v) / len(v) for i in range(d)] for k, v in of.items()}
    scatter = {k: [[sum((f[i] - mean[k][i]) * (f[j] - mean[k][j]) for f in v) for j in range(d)] for i in range(d)] for k, v in of.items()}
    both = [[(scatter[0][i][j] + scatter[1][i][j]) / len(rows) for j in range(d)] for i in range(d)]
    trace = sum(both[i][i] for i in range(d))
    for i in range(d):
        both[i][i] += 1e-6 + 1e-3 * trace / d
    calm = [[both[i][j] * (1 if i == j else 1 - diagonal) for j in range(d)] for i in range(d)]
    parts = {}
    for k in (0, 1):
        cov = [[(1 - pooled) * scatter[k][i][j] / len(of[k]) + pooled * calm[i][j] for j in range(d)] for i in range(d)]
        inv, log_det = inverse_and_log_det(cov)
        parts[k] = (mean[k], inv, math.log(len(of[k])) - 0.5 * log_det)
    out = []
    for f in x:
        logs = []
        for k in (0, 1):
            m, inv, const = parts[k]
            z = [f[i] - m[i] for i in range(d)]
            logs.append(const - 0.5 * sum(z[i] * inv[i][j] * z[j] for i in range(d) for j in range(d)))
        out.append(1 / (1 + math.exp(max(-500.0, min(500.0, logs[0] - logs[1])))))
    return out


def test_quality_scores_are_those_of_a_plain_discriminant(spark):
    docs, labels, marks = labelled(spark, 240)
    known = labels.select("doc_id", F.col("quality").alias("label"))
    got = {r.doc_id: r for r in qda.quality_scores(docs, known, C.crc_mod(3) != 1).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    ids = sorted(texts)
    x = dict(zip(ids, qda.features(pa.array([texts[i] for i in ids])).tolist()))
    rows = [(x[i], y) for i, y, _ in marks if i is not None and y in (0, 1) and got[i].learn]
    want = plain_qda(rows, [x[i] for i in ids])
    for i, w in zip(ids, want):
        assert got[i].score == pytest.approx(w, rel=1e-6, abs=1e-9)


def plain_weak(votes, labels, x, rounds=30, ridge=0.05):
    """Posteriors by expectation maximisation and ridge logistic weights, text by text."""
    n, v = len(votes), len(votes[0])
    clip = lambda a, lo, hi: max(lo, min(hi, a))
    post = [0.9 * y + 0.05 for y in labels]
    for _ in range(rounds):
        s1, s0 = sum(post), n - sum(post)
        share = clip(s1 / n, 1e-4, 1 - 1e-4)
        a = [(sum(p * r[j] for p, r in zip(post, votes)) + 0.5) / (s1 + 1) for j in range(v)]
        b = [(sum((1 - p) * r[j] for p, r in zip(post, votes)) + 0.05) / (s0 + 0.5) for j in range(v)]
        gold1 = clip((sum(p * y for p, y in zip(post, labels)) + 0.9) / (s1 + 1), 0.5, 0.99)
        gold0 = clip((sum((1 - p) * (1 - y) for p, y in zip(post, labels)) + 0.9) / (s0 + 1), 0.5, 0.99)
        dev = [[r[j] - p * a[j] - (1 - p) * b[j] for j in range(v)] for p, r in zip(post, votes)]
        cov = [[sum(e[i] * e[j] for e in dev) / n for j in range(v)] for i in range(v)]
        sd = [math.sqrt(cov[i][i]) + 1e-12 for i in range(v)]
        weight = [1 / max(1, sum(r for r in (cov[i][j] / (sd[i] * sd[j]) for j in range(v)) if r > 0.2)) for i in range(v)]
        new = []
        for r, y in zip(votes, labels):
            z = math.log(share / (1 - share)) + (math.log(gold1 / (1 - gold0)) if y else math.log((1 - gold1) / gold0))
            for j in range(v):
                z += weight[j] * (math.log(a[j] / b[j]) if r[j] else math.log(max(1 - a[j], 1e-6) / max(1 - b[j], 1e-6)))
            new.append(1 / (1 + math.exp(-clip(z, -60, 60))))
        post = new
    d = len(x[0])
    w = [0.0] * d
    for _ in range(200):  # Newton steps, the constant all but free
        p = [1 / (1 + math.exp(-clip(sum(c * f for c, f in zip(w, r)), -60, 60))) for r in x]
        lam = [ridge] * (d - 1) + [1e-6]
        g = [sum((q - t) * r[i] for q, t, r in zip(p, post, x)) + lam[i] * w[i] for i in range(d)]
        h = [[sum((q * (1 - q) + 1e-9) * r[i] * r[j] for q, r in zip(p, x)) + (lam[i] if i == j else 0) for j in range(d)] for i in range(d)]
        inv, _ = inverse_and_log_det(h)
        step = [sum(inv[i][j] * g[j] for j in range(d)) for i in range(d)]
        w = [c - clip(s, -4, 4) for c, s in zip(w, step)]
        if max(map(abs, step)) < 1e-8:
            break
    return post, w


def test_label_model_and_classifier_are_those_of_plain_loops():
    rng = np.random.default_rng(3)
    n, v = 160, 5
    truth = rng.random(n) < 0.3
    votes = (rng.random((n, v)) < np.where(truth[:, None], 0.6, 0.03)).astype(float)
    votes[:, 1] = votes[:, 0]  # two that always say the same
    labels = np.where(rng.random(n) < 0.95, truth, ~truth).astype(float)
    hits = votes * rng.integers(1, 4, (n, v))
    hits = np.column_stack([hits, np.zeros((n, len(tox.PATTERNS)))])
    rows, times = np.unique(np.column_stack([hits, labels]), axis=0, return_counts=True)
    grouped, y = rows[:, :-1], rows[:, -1]
    post = tox.label_model((grouped > 0).astype(float), y, times.astype(float))
    weights = tox.logistic(tox.features(grouped), post, times.astype(float))
    x = tox.features(hits)
    want_post, want = plain_weak((hits > 0).astype(float).tolist(), labels.tolist(), x.tolist())
    at = {tuple(r): k for k, r in enumerate(rows.tolist())}
    for r, p in zip(np.column_stack([hits, labels]).tolist(), want_post):
        assert post[at[tuple(r)]] == pytest.approx(p, rel=1e-9, abs=1e-9)
    assert (x @ weights).tolist() == pytest.approx((x @ np.array(want)).tolist(), rel=1e-6, abs=1e-6)


def test_toxicity_does_not_depend_on_the_order_of_the_rows(spark):
    docs, labels, _ = labelled(spark, 240)
    known = labels.select("doc_id", F.col("toxic").alias("label"))
    runs = [{r.doc_id: r.score for r in tox.toxicity_scores(docs.repartition(k), known, C.crc_mod(5) != 0, sample=100).collect()} for k in (1, 5)]
    assert runs[0].keys() == runs[1].keys()
    assert all(runs[0][i] == pytest.approx(runs[1][i], rel=1e-9) for i in runs[0])
