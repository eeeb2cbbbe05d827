import hashlib
import zlib

import numpy as np
import pytest

from basketry.llm import periodic_runs as P
from basketry.llm.recompression import extend, extend_back, grammar
from tests.llm import helpers as H


def runs(w, least=12):
    """All runs by comparing words q apart for every q."""
    out = {}
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, 2 * q):
                out.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted((s, n, q) for (s, n), q in out.items())


def tail(words, doc_id):
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def digest(doc_id, text):
    w = tail(H.WORD.findall(text or ""), doc_id)
    found = runs(w)
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, len(found), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            sha("".join(f"{s},{n},{q}\n" for s, n, q in found)), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


@pytest.fixture(scope="module")
def rows():
    out = H.texts() + [(None, "a b " * 20), (None, None)]
    out += [(200 + k, t) for k, (_, t) in enumerate(H.texts(seed=9, n=150))]
    out += [(900, "a " * 500), (901, "a b c " * 4), (902, "a b c a b c a b c a b"), (903, "x " + "p q " * 9 + "y " + "p q " * 9),
            (904, "\u00a0 \u2003 a\x0bb\x0cc " * 12), (905, "u v w " * 2000), (903, "z " * 12)]
    return out


def test_digests_against_brute_force(spark, rows):
    got = P.run_digests(H.frame(spark, rows).repartition(3)).collect()
    H.same([tuple(r) for r in got], [digest(i, t) for i, t in rows])
    assert sum(r.n_runs > 0 for r in got) > 20
    assert P.run_digests(H.frame(spark, []).limit(0)).count() == 0


def test_runs_and_collapsed_texts(spark):
    docs = spark.createDataFrame([(1, "x " + "p q " * 9 + "y"), (2, None), (3, "one two")], "doc_id int, text string")
    got = {r.doc_id: r for r in P.periodic_runs(docs).collect()}
    assert [tuple(x) for x in got[1].runs] == [(1, 18, 2)] and got[1].collapsed == "x p q y" and got[1].n_words == 20
    assert got[2].runs == [] and got[2].collapsed == "" and got[3].collapsed == "one two"


def test_runs_of_many_texts_in_one_grammar():
    rng = np.random.default_rng(0)
    for _ in range(150):
        docs = []
        for _ in range(int(rng.integers(1, 6))):
            w = rng.integers(0, rng.integers(1, 5), rng.integers(0, 90))
            if rng.random() < 0.5 and len(w):
                w = np.resize(rng.integers(0, 6, rng.integers(1, 20)), len(w))
                w[rng.integers(0, len(w))] = 7
            docs.append(w)
        size = np.array([len(x) for x in docs])
        seq, begin = P.marked(np.concatenate(docs).astype(np.int64), size, 10)
        least = int(rng.integers(2, 13))
        got = [tuple(r) for r in P.runs_of(seq, begin, size, least).tolist()]
        assert got == sorted(((t, *r) for t, x in enumerate(docs) for r in runs(x.tolist(), least)), key=lambda r: (r[0], r[1], r[3]))


def test_extensions_on_the_grammar():
    rng = np.random.default_rng(2)
    for _ in range(60):
        x = rng.integers(1, rng.integers(2, 5), 200)
        x[50:120] = x[10:80]
        x[130:160] = 1
        seq = np.concatenate([[0], x, [9]])
        levels = grammar(seq)
        assert len(np.unique(levels[-1].symbols)) == len(levels[-1].symbols)
        a, b = rng.integers(1, 201, (2, 300))
        a, b = np.minimum(a, b)[a != b], np.maximum(a, b)[a != b]
        for i, j, f, g in zip(a, b, extend(levels, a, b), extend_back(levels, a, b)):
            k = 0
            while seq[i + k] == seq[j + k]:
                k += 1
            assert f == k
            k = 0
            while seq[i - k] == seq[j - k]:
                k += 1
            assert g == k


def test_every_grid_candidate_is_visited_in_pieces(monkeypatch):
    monkeypatch.setattr(P, "CANDIDATES", 16)
    size, begin = np.array([0, 1, 2, 37, 5]), np.array([1, 2, 4, 7, 45])
    got = [(t, i - begin[t], p) for x in P.grid(begin, size) for t, i, p in zip(*x)]
    want = [(t, k * p, p) for t, n in enumerate(size) for p in range(1, n // 2 + 1) for k in range((n - 1) // p)]
    assert sorted(got) == sorted(want)
