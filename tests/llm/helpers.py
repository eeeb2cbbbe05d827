"""Fixtures and brute-force versions of the operators."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {65 + k: 97 + k for k in range(26)}
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "score double, n_tokens int, component_id string, c int, learn int, budget long, kept string, x double")


def texts(seed: int = 1, n: int = 40) -> list[tuple[int, str]]:
    """Texts with exact copies, near copies, shared passages, odd characters and odd lengths."""
    rng = random.Random(seed)
    vocab = ["".join(rng.choice(["th", "an", "er", "é", "ü", "ing", "on", "re", "x", "ß"]) for _ in range(rng.randint(1, 5)))
             for _ in range(400)]
    def prose(k):
        return " ".join(rng.choice(vocab) for _ in range(k))
    passage = prose(70)
    out = [(k, prose(rng.randint(1, 160))) for k in range(n)]
    base = out[3][1] + " " + prose(120)
    out[5] = (5, base)
    out[9] = (9, base)
    words = base.split(" ")
    for k, at in ((11, 7), (12, 40), (13, 90)):
        changed = list(words)
        changed[at] = "changed"
        out[k] = (k, " ".join(changed))
    out[20] = (20, prose(20) + "\n" + passage + "\n" + prose(10))
    out[21] = (21, prose(5) + "\t" + passage)
    out[22] = (22, passage.upper() + "  " + passage)
    out += [(100, ""), (101, None), (102, "   \n\t "), (103, "one"), (104, "One"), (105, "a b c d"), (106, "a  b\tc d"),
            (107, "<|endoftext|> x<|startoftext|>y é ́日本語 🙂 İ ﬁ"), (108, "x" * 3000), (109, prose(4000)), (110, "a" * 49), (111, "a" * 50),
            (112, "ab" * 200), (113, "\x00\x01\x7f\x1c z"), (9, base), (114, base)]
    return out


def frame(spark, rows=None):
    """The texts with null ids, null columns, and extra columns whose names the operators use inside."""
    rows = texts() if rows is None else rows
    full = [(i, t, None if k % 5 == 0 else "en", None if k % 7 == 0 else f"src{k % 3}", len(t or ""), 1.0, 2, "z", 3, 4, None, "k", None)
            for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(full, SCHEMA)


def crc(i, n):
    return zlib.crc32(str(i).encode()) % n if i is not None else 0


def shingles(text):
    w = WORD.findall((text or "").translate(LOWER))
    if not w:
        return set()
    return {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)}


def components(nodes, pairs):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in pairs:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def near_duplicates(rows):
    sets = [(i, shingles(t)) for i, t in rows if i is not None]
    pairs = [(a, b) for k, (a, x) in enumerate(sets) for b, y in sets[k + 1:]
             if x and y and 100 * len(x & y) >= 85 * len(x | y)]
    return components({i for i, _ in sets}, pairs)


def removed(rows, length=50):
    """Per row: bytes, removed bytes, spans, digest of the rest."""
    where = defaultdict(lambda: None)
    data = [(i, (t or "").encode()) for i, t in rows]
    for i, b in data:
        if i is None:
            continue
        for k in range(len(b) - length + 1):
            s = b[k:k + length]
            if where[s] is None or i < where[s]:
                where[s] = i
    out = []
    for i, b in data:
        lost = [False] * len(b)
        for k in range(len(b) - length + 1):
            if i is not None and where[b[k:k + length]] < i:
                lost[k:k + length] = [True] * length
        spans = sum(1 for k in range(len(b)) if lost[k] and (k == 0 or not lost[k - 1]))
        rest = bytes(x for x, g in zip(b, lost) if not g)
        out.append((i, len(b), sum(lost), spans, hashlib.sha256(rest).hexdigest()))
    return out


def ppm(rows, learn, order=6):
    """Prediction by partial matching, method C with exclusion, one byte at a time."""
    trie = [defaultdict(Counter) for _ in range(order + 1)]
    seq = lambda t: [254] * order + list((t or "").encode()) + [255]
    for i, t in rows:
        if learn(i):
            q = seq(t)
            for k in range(order, len(q)):
                for o in range(order + 1):
                    trie[o][tuple(q[k - o:k])][q[k]] += 1

    def code(q, k):
        out, gone = 0.0, set()
        for o in range(order, -1, -1):
            seen = trie[o].get(tuple(q[k - o:k]))
            if not seen:
                continue
            left = {s: n for s, n in seen.items() if s not in gone}
            if left:
                total = sum(left.values()) + len(left)
                if q[k] in left:
                    return out + math.log10(left[q[k]] / total)
                out += math.log10(len(left) / total)
            gone |= set(seen)
        return out - math.log10(256 - len(gone))
    return [sum(code(q, k) for k in range(order, len(q))) for q in (seq(t) for _, t in rows)]


def key(rows):
    return sorted(rows, key=lambda r: tuple((v is None, str(v)) for v in r))


def same(got, want):
    got, want = key(got), key(want)
    assert len(got) == len(want)
    for g, w in zip(got, want):
        for a, b in zip(g, w):
            if isinstance(b, float):
                assert a == b or math.isclose(a, b, rel_tol=1e-5, abs_tol=1e-9), (g, w)
            else:
                assert a == b, (g, w)


def vectors(seed=3, n=120, dim=32):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, dim))
    for k in range(10, 30):
        x[k] = x[5] + 0.05 * rng.standard_normal(dim)
    x[40] = x[41] = x[42]
    x[43] = 3 * x[42]
    rows = [(k, [float(np.float32(v)) for v in x[k]], k % 2 if k >= 44 or k < 5 else 0) for k in range(n)]
    rows += [(500, None, 0), (501, [0.0] * dim, 0), (502, [float("nan")] * dim, 0), (503, [None, *[1.0] * (dim - 1)], 0),
             (504, [float("inf"), *[1.0] * (dim - 1)], 0), (505, [1.0, 2.0], 0), (506, [1.0, 2.0], 0), (507, rows[5][1], None), (508, [], 0),
             (None, rows[5][1], 0), (5, rows[5][1], 0)]
    return rows
