import hashlib
import math
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from basketry.llm import common as C
from basketry.llm.quality_qda import quality_scores
from tests.llm import helpers as H
from tests.llm.test_text_operators import labelled, library_ids


def near_copies(words: int, changes: int, first: int, n: int):
    """``n`` texts of words of their own, each with a copy in which some words far apart differ."""
    rows = []
    for k in range(n):
        text = [f"w{first + k}x{j}" for j in range(words)]
        copy = list(text)
        for c in range(changes):
            copy[10 + 20 * c] = f"c{first + k}x{c}"
        rows += [(first + 2 * k, " ".join(text)), (first + 2 * k + 1, " ".join(copy))]
    return rows


def test_near_duplicates_stage_links_from_four_fifths(spark):
    # similarities 0.9, 0.811, 0.8 (linked) and 0.798 (not)
    rows = near_copies(100, 1, 0, 10) + near_copies(100, 2, 1000, 40) + near_copies(94, 2, 2000, 40) + near_copies(93, 2, 3000, 40)
    sets = [(i, H.shingles(t)) for i, t in rows]
    pairs = [(a, b) for k, (a, x) in enumerate(sets) for b, y in sets[k + 1:] if 100 * len(x & y) >= 80 * len(x | y)]
    assert len(pairs) == 90
    want = sorted(i for i, c in H.components([i for i, _ in rows], pairs).items() if i == c)
    docs = H.frame(spark, rows)
    got = corpus_pipeline.near_duplicates(spark, docs, "")
    assert got.columns == docs.columns
    assert sorted(r.doc_id for r in got.collect()) == want


def without_repeats(rows, length=50):
    """The texts without the passages that a smaller id has too."""
    least = {}
    data = [(i, t.encode()) for i, t in rows]
    for i, b in data:
        for k in range(len(b) - length + 1):
            s = b[k:k + length]
            least[s] = min(i, least.get(s, i))
    out = {}
    for i, b in data:
        lost = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if least[b[k:k + length]] < i:
                lost[k:k + length] = b"\1" * length
        out[i] = bytes(x for x, g in zip(b, lost) if not g).decode("utf-8", "ignore")
    return out


def dealt(children, budget):
    """Budgets of siblings ``{name: tokens}``, two epochs, weights the whole square roots."""
    order = sorted((2 * t / math.isqrt(t), n, 2 * t, math.isqrt(t)) for n, t in children.items() if t)
    whole, out, rest, before, taken = sum(w for *_, w in order), {}, [], 0, 0
    for _, n, cap, w in order:
        if cap * (whole - before) <= (budget - taken) * w:
            out[n] = cap
        else:
            rest.append((n, cap, w))
        before, taken = before + w, taken + cap
    left, total, upto = budget - sum(out.values()), sum(w for *_, w in rest), 0
    for n, cap, w in rest:
        out[n] = min(cap, left * (upto + w) // total - left * upto // total)
        upto += w
    return out


def mixed(rows):
    """``{id: copies}`` for ``(id, text, lang, source)`` at nine tenths of all tokens."""
    def domain(source):
        d = hashlib.md5(source.encode()).hexdigest()[0]
        return "d0" if d < "4" else "d1" if d < "8" else "d2" if d < "c" else "d3"
    tokens = {i: len(H.WORD.findall(t)) for i, t, _, _ in rows}
    leaf = {i: (domain(s or ""), x or "", s or "") for i, _, x, s in rows}
    budgets = {(): sum(tokens.values()) * 9 // 10}
    for depth in range(3):
        children = defaultdict(Counter)
        for i, at in leaf.items():
            children[at[:depth]][at[depth]] += tokens[i]
        budgets = {(*at, n): b for at, c in children.items() for n, b in dealt(c, budgets.get(at, 0)).items()}
    out = {}
    for at in set(leaf.values()):
        mine = [i for i in leaf if leaf[i] == at]
        t, b = sum(tokens[i] for i in mine), budgets.get(at, 0)
        if not t:
            continue
        upto = 0
        for i in sorted(mine, key=lambda i: hashlib.md5(f"7:{b // t}:{i}".encode()).hexdigest()):
            upto += tokens[i]
            out[i] = b // t + (0 < b % t >= upto)
    return out


def test_run_and_each_stage_against_a_brute_force_chain(spark, scratch):
    first, labels, _ = labelled(spark)
    rows = [(r.doc_id, r.text) for r in first.collect()]
    for i, t in rows[3:600:10]:  # copies with two other words: similarities on both sides of 0.8
        w = t.split(" ")
        if len(w) > 35:
            w[10], w[30] = "elsewhere", "otherwise"
            rows.append((1000 + i, " ".join(w)))
    H.frame(spark, rows).write.parquet(f"{scratch}/documents.parquet")
    labels.write.parquet(f"{scratch}/labels.parquet")
    docs = spark.read.parquet(f"{scratch}/documents.parquet")
    source = {r.doc_id: r for r in docs.collect()}
    known = labels.select("doc_id", F.col("quality").alias("label"))
    texts = {r.doc_id: source[r.doc_id].text for r in quality_scores(docs, known, C.crc_mod(3) != 1).collect() if r.score >= 0.5}

    staged = docs
    seen = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        staged = C.staged(stage(spark, staged, scratch))
        assert staged.columns == docs.columns
        seen.append(staged.collect())
    assert sorted((r.doc_id, r.text) for r in seen[0]) == sorted(texts.items())

    sets = [(i, H.shingles(t)) for i, t in texts.items()]
    alike = [(a, b, len(x & y) / len(x | y)) for k, (a, x) in enumerate(sets) for b, y in sets[k + 1:]
             if 100 * len(x & y) >= 80 * len(x | y)]
    assert sum(j < 0.85 for _, _, j in alike) > 5
    group = H.components(list(texts), [p[:2] for p in alike])
    texts = {i: t for i, t in texts.items() if group[i] == i}
    assert sorted((r.doc_id, r.text) for r in seen[1]) == sorted(texts.items())

    cut = without_repeats(texts.items())
    assert cut != texts
    assert sorted((r.doc_id, r.text, r.n_chars) for r in seen[2]) == sorted((i, t, len(t)) for i, t in cut.items())

    taken = mixed([(i, t, source[i].lang, source[i].source) for i, t in cut.items()])
    want = sorted((i, cut[i]) for i, n in taken.items() for _ in range(n))
    assert set(taken.values()) > {0, 1}
    assert sorted((r.doc_id, r.text) for r in seen[3]) == want

    out = corpus_pipeline.run(spark, scratch)
    assert out.columns == [*docs.columns, "encoded"]
    got = out.collect()
    assert sorted((r.doc_id, r.text) for r in got) == want
    for r in got:
        ids = np.array(library_ids(r.text), "<u4")
        assert r.encoded.n_tokens == len(ids)
        assert hashlib.sha256(ids.tobytes()).hexdigest() in list(r.encoded)
