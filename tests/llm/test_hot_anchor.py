import random

import numpy as np
import pyarrow as pa
import pytest

from basketry.llm import suffix_dedup as S
from tests.llm import helpers as H

PHRASE = "the very line that is at the head of each page.."


def hot_rows(n, seed=5):
    """Texts with one common phrase of 48 bytes; what stands around it repeats here and there."""
    rng = random.Random(seed)
    around = ["".join(rng.choice("bcdfghjk") for _ in range(30)) for _ in range(n)]
    rows = []
    for k in range(n):
        left, right = (around[k], around[k]) if k % 10 else (rng.choice(around), rng.choice(around))
        rows.append((k, left + PHRASE + right[:20] if k % 7 else left + PHRASE * 2 + right))
    return rows


def steps(rows, chunks, monkeypatch, bits=5, length=50):
    """The verdicts step in this process: distinct runs of the largest key, and the most symbols sorted together."""
    sorted_sizes = [0]
    whole = S.suffix_array
    monkeypatch.setattr(S, "suffix_array", lambda t: sorted_sizes.append(len(t)) or whole(t))
    c_of = [(i * 7) % chunks for i, _ in rows]
    docs = {c: pa.table({"doc_id": pa.array([i for (i, _), x in zip(rows, c_of) if x == c], pa.int64()),
                         "text": pa.array([t for (_, t), x in zip(rows, c_of) if x == c], pa.string())}) for c in range(chunks)}

    def by(tables, name):
        t = pa.concat_tables(tables)
        for v in sorted(set(t.column(name).to_pylist())):
            yield v, t.filter(pa.array([x == v for x in t.column(name).to_pylist()]))
    anchors = [S._anchors(bits, length)((pa.scalar(c),), t) for c, t in docs.items()]
    shared = dict(by([S._shared((pa.scalar(p),), t) for p, t in by(anchors, "part")], "c"))
    found = [S._runs(bits, length)((pa.scalar(c),), docs[c], t) for c, t in shared.items()]
    most = 0
    for p, t in by(found, "part"):
        keys = np.concatenate([np.frombuffer(x, np.uint64) for x in t.column("key").to_pylist()])
        most = max(most, int(np.unique(keys, return_counts=True)[1].max()))
        S._verdicts(length)((pa.scalar(p),), t)
    return most, max(sorted_sizes)


def test_no_part_gets_all_runs_of_a_frequent_phrase(monkeypatch):
    most, symbols = steps(hot_rows(1500), 6, monkeypatch)
    assert most <= 1024
    assert symbols <= 1024 * 78 + 4096


@pytest.mark.parametrize("n", [300, 1500])
def test_repeats_around_a_frequent_phrase(spark, n):
    rows = [*hot_rows(n), (None, PHRASE * 3), (7, PHRASE + "x" * 40)]
    docs = H.frame(spark, rows).repartition(3)
    got = [tuple(r) for r in S.repeats(docs).collect()]
    want = H.removed(rows)
    assert sum(w[2] > 0 for w in want) > n // 20
    H.same(got, want)
