import numpy as np
import pytest
from pyspark.sql import functions as F

from basketry.llm.kd_topk import Tree, top_k
from basketry.llm.rabitq import TIMES, codes, estimators, near_vectors, plan, turned
from tests.llm import helpers as H

ROWS = H.vectors()
SCHEMA = "vec_id long, embedding array<float>, label int, n_links int, x string, score double, rank int"


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame([(*r, 1, "y", None, 2) for r in ROWS], SCHEMA).repartition(3)


def fine(v):
    return v is not None and all(c is not None and np.isfinite(c) for c in v)


def test_near_vectors(spark, table):
    good = [(i, np.array(v, float), lab) for i, v, lab in ROWS if i is not None and fine(v) and any(v) and lab is not None]
    pairs, links = [], {}
    for a, (i, x, p) in enumerate(good):
        for b, (j, y, q) in enumerate(good):
            if a != b and p == q and len(x) == len(y) and x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= 0.93:
                links[a] = links.get(a, 0) + 1
                pairs.append((i, j))
    comp = H.components({i for i, _, _ in ROWS if i is not None}, pairs)
    want = [(i, links.get(a, 0), comp[i], comp[i] == i) for a, (i, _, _) in enumerate(good)]
    out = {id(g) for g in good}
    rest = [(i, 0, None if i is None else comp[i], True if i is None else comp[i] == i) for i, v, lab in ROWS
            if not (i is not None and fine(v) and any(v) and lab is not None)]
    got = [tuple(r) for r in near_vectors(table).collect()]
    H.same(got, want + rest)
    assert out and near_vectors(table.limit(0)).count() == 0


def test_hot_group_of_vectors_counts_each_link_once(spark):
    rng = np.random.default_rng(0)
    base = rng.standard_normal(16)
    rows = [(k, [float(v) for v in (base + 0.02 * rng.standard_normal(16)).astype(np.float32)], 1, 0, "", 0.0, 0) for k in range(1200)]
    got = near_vectors(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.component_id for r in got} == {0}
    assert np.mean([r.n_links for r in got]) >= 0.99 * 1199 and max(r.n_links for r in got) <= 1199


def test_recall_at_the_threshold(spark):
    rng = np.random.default_rng(1)
    x = rng.standard_normal((600, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    n = rng.standard_normal((600, 64))
    n -= (n * x).sum(axis=1, keepdims=True) * x
    n /= np.linalg.norm(n, axis=1, keepdims=True)
    y = 0.932 * x + np.sqrt(1 - 0.932 ** 2) * n
    rows = [(k, [float(v) for v in z], 1, 0, "", 0.0, 0) for k, z in enumerate(np.concatenate([x, y]))]
    got = {r.vec_id: r.n_links for r in near_vectors(spark.createDataFrame(rows, SCHEMA.replace("float", "double"))).collect()}
    assert sum(got[k] > 0 for k in range(600)) >= 0.9 * 600
    assert plan(1200, 0.93, 0.995)[1] >= 1 and plan(1 << 30, 0.93, 0.995)[0] == 24


def test_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(2)
    x = rng.standard_normal((300, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    packed, factor = codes(x)
    assert packed.shape == (300, TIMES * 64 // 8) and factor.shape == (300, TIMES)
    code, radius = estimators(packed, factor, 64)
    error = turned(x, TIMES).reshape(300, -1) @ code.T - x @ x.T
    off = ~np.eye(300, dtype=bool)
    assert abs(error[off].mean()) < 0.01 and (np.abs(error) <= radius[None, :])[off].mean() > 0.999


def test_top_k(table):
    ints = [(i, np.floor(1024 * np.array(v, float)).astype(int)) for i, v, _ in ROWS if i is not None and fine(v)]
    want = []
    for i, q in ints:
        if i % 20 == 0:
            best = sorted(((-int(q @ x), j) for j, x in ints if j != i and len(x) == len(q)))[:10]
            want += [(i, k + 1, j, -s) for k, (s, j) in enumerate(best)]
    assert len(want) > 50
    H.same([tuple(r) for r in top_k(table, F.col("vec_id") % 20 == 0).collect()], want)
    assert top_k(table.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def brute_top(rows, k=10, every=20):
    import math

    ints = [(i, [math.floor(1024 * c) if abs(c) < 1e300 else int(c) * 1024 for c in v]) for i, v in rows]
    out = []
    for i, q in ints:
        if i % every == 0:
            best = sorted((-sum(a * b for a, b in zip(q, x)), j) for j, x in ints if j != i and len(x) == len(q))[:k]
            out += [(i, r + 1, j, -s if -(2 ** 63) <= -s < 2 ** 63 else None) for r, (s, j) in enumerate(best)]
    return out


def test_top_k_with_components_of_any_size(spark):
    rng = np.random.default_rng(6)
    rows = [(k, [float(c) for c in v]) for k, v in enumerate(rng.standard_normal((90, 16)))]
    rows += [(100 + k, [3e6] * 15 + [float(k)]) for k in range(5)] + [(120 + k, [1e12 * (-1) ** k] * 15 + [0.5]) for k in range(4)]
    rows += [(140, [1e307] * 16), (160, [-1e307] * 16), (200, [3e6] * 64), (201, [3e6] * 63 + [1.0]), (220, [3e6] * 64)]
    frame = spark.createDataFrame([(i, v, 0, 1, "y", None, 2) for i, v in rows], SCHEMA.replace("float", "double")).repartition(3)
    H.same([tuple(r) for r in top_k(frame, F.col("vec_id") % 20 == 0).collect()], brute_top(rows))


def test_top_k_over_many_cells_tiles_and_box_blocks(spark, monkeypatch):
    import basketry.llm.kd_topk as kd

    for name, value in (("SHARD", 20), ("TILE", 4), ("BOXES", 3), ("LEAF", 4)):
        monkeypatch.setattr(kd, name, value)
    rng = np.random.default_rng(7)
    near = rng.standard_normal((8, 6)) * 3
    x = [near[k % 8] + 0.1 * rng.standard_normal(6) for k in range(300)] + [near[0]] * 150  # a third of the rows are alike
    rows = [(k, [float(c) for c in v]) for k, v in enumerate(x)]
    frame = spark.createDataFrame([(i, v, 0, 1, "y", None, 2) for i, v in rows], SCHEMA.replace("float", "double")).repartition(3)
    H.same([tuple(r) for r in top_k(frame, F.col("vec_id") % 20 == 0, k=7).collect()], brute_top(rows, 7))


def test_boxes_that_cannot_reach_a_floor_are_ruled_out():
    import pyarrow as pa

    from basketry.llm.kd_topk import _pack_floors, _reach

    q = np.array([[1.0, 0.0], [0.0, 1.0]])
    tiles = pa.table({"ids": [np.arange(2).tobytes()], "x": [q.tobytes()], "floors": [_pack_floors([1024 * 1024 * 5, None])]})
    boxes = pa.table({"cell": [0, 1], "sub": [0, 0], "box": [np.array([[0.0, 0], [4, 1]]).tobytes(), np.array([[0.0, 0], [5, 1]]).tobytes()]})
    got = _reach((pa.scalar(2), pa.scalar(9)), tiles, boxes).to_pylist()
    assert [(r["cell"], np.frombuffer(r["ids"], np.int64).tolist()) for r in got] == [(0, [1]), (1, [0, 1])]


def test_keys_sort_as_integers():
    from basketry.llm.kd_topk import order_key, order_value

    n = sorted([0, 1, -1, 255, 256, -255, -256, 2 ** 63, -(2 ** 63), 10 ** 600, -(10 ** 600), 7, -7, 65535, -65536])
    assert [order_value(k) for k in sorted(map(order_key, n))] == n


def test_tree_bounds_hold_and_large_numbers_stay_exact():
    rng = np.random.default_rng(4)
    for scale in (50, 2 ** 31 - 1):
        points = rng.integers(-scale, scale, (700, 6)).astype(float)
        points[:200] = points[0]
        tree = Tree(points, np.arange(700))
        q = rng.integers(-scale, scale, (5, 6)).astype(float)
        for i, best in tree.search(q, np.full(5, -1), [None] * 5, 10):
            exact = sorted(((-sum(int(a) * int(b) for a, b in zip(q[i], p)), j) for j, p in enumerate(points)))[:10]
            assert sorted((-s, -j) for s, j in best) == exact
