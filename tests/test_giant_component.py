"""Components that no task holds, removals that run few sources again, items that everybody has."""

import itertools
import random

import pytest

from basketry.operators import cooccurrence as co
from basketry.operators import graph as gr
from basketry.operators import paths

from test_graph import _edges, brandes, girvan_newman_brute


def random_graph(seed, nodes, edges):
    rng = random.Random(seed)
    out = {(rng.randrange(k), k) for k in range(1, nodes)}  # connected
    while len(out) < edges:
        a, b = rng.sample(range(nodes), 2)
        out.add((min(a, b), max(a, b)))
    return sorted(out)


def check(got, pairs):
    got = {(r["src"], r["dst"]): r["betweenness"] for r in got.collect()}
    want = brandes(pairs)
    assert set(got) == set(want)
    assert all(got[k] == pytest.approx(want[k]) for k in want)


def test_components_above_a_task_go_level_by_level(spark, monkeypatch):
    held = []
    whole = gr._credits
    monkeypatch.setattr(gr, "_credits", lambda key, e, s: held.append(len(e)) or whole(key, e, s))
    big, small = random_graph(1, 40, 70), [(100, 101), (101, 102), (100, 102), (102, 103)]
    check(gr.edge_betweenness(_edges(spark, big + small), task_edges=10), big + small)


def test_batches_hubs_and_strings(spark, monkeypatch):
    monkeypatch.setattr(paths, "STATE_ROWS", 300)
    monkeypatch.setattr(paths, "HUB", 4)
    star = [(0, k) for k in range(1, 25)] + [(1, 2), (3, 4), (24, 25)]
    check(gr.edge_betweenness(_edges(spark, star), task_edges=0), star)
    named = [(f"n{a:02d}", f"n{b:02d}") for a, b in star]
    check(gr.edge_betweenness(spark.createDataFrame(named, "src string, dst string"), task_edges=0), named)


def test_level_tables_do_not_stay(spark):
    import glob

    from basketry.session import ensure_checkpoint_dir

    where = ensure_checkpoint_dir(spark).removeprefix("file:") + "/basketry-tables/*"
    before = set(glob.glob(where))
    gr.edge_betweenness(_edges(spark, random_graph(2, 12, 15)), task_edges=0)
    assert len(set(glob.glob(where)) - before) == 1


def test_only_sources_that_use_a_removed_edge_run_again():
    # two cliques of 12 with one bridge: an edge of a clique is on few shortest paths
    one = list(itertools.combinations(range(12), 2))
    pairs = one + [(a + 12, b + 12) for a, b in one] + [(0, 12)]
    nodes = list(range(24))
    left = list(range(len(pairs)))
    known = gr.Credits(nodes, gr._around(pairs, left))
    assert known.ran == 24
    total = 24
    rng = random.Random(0)
    for _ in range(40):
        gone = rng.choice([e for e in left if pairs[e] != (0, 12)])
        users = len(known.users[gone])
        left.remove(gone)
        known.remove([gone], gr._around(pairs, left))
        total += users
        assert known.ran == total
        want = brandes([pairs[e] for e in left])
        assert all(known.credit[e] / 2 == pytest.approx(want[pairs[e]]) for e in left)
    assert total < 24 + 40 * 24 / 2  # less than half of what running all again would take


def test_communities_with_the_index(spark):
    pairs = random_graph(5, 24, 40) + [(a + 50, b + 50) for a, b in random_graph(6, 9, 14)]
    got = {r["node"]: r["community"] for r in gr.communities(_edges(spark, pairs)).collect()}
    assert got == girvan_newman_brute(pairs)


# --- items that many users share -------------------------------------------------------

def brute_shared(sets, thre):
    return {(a, b): len(sets[a] & sets[b]) for a, b in itertools.combinations(sorted(sets), 2) if len(sets[a] & sets[b]) >= thre}


@pytest.mark.parametrize("thre", [1, 2, 4])
def test_heavy_and_light_items(spark, monkeypatch, thre):
    monkeypatch.setattr(co, "USER_BLOCK", 7)
    monkeypatch.setattr(co, "ITEM_SLICE", 2)
    rng = random.Random(thre)
    sets = {u: {rng.randrange(60) for _ in range(rng.randint(1, 9))} | {x for x in (100, 101, 102, 103, 104) if rng.random() < 0.7} for u in range(40)}
    rows = [(u, i) for u, items in sets.items() for i in items]
    inc = spark.createDataFrame([*rows, *rows[:9], (None, 1), (1, None)], "basket long, item long")
    got = {(r["src"], r["dst"]): r["shared"] for r in co.shared_counts(inc, thre, heavy=8).collect()}
    assert got == brute_shared(sets, thre)


def test_an_item_of_everybody_makes_no_row_per_pair(spark):
    users = 3000
    rows = [(u, 0) for u in range(users)] + [(u, 1 + u // 2) for u in range(users)]
    inc = spark.createDataFrame(rows, "basket long, item long")
    seen = shuffled(spark, lambda: co.shared_counts(inc, 2))
    got, written = seen
    assert got.count() == users // 2 and {r["shared"] for r in got.collect()} == {2}
    assert written < 40 * users  # the pairs of item 0 alone would be 4.5 million


def test_heavy_products_return_only_what_reaches_the_threshold(spark):
    rows = [(u, i) for u in range(60) for i in (1, 2) if (u + i) % 2] + [(0, 2), (2, 1)]
    inc = spark.createDataFrame([(u, i) for u, i in rows], "u long, i long")
    got = sorted(tuple(r) for r in co.heavy_pairs(inc, 2).collect())
    sets = {}
    for u, i in rows:
        sets.setdefault(u, set()).add(i)
    assert got == sorted((a, b, n) for (a, b), n in brute_shared(sets, 2).items())


def shuffled(spark, run):
    """What ``run`` returns, and the records that its stages shuffled."""
    store = spark.sparkContext._jsc.sc().statusStore()
    jvm = spark._jvm
    none = jvm.java.util.ArrayList()
    doubles = spark.sparkContext._gateway.new_array(jvm.double, 0)

    def records():
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(10000)
        stages = store.stageList(none, False, False, doubles, none)
        return sum(stages.apply(k).shuffleWriteRecords() for k in range(stages.size()))

    before = records()
    out = run()
    return out, records() - before


def test_threshold_follows_the_counts(spark):
    counts = spark.createDataFrame([(k, k + 1, s) for k, s in enumerate([2] * 50 + [3] * 10 + [4] * 2)], "src long, dst long, shared long")
    assert [co.threshold_for(counts, n) for n in (1, 2, 3, 12, 13, 62, 63)] == [4, 4, 3, 3, 2, 2, 2]
    assert co.threshold_for(counts.limit(0), 1) is None
    inc = spark.createDataFrame([(u, i) for u in range(100) for i in range(u // 2 * 3, u // 2 * 3 + 3)], "basket long, item long")
    assert gr.shared_item_graph(inc).count() == 50
    assert gr.shared_item_graph(inc.limit(0)).count() == 0


def test_trees_on_cycles_need_no_paths(spark, monkeypatch):
    import pandas as pd

    # a ring of six with a chord, long and bushy trees on it, and a component that is a tree
    ring = [(0, 1), (1, 2), (2, 3), (3, 4), (4, 5), (0, 5), (1, 4)]
    trees = [(0, 10), (10, 11), (11, 12), (11, 13), (3, 14), (3, 15), (15, 16)] + [(k, k + 1) for k in range(16, 30)]
    alone = [(50, 51), (51, 52), (51, 53), (53, 54)]
    pairs = ring + trees + alone
    of = [50 if a >= 50 else 0 for a, _ in pairs]
    left = gr._stripped(pd.DataFrame(pairs, columns=["src", "dst"]).assign(component=of))
    assert sorted(zip(left.src[left.core], left.dst[left.core])) == sorted(ring)
    want = brandes(pairs)
    assert all(r.c / 2 == want[r.src, r.dst] for r in left[~left.core].itertuples())
    check(gr.edge_betweenness(_edges(spark, pairs)), pairs)
    monkeypatch.setattr(gr, "SOURCE_BLOCK", 1)
    monkeypatch.setattr(gr, "BLOCK_WORK", 8)
    check(gr.edge_betweenness(_edges(spark, pairs)), pairs)


def test_sparse_giant_component_is_followed_in_blocks(spark, monkeypatch):
    # 120,000 nodes hang off a few cycles and go first; level by level, as above 100,000 edges before, this took no end
    def never(*args):
        raise AssertionError("level by level")

    monkeypatch.setattr(gr, "level_credits", never)
    rng = random.Random(3)
    core = random_graph(4, 60, 90)
    nodes = [a for a, _ in core] + [b for _, b in core]
    tree = [(rng.choice(nodes), 1000 + k) for k in range(120_000)]
    got = {(r["src"], r["dst"]): r["betweenness"] for r in gr.edge_betweenness(_edges(spark, core + tree)).collect()}
    total = 60 + len(tree)
    assert len(got) == len(core) + len(tree)
    assert all(got[e] == total - 1 for e in tree)
    weight = {v: 1 + sum(a == v for a, _ in tree) for v in set(nodes)}
    # between two nodes of the core there are weight * weight shortest paths: their lengths add up over the edges
    around = {}
    for a, b in core:
        around.setdefault(a, []).append(b)
        around.setdefault(b, []).append(a)
    lengths = 0
    for s in around:
        far = {s: 0}
        order = [s]
        for v in order:
            for w in around[v]:
                if w not in far:
                    far[w] = far[v] + 1
                    order.append(w)
        lengths += sum(weight[s] * weight[v] * d for v, d in far.items())
    assert sum(got[e] for e in core) == pytest.approx(lengths / 2)
