"""Graph operators on hand-made graphs, brute force, and golden files."""

import glob
from collections import deque

import pytest

from basketry.operators import graph as gr

from conftest import REFERENCE


def brandes(edges):
    adj = {}
    for a, b in edges:
        adj.setdefault(a, set()).add(b)
        adj.setdefault(b, set()).add(a)
    eb = {tuple(sorted(e)): 0.0 for e in edges}
    for s in adj:
        dist, sigma, order, preds = {s: 0}, {s: 1.0}, [], {v: [] for v in adj}
        q = deque([s])
        while q:
            v = q.popleft()
            order.append(v)
            for w in adj[v]:
                if w not in dist:
                    dist[w] = dist[v] + 1
                    sigma[w] = 0.0
                    q.append(w)
                if dist[w] == dist[v] + 1:
                    sigma[w] += sigma[v]
                    preds[w].append(v)
        delta = {v: 0.0 for v in adj}
        for w in reversed(order):
            for v in preds[w]:
                c = sigma[v] / sigma[w] * (1 + delta[w])
                eb[tuple(sorted((v, w)))] += c
                delta[v] += c
    return {k: v / 2 for k, v in eb.items()}


def _edges(spark, pairs):
    return spark.createDataFrame(pairs, "src long, dst long")


TWO_TRIANGLES = [(1, 2), (2, 3), (1, 3), (3, 4), (4, 5), (5, 6), (4, 6)]


def test_bridge_betweenness_is_nine(spark):
    got = {(r["src"], r["dst"]): r["betweenness"] for r in gr.edge_betweenness(_edges(spark, TWO_TRIANGLES)).collect()}
    assert got[(3, 4)] == pytest.approx(9.0)
    want = brandes(TWO_TRIANGLES)
    for k in want:
        assert got[k] == pytest.approx(want[k])


@pytest.mark.parametrize("pairs", [
    [(1, 2), (2, 3), (3, 4), (4, 5)],                        # path
    [(0, 1), (0, 2), (0, 3), (0, 4)],                        # star
    [(a, b) for a in range(5) for b in range(a + 1, 5)],     # clique
    [(1, 2), (2, 3), (10, 11), (11, 12), (12, 10)],          # two components
])
def test_betweenness_brute_force(spark, pairs):
    got = {(r["src"], r["dst"]): r["betweenness"] for r in gr.edge_betweenness(_edges(spark, pairs)).collect()}
    want = brandes(pairs)
    assert set(got) == set(want)
    for k in want:
        assert got[k] == pytest.approx(want[k])


def test_betweenness_sum_is_sum_of_distances(spark):
    pairs = [(1, 2), (2, 3), (3, 4), (2, 5), (5, 6)]
    total = sum(r["betweenness"] for r in gr.edge_betweenness(_edges(spark, pairs)).collect())
    # sum over unordered pairs of their distance
    adj = {}
    for a, b in pairs:
        adj.setdefault(a, set()).add(b)
        adj.setdefault(b, set()).add(a)
    dsum = 0
    for s in adj:
        dist = {s: 0}
        q = deque([s])
        while q:
            v = q.popleft()
            for w in adj[v]:
                if w not in dist:
                    dist[w] = dist[v] + 1
                    q.append(w)
        dsum += sum(dist.values())
    assert total == pytest.approx(dsum / 2)


def test_components_and_isolated_nodes(spark):
    e = _edges(spark, [(1, 2), (2, 3), (10, 11), (5, 4)])
    nodes = spark.createDataFrame([(99,), (1,)], "node long")
    got = {r["node"]: r["component"] for r in gr.connected_components(e, nodes).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 10: 10, 11: 10, 4: 4, 5: 4, 99: 99}


def test_long_path_component(spark):
    pairs = [(i, i + 1) for i in range(40)]
    got = {r["component"] for r in gr.connected_components(_edges(spark, pairs)).collect()}
    assert got == {0}


def test_modularity_and_split(spark):
    e = _edges(spark, TWO_TRIANGLES)
    labels = spark.createDataFrame([(1, 1), (2, 1), (3, 1), (4, 4), (5, 4), (6, 4)], "node long, component long")
    q = gr.modularity(e, labels).first()[0]
    # m = 7; each triangle: 3 inside, degree sum 7
    assert q == pytest.approx(2 * (3 / 7 - (7 / 14) ** 2))
    remaining, split = gr.split_round(e)
    assert remaining.count() == 6
    comm = {r["node"]: r["component"] for r in split.collect()}
    assert comm == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 6: 4}
    best = {r["node"]: r["community"] for r in gr.communities(e).collect()}
    assert best == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 6: 4}


def test_shared_item_edges_brute_force(spark):
    import itertools
    import random

    rng = random.Random(3)
    sets = {u: {rng.randrange(12) for _ in range(rng.randint(1, 8))} | {100} for u in range(30)}
    rows = [(u, i) for u, items in sets.items() for i in items]
    inc = spark.createDataFrame(rows, "basket long, item long")
    for thre in (2, 4):
        got = {(r["src"], r["dst"]): r["shared"] for r in gr.shared_item_edges(inc, thre).collect()}
        want = {(a, b): len(sets[a] & sets[b]) for a, b in itertools.combinations(sorted(sets), 2)
                if len(sets[a] & sets[b]) >= thre}
        assert got == want


def girvan_newman_brute(edges):
    """Full Girvan-Newman in plain Python: best-modularity partition over all removals."""
    orig = {tuple(sorted(e)) for e in edges}
    nodes = sorted({v for e in orig for v in e})
    m = len(orig)
    deg = {v: 0 for v in nodes}
    for a, b in orig:
        deg[a] += 1
        deg[b] += 1

    def labels_of(cur):
        lab = {v: v for v in nodes}
        changed = True
        while changed:
            changed = False
            for a, b in cur:
                low = min(lab[a], lab[b])
                if lab[a] != low or lab[b] != low:
                    lab[a] = lab[b] = low
                    changed = True
        return lab

    def score(lab):
        inside, dsum = {}, {}
        for a, b in orig:
            if lab[a] == lab[b]:
                inside[lab[a]] = inside.get(lab[a], 0) + 1
        for v in nodes:
            dsum[lab[v]] = dsum.get(lab[v], 0) + deg[v]
        return sum(inside.get(c, 0) / m - (d / (2 * m)) ** 2 for c, d in dsum.items())

    cur = set(orig)
    best = labels_of(cur)
    best_q = score(best)
    while cur:
        eb = brandes(sorted(cur))
        mx = max(eb.values())
        cur = {e for e in cur if eb[e] < mx * (1 - gr.TIE_TOLERANCE)}
        lab = labels_of(cur)
        q = score(lab)
        if q > best_q + 1e-12:
            best, best_q = lab, q
    return best


def test_communities_full_sequence_brute_force(spark):
    import random

    rng = random.Random(11)
    pairs = set()
    for lo, hi in ((0, 9), (9, 16), (20, 26)):           # three dense groups ...
        for _ in range(2 * (hi - lo)):
            a, b = rng.randrange(lo, hi), rng.randrange(lo, hi)
            if a != b:
                pairs.add((min(a, b), max(a, b)))
    pairs |= {(3, 12), (8, 10), (30, 31), (31, 32)}     # ... bridges and a path
    want = girvan_newman_brute(pairs)
    got = {r["node"]: r["community"] for r in gr.communities(_edges(spark, sorted(pairs))).collect()}
    assert got == want


def test_communities_with_ties_across_components(spark):
    one = [(1, 2), (2, 3), (1, 3), (3, 4), (4, 5), (5, 6), (4, 6), (6, 7)]
    cycle = [(20, 21), (21, 22), (22, 23), (20, 23)]
    pairs = one + [(a + 100, b + 100) for a, b in one] + cycle + [(50, 51), (51, 52)]
    got = {r["node"]: r["community"] for r in gr.communities(_edges(spark, pairs)).collect()}
    assert got == girvan_newman_brute(pairs)


@pytest.mark.parametrize("seed", [3, 4])
def test_communities_sql_is_the_whole_sequence(seed):
    import random

    import duckdb

    from basketry.plans import ORACLE

    rng = random.Random(seed)
    pairs = {tuple(sorted(rng.sample(range(lo, lo + 7), 2))) for lo in (0, 7, 20) for _ in range(12)} | {(3, 9), (40, 41)}
    con = duckdb.connect()
    con.execute("CREATE TABLE orders (o_orderkey BIGINT, o_custkey BIGINT)")
    con.execute("CREATE TABLE lineitem (l_orderkey BIGINT, l_partkey BIGINT)")
    for k, (a, b) in enumerate(sorted(pairs)):  # every edge is two parts that only its ends have
        for at, v in ((2 * k, a), (2 * k + 1, b)):
            con.execute("INSERT INTO orders VALUES (?, ?)", [at, v])
            con.execute("INSERT INTO lineitem VALUES (?, ?), (?, ?)", [at, 2 * k, at, 2 * k + 1])
    assert dict(con.execute(ORACLE["communities"]).fetchall()) == girvan_newman_brute(pairs)


def test_communities_of_large_parts_go_through_rounds(spark, monkeypatch):
    """Parts above the bound of a task are split by distributed rounds, with the same result."""
    one = [(1, 2), (2, 3), (1, 3), (3, 4), (4, 5), (5, 6), (4, 6), (6, 7)]
    cycle = [(20, 21), (21, 22), (22, 23), (20, 23)]
    pairs = one + [(a + 100, b + 100) for a, b in one] + cycle + [(50, 51), (51, 52)]
    most = []
    whole = gr.edge_betweenness
    monkeypatch.setattr(gr, "edge_betweenness", lambda e, labels=None: most.append(e.count()) or whole(e, labels))
    monkeypatch.setattr(gr, "TASK_WORK", 100, raising=False)
    got = {r["node"]: r["community"] for r in gr.communities(_edges(spark, pairs)).collect()}
    assert got == girvan_newman_brute(pairs)
    assert most and most[0] == 16


def test_empty_graph(spark):
    e = _edges(spark, [(1, 2)]).limit(0)
    assert gr.connected_components(e).count() == 0
    assert gr.edge_betweenness(e).count() == 0
    assert gr.communities(e).count() == 0


def test_sources_in_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(gr, "SOURCE_BLOCK", 2)
    got = {(r["src"], r["dst"]): r["betweenness"] for r in gr.edge_betweenness(_edges(spark, TWO_TRIANGLES)).collect()}
    want = brandes(TWO_TRIANGLES)
    assert set(got) == set(want) and all(got[k] == pytest.approx(want[k]) for k in want)


def _golden(name):
    found = glob.glob(f"{REFERENCE}/**/{name}", recursive=True)
    if not found:
        pytest.skip("golden file not present")
    return found[0]


def _golden_edges():
    path = _golden("out2a.txt")
    out = []
    with open(path) as f:
        for line in f:
            left, val = line.rsplit(",", 1)
            a, b = [x.strip().strip("'") for x in left.strip().strip("()").split(",")]
            out.append((a, b, float(val)))
    return out


def test_golden_edge_betweenness(spark):
    gold = _golden_edges()
    e = spark.createDataFrame([(a, b) for a, b, _ in gold], "src string, dst string")
    got = {(r["src"], r["dst"]): r["betweenness"] for r in gr.edge_betweenness(e).collect()}
    for a, b, v in gold:
        key = (min(a, b), max(a, b))
        assert got[key] == pytest.approx(v, rel=1e-6)


def test_golden_communities(spark):
    gold = _golden_edges()
    path = _golden("out2b.txt")
    want = set()
    with open(path) as f:
        for line in f:
            want.add(tuple(x.strip().strip("'") for x in line.strip().split(",")))
    e = spark.createDataFrame([(a, b) for a, b, _ in gold], "src string, dst string")
    lab = gr.communities(e).collect()
    groups = {}
    for r in lab:
        groups.setdefault(r["community"], []).append(r["node"])
    got = {tuple(sorted(v)) for v in groups.values()}
    assert got == want


def test_blocks_of_small_components_share_calls(spark, monkeypatch):
    # 60 triangles with tails: as many tasks as packs, not one, and several components in a call
    edges = [(10 * k + a, 10 * k + b) for k in range(60) for a, b in ((0, 1), (0, 2), (1, 2), (2, 3))]
    monkeypatch.setattr(gr, "PACK_EDGES", 40)
    assert gr._packed(spark.createDataFrame(edges, "src long, dst long"), ["src"], 6, "p").rdd.getNumPartitions() == 6
    found = {(r.src, r.dst): r.betweenness for r in gr.edge_betweenness(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert found == pytest.approx(brandes(edges))
    labels = {r.node: r.community for r in gr.communities(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert len(labels) == 240 and all(c // 10 == v // 10 for v, c in labels.items())


def test_light_pairs_counted_in_steps(spark, monkeypatch):
    # steps of few lists and pairs, users whose pairs are counted by row, and names as ids
    import random
    from collections import Counter
    from itertools import combinations

    from basketry.operators import cooccurrence as co

    rng = random.Random(4)
    rows = sorted({(f"u{rng.randrange(30)}", rng.randrange(60)) for _ in range(500)} | {("u7", i) for i in range(50)})
    users: dict = {}
    for u, i in rows:
        users.setdefault(i, set()).add(u)
    want = Counter(p for us in users.values() for p in combinations(sorted(us), 2))
    df = spark.createDataFrame(rows + rows[:20], "basket string, item long")
    for steps in ((512, 1 << 20, 65_536), (3, 5, 65_536), (3, 5, 20)):
        for name, value in zip(("STEP_LISTS", "STEP_PAIRS", "BUSY"), steps):
            monkeypatch.setattr(co, name, value)
        monkeypatch.setattr(co, "PART_PAIRS", 300)
        for thre in (1, 4):
            found = [((r.src, r.dst), r.shared) for r in co.shared_counts(df, thre).collect()]
            assert len(found) == len(dict(found)) and dict(found) == {p: n for p, n in want.items() if n >= thre}
