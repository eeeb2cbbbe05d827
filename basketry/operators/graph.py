"""Graph operators over an undirected, unweighted edge DataFrame ``(src, dst)``.

Edges are stored once with ``src < dst``; ``adjacency`` gives both
directions.  Every iterative operator checkpoints its state once per round
in the reliable checkpoint folder (``spark.checkpoint.dir``), so plans do not
grow with the number of rounds and a lost executor never replays earlier
rounds.  The driver loop only reads one number per round.

* ``shared_item_edges``: users that share at least ``thre`` items (exact,
  light items by their lists, heavy ones by blocked products).
* ``connected_components``: least node id per component.
* ``edge_betweenness``: Brandes' algorithm, the sources of a component dealt
  into blocks, those of a giant one followed level by level; halved (each
  unordered pair once).
* ``modularity`` / ``communities``: Girvan-Newman divisive clustering that
  keeps the partition of largest modularity (computed on the original graph).
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry.operators.cooccurrence import shared_counts, threshold_for
from basketry.operators.paths import level_credits
from basketry.session import Scope, cut_lineage

#: Relative tolerance under which two betweenness values count as tied.
TIE_TOLERANCE = 1e-9


# --- construction --------------------------------------------------------------

def normalize_edges(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """Distinct undirected edges ``(src, dst)`` with ``src < dst``; self loops dropped."""
    e = edges.select(F.col(src).alias("a"), F.col(dst).alias("b")).where(
        F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
    return e.select(F.least("a", "b").alias("src"), F.greatest("a", "b").alias("dst")).distinct()


def adjacency(edges: DataFrame) -> DataFrame:
    """Both directions of every edge: ``(src, dst)``."""
    return edges.select("src", "dst").unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))


def nodes_of(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("src").alias("node")).unionByName(edges.select(F.col("dst").alias("node"))).distinct()


def shared_item_edges(inc: DataFrame, thre: int, user: str = "basket", item: str = "item") -> DataFrame:
    """``(src, dst, shared)``: users sharing at least ``thre`` distinct items, counted exactly (``cooccurrence``)."""
    return shared_counts(inc, thre, user, item)


def shared_item_graph(inc: DataFrame, per_edge: int = 40, user: str = "basket", item: str = "item") -> DataFrame:
    """``(src, dst, shared)`` from a threshold that the overlap counts give.

    The largest number of shared items that at least one pair per
    ``per_edge`` users reaches, and no fewer than two, so the graph does not
    thin out as the data grow; one counting of pairs serves both.
    """
    with Scope() as scope:
        rows = scope.table(inc.select(user, item).where(F.col(user).isNotNull() & F.col(item).isNotNull()).distinct())
        counts = scope.adopt(shared_counts(rows, 2, user, item, prepared=True))
        users = rows.select(user).distinct().count()
        thre = threshold_for(counts, -(-users // per_edge))
        return cut_lineage(counts if thre is None else counts.where(F.col("shared") >= thre))


# --- components ------------------------------------------------------------------

def _star(e: DataFrame, large: bool) -> DataFrame:
    """One large-star or small-star step on edges ``(a, b)``, ``a > b``."""
    both = e.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if large:
        both = both.unionByName(e.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    hit = both.join(least, "u")
    if large:
        hit = hit.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        hit = hit.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(
            least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return hit.where("a != b").distinct()


def connected_components(edges: DataFrame, nodes: DataFrame | None = None) -> DataFrame:
    """``(node, component)`` with component = least node id of its component.

    Alternating large-star and small-star steps until the edges are stable:
    each points the neighbours of a node at the least node around it.  A step
    is a partial/final minimum per node and one join on the node, so neither
    a hub nor a giant component is gathered or joined on its label.
    ``nodes`` adds isolated nodes (their own component).
    """
    marks = {"x": F.coalesce(F.bit_xor(F.xxhash64("a", "b")), F.lit(0)),
             "s": F.coalesce(F.sum(F.pmod(F.xxhash64("b", "a"), F.lit(1 << 31))), F.lit(0))}
    with Scope() as scope:
        e = normalize_edges(edges).select(F.col("dst").alias("a"), F.col("src").alias("b"))
        cur, now = scope.counted(e, **marks)
        ends = cur.select(F.col("a").alias("node")).unionByName(cur.select(F.col("b").alias("node")))
        base = (ends if nodes is None else ends.unionByName(nodes.select("node"))).distinct()
        base = scope.table(base)
        while now["n"]:
            nxt, new = scope.counted(_star(_star(cur, True), False), **marks)
            stable = all(new[k] == now[k] for k in ("n", "x", "s"))
            scope.drop(cur)
            cur, now = nxt, new
            if stable:
                break
        return cut_lineage(base.join(cur.select(F.col("a").alias("node"), F.col("b").alias("component")), "node", "left")
                           .select("node", F.coalesce("component", "node").alias("component")))


# --- betweenness -----------------------------------------------------------------

#: Sources of a block at least, edges of a component that a task may hold, and edges (once per source) that a block asks for.
SOURCE_BLOCK, TASK_EDGES, BLOCK_WORK = 64, 1_000_000, 32_000_000
#: Edges (each once per source block) that small components are packed to, for one call in a task; tasks at most.
PACK_EDGES, PACK_TASKS = 1024, 4096
#: Edges of whole components that a call strips, and nodes and edges (once per source) that paths are followed over in one go.
STRIP_EDGES, STEP_STATE = 65_536, 250_000


def _packed(df: DataFrame, keys: list[str], packs: int, name: str) -> DataFrame:
    """``df`` laid out by ``name``, the pack that the hash of ``keys`` gives; as many tasks as packs, up to PACK_TASKS."""
    # the number of tasks is named, so that small tables of much work stay spread
    return df.withColumn(name, F.pmod(F.xxhash64(*keys), F.lit(packs)).cast("int")).repartition(min(packs, PACK_TASKS), name)


def _from_source(around: dict, s) -> dict:
    """The credit of each edge on the shortest paths from ``s``; ``around`` maps a node to ``(neighbour, edge)``."""
    far, paths, order = {s: 0}, {s: 1.0}, [s]
    for v in order:
        for w, _ in around.get(v, ()):
            if w not in far:
                far[w] = far[v] + 1
                paths[w] = 0.0
                order.append(w)
            if far[w] == far[v] + 1:
                paths[w] += paths[v]
    owed = dict.fromkeys(order, 0.0)
    out = {}
    for w in reversed(order):
        for v, e in around.get(w, ()):
            if far[v] == far[w] - 1:
                out[e] = part = paths[v] / paths[w] * (1.0 + owed[w])
                owed[v] += part
    return out


def _around(ends, which) -> dict:
    out: dict = {}
    for e in which:
        a, b = ends[e]
        out.setdefault(a, []).append((b, e))
        out.setdefault(b, []).append((a, e))
    return out


def _stripped(edges):
    """Whole components without the trees that hang off their cycles.

    An edge of such a tree parts its component in two, so its credit is known
    (``core`` false); the other edges come with the numbers of nodes that
    their ends stand for, ``w1`` and ``w2``: themselves and what hung there.
    """
    import numpy as np
    import pandas as pd

    m = len(edges)
    ends, _ = pd.factorize(pd.concat([edges["src"], edges["dst"]], ignore_index=True))
    a, b = ends[:m], ends[m:]
    of = np.zeros(ends.max() + 1, np.int64)
    of[a] = of[b] = pd.factorize(edges["component"])[0]
    total, size = np.bincount(of)[of], np.ones(len(of), np.int64)
    degree, link = np.bincount(ends), np.zeros(len(of), np.int64)  # edges left at a node, and the sum of their numbers
    np.add.at(link, ends, np.tile(np.arange(m), 2))
    credit, core = np.zeros(m), np.ones(m, bool)
    leaves = np.flatnonzero(degree == 1)
    while len(leaves):
        e, one = np.unique(link[leaves], return_index=True)  # the last edge of a tree has two leaves
        leaves = leaves[one]
        top, s = a[e] + b[e] - leaves, size[leaves]
        credit[e], core[e] = 2.0 * s * (total[leaves] - s), False
        np.add.at(size, top, s)
        np.subtract.at(link, top, e)
        np.subtract.at(degree, top, 1)
        degree[leaves] = 0
        leaves = np.unique(top[degree[top] == 1])
    return pd.DataFrame({"component": edges["component"], "src": edges["src"], "dst": edges["dst"], "w1": size[a], "w2": size[b], "core": core, "c": credit})


def _credits(key, edges, sources):
    """Credits of each edge of the blocks of a pack: in a block, from some of the nodes of its component.

    The sources of a few blocks go together: a place is a source and a node,
    a step follows all edges from the places that the one before has reached.
    """
    import numpy as np
    import pandas as pd

    edges = edges.drop_duplicates(["src", "dst"])  # blocks of one component have the same
    m = len(edges)
    ends, names = pd.factorize(pd.concat([edges["src"], edges["dst"]], ignore_index=True))
    n = len(names)
    weight = np.zeros(n)
    weight[ends] = np.concatenate([edges["w1"], edges["w2"]])
    by = np.argsort(ends, kind="stable")
    to, number = np.roll(ends, m)[by], by % max(1, m)
    degrees = np.bincount(ends, minlength=n)
    begin = np.cumsum(degrees) - degrees
    starts = pd.Index(names).get_indexer(sources["node"])
    credit = np.zeros(m)
    at_once = max(1, STEP_STATE // max(1, n + 2 * m))
    for lo in range(0, len(starts), at_once):
        some = starts[lo:lo + at_once]
        reached, paths, mark = np.zeros(n * len(some), bool), np.zeros(n * len(some)), np.zeros(n * len(some), np.int64)
        front = np.arange(len(some)) * n + some
        reached[front], paths[front] = True, 1.0
        steps = []
        while len(front):
            node = front % n
            d = degrees[node]
            which = np.arange(d.sum()) + np.repeat(begin[node] - (np.cumsum(d) - d), d)
            met = np.repeat(front - node, d) + to[which]
            new = np.flatnonzero(~reached[met])
            frm, e, met = np.repeat(front, d)[new], number[which[new]], met[new]
            np.add.at(paths, met, paths[frm])
            reached[met] = True
            mark[met] = np.arange(len(met))
            front = met[mark[met] == np.arange(len(met))]
            steps.append((frm, e, met))
        owed = np.tile(weight, len(some))
        for frm, e, met in reversed(steps):
            part = paths[frm] / paths[met] * owed[met]
            np.add.at(owed, frm, part)
            np.add.at(credit, e, part * weight[some[frm // n]])
    return pd.DataFrame({"src": edges["src"], "dst": edges["dst"], "c": credit})


def edge_betweenness(edges: DataFrame, labels: DataFrame | None = None, task_edges: int | None = None) -> DataFrame:
    """``(src, dst, betweenness)`` for every edge (``src < dst``).

    Brandes' algorithm with every node as a source.  A component of at most
    ``task_edges`` edges: a task strips the trees that hang off its cycles,
    whose edges need no paths; the nodes left, which stand for their trees,
    are sources, dealt into blocks of equal work, and a task holds the edges
    left and follows the shortest paths from one block; blocks of few edges
    are packed, so that a call serves many of them.  A larger component is
    never held by a task: its paths are followed level by level with joins
    (``paths.level_credits``).  Credits are added up per edge.  ``labels`` are
    the components where the caller knows them.
    """
    most = TASK_EDGES if task_edges is None else task_edges
    with Scope() as scope:
        edges = scope.table(normalize_edges(edges))
        labels = scope.adopt(connected_components(edges)) if labels is None else labels
        of = scope.table(edges.join(labels.select(F.col("node").alias("src"), "component"), "src"))
        sizes = of.groupBy("component").agg(F.count(F.lit(1)).alias("e"))
        giant = scope.table(sizes.where(F.col("e") > most).select("component"))
        parts = []
        if not giant.isEmpty():
            big = of.join(giant, "component", "left_semi").select("src", "dst")
            parts += [scope.adopt(c) for c in level_credits(scope.table(big), scope.table(labels.join(giant, "component", "left_semi")))]
            of = of.join(giant, "component", "left_anti")
        kind = edges.schema["src"].dataType.simpleString()
        label = labels.schema["component"].dataType.simpleString()
        packs = max(1, -(-edges.count() // STRIP_EDGES))
        stripped = scope.table(_packed(of.select("component", "src", "dst"), ["component"], packs, "pack").groupBy("pack").applyInPandas(
            _stripped, f"component {label}, src {kind}, dst {kind}, w1 long, w2 long, core boolean, c double"))
        parts.append(stripped.where("not core").select("src", "dst", "c"))
        held = stripped.where("core").drop("core", "c")
        nodes = held.select("component", F.col("src").alias("node")).unionByName(held.select("component", F.col("dst").alias("node"))).distinct()
        sizes = scope.table(nodes.groupBy("component").agg(F.count(F.lit(1)).alias("n")).join(
            held.groupBy("component").agg(F.count(F.lit(1)).alias("e")), "component").select(
            "component", "e", F.ceil(F.col("n") / F.greatest(F.lit(float(SOURCE_BLOCK)), F.lit(BLOCK_WORK) / F.col("e"))).cast("int").alias("nb")))
        sources = nodes.join(sizes, "component").select("component", "node", F.pmod(F.xxhash64("node"), F.col("nb")).cast("int").alias("blk"))
        copied = held.join(sizes.drop("e"), "component").withColumn("blk", F.explode(F.sequence(F.lit(0), F.col("nb") - 1))).drop("nb")
        packs = max(1, -(-(sizes.agg(F.sum(F.col("nb") * F.least("e", F.lit(PACK_EDGES)))).first()[0] or 0) // PACK_EDGES))
        copied = _packed(copied, ["component", "blk"], packs, "pack")
        sources = _packed(sources.toDF("_c", "node", "_b"), ["_c", "_b"], packs, "_p")  # names of its own: both sides come from the same labels
        parts.append(copied.groupBy("pack").cogroup(sources.groupBy("_p")).applyInPandas(
            _credits, f"src {kind}, dst {kind}, c double"))
        return cut_lineage(_union(parts).groupBy("src", "dst").agg((F.sum("c") / 2).alias("betweenness")))


# --- modularity and communities --------------------------------------------------

def modularity(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """One-row ``(modularity)``: sum over communities of ``L_c/m - (d_c/2m)^2``.

    ``edges`` is the graph the score refers to (the original one in
    Girvan-Newman); ``labels`` maps every node to a community.
    """
    edges = cut_lineage(normalize_edges(edges))
    return modularity_of(edges, node_degrees(edges), edges.count(), labels)


def node_degrees(edges: DataFrame) -> DataFrame:
    """``(node, deg)`` of normalized edges."""
    return adjacency(edges).groupBy(F.col("src").alias("node")).agg(F.count(F.lit(1)).alias("deg"))


def modularity_of(edges: DataFrame, deg: DataFrame, m_val: int, labels: DataFrame) -> DataFrame:
    """``modularity`` with the degrees and edge count of the graph given (computed once by loops)."""
    lab = labels.select("node", F.col("component").alias("c"))
    inside = (edges.join(lab.select(F.col("node").alias("src"), F.col("c").alias("c1")), "src")
              .join(lab.select(F.col("node").alias("dst"), F.col("c").alias("c2")), "dst")
              .where(F.col("c1") == F.col("c2")).groupBy(F.col("c1").alias("c"))
              .agg(F.count(F.lit(1)).alias("l")))
    per_c = (deg.join(lab, "node").groupBy("c").agg(F.sum("deg").alias("d"))
             .join(inside, "c", "left").fillna(0, subset=["l"]))
    return per_c.agg(F.sum(F.col("l") / m_val - F.pow(F.col("d") / (2 * m_val), 2)).alias("modularity"))


def remove_top_edges(current: DataFrame, eb: DataFrame) -> DataFrame:
    """Drop every edge whose betweenness ties the maximum (relative tolerance)."""
    mx = eb.agg(F.max("betweenness")).scalar()
    top = eb.where(F.col("betweenness") >= mx * (1 - TIE_TOLERANCE)).select("src", "dst")
    return current.join(top, ["src", "dst"], "left_anti")


def split_round(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One Girvan-Newman round: ``(remaining_edges, labels)``."""
    edges = cut_lineage(normalize_edges(edges))
    nodes = nodes_of(edges)
    remaining = cut_lineage(remove_top_edges(edges, edge_betweenness(edges)))
    return remaining, connected_components(remaining, nodes)


class Credits:
    """Credits of the edges of a part, kept up to date while edges go.

    ``users`` is an index from an edge to the sources that have it on a
    shortest path; after a removal only those run again (the distances and
    path counts of all others are what they were).  ``ran`` counts the
    sources that have run.
    """

    def __init__(self, nodes, around: dict) -> None:
        self.by_source: dict = {}
        self.users: dict = {}
        self.credit: dict = {}
        self.ran = 0
        self._run(nodes, around)

    def _run(self, sources, around: dict) -> None:
        for s in sources:
            found = self.by_source[s] = _from_source(around, s)
            self.ran += 1
            for e, c in found.items():
                self.users.setdefault(e, set()).add(s)
                self.credit[e] = self.credit.get(e, 0.0) + c

    def remove(self, gone, around: dict) -> None:
        """Edges ``gone`` are no more; ``around`` is what is left."""
        again = set().union(*[self.users[e] for e in gone])
        if len(again) == len(self.by_source):  # nothing to keep: start afresh
            self.by_source, self.users, self.credit = {}, {}, {}
        for s in again & self.by_source.keys():
            for e, c in self.by_source[s].items():
                self.credit[e] -= c
                self.users[e].discard(s)
        for e in gone:
            self.credit.pop(e, None)
            self.users.pop(e, None)
        self._run(sorted(again), around)

    def within(self, nodes, edges) -> "Credits":
        """The credits of a part that has come apart from the others."""
        out = Credits((), {})
        out.by_source = {s: self.by_source[s] for s in nodes}
        out.users = {e: self.users[e] for e in edges}
        out.credit = {e: self.credit[e] for e in edges}
        return out


def _sequence(m: int):
    """The removals of the parts of a pack: how each falls apart further, under the keys that order them."""
    def run(packed):
        import pandas as pd

        rows: list[tuple] = []
        for _, edges in packed.groupby("part", sort=False):
            rows += removals(edges)
        return pd.DataFrame(rows, columns=["node", "component", "step", "key", "dq"]).astype({"node": object, "component": object})

    def removals(edges) -> list[tuple]:
        ends = list(zip(edges["src"].tolist(), edges["dst"].tolist()))
        degree: dict = {}
        for (a, b), da, db in zip(ends, edges["src_deg"].tolist(), edges["dst_deg"].tolist()):
            degree[a], degree[b] = da, db

        def share(inside: int, nodes) -> float:
            return inside / m - (sum(degree[v] for v in nodes) / (2 * m)) ** 2

        rows: list[tuple] = []
        present = [e for e, x in enumerate(edges["present"].tolist()) if x]
        # (nodes, edges left, original edges inside, removals on the way, key so far)
        first = Credits(list(degree), _around(ends, present))
        todo = [(list(degree), present, list(range(len(ends))), int(edges["step"].iloc[0]), list(edges["key"].iloc[0]), first)]
        while todo:
            nodes, left, own, step, way, known = todo.pop()
            credit = known.credit
            top = max(credit[e] for e in left) / 2
            step += 1
            way = [x for x in way if -x <= round(top, 7)] + [-round(top, 7)]
            gone = [e for e in left if credit[e] / 2 >= top * (1 - TIE_TOLERANCE)]
            left = [e for e in left if credit[e] / 2 < top * (1 - TIE_TOLERANCE)]
            known.remove(gone, _around(ends, left))
            around = _around(ends, left)
            part: dict = {}
            for v in sorted(nodes):
                if v not in part:
                    part[v] = v
                    reach = [v]
                    for x in reach:
                        for y, _ in around.get(x, ()):
                            if y not in part:
                                part[y] = v
                                reach.append(y)
            parts: dict = {}
            for v in nodes:
                parts.setdefault(part[v], ([], [], []))[0].append(v)
            for e in left:
                parts[part[ends[e][0]]][1].append(e)
            for e in own:
                if part[ends[e][0]] == part[ends[e][1]]:
                    parts[part[ends[e][0]]][2].append(e)
            if len(parts) > 1:
                was = min(nodes)
                rows += [(v, c, step, way, None) for c, (of, _, _) in parts.items() if c != was for v in of]
                gain = sum(share(len(inside), of) for of, _, inside in parts.values()) - share(len(own), nodes)
                rows.append((None, None, step, way, gain))
            todo += [(of, rest, inside, step, way, known.within(of, rest)) for of, rest, inside in parts.values() if rest]
        return rows

    return run


#: Nodes times squared edges of a part that one task takes apart to the end; larger parts go through rounds.
TASK_WORK = 100_000_000


def _shares(nodes: DataFrame, own: DataFrame, m: int) -> DataFrame:
    """``(part, share)``: what each part adds to the modularity."""
    inside = own.groupBy("part").agg(F.count(F.lit(1)).alias("l"))
    return nodes.groupBy("part").agg(F.sum("deg").alias("d")).join(inside, "part", "left").select(
        "part", (F.coalesce("l", F.lit(0)) / m - F.pow(F.col("d") / (2 * m), 2)).alias("share"))


def _split_parts(scope: Scope, nodes: DataFrame, own: DataFrame, m: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """One removal in every part: the nodes and edges after it, and what it changes (rows as of ``_sequence``).

    Betweenness runs in source blocks, components in star steps, the rest is
    joins and sums by part: no task holds more than ``edge_betweenness`` asks.
    """
    left = own.where("present").select("src", "dst")
    eb = scope.adopt(edge_betweenness(left, nodes.select("node", F.col("part").alias("component"))))
    scored = own.join(eb, ["src", "dst"], "left")
    top = scope.table(scored.groupBy("part").agg(F.max("betweenness").alias("top")))
    low = scored.join(top, "part").withColumn("present", F.coalesce(
        F.col("betweenness") < F.col("top") * (1 - TIE_TOLERANCE), F.lit(False))).drop("betweenness", "top")
    low = scope.table(low)
    labels = scope.adopt(connected_components(low.where("present").select("src", "dst"), nodes.select("node")))
    score = F.bround("top", 7)
    after = scope.table(
        nodes.join(top, "part").join(labels, "node").select(
            "node", F.col("part").alias("was"), F.col("component").alias("part"), "deg", (F.col("step") + 1).alias("step"),
            F.concat(F.filter("key", lambda x: -x <= score), F.array(-score)).alias("key")))
    src = labels.select(F.col("node").alias("src"), F.col("component").alias("part"))
    dst = labels.select(F.col("node").alias("dst"), F.col("component").alias("_other"))
    inside = scope.table(low.drop("part").join(src, "src").join(dst, "dst").where("part = _other").drop("_other"))
    family = after.select("was", "part", "step", "key").distinct()
    gains = family.join(_shares(after, inside, m), "part").groupBy("was").agg(
        F.count(F.lit(1)).alias("n"), F.sum("share").alias("now"), F.min("step").alias("step"), F.min("key").alias("key"))
    before = _shares(nodes, own, m).withColumnsRenamed({"part": "was", "share": "then"})
    gains = gains.where("n > 1").join(before, "was")
    kind = nodes.schema["node"].dataType
    none = F.lit(None).cast(kind)
    changes = after.where("part != was").select(
        "node", F.col("part").alias("component"), "step", "key", F.lit(None).cast("double").alias("dq")).unionByName(
        gains.select(none.alias("node"), none.alias("component"), "step", "key", (F.col("now") - F.col("then")).alias("dq")))
    return after.drop("was"), inside, scope.table(changes)


def _running_total(scope: Scope, df: DataFrame, order: str, value: str, name: str) -> DataFrame:
    """Running total of ``value`` in the order of unique ``order``: sums within ranges, and one row per range before them."""
    laid = scope.table(df.repartitionByRange(order).withColumn("_pid", F.spark_partition_id()))
    sizes = laid.groupBy("_pid").agg(F.sum(value).alias("_n"))
    offsets = sizes.select("_pid", F.coalesce(F.sum("_n").over(
        Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)).alias("_off"))
    within = Window.partitionBy("_pid").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return laid.withColumn("_in", F.sum(value).over(within)).join(offsets, "_pid").select(
        order, (F.col("_off") + F.col("_in")).alias(name))


def communities(edges: DataFrame) -> DataFrame:
    """``(node, community)`` of the best-modularity Girvan-Newman partition, over the whole sequence.

    Parts do not influence each other's scores, so each is taken apart on
    its own: its top edges (ties together) go until none is left.  Parts of
    more than TASK_WORK lose theirs in rounds, all of them at once, with the
    source blocks of ``edge_betweenness`` and joins; smaller ones are taken
    apart to the end in a task each.  The one-by-one sequence over all parts
    is then restored by sorting: it always takes the highest score on offer,
    so a removal with scores p1, ..., pk on its way (its own last) comes in
    the order of the suffix minima of that way, higher first, a shorter way
    before its extensions; removals with equal keys share a step.  Modularity
    is a sum over parts, so running totals of the changes in that order give
    its value after each step, and each node takes the part it is in after
    the best one.

    The sequence of a part is one removal after the other by nature: a
    component of many edges takes as many rounds as it has distinct top scores.
    """
    with Scope() as scope:
        edges = scope.table(normalize_edges(edges))
        m = edges.count()
        kind = edges.schema["src"].dataType.simpleString()
        schema = f"node {kind}, component {kind}, step int, key array<double>, dq double"
        deg = scope.table(node_degrees(edges))
        labels = scope.adopt(connected_components(edges))
        nodes = scope.table(labels.join(deg, "node").select(
            "node", F.col("component").alias("part"), F.col("deg"), F.lit(0).alias("step"),
            F.array().cast("array<double>").alias("key")))
        own = scope.table(edges.join(labels.select(F.col("node").alias("src"), F.col("component").alias("part")), "src").select(
            "src", "dst", F.lit(True).alias("present"), "part"))
        none = F.lit(None).cast(kind)
        start = nodes.select("node", F.col("part").alias("component"), "step", "key", F.lit(None).cast("double").alias("dq"))
        first = _shares(nodes, own, m).select(none.alias("node"), none.alias("component"), F.lit(0).alias("step"),
                                              F.array().cast("array<double>").alias("key"), F.col("share").alias("dq"))
        taken = [scope.table(start.unionByName(first))]
        ready: list[DataFrame] = []

        def few(frames: list[DataFrame]) -> list[DataFrame]:
            """Many small tables as one, so that plans do not grow with the rounds."""
            if len(frames) < 16:
                return frames
            one = scope.table(_union(frames))
            for f in frames:
                scope.drop(f)
            return [one]

        while True:
            # a part without edges is a single node and done
            sizes = nodes.groupBy("part").agg(F.count(F.lit(1)).alias("n")).join(
                own.groupBy("part").agg(F.count_if("present").alias("e")), "part")
            sizes, _ = scope.counted(sizes.select("part", (F.col("n") * F.col("e") * F.col("e") > TASK_WORK).alias("large")))
            small, large = (sizes.where(c).select("part") for c in ("not large", "large"))
            around = nodes.select("node", "part", "deg", "step", "key").join(small, "part", "left_semi")
            ready = few([*ready, scope.table(
                own.join(around.select(F.col("node").alias("src"), F.col("deg").alias("src_deg"), "step", "key"), "src")
                .join(around.select(F.col("node").alias("dst"), F.col("deg").alias("dst_deg")), "dst"))])
            if large.isEmpty():
                break
            big_nodes = scope.table(nodes.join(large, "part", "left_semi"))
            big_own = scope.table(own.join(large, "part", "left_semi"))
            with Scope() as inner:
                after, inside, changes = _split_parts(inner, big_nodes, big_own, m)
                nxt = [scope.table(x) for x in (after, inside, changes)]
            for f in (nodes, own, sizes, big_nodes, big_own):
                scope.drop(f)
            nodes, own = nxt[:2]
            taken = few([*taken, nxt[2]])
        ready = _union(ready)
        packs = max(1, -(-ready.count() // PACK_EDGES))
        ends = _packed(ready, ["part"], packs, "_pack").groupBy("_pack").applyInPandas(_sequence(m), schema)
        taken = scope.table(_union([*taken, ends]))
        # one row per step that splits something, at most as many as nodes
        steps = taken.where("dq is not null").groupBy("key").agg(F.sum("dq").alias("dq"))
        ordered = scope.table(_running_total(scope, steps, "key", "dq", "q"))
        best = ordered.agg(F.max("q")).scalar()
        last = ordered.where(F.col("q") >= best - 1e-12).agg(F.min("key")).scalar()
        return cut_lineage(taken.where(F.col("node").isNotNull() & (F.col("key") <= last)).groupBy("node").agg(
            F.max_by("component", "step").alias("community")))


def _union(frames: list[DataFrame]) -> DataFrame:
    return functools.reduce(DataFrame.unionByName, frames)
