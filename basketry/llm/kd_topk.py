"""Exact top-k by integer inner product with KD-trees per shard.

1. Shards are cells of space: the top of a KD-tree (median splits of the
   widest dimension) is fitted on a bounded sample, every row falls into one
   cell, and a cell with more rows than a shard holds is dealt on by hash.
   Vectors with large components have shards of their own.
2. A shard's KD-tree (median splits down to LEAF rows, tight bounding boxes)
   is built once and kept with its points.  No vector of a box can score above
   the box bound, the sum of max(q * low, q * high).
3. Each query searches one shard of its own cell; its kth score there is a
   valid floor.
4. Tiles of queries meet the boxes of all shards (a kilobyte each, in blocks);
   only queries whose bound reaches their floor go on to a shard, and a shard
   is copied only to tiles that have such queries.  There the best-first
   search visits nodes in the order of their bounds and stops when the best
   bound left is below the kth score (an equal bound is visited: a smaller id
   may tie).

Rows: vectors that are null or hold null or non-finite components take no
part, nor do rows without an id; vectors of different dimensions are not
compared; rows with the query's own id are not its candidates.  Components
are floor(1024 * x) whatever their size, and scores are compared exactly: in
doubles where these hold every sum, else in whole numbers of any size.  A
score beyond a long takes part in the ranking and is null in the result.
Ties go to the smaller id, equal ids that tie are all counted.  An empty table
gives an empty result.  Other columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm import common as C
from basketry.llm.vectors import matrices, usable

#: Rows of a shard and of a tile of queries, of a leaf, and boxes that a tile meets at once.
SHARD, TILE, LEAF, BOXES = 2048, 2048, 64, 1024
#: Rows at most that the cells are fitted on (those with the least hash of their id).
FIT = 16_384
#: A vector with a component above this is in a shard of its own kind.
LARGE = 1024.0


def whole(x: np.ndarray) -> np.ndarray:
    """floor(1024 x), exactly: doubles, or Python's integers where 1024 x is beyond a double."""
    with np.errstate(over="ignore"):
        f = np.floor(x * 1024.0)
    if np.isfinite(f).all():
        return f
    return np.array([[int(v) * 1024 if abs(v) >= 2.0 ** 60 else math.floor(v * 1024.0) for v in row] for row in x.tolist()], dtype=object)


def order_key(n: int) -> bytes:
    """Bytes that sort as the integers do."""
    size = (abs(n).bit_length() + 7) // 8
    raw = size.to_bytes(2, "big") + abs(n).to_bytes(size, "big")
    return b"\1" + raw if n >= 0 else b"\0" + bytes(255 - b for b in raw)


def order_value(key: bytes) -> int:
    """The integer of an ``order_key``."""
    raw = key[1:] if key[:1] == b"\1" else bytes(255 - b for b in key[1:])
    n = int.from_bytes(raw[2:], "big")
    return n if key[:1] == b"\1" else -n


class Tree:
    """KD-tree over whole-number vectors; ``ids`` break ties."""

    def __init__(self, points: np.ndarray, ids: np.ndarray) -> None:
        order, low, high, start, stop, left, right = [], [], [], [], [], [], []
        todo = [(np.arange(len(ids)), -1, 0)]
        while todo:
            rows, parent, side = todo.pop()
            node = len(low)
            if parent >= 0:
                (left, right)[side][parent] = node
            box = points[rows]
            low.append(box.min(axis=0))
            high.append(box.max(axis=0))
            left.append(-1)
            right.append(-1)
            start.append(sum(map(len, order)))
            stop.append(start[-1])
            spread = high[-1] - low[-1]
            if len(rows) > LEAF and spread.size and spread.max() > 0:
                half = len(rows) // 2
                by = np.argpartition(box[:, int(spread.argmax())].astype(np.float64), half)
                todo += [(rows[by[half:]], node, 1), (rows[by[:half]], node, 0)]
            else:
                order.append(rows)
                stop[-1] += len(rows)
        rows = np.concatenate(order)
        self.points, self.ids = points[rows], ids[rows]
        self.low, self.high = np.array(low), np.array(high)
        self.nodes = np.array([start, stop, left, right], np.int64)

    @classmethod
    def kept(cls, x: bytes, ids: bytes, nodes: bytes, dim: int) -> "Tree":
        """A tree from what ``stored`` kept: boxes follow from the points in their order."""
        tree = cls.__new__(cls)
        tree.ids = np.frombuffer(ids, np.int64)
        tree.points = whole(np.frombuffer(x, np.float64).reshape(len(tree.ids), dim))
        tree.nodes = np.frombuffer(nodes, np.int64).reshape(4, -1)
        n = tree.nodes.shape[1]
        tree.low, tree.high = (np.zeros((n, dim), tree.points.dtype) for _ in range(2))
        for k in range(n - 1, -1, -1):  # children come after their parent
            start, stop, left, right = tree.nodes[:, k].tolist()
            if left < 0:
                part = tree.points[start:stop]
                tree.low[k], tree.high[k] = part.min(axis=0), part.max(axis=0)
            else:
                tree.low[k] = np.minimum(tree.low[left], tree.low[right])
                tree.high[k] = np.maximum(tree.high[left], tree.high[right])
        return tree

    def exact(self, queries: np.ndarray) -> bool:
        """Whether doubles hold every product sum exactly."""
        if queries.dtype == object or self.points.dtype == object:
            return False
        reach = max(np.abs(self.low).max(initial=0.0), np.abs(self.high).max(initial=0.0))
        return float(np.abs(queries).max(initial=0.0)) * float(reach) * max(1, self.points.shape[1]) < 2.0 ** 53

    def search(self, queries: np.ndarray, own: np.ndarray, floors: list[int | None], k: int):
        """``(query row, [(score, -id)])`` of the best k of each query at or above its floor."""
        if self.exact(queries):
            points, low, high, q = self.points, self.low, self.high, queries
        else:
            points, low, high, q = (_integers(m) for m in (self.points, self.low, self.high, queries))
        bounds = np.maximum(q, 0) @ high.T + np.minimum(q, 0) @ low.T
        start, stop, left, right = self.nodes.tolist()
        for i in range(len(q)):
            b = bounds[i].tolist()
            heap = [(-b[0], 0)]
            best: list[tuple] = []  # (score, -id), the worst first
            floor = floors[i]
            while heap:
                bound, node = heapq.heappop(heap)
                if floor is not None and -bound < floor:
                    break
                if left[node] >= 0:
                    for c in (left[node], right[node]):
                        if floor is None or b[c] >= floor:
                            heapq.heappush(heap, (-b[c], c))
                    continue
                scores = points[start[node]:stop[node]] @ q[i]
                hits = range(len(scores)) if floor is None else np.flatnonzero(scores >= floor).tolist()
                for at in hits:
                    item = (int(scores[at]), -int(self.ids[start[node] + at]))
                    if -item[1] == own[i]:
                        continue
                    if len(best) < k:
                        heapq.heappush(best, item)
                    elif item > best[0]:
                        heapq.heapreplace(best, item)
                if len(best) == k and (floor is None or best[0][0] > floor):
                    floor = best[0][0]
            yield i, best


def _integers(m: np.ndarray) -> np.ndarray:
    return m if m.dtype == object else np.array([[int(v) for v in row] for row in m.tolist()], dtype=object).reshape(m.shape)


# --- cells ---------------------------------------------------------------------------

def split_cells(x: np.ndarray, cells: int) -> list[tuple]:
    """The top of a KD-tree over sampled vectors: ``(dimension, value, left, right)`` or ``(-1, cell, 0, 0)``."""
    out: list[tuple] = []

    def grow(rows: np.ndarray, want: int) -> int:
        node = len(out)
        out.append((-1, 0, 0, 0))
        box = x[rows]
        spread = box.max(axis=0) - box.min(axis=0) if len(rows) > 1 and box.shape[1] else np.zeros(0)
        if want > 1 and spread.size and spread.max() > 0:
            d = int(spread.argmax())
            value = float(np.median(box[:, d]))
            under = box[:, d] < value
            if under.any():
                out[node] = (d, value, grow(rows[under], want // 2), grow(rows[~under], want - want // 2))
        return node

    grow(np.arange(len(x)), cells)
    leaves = [k for k, n in enumerate(out) if n[0] < 0]
    for cell, k in enumerate(leaves):
        out[k] = (-1, cell, 0, 0)
    return out


def _cells(splits: dict[int, list[tuple]]):
    """Rows with their dimension and cell; large vectors in cell -1."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for rows, x in matrices(C.column(b, "x")):
                tree = splits.get(x.shape[1], [(-1, 0, 0, 0)])
                at = np.zeros(len(x), np.int64)
                dim, value, left, right = (np.array(v) for v in zip(*tree))
                inner = dim[at] >= 0
                while inner.any():
                    r = np.flatnonzero(inner)
                    n = at[r]
                    at[r] = np.where(x[r, dim[n]] < value[n], left[n], right[n])
                    inner = dim[at] >= 0
                cell = value[at].astype(np.int32)
                cell[np.abs(x).max(axis=1, initial=0.0) > LARGE] = -1
                take = pa.array(rows)
                yield pa.RecordBatch.from_arrays(
                    [C.column(b, "vec_id").take(take), C.column(b, "is_query").take(take), pa.array(np.full(len(x), x.shape[1], np.int32)),
                     pa.array(cell), pa.array([v.tobytes() for v in x], pa.binary())], ["vec_id", "is_query", "dim", "cell", "x"])

    return run


PLACE = ["dim", "cell", "sub"]
_PLACE = "dim int, cell int, sub int"
_TILE = "dim int, tile int, ids binary, x binary, floors binary"
_FOUND = "query_id long, vec_id long, score long, key binary"


def _matrix(table: pa.Table, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(table.column("x").to_pylist()), np.float64).reshape(table.num_rows, dim)


def _shard(key, table):
    """One row per shard: its points and ids in the order of the tree, the tree, and its box."""
    dim = key[0].as_py()
    x, ids = _matrix(table, dim), table.column("vec_id").to_numpy()
    points = whole(x)
    tree = Tree(points, np.arange(len(ids)))
    box = np.stack([x.min(axis=0), x.max(axis=0)])
    out = {c: [k.as_py()] for c, k in zip(PLACE, key)}
    out |= {"ids": [ids[tree.ids].tobytes()], "x": [x[tree.ids].tobytes()], "nodes": [tree.nodes.tobytes()], "box": [box.tobytes()]}
    kinds = {c: pa.int32() for c in PLACE}
    return pa.table({c: pa.array(v, kinds.get(c, pa.binary())) for c, v in out.items()})


def _pack_floors(floors: list[int | None]) -> bytes:
    keys = [b"" if f is None else order_key(f) for f in floors]
    return np.array([len(x) for x in keys], np.int64).tobytes() + b"".join(keys)


def _unpack_floors(data: bytes, n: int) -> list[int | None]:
    size, at, out = np.frombuffer(data, np.int64, n).tolist(), 8 * n, []
    for s in size:
        out.append(order_value(data[at:at + s]) if s else None)
        at += s
    return out


def _tile(key, table):
    """One row per tile: its queries and their floors."""
    floors = [None if k is None else order_value(k) for k in table.column("key").to_pylist()]
    return pa.table({"dim": pa.array([key[0].as_py()], pa.int32()), "tile": pa.array([key[1].as_py()], pa.int32()),
                     "ids": pa.array([table.column("vec_id").to_numpy().tobytes()], pa.binary()),
                     "x": pa.array([b"".join(table.column("x").to_pylist())], pa.binary()),
                     "floors": pa.array([_pack_floors(floors)], pa.binary())})


def _reach(key, tiles, boxes):
    """For a tile and a block of boxes: the queries that may find something in each shard."""
    dim = key[0].as_py()
    out = {c: [] for c in (*PLACE, "tile", "ids", "x", "floors")}
    for ids, x, floors in zip(*(tiles.column(c).to_pylist() for c in ("ids", "x", "floors"))):
        ids = np.frombuffer(ids, np.int64)
        raw = np.frombuffer(x, np.float64).reshape(len(ids), dim)
        least = _unpack_floors(floors, len(ids))
        q = whole(raw)
        for cell, sub, box in zip(*(boxes.column(c).to_pylist() for c in ("cell", "sub", "box"))):
            low, high = whole(np.frombuffer(box, np.float64).reshape(2, dim))
            plain = q.dtype != object and low.dtype != object
            reach = max(np.abs(low).max(initial=0), np.abs(high).max(initial=0)) if plain else 0
            if not plain or float(np.abs(q).max(initial=0.0)) * float(reach) * max(1, dim) >= 2.0 ** 53:
                i, lo, hi = _integers(q), _integers(low[None])[0], _integers(high[None])[0]
            else:
                i, lo, hi = q, low, high
            bound = np.maximum(i, 0) @ hi + np.minimum(i, 0) @ lo
            some = [k for k, (b, f) in enumerate(zip(bound.tolist(), least)) if f is None or b >= f]
            if some:
                for c, v in zip(out, (dim, cell, sub, key[1].as_py(), ids[some].tobytes(), raw[some].tobytes(), _pack_floors([least[k] for k in some]))):
                    out[c].append(v)
    return pa.table({c: pa.array(v, pa.int32() if c in (*PLACE, "tile") else pa.binary()) for c, v in out.items()})


def _search(k: int):
    def run(key, shards, tiles):
        dim = key[0].as_py()
        out: dict[str, list] = {c: [] for c in ("query_id", "vec_id", "score", "key")}
        for s in shards.select(["x", "ids", "nodes"]).to_pylist():
            tree = Tree.kept(s["x"], s["ids"], s["nodes"], dim)
            for ids, x, floors in zip(*(tiles.column(c).to_pylist() for c in ("ids", "x", "floors"))):
                ids = np.frombuffer(ids, np.int64)
                q = whole(np.frombuffer(x, np.float64).reshape(len(ids), dim))
                for row, best in tree.search(q, ids, _unpack_floors(floors, len(ids)), k):
                    for score, other in best:
                        for c, v in zip(out, (int(ids[row]), -other, score if -(2 ** 63) <= score < 2 ** 63 else None, order_key(score))):
                            out[c].append(v)
        kinds = dict(zip(out, (pa.int64(), pa.int64(), pa.int64(), pa.binary())))
        return pa.table({c: pa.array(v, kinds[c]) for c, v in out.items()})

    return run


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, vector: str = "embedding", fit: int = FIT) -> DataFrame:
    """``(query_id, rank, vec_id, score)`` of the k best for each row that ``is_query`` marks."""
    with C.tables() as t:
        rows = vectors.where(F.col("vec_id").isNotNull() & usable(vector)).select(
            F.col("vec_id").cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("x"), is_query.alias("is_query"))
        sizes = {r.dim: r.n for r in rows.groupBy(F.size("x").alias("dim")).agg(F.count(F.lit(1)).alias("n")).collect()}
        seen = rows.select("vec_id", "x").orderBy(F.xxhash64("vec_id"), "vec_id").limit(fit).collect()  # at most ``fit`` rows
        splits = {d: split_cells(np.array([r.x for r in seen if len(r.x) == d], float).reshape(-1, d or 1)[:, :d], -(-n // SHARD))
                  for d, n in sizes.items()}
        placed = t.table(rows.mapInArrow(_cells(splits), "vec_id long, is_query boolean, dim int, cell int, x binary"))
        cells = placed.groupBy("dim", "cell").agg(F.ceil(F.count(F.lit(1)) / F.lit(2 * SHARD)).cast("int").alias("subs"))
        dealt = placed.join(cells, ["dim", "cell"]).withColumn("sub", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.col("subs")).cast("int"))
        shards = t.table(dealt.select(*PLACE, "vec_id", "x").groupBy(*PLACE).applyInArrow(
            _shard, f"{_PLACE}, ids binary, x binary, nodes binary, box binary"))
        queries = t.table(dealt.where("is_query").select(*PLACE, "vec_id", "x"))
        tiles = -(-queries.count() // TILE) or 1
        tile = F.pmod(F.xxhash64("vec_id", F.lit(3)), F.lit(tiles)).cast("int")
        tile = F.when(F.col("cell") < 0, -1 - tile).otherwise(tile)  # large queries are in tiles of their own
        # the floor: each query against its own shard
        one = queries.withColumn("tile", tile).withColumn("key", F.lit(None).cast("binary"))
        home = one.groupBy(*PLACE, "tile").applyInArrow(_home, f"{_PLACE}, {_TILE.removeprefix('dim int, ')}")
        seeds = t.table(_met(shards, t.table(home), k))
        floors = seeds.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("key")).where(F.col("n") >= k)
        floored = one.drop("key").join(floors.select(F.col("query_id").alias("vec_id"), "key"), "vec_id", "left")
        tiled = t.table(floored.select("dim", "tile", "vec_id", "x", "key").groupBy("dim", "tile").applyInArrow(_tile, _TILE))
        blocks = -(-shards.count() // BOXES) or 1
        boxes = shards.select(*PLACE, "box").withColumn("block", F.pmod(F.xxhash64(*PLACE), F.lit(blocks)).cast("int"))
        # the box of every shard to every tile, a kilobyte each (names of its own: both sides come from the same tiles)
        spread = boxes.join(tiled.select("dim", F.col("tile").alias("_tile")), "dim").withColumnsRenamed({"dim": "_dim", "block": "_block"})
        against = tiled.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
        reached = t.table(against.groupBy("dim", "tile", "block").cogroup(spread.groupBy("_dim", "_tile", "_block")).applyInArrow(
            _reach, f"{_PLACE}, tile int, ids binary, x binary, floors binary"))
        hits = _met(shards, reached, k)
        order = Window.partitionBy("query_id").orderBy(F.col("key").desc(), F.col("vec_id").asc())
        return C.staged(hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
            "query_id", "rank", "vec_id", "score"))


def _home(key, table):
    """The queries of a tile in their own shard, without floors."""
    out = _tile((key[0], key[3]), table)
    place = {c: pa.array([k.as_py()], pa.int32()) for c, k in zip(PLACE, key)}
    return pa.table({**place, **{c: out.column(c) for c in ("tile", "ids", "x", "floors")}})


def _met(shards: DataFrame, tiles: DataFrame, k: int) -> DataFrame:
    """What the queries of each tile find in the shards that they name; a shard is copied to those tiles only."""
    copied = shards.drop("box").join(tiles.select(*PLACE, F.col("tile").alias("_tile")), PLACE)
    return copied.groupBy(*PLACE, "_tile").cogroup(tiles.groupBy(*PLACE, "tile")).applyInArrow(_search(k), _FOUND)
