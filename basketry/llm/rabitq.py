"""Near-duplicate vectors with randomised-rotation binary codes.

A unit vector o is turned by seeded random rotations and kept as the signs of
its coordinates, the code b (scaled to length one), with the correction factor
<b, o>.  For a unit vector q, <b, q> / <b, o> estimates <o, q> without bias,
and the error stays within ``SIGMAS`` * sqrt((1 - f**2) / f**2 / (D - 1)) for
one rotation; the mean over r rotations tightens it by sqrt(r).

The codes, packed to bits, and the correction factors are made once per vector
and kept; a block of pairs turns only the vectors on its left side.

1. Equal vectors of a label collapse to the smallest id and a count.
2. Bands of code bits are the buckets of several tables: close vectors share
   most signs.  Bits per band follow from the number of vectors, the number
   of tables from the chance to meet at the threshold (at least ``recall``).
3. A bucket beyond BLOCK vectors is dealt into pairs of blocks.  In a block
   the estimates' upper confidence bounds decide which pairs are computed
   exactly; a pair at or above the threshold is a link.  A pair that has met
   in an earlier table is not counted again.  Counts and the links that join
   parts (at most one per vector and block) are returned, never the pairs.
4. Components come from large-star/small-star rounds.

Rows: every input row stays.  Vectors that are null, zero, or hold null or
non-finite components, rows without a label and rows without an id link with
nothing and are their own component.  Vectors of different dimensions are not
compared.  Rows that share an id are one node; ``n_links`` counts rows.  An
empty table gives an empty result.  Other columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm import common as C
from basketry.llm.vectors import matrices, usable

#: Vectors of a block, width of the confidence bounds, rotations of a code.
BLOCK, SIGMAS, TIMES = 512, 4.0, 4
#: What single precision may add to an estimate's error (some thousand terms of at most one in all).
SINGLE = 1e-4


@functools.cache
def rotations(dim: int, times: int) -> np.ndarray:
    """Random orthogonal matrices of a dimension, stacked; the same everywhere."""
    rng = np.random.default_rng([dim, 2024])
    return np.stack([np.linalg.qr(rng.standard_normal((dim, dim)))[0] for _ in range(times)])


def plan(n: int, threshold: float, recall: float) -> tuple[int, int]:
    """``(bits of a band, tables)`` for n vectors."""
    bits = max(6, math.ceil(math.log2(max(n, 2) / 64)))
    meet = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(1 - recall) / math.log(1 - meet))


def turned(unit: np.ndarray, times: int) -> np.ndarray:
    """Coordinates under each rotation: (rows, times, dim)."""
    return (unit @ np.concatenate(rotations(unit.shape[1], times), axis=1)).reshape(len(unit), times, -1)


def codes(unit: np.ndarray, times: int = TIMES) -> tuple[np.ndarray, np.ndarray]:
    """Packed sign bits of unit vectors under ``times`` rotations, and the correction factor of each."""
    y = turned(unit, times)
    return np.packbits((y > 0).reshape(len(unit), -1), axis=1), np.abs(y).sum(axis=2) / math.sqrt(unit.shape[1])


def estimators(packed: np.ndarray, factor: np.ndarray, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """From kept codes and factors: the vectors whose product with a turned unit vector is the estimate, and the error radii.

    Estimates are taken in single precision; the radii allow for it.
    """
    times = factor.shape[1]
    weight = (1 / (math.sqrt(dim) * times * factor)).astype(np.float32)
    sign = np.where(np.unpackbits(packed, axis=1, count=times * dim).reshape(len(packed), times, dim), weight[:, :, None], -weight[:, :, None])
    radius = SIGMAS * np.sqrt(np.maximum(1 - factor ** 2, 0) / factor ** 2 / max(dim - 1, 1)).mean(axis=1) / math.sqrt(times)
    return sign.reshape(len(packed), -1), radius + SINGLE


def _code(bits: int, tables: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, lists = C.column(b, "vec_id"), C.column(b, "x")
            label, count = C.column(b, "label"), C.column(b, "m")
            for rows, x in matrices(lists):
                unit = x / np.linalg.norm(x, axis=1, keepdims=True)
                times = math.ceil(bits * tables / x.shape[1])
                signs = (turned(unit, times) > 0).reshape(len(x), -1)[:, :bits * tables].reshape(len(x), tables, bits)
                band = (signs * (1 << np.arange(bits))).sum(axis=2).astype(np.int32)
                code, factor = codes(unit)
                at = pa.array(rows)
                yield pa.RecordBatch.from_arrays(
                    [ids.take(at), label.take(at), pa.array([x.shape[1]] * len(x), pa.int32()), count.take(at),
                     pa.ListArray.from_arrays(np.arange(0, band.size + 1, tables, dtype=np.int32), band.ravel()),
                     *[pa.array([v.tobytes() for v in m], pa.binary()) for m in (x, code, factor)]],
                    ["vec_id", "label", "dim", "m", "bands", "x", "code", "factor"])

    return run


def _links(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in C.groups(batches, ["label", "dim", "t", "band", "lo", "hi"]):
            ids = t.column("vec_id").to_numpy()
            if len(ids) < 2:
                continue
            blk, table = t.column("blk").to_numpy(), t.column("t")[0].as_py()
            lo, hi = t.column("lo")[0].as_py(), t.column("hi")[0].as_py()
            m = t.column("m").to_numpy()
            x = np.frombuffer(b"".join(t.column("x").to_pylist()), np.float64).reshape(len(ids), -1)
            norm = np.linalg.norm(x, axis=1)
            left = np.flatnonzero(blk == lo)
            right = left if lo == hi else np.flatnonzero(blk == hi)
            if not len(left) or not len(right):
                continue
            kept = [np.frombuffer(b"".join(t.column(c).to_pylist()), kind).reshape(len(ids), -1)[right]
                    for c, kind in (("code", np.uint8), ("factor", np.float64))]
            code, radius = estimators(*kept, x.shape[1])
            y = turned(x[left] / norm[left, None], TIMES).reshape(len(left), -1)
            near = y.astype(np.float32) @ code.T >= (threshold - radius).astype(np.float32)[None, :]
            if lo == hi:
                near &= left[:, None] < right[None, :]
            a, b = np.nonzero(near)
            a, b = left[a], right[b]
            hit = np.einsum("ij,ij->i", x[a], x[b]) / (norm[a] * norm[b]) >= threshold
            a, b = a[hit], b[hit]
            if table and len(a):
                bands = t.column("bands").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1)[:, :table]
                new = ~(bands[a] == bands[b]).any(axis=1)
                a, b = a[new], b[new]
            if not len(a):
                continue
            n = np.bincount(a, weights=m[b], minlength=len(ids)) + np.bincount(b, weights=m[a], minlength=len(ids))
            parent = list(range(len(ids)))

            def root(v: int) -> int:
                while parent[v] != v:
                    parent[v] = parent[parent[v]]
                    v = parent[v]
                return v

            joined = []
            for p, q in zip(a.tolist(), b.tolist()):
                p_, q_ = root(p), root(q)
                if p_ != q_:
                    parent[q_] = p_
                    joined.append((int(ids[p]), int(ids[q])))
            some = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array([*ids[some].tolist(), *[p for p, _ in joined]], pa.int64()),
                 pa.array([*n[some].astype(np.int64).tolist(), *[0] * len(joined)], pa.int64()),
                 pa.array([*[None] * len(some), *[q for _, q in joined]], pa.int64())], ["vec_id", "n", "to"])

    return run


def _fingerprint(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """128 bits of each vector's components (as doubles, -0 as 0)."""
    for b in batches:
        lists = C.column(b, "x")
        k = np.zeros((b.num_rows, 2), np.int64)
        for rows, x in matrices(lists):
            for r, v in zip(rows.tolist(), x + 0.0):
                k[r] = np.frombuffer(hashlib.md5(v.tobytes()).digest(), np.int64)
        yield pa.RecordBatch.from_arrays([*[C.column(b, c) for c in b.schema.names], pa.array(k[:, 0]), pa.array(k[:, 1])],
                                         [*b.schema.names, "k1", "k2"])


def near_vectors(vectors: DataFrame, threshold: float = 0.93, recall: float = 0.995, vector: str = "embedding") -> DataFrame:
    """``(vec_id, n_links, component_id, kept)``, one row per input row."""
    with C.tables() as t:
        zero = F.forall(F.col(vector), lambda v: v == 0)
        ok = usable(vector) & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
        rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
                              F.when(ok & ~zero, F.col(vector).cast("array<double>")).alias("x"))
        keyed = t.table(rows.where("x is not null").mapInArrow(_fingerprint, "vec_id long, label long, x array<double>, k1 long, k2 long"))
        reps = t.table(keyed.groupBy("label", "k1", "k2").agg(F.min(F.struct("vec_id", "x")).alias("r"), F.count(F.lit(1)).alias("m"))
                        .select("label", "k1", "k2", F.col("r.vec_id").alias("vec_id"), F.col("r.x").alias("x"), "m"))
        n = reps.count()
        bits, tables = plan(n, threshold, recall)
        coded = t.table(reps.select("vec_id", "label", "m", "x").mapInArrow(
            _code(bits, tables), "vec_id long, label long, dim int, m long, bands array<int>, x binary, code binary, factor binary"))
        placed = coded.select("vec_id", "label", "dim", F.posexplode("bands").alias("t", "band"))
        full = placed.groupBy("label", "dim", "t", "band").agg(F.count(F.lit(1)).alias("size")).where("size > 1").select(
            "label", "dim", "t", "band", F.ceil(F.col("size") / BLOCK).cast("int").alias("nb"))
        blocks = (placed.join(full, ["label", "dim", "t", "band"])
                  .withColumn("blk", F.pmod(F.xxhash64("vec_id"), F.col("nb")).cast("int"))
                  .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
                  .select("vec_id", "t", "band", "blk", F.least("blk", "other").alias("lo"), F.greatest("blk", "other").alias("hi")))
        keys = ["label", "dim", "t", "band", "lo", "hi"]
        found = t.table(coded.join(blocks, "vec_id").repartition(*[F.col(k) for k in keys]).sortWithinPartitions(*keys)
                         .mapInArrow(_links(threshold), "vec_id long, n long, to long"))
        copies = keyed.groupBy("vec_id").agg(F.count(F.lit(1)).alias("c"), F.min(F.struct("label", "k1", "k2")).alias("lo"),
                                             F.max(F.struct("label", "k1", "k2")).alias("hi")).where("lo != hi")
        links = found.where("to is not null").select(F.col("vec_id").alias("a"), F.col("to").alias("b"))
        if not copies.isEmpty():  # rows that share an id tie their classes together
            tied = keyed.join(copies.select("vec_id"), "vec_id", "left_semi").join(
                reps.select("label", "k1", "k2", F.col("vec_id").alias("b")), ["label", "k1", "k2"]).select(F.col("vec_id").alias("a"), "b")
            links = links.unionByName(tied)
        comps = C.connected_components(links)
        degree = found.where("to is null").groupBy("vec_id").agg(F.sum("n").alias("n"))
        classes = (reps.select("label", "k1", "k2", "vec_id", "m").join(degree, "vec_id", "left")
                   .join(comps.withColumnRenamed("node", "vec_id"), "vec_id", "left")
                   .select("label", "k1", "k2", (F.col("m") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"),
                           F.coalesce("component", "vec_id").alias("component_id")))
        linked = keyed.select("vec_id", "label", "k1", "k2").join(classes, ["label", "k1", "k2"]).select(
            "vec_id", "n_links", "component_id")
        alone = rows.where("x is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
        return C.staged(linked.unionByName(alone).select(
            "*", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)).alias("kept")))
