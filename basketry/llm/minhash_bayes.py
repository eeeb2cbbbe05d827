"""MinHash near-duplicates with sequential Bayesian verification of banded candidates.

Sets: distinct shingles of five words (``[^\\x20\\x09-\\x0D]+`` after A-Z are
lower-cased); a text of one to four words is one shingle, a text without
words has the empty set and links with nothing.

1. Each text gives its set's size, a 128-bit fingerprint of the set and the
   keys of its signature's bands.  Equal sets collapse to the smallest id
   (partial/final minimum), so thousands of copies cost one row per task.
2. Representatives that share a band key are candidates.  Buckets with the
   same members are looked at once.  A bucket beyond the bounds of a block is
   dealt into pairs of blocks, so no task holds more than two blocks.
3. Inside a block the signatures are compared batch by batch; a pair goes as
   soon as its posterior chance to reach the threshold (uniform prior) falls
   below ``miss``.  Survivors that are not yet connected inside the block are
   verified on their full sets; only links that join parts are emitted, at
   most one per document and block, since components need no more.
4. Components come from large-star/small-star rounds.

A pair at the threshold t shares no band with chance (1 - t**ROWS)**bands, and
the number of bands follows t so that this is at most NO_BAND (21 bands at 0.85,
33 at 0.80); pruning misses it with a chance of at most ``miss`` a batch.

Rows: every input row stays.  A null text is empty.  Rows that share a
doc_id are one node: it has the least class of theirs.  A null doc_id has a
null component_id, is kept and links with nothing.  An empty table gives an
empty result.  Other columns are ignored, whatever their names.
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

WORDS, ROWS, BATCH = 5, 6, 18
#: Chance that a pair exactly at the threshold shares no band.
NO_BAND = 5e-5
#: Bounds of one block: documents and shingles.
BLOCK_DOCS, BLOCK_SHINGLES = 1024, 1 << 20
WORD_WEIGHTS = C.stream(WORDS, 102) | np.uint64(1)
SLICE = 2 << 20


def shingle_sets(texts: pa.Array) -> Iterator[np.ndarray]:
    """The sorted distinct 64-bit shingle hashes of each text."""
    for lo, hi in C.slices(texts, SLICE):
        buf, offs = C.buffer(texts.slice(lo, hi - lo))
        low = C.LOWER[buf]
        start, end = C.word_spans(low, offs)
        words = C.range_hash(C.prefix_hash(low), start, end) if len(start) else np.zeros(0, np.uint64)
        first = np.searchsorted(start, offs)
        n = len(words)
        five = np.zeros(max(n - WORDS + 1, 0), np.uint64)
        for k in range(WORDS):
            five += words[k:n - WORDS + 1 + k] * WORD_WEIGHTS[k] if len(five) else five
        five = C.mix(five)
        for a, b in zip(first[:-1], first[1:]):
            m = int(b - a)
            if m >= WORDS:
                yield np.unique(five[a:b - WORDS + 1])
            elif m:
                yield C.mix((words[a:b] * WORD_WEIGHTS[:m]).sum(dtype=np.uint64, keepdims=True) + np.uint64(m))
            else:
                yield np.zeros(0, np.uint64)


def bands_for(threshold_pct: int) -> int:
    """The fewest bands, in whole batches of hashes, that miss a pair at the threshold with at most NO_BAND."""
    step = BATCH // ROWS
    same = (threshold_pct / 100) ** ROWS
    need = math.log(NO_BAND) / math.log1p(-same) if same < 1 else 1
    return step * math.ceil(need / step)


@functools.cache
def multipliers(hashes: int) -> np.ndarray:
    return C.stream(hashes, 101) | np.uint64(1)


def signature(shingles: np.ndarray, hashes: int) -> np.ndarray:
    """Minima of so many multiplicative permutations, as uint32."""
    by = multipliers(hashes)
    low = np.full(hashes, C.MASK, np.uint64)
    for at in range(0, len(shingles), 512):
        np.minimum(low, (shingles[at:at + 512, None] * by).min(axis=0), out=low)
    return (low >> np.uint64(32)).astype(np.uint32)


def _features(bands_n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = C.stream(ROWS, 103) | np.uint64(1)
        salt = C.stream(bands_n, 104)
        for b in batches:
            n, k1, k2, bands = [], [], [], []
            for s in shingle_sets(C.column(b, "text")):
                n.append(len(s))
                d = np.frombuffer(hashlib.md5(s.tobytes()).digest(), np.int64)
                k1.append(int(d[0]))
                k2.append(int(d[1]))
                if len(s):
                    sig = signature(s, bands_n * ROWS).reshape(bands_n, ROWS).astype(np.uint64)
                    bands.append(C.mix((C.mix(sig + np.uint64(1)) * weights).sum(axis=1, dtype=np.uint64) + salt).view(np.int64))
                else:
                    bands.append(np.zeros(0, np.int64))
            lists = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum([len(x) for x in bands])]).astype(np.int32),
                                             np.concatenate([*bands, np.zeros(0, np.int64)]))
            yield pa.RecordBatch.from_arrays(
                [C.column(b, "doc_id"), pa.array(n, pa.int64()), pa.array(k1, pa.int64()), pa.array(k2, pa.int64()), lists],
                ["doc_id", "n_shingles", "k1", "k2", "bands"])

    return run


def _sets(hashes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = C.column(b, "doc_id")
            at = 0
            for lo, hi in C.slices(C.column(b, "text"), SLICE):
                sets = list(shingle_sets(C.column(b, "text").slice(lo, hi - lo)))
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(at, hi - lo), pa.array([signature(s, hashes).tobytes() for s in sets], pa.binary()),
                     pa.array([s.tobytes() for s in sets], pa.binary())], ["doc_id", "sig", "sh"])
                at += hi - lo

    return run


@functools.cache
def least_matches(threshold: float, miss: float, hashes: int = 126) -> list[int]:
    """For each number of hashes compared, batch by batch, the fewest matches that keep a pair.

    With a uniform prior the posterior after m of n matches is
    Beta(m + 1, n - m + 1); its chance to reach t is P(Bin(n + 1, t) <= m).
    """
    out = []
    for n in range(BATCH, hashes + 1, BATCH):
        total, m = 0.0, 0
        for m in range(n + 1):
            total += math.comb(n + 1, m) * threshold ** m * (1 - threshold) ** (n + 1 - m)
            if total >= miss:
                break
        out.append(m)
    return out


def _links(threshold_pct: int, miss: float):
    hashes = bands_for(threshold_pct) * ROWS
    need = least_matches(threshold_pct / 100, miss, hashes)

    def survivors(sig: np.ndarray, left: np.ndarray, right: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
        i, j = [], []
        for at in range(0, len(left), 128):
            rows = left[at:at + 128]
            hits = np.zeros((len(rows), len(right)), np.int16)
            for k in range(BATCH):
                hits += sig[rows, k][:, None] == sig[right, k][None, :]
            ok = hits >= need[0]
            if same:
                ok &= rows[:, None] < right[None, :]
            a, c = np.nonzero(ok)
            count = hits[a, c]
            x, y = rows[a], right[c]
            for step, least in enumerate(need[1:], 1):
                if not len(x):
                    break
                part = slice(step * BATCH, (step + 1) * BATCH)
                count = count + (sig[x, part] == sig[y, part]).sum(axis=1)
                keep = count >= least
                x, y, count = x[keep], y[keep], count[keep]
            i.append(x)
            j.append(y)
        return np.concatenate(i), np.concatenate(j)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out_a: list[int] = []
        out_b: list[int] = []
        for t in C.groups(batches, ["band", "lo", "hi"]):
            ids = t.column("doc_id").to_numpy()
            blk = t.column("blk").to_numpy()
            lo, hi = t.column("lo")[0].as_py(), t.column("hi")[0].as_py()
            left = np.flatnonzero(blk == lo)
            right = left if lo == hi else np.flatnonzero(blk == hi)
            if not len(left) or not len(right):
                continue
            sig = np.frombuffer(b"".join(t.column("sig").to_pylist()), np.uint32).reshape(len(ids), hashes)
            x, y = survivors(sig, left, right, lo == hi)
            if not len(x):
                continue
            sets = [np.frombuffer(s, np.uint64) for s in t.column("sh").to_pylist()]
            parent = list(range(len(ids)))

            def root(v: int) -> int:
                while parent[v] != v:
                    parent[v] = parent[parent[v]]
                    v = parent[v]
                return v

            sizes = np.array([len(s) for s in sets])
            fit = 100 * np.minimum(sizes[x], sizes[y]) >= threshold_pct * np.maximum(sizes[x], sizes[y])
            for p, q in zip(x[fit].tolist(), y[fit].tolist()):
                rp, rq = root(p), root(q)
                if rp == rq:
                    continue
                merged = np.concatenate([sets[p], sets[q]])
                merged.sort()
                both = int((merged[1:] == merged[:-1]).sum())
                if 100 * both >= threshold_pct * (len(merged) - both):
                    parent[rq] = rp
                    out_a.append(int(ids[p]))
                    out_b.append(int(ids[q]))
        yield pa.RecordBatch.from_arrays([pa.array(out_a, pa.int64()), pa.array(out_b, pa.int64())], ["a", "b"])

    return run


def near_duplicates(docs: DataFrame, threshold_pct: int = 85, miss: float = 1e-5) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)``, one row per input row."""
    with C.tables() as t:
        spark = docs.sparkSession
        bands_n = bands_for(threshold_pct)
        texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        feats = t.table(texts.mapInArrow(_features(bands_n), "doc_id long, n_shingles long, k1 long, k2 long, bands array<long>"))
        known = feats.where("doc_id is not null and n_shingles > 0")
        reps = known.groupBy("k1", "k2").agg(F.min(F.struct("doc_id", "bands", "n_shingles")).alias("r")).select(
            "k1", "k2", F.col("r.doc_id").alias("rep"), F.col("r.bands").alias("bands"), F.col("r.n_shingles").alias("n"))
        reps = t.table(reps)
        rows = reps.select(F.explode("bands").alias("band"), F.col("rep").alias("doc_id"), "n")
        buckets = rows.groupBy("band").agg(
            F.count(F.lit(1)).alias("m"), F.sum("n").alias("total"), F.bit_xor(F.xxhash64("doc_id")).alias("x"),
            F.sum(F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(1 << 31))).alias("s")).where("m > 1")
        once = buckets.groupBy("m", "total", "x", "s").agg(F.min("band").alias("band")).select(
            "band", F.greatest(F.ceil(F.col("m") / BLOCK_DOCS), F.ceil(F.col("total") / BLOCK_SHINGLES)).cast("int").alias("nb"))
        active = t.table(rows.join(once, "band").select("band", "doc_id", "nb"))
        sets = (texts.join(active.select("doc_id").distinct().hint("merge"), "doc_id", "left_semi")
                .mapInArrow(_sets(bands_n * ROWS), "doc_id long, sig binary, sh binary"))
        blocks = (active.withColumn("blk", F.pmod(F.xxhash64("doc_id"), F.col("nb")).cast("int"))
                  .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
                  .select("band", "doc_id", "blk", F.least("blk", "other").alias("lo"), F.greatest("blk", "other").alias("hi")))
        links = t.table(blocks.join(sets, "doc_id")
                         .repartition(F.col("band"), F.col("lo"), F.col("hi"))
                         .sortWithinPartitions("band", "lo", "hi")
                         .mapInArrow(_links(threshold_pct, miss), "a long, b long"))
        same = known.select("doc_id", "k1", "k2").groupBy("doc_id").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
        if not same.isEmpty():  # rows that share an id tie their classes together
            tied = known.join(same.select("doc_id"), "doc_id", "left_semi").join(
                reps.select("k1", "k2", "rep"), ["k1", "k2"]).select("doc_id", "rep")
            links = links.unionByName(tied.select(F.col("doc_id").alias("a"), F.col("rep").alias("b")))
            links = links.unionByName(tied.groupBy("doc_id").agg(F.min("rep").alias("b"), F.max("rep").alias("a")).select("a", "b"))
        comps = C.connected_components(links)
        classes = reps.select("k1", "k2", "rep").join(comps.withColumnRenamed("node", "rep"), "rep", "left").select(
            "k1", "k2", F.coalesce("component", "rep").alias("component_id"))
        out = feats.select("doc_id", "n_shingles", "k1", "k2").join(classes, ["k1", "k2"], "left")
        alone = F.col("doc_id").isNull() | (F.col("n_shingles") == 0)
        component = F.when(alone, F.col("doc_id")).otherwise(F.col("component_id"))
        return C.staged(out.select("doc_id", "n_shingles", component.alias("component_id"),
                                   F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept")))


def keep_one(docs: DataFrame, threshold_pct: int = 85, miss: float = 1e-5) -> DataFrame:
    """The rows of ``docs`` whose document represents its class; one row per doc_id.

    Of rows that share a doc_id the one with the least hash of its text stays,
    among equal texts the one with the least hash of all columns (rows that are
    alike in all columns are interchangeable).  Rows with a null doc_id stay.
    Repeated ids are found on the ids alone; texts are neither sorted nor
    aggregated unless their id repeats.
    """
    with C.tables() as t:
        found = t.adopt(near_duplicates(docs, threshold_pct, miss))
        ids = C.staged(found.where("kept and doc_id is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")))
    known = lambda which: docs.join(ids.where(which).select("doc_id").hint("shuffle_hash"), "doc_id", "left_semi")
    out = known("n = 1").unionByName(docs.where(F.col("doc_id").isNull()))
    if not ids.where("n > 1").isEmpty():
        order = F.struct(F.xxhash64("text"), F.xxhash64(*docs.columns))
        one = known("n > 1").groupBy("doc_id").agg(F.min_by(F.struct(*docs.columns), order).alias("r"))
        out = out.unionByName(one.select("r.*"))
    return out.select(*docs.columns)
