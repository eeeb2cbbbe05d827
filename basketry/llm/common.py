"""Helpers shared by the operators: staged tables, components, groups of a sorted stream.

Null and repeated rows: operators keep every input row; a null text counts as
the empty text.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.operators.graph import connected_components as graph_components
from basketry.session import Scope, cut_lineage

#: Bytes of text that one chunk of a chunked exchange holds (about); bounds a task's memory.
CHUNK_BYTES = 8 << 20


def staged(df: DataFrame) -> DataFrame:
    """Write ``df`` once under ``spark.checkpoint.dir`` and read it back; for what a call returns."""
    return cut_lineage(df)


def tables() -> Scope:
    """Tables of one call (``with tables() as t: t.table(df)``), deleted when it ends."""
    return Scope()


def crc_mod(n: int, col: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo n; null ids count as remainder 0."""
    return F.coalesce(F.crc32(F.col(col).cast("string")) % F.lit(n), F.lit(0)).cast("int")


def text_bytes(docs: DataFrame, col: str = "text") -> int:
    """Total bytes of the texts: one scan and a partial/final sum."""
    return docs.agg(F.coalesce(F.sum(F.octet_length(col).cast("long")), F.lit(0))).first()[0]


def chunk_count(n_bytes: int, spark, size: int = CHUNK_BYTES) -> int:
    """Chunks for so many bytes: one per ``size``, and at least one per core."""
    return max(1, math.ceil(n_bytes / size), min(spark.sparkContext.defaultParallelism, 1 + (n_bytes >> 16)))


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` of every node of ``edges (a, b)``: the least node reachable."""
    return graph_components(edges.select(F.col("a").alias("src"), F.col("b").alias("dst")))


# --- inside tasks ------------------------------------------------------------------

def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of an Arrow string or binary array and the int64 offsets of its rows (null: empty)."""
    texts = pc.fill_null(texts, "" if pa.types.is_string(texts.type) or pa.types.is_large_string(texts.type) else b"")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, offs, data = texts.buffers()
    kind = np.int64 if wide else np.int32
    offsets = np.frombuffer(offs, kind)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    if data is None or len(offsets) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(texts: pa.Array, limit: int) -> Iterator[tuple[int, int]]:
    """Row ranges of ``texts`` that hold about ``limit`` bytes each (one row at least)."""
    sizes = np.concatenate([[0], np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))])
    at, n = 0, len(texts)
    while at < n:
        to = max(at + 1, int(np.searchsorted(sizes, sizes[at] + limit, "right")) - 1)
        yield at, min(to, n)
        at = to


def groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of consecutive rows with equal keys from a stream sorted by them."""
    held: list[pa.RecordBatch] = []
    last = None
    for b in batches:
        if not b.num_rows:
            continue
        cols = [column(b, k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(b.num_rows, bool)
        for c in cols:
            change[1:] |= c[1:] != c[:-1]
        starts = [0, *np.flatnonzero(change).tolist(), b.num_rows]
        for s, e in zip(starts, starts[1:]):
            key = tuple(c[s] for c in cols)
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            last = key
            held.append(b.slice(s, e - s))
    if held:
        yield pa.Table.from_batches(held)


MASK = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser, elementwise on uint64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def stream(n: int, seed: int) -> np.ndarray:
    """``n`` pseudo-random uint64 from a seed."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + mix(np.array([seed], np.uint64)))


BASE = 0xD1342543DE82EF95 | 1
BASE_INV = pow(BASE, -1, 1 << 64)
BYTE_VALUE = stream(256, 11)
_POWERS: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i < n (kept between calls)."""
    if len(_POWERS.get("p", ())) < n:
        size = 1 << max(16, (n - 1).bit_length())
        for name, base in (("p", BASE), ("q", BASE_INV)):
            v = np.full(size, base, np.uint64)
            v[0] = 1
            _POWERS[name] = np.cumprod(v, dtype=np.uint64)
    return _POWERS["p"][:n], _POWERS["q"][:n]


def prefix_hash(buf: np.ndarray) -> np.ndarray:
    """Prefix sums of BYTE_VALUE * BASE**i; with ``range_hash`` the hash of any byte range."""
    p, _ = powers(len(buf) + 1)
    out = np.empty(len(buf) + 1, np.uint64)
    out[0] = 0
    np.cumsum(BYTE_VALUE[buf] * p[:len(buf)], out=out[1:])
    return out


def range_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte ranges [start, end); equal bytes give equal hashes anywhere."""
    _, q = powers(len(prefix))
    return mix((prefix[end] - prefix[start]) * q[start] + (end - start).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def word_spans(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words ``[^\\x20\\x09-\\x0D]+`` of each row; none crosses rows."""
    on = ~IS_SPACE[buf]
    prev, nxt = np.zeros_like(on), np.zeros_like(on)
    prev[1:], nxt[:-1] = on[:-1], on[1:]
    inner = offsets[(offsets > 0) & (offsets < len(buf))]
    prev[inner] = False
    nxt[inner - 1] = False
    return np.flatnonzero(on & ~prev), np.flatnonzero(on & ~nxt) + 1
