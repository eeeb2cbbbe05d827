"""Token ids in files of patched frame-of-reference blocks.

A file holds the ids of consecutive documents in ascending doc_id order:

    magic ``PFOR0001``
    blocks of BLOCK ids (the last is filled up with its own minimum):
        minimum uint32 | width uint8 | 0 | exceptions uint16
        width bit planes of BLOCK / 8 bytes: the ids less the minimum, low bits first
        per exception: place uint16, then per exception: the id less the minimum, uint32
    index: start of each block, uint64
    documents: flag of a null id uint8, doc_id int64, ids uint32 (three arrays)
    tail: ids uint64 | blocks uint64 | documents uint64 | position of the index uint64 | magic

The width is that of the ``percentile`` value of a block, so a few large
values go to the exception list and do not widen the rest; a block can be
read alone through the index.

Texts are range-partitioned by id; a task writes files of about FILE_IDS ids
block by block (what it holds is a slice of text and its ids, whatever the
size of a file), each under a temporary name that becomes the final one when it is complete,
so a task that runs again replaces its files by the same bytes.  Files are
read back with Spark's binary reader.

Rows: every input row stays, rows that share an id in the order of their
text's hash.  A null text gives the end id alone.  Rows with a null id come
first.  An empty table writes no files and gives an empty result.  Other
columns are ignored.
"""

from __future__ import annotations

import io
import math
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm import common as C
from basketry.llm.encoder import default_path, encoder
from basketry.session import ensure_checkpoint_dir

BLOCK, PERCENTILE, FILE_IDS, END_ID = 256, 90, 4 << 20, 1
MAGIC = b"PFOR0001"
#: Bytes of text encoded at once, and ids packed at once.
SLICE, STEP_IDS = 1 << 20, 256 * BLOCK
PART_BYTES = 16 << 20


def pack_blocks(ids: np.ndarray, percentile: int = PERCENTILE) -> tuple[bytes, np.ndarray]:
    """Blocks of ``ids`` (the last is filled up with its own minimum) and the size of each."""
    n = len(ids)
    blocks = -(-n // BLOCK)
    if not blocks:
        return b"", np.zeros(0, np.int64)
    x = np.zeros(blocks * BLOCK, np.uint32)
    x[:n] = ids
    if n < len(x):
        x[n:] = x[(blocks - 1) * BLOCK:n].min()
    r = x.reshape(blocks, BLOCK)
    low = r.min(axis=1)
    r -= low[:, None]
    pick = np.partition(r, BLOCK * percentile // 100 - 1, axis=1)[:, BLOCK * percentile // 100 - 1]
    width = np.ceil(np.log2(pick.astype(np.float64) + 1)).astype(np.int64)
    outside = r > ((np.uint64(1) << width.astype(np.uint64)) - np.uint64(1)).astype(np.uint32)[:, None]
    exceptions = outside.sum(axis=1)
    plane = BLOCK // 8
    size = 8 + width * plane + exceptions * 6
    start = np.cumsum(size) - size
    out = np.zeros(int(size.sum()), np.uint8)

    def put(at: np.ndarray, values: np.ndarray) -> None:
        raw = np.ascontiguousarray(values).view(np.uint8).reshape(len(at), -1)
        out[at[:, None] + np.arange(raw.shape[1])] = raw

    put(start, low.reshape(-1, 1))
    out[start + 4] = width
    put(start + 6, exceptions.astype(np.uint16).reshape(-1, 1))
    for w in np.unique(width).tolist():
        rows = np.flatnonzero(width == w)
        for k in range(w):
            put(start[rows] + 8 + k * plane, np.packbits((r[rows] >> np.uint32(k)).astype(np.uint8) & 1, axis=1))
    b, at = np.nonzero(outside)
    if len(b):
        nth = np.arange(len(b)) - np.repeat(np.cumsum(exceptions) - exceptions, exceptions)
        base = start[b] + 8 + width[b] * plane
        put(base + 2 * nth, at.astype(np.uint16).reshape(-1, 1))
        put(base + 2 * exceptions[b] + 4 * nth, r[b, at].reshape(-1, 1))
    return out.tobytes(), size


class FileWriter:
    """One file, written block by block: ids wait only until they fill a block."""

    def __init__(self, sink, percentile: int = PERCENTILE) -> None:
        self.sink, self.percentile = sink, percentile
        self.rest = np.zeros(0, np.uint32)
        self.sizes: list[np.ndarray] = []
        self.rows: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.ids = 0
        sink.write(MAGIC)

    def _blocks(self, ids: np.ndarray) -> None:
        for at in range(0, len(ids), STEP_IDS):
            data, size = pack_blocks(ids[at:at + STEP_IDS], self.percentile)
            self.sink.write(data)
            self.sizes.append(size)

    def add(self, ids: np.ndarray, docs: np.ndarray, null: np.ndarray, counts: np.ndarray) -> None:
        """Whole documents: all their ids, and a row of each."""
        self.rows.append((null.astype(np.uint8), docs.astype(np.int64), counts.astype(np.uint32)))
        self.ids += len(ids)
        full = np.concatenate([self.rest, ids.astype(np.uint32, copy=False)])
        cut = len(full) // BLOCK * BLOCK
        self._blocks(full[:cut])
        self.rest = full[cut:].copy()

    def close(self) -> None:
        """The last block, the index, the documents and the tail."""
        self._blocks(self.rest)
        size = np.concatenate([np.zeros(0, np.int64), *self.sizes])
        null, docs, counts = (np.concatenate([np.zeros(0, t), *[r[k] for r in self.rows]])
                              for k, t in enumerate((np.uint8, np.int64, np.uint32)))
        index = len(MAGIC) + int(size.sum())
        start = (len(MAGIC) + np.cumsum(size) - size).astype(np.uint64)
        for part in (start, null, docs, counts):
            self.sink.write(part.tobytes())
        self.sink.write(struct.pack("<QQQQ", self.ids, len(size), len(docs), index) + MAGIC)


def pack(ids: np.ndarray, docs: np.ndarray, null: np.ndarray, counts: np.ndarray, percentile: int = PERCENTILE) -> bytes:
    """One whole file of ``ids`` and its documents."""
    out = io.BytesIO()
    writer = FileWriter(out, percentile)
    writer.add(ids, docs, null, counts)
    writer.close()
    return out.getvalue()


def unpack(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(ids, doc_ids, null flags, counts)`` of a file."""
    n, blocks, n_docs, index = struct.unpack("<QQQQ", data[-len(MAGIC) - 32:-len(MAGIC)])
    if data[:len(MAGIC)] != MAGIC or data[-len(MAGIC):] != MAGIC:
        raise ValueError("not a complete token file")
    raw = np.frombuffer(data, np.uint8)
    start = np.frombuffer(data, np.uint64, blocks, index).astype(np.int64)
    at = index + 8 * blocks
    null = np.frombuffer(data, np.uint8, n_docs, at)
    docs = np.frombuffer(data, np.int64, n_docs, at + n_docs)
    counts = np.frombuffer(data, np.uint32, n_docs, at + 9 * n_docs)
    get = lambda p, k, kind: np.ascontiguousarray(raw[p[:, None] + np.arange(k)]).view(kind).ravel()
    x = np.zeros((blocks, BLOCK), np.uint32)
    if blocks:
        low, width, exceptions = get(start, 4, np.uint32), raw[start + 4].astype(np.int64), get(start + 6, 2, np.uint16).astype(np.int64)
        plane = BLOCK // 8
        for w in np.unique(width).tolist():
            rows = np.flatnonzero(width == w)
            part = np.zeros((len(rows), BLOCK), np.uint32)
            for k in range(w):
                bits = raw[(start[rows] + 8 + k * plane)[:, None] + np.arange(plane)]
                part |= np.unpackbits(bits, axis=1).astype(np.uint32) << np.uint32(k)
            x[rows] = part
        if exceptions.sum():
            b = np.repeat(np.arange(blocks), exceptions)
            nth = np.arange(len(b)) - np.repeat(np.cumsum(exceptions) - exceptions, exceptions)
            base = start[b] + 8 + width[b] * plane
            x[b, get(base + 2 * nth, 2, np.uint16)] = get(base + 2 * exceptions[b] + 4 * nth, 4, np.uint32)
        x += low[:, None]
    return x.ravel()[:n], docs, null, counts


def _write(folder: str, path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs
        from pyspark import TaskContext

        store, root = fs.FileSystem.from_uri(folder)
        task = TaskContext.get().partitionId()
        enc = encoder(path)
        writer, temp, file = None, "", 0
        out: dict[str, list] = {"name": [], "task": [], "file": [], "ids": []}

        def done() -> None:
            """The open file under its final name."""
            nonlocal writer, file
            name = f"part-{task:08d}-{file:06d}.pfor"
            writer.close()
            writer.sink.close()
            store.move(temp, f"{root}/{name}")
            for k, v in zip(out, (name, task, file, writer.ids)):
                out[k].append(v)
            writer, file = None, file + 1

        for b in batches:
            texts, docs = C.column(b, "text"), C.column(b, "doc_id")
            for lo, hi in C.slices(texts, SLICE):
                if writer is None:
                    temp = f"{root}/_{task:08d}-{file:06d}.{uuid.uuid4().hex}"
                    writer = FileWriter(store.open_output_stream(temp))
                ids, offs = enc.encode(texts.slice(lo, hi - lo))
                n = np.diff(offs)
                d = docs.slice(lo, hi - lo)
                writer.add(np.insert(ids, offs[1:], np.uint32(END_ID)) if len(n) else ids, d.fill_null(0).to_numpy(zero_copy_only=False),
                           d.is_null().to_numpy(zero_copy_only=False), n + 1)
                if writer.ids >= FILE_IDS:
                    done()
        if writer is not None:
            done()
        yield pa.RecordBatch.from_pydict(out, pa.schema([("name", pa.string()), ("task", pa.int32()), ("file", pa.int32()), ("ids", pa.int64())]))

    return run


def write_files(docs: DataFrame, path: str | None = None, folder: str | None = None) -> tuple[str, DataFrame]:
    """Write the ids of ``docs``; returns the folder and ``(name, task, file, ids)`` of its files in order."""
    spark = docs.sparkSession
    folder = folder or f"{ensure_checkpoint_dir(spark).rstrip('/')}/tokens-{uuid.uuid4().hex}"
    if "://" not in folder and not folder.startswith("file:"):
        folder = f"file://{folder}"
    folder = folder.replace("file:/", "file:///") if folder.startswith("file:/") and not folder.startswith("file://") else folder
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(folder)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(hadoop)
    parts = max(math.ceil(C.text_bytes(docs) / PART_BYTES), spark.sparkContext.defaultParallelism)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("h"))
    ordered = rows.repartitionByRange(parts, "doc_id", "h").sortWithinPartitions("doc_id", "h").select("doc_id", "text")
    files = C.staged(ordered.mapInArrow(_write(folder, path or default_path()), "name string, task int, file int, ids long"))
    return folder, files


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for name, data in zip(C.column(b, "name").to_pylist(), C.column(b, "content")):
            ids, docs, null, counts = unpack(data.as_buffer().to_pybytes())
            ends = np.cumsum(counts, dtype=np.int64)
            raw = memoryview(np.ascontiguousarray(ids, "<u4")).cast("B")
            crc = [zlib.crc32(raw[4 * (e - n):4 * e]) for e, n in zip(ends.tolist(), counts.tolist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(docs), pa.string()), pa.array(docs, pa.int64(), mask=null.astype(bool)),
                 pa.array(ends - counts, pa.int64()), pa.array(counts.astype(np.int64)), pa.array(crc, pa.int64())],
                ["name", "doc_id", "at", "n_tokens", "ids_crc32"])


def read_digests(spark, folder: str, files: DataFrame) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` from the files alone; ``files`` gives their order and sizes."""
    content = spark.read.format("binaryFile").option("pathGlobFilter", "part-*.pfor").load(folder).select(
        F.element_at(F.split("path", "/"), -1).alias("name"), "content")
    docs = content.mapInArrow(_read, "name string, doc_id long, at long, n_tokens long, ids_crc32 long")
    by_task = files.groupBy("task").agg(F.sum("ids").alias("ids"))
    before = by_task.select("task", (F.sum("ids").over(Window.partitionBy(F.lit(0)).orderBy("task")) - F.col("ids")).alias("before"))
    within = Window.partitionBy("task").orderBy("file")
    starts = files.withColumn("inner", F.sum("ids").over(within) - F.col("ids")).join(before, "task").select(
        "name", (F.col("before") + F.col("inner")).alias("begin"))
    return docs.join(starts, "name").select("doc_id", (F.col("begin") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def token_files(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Write the files and read them back: one row per input row."""
    folder, files = write_files(docs, path)
    if files.isEmpty():
        return docs.sparkSession.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    return read_digests(docs.sparkSession, folder, files)
