"""BPE encoding and decoding with content-defined chunks that documents share.

Texts are cut where a rolling hash of ``WINDOW`` bytes has its low bits zero,
so equal passages are cut alike wherever they stand.

1. A scan lists each document's chunks (128 bits of hash and length).  Chunks
   that occur more than once are shared; the least place of each owns it.
2. The owners' texts are encoded once; the ids go once to each group of
   documents that needs them, not once to each document.
3. A group of documents encodes its own remaining distinct chunks, lays the
   ids of each document end to end, and repairs every join: the text between
   the last white space before the join and the first one after it is encoded
   anew and replaces the ids of the two fragments.  Where the chunks' ids do
   not end and begin with the fragments' ids, the window grows by a word and
   the join is tried again, at last with both chunks whole.
4. Ids and decoded text give the digests.

Rows: every input row stays.  A null text is empty and has no ids.  Rows that
share an id are encoded one by one; a null id is kept.  An empty table gives
an empty result.  Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm import common as C
from basketry.llm.encoder import Encoder, default_path, encoder

WINDOW, CUT_BITS = 16, 10
SLICE = 1 << 20
GROUP = 4 << 20
_U = np.uint64
_SPACE = b" \t\n\r"


def cuts(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the chunks of all rows; an empty row has none."""
    edges = [offsets]
    if len(buf) > WINDOW:
        b = C.BASE
        h = C.BYTE_VALUE[buf]
        for k in (1, 2, 4, 8):
            h = h[:-k] * _U(pow(b, k, 1 << 64)) + h[k:]
        h = h[:-1]
        h ^= h >> _U(29)
        h *= _U(0xBF58476D1CE4E5B9)
        at = np.flatnonzero((h >> _U(64 - CUT_BITS)) == 0) + WINDOW
        at = at[(buf[at] & 0xC0) != 0x80]  # not inside a character
        row = np.searchsorted(offsets, at, "right") - 1
        edges.append(at[at - WINDOW >= offsets[row]])
    e = np.unique(np.concatenate(edges))
    return e[:-1], e[1:]


def _listed(key: np.ndarray, data: memoryview, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The second half of each chunk's key: its crc32 and length."""
    return np.array([zlib.crc32(data[a:b]) << 31 ^ (b - a) for a, b in zip(begin.tolist(), end.tolist())], np.int64)


def _keys(buf: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    h = C.range_hash(C.prefix_hash(buf), begin, end).view(np.int64) if len(begin) else np.zeros(0, np.int64)
    return h, _listed(h, memoryview(buf), begin, end)


def _list(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each distinct chunk of a slice of documents: key, group, times, first place."""
    for b in batches:
        group, spot = C.column(b, "c").to_numpy(zero_copy_only=False), C.column(b, "spot").to_numpy(zero_copy_only=False)
        texts = C.column(b, "text")
        for lo, hi in C.slices(texts, SLICE):
            buf, offs = C.buffer(texts.slice(lo, hi - lo))
            begin, end = cuts(buf, offs)
            h, k = _keys(buf, begin, end)
            row = np.searchsorted(offs, begin, "right") - 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(h), pa.array(k), pa.array(group[lo + row], pa.int32()), pa.array(spot[lo + row]),
                 pa.array(begin - offs[row], pa.int64())], ["h", "k", "c", "spot", "at"])


def _narrow(enc: Encoder):
    """The type in which ids travel."""
    return np.uint16 if enc.vocab <= 1 << 16 else np.uint32


def _owned(path: str):
    """Ids of the shared chunks that this group owns."""
    def run(key, docs, owned):
        texts = docs.column("text").combine_chunks()
        want = set(zip(owned.column("h").to_pylist(), owned.column("k").to_pylist()))
        held: dict[tuple[int, int], bytes] = {}
        if want:
            for lo, hi in C.slices(texts, SLICE):
                buf, offs = C.buffer(texts.slice(lo, hi - lo))
                begin, end = cuts(buf, offs)
                h, k = _keys(buf, begin, end)
                for key2, a, b in zip(zip(h.tolist(), k.tolist()), begin.tolist(), end.tolist()):
                    if key2 in want and key2 not in held:
                        held[key2] = buf[a:b].tobytes()
        enc = encoder(path)
        ids, offs = enc.encode(pa.array(list(held.values()), pa.binary()).cast(pa.string()))
        ids = ids.astype(_narrow(enc))
        return pa.table({"h": pa.array([x[0] for x in held], pa.int64()), "k": pa.array([x[1] for x in held], pa.int64()),
                         "ids": pa.array([ids[a:b].tobytes() for a, b in zip(offs[:-1].tolist(), offs[1:].tolist())], pa.binary())})

    return run


def _last_space(text: bytes, stop: int) -> int:
    """Position behind the last white space before ``stop`` (0: none)."""
    return max(text.rfind(s, 0, stop) for s in (b" ", b"\t", b"\n", b"\r")) + 1


def _first_space(text: bytes, start: int) -> int:
    found = [p for p in (text.find(s, start) for s in (b" ", b"\t", b"\n", b"\r")) if p >= 0]
    return min(found) if found else len(text)


def join_ids(enc: Encoder, parts: list[bytes], ids: list[np.ndarray]) -> np.ndarray:
    """Ids of the joined parts from the ids of each part alone.

    The repaired stretch ``[tail | head]`` reaches from white space to white
    space.  Its ids replace those of the two fragments once the left ids end
    with the tail's and the right ids begin with the head's.
    """
    if not enc.by_word:  # white space matters to this tokenizer: nothing to reuse at the joins
        return enc.encode(pa.array([b"".join(parts).decode()]))[0]
    out: list[np.ndarray] = []
    text, mine = parts[0], ids[0]
    for nxt, right in zip(parts[1:], ids[1:]):
        if text[-1] in _SPACE or nxt[0] in _SPACE:
            out.append(mine)
            text, mine = nxt, right
            continue
        a, b = _last_space(text, len(text)), _first_space(nxt, 0)
        while True:
            tail, head = text[a:], nxt[:b]
            t, h, both = (np.frombuffer(x, np.uint32) for x in _fragments(enc, [tail, head, tail + head]))
            if (len(t) <= len(mine) and len(h) <= len(right) and np.array_equal(mine[len(mine) - len(t):], t)
                    and np.array_equal(right[:len(h)], h)):
                break
            if a == 0 and b == len(nxt):  # both chunks whole: what they were encoded to is not used at all
                t, h = mine, right
                break
            a = _last_space(text, max(a - 1, 0)) if a else 0
            b = _first_space(nxt, b + 1) if b < len(nxt) else b
        if b == len(nxt):  # no white space left in the next chunk: it melts into this one
            mine = np.concatenate([mine[:len(mine) - len(t)], both, right[len(h):]])
            text += nxt
        else:
            out += [mine[:len(mine) - len(t)], both]
            text, mine = nxt[b:], right[len(h):]
    out.append(mine)
    return np.concatenate(out)


def _fragments(enc: Encoder, parts: list[bytes]) -> list[bytes]:
    if any(s in p for p in parts for s in (b" ", b"\t", b"\n", b"\r")):
        ids, offs = enc.encode(pa.array([p.decode() for p in parts]))
        return [ids[a:b].tobytes() for a, b in zip(offs[:-1], offs[1:])]
    return enc.words([p.decode() for p in parts])


OUT = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def _encoded(path: str, with_text: bool, rest: bool):
    def run(key, docs, given):
        enc = encoder(path)
        texts = docs.column("text").combine_chunks()
        known = {k: np.frombuffer(x, _narrow(enc)).astype(np.uint32) for k, x in zip(
            zip(given.column("h").to_pylist(), given.column("k").to_pylist()), given.column("ids").to_pylist())}
        n, ids_sha, text_sha, decoded = [], [], [], []
        for lo, hi in C.slices(texts, SLICE):
            buf, offs = C.buffer(texts.slice(lo, hi - lo))
            begin, end = cuts(buf, offs)
            h, k = _keys(buf, begin, end)
            keys = list(zip(h.tolist(), k.tolist()))
            data = buf.tobytes()
            parts = [data[a:b] for a, b in zip(begin.tolist(), end.tolist())]
            new = {}
            for key2, p in zip(keys, parts):
                if key2 not in known:
                    new[key2] = p
            ids, at = enc.encode(pa.array(list(new.values()), pa.binary()).cast(pa.string()))
            own = dict(zip(new, (ids[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist()))))
            first = np.searchsorted(begin, offs)
            for a, b, empty in zip(first[:-1].tolist(), first[1:].tolist(), (np.diff(offs) == 0).tolist()):
                if empty:
                    x = np.zeros(0, np.uint32)
                else:
                    x = join_ids(enc, parts[a:b], [known[q] if q in known else own[q] for q in keys[a:b]])
                back = enc.decode(x)
                n.append(len(x))
                ids_sha.append(hashlib.sha256(x.tobytes()).hexdigest())
                text_sha.append(hashlib.sha256(back).hexdigest())
                if with_text:
                    decoded.append(back.decode())
        out = {"doc_id": docs.column("doc_id"), "n_tokens": pa.array(n, pa.int64()),
               "ids_sha256": pa.array(ids_sha, pa.string()), "decoded_sha256": pa.array(text_sha, pa.string())}
        if with_text:
            out["decoded"] = pa.array(decoded, pa.string())
        if rest:
            out["rest"] = docs.column("rest")
        return pa.table(out)

    return run


def encode_decode(docs: DataFrame, path: str | None = None, with_text: bool = False,
                  rest: list[str] | None = None) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)``, one row per input row.

    ``with_text`` adds the decoded text as ``decoded``; ``rest`` names columns
    carried along unchanged in a struct ``rest``.  ``path`` is a tokenizer
    file that every executor can read.
    """
    path = path or default_path()
    n_bytes = C.text_bytes(docs)
    groups = max(math.ceil(n_bytes / GROUP), min(2 * docs.sparkSession.sparkContext.defaultParallelism, 1 + (n_bytes >> 17)))
    spot = F.xxhash64("doc_id", "text")
    cols = [F.col("doc_id").cast("long").alias("doc_id"), "text", F.pmod(spot, F.lit(groups)).cast("int").alias("c")]
    if rest:
        cols.append(F.struct(*[F.col(f"`{x}`") for x in rest]).alias("rest"))
    dealt = docs.select(*cols)
    listed = C.staged(docs.select("text", spot.alias("spot"), F.pmod(spot, F.lit(groups)).cast("int").alias("c"))
                      .mapInArrow(_list, "h long, k long, c int, spot long, at long")
                      .groupBy("h", "k", "c").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("spot", "at")).alias("place")))
    shared = C.staged(listed.groupBy("h", "k").agg(
        F.sum("n").alias("n"), F.min(F.struct("place", "c")).getField("c").alias("c"), F.count(F.lit(1)).alias("groups"))
        .where("groups > 1").select("h", "k", "c"))
    codes = dealt.groupBy("c").cogroup(shared.groupBy("c")).applyInArrow(_owned(path), "h long, k long, ids binary")
    given = listed.select("h", "k", "c").join(codes, ["h", "k"])
    schema = OUT + ", decoded string" * with_text
    if rest:
        schema += f", rest {dealt.schema['rest'].dataType.simpleString()}"
    return dealt.groupBy("c").cogroup(given.groupBy("c")).applyInArrow(_encoded(path, with_text, bool(rest)), schema)


def round_trip(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``docs`` with the digest columns ``n_tokens, ids_sha256, decoded_sha256`` in a struct ``encoded``.

    All rows and columns stay as they are (a column ``encoded`` of the input
    is replaced).
    """
    rest = [c for c in docs.columns if c not in ("doc_id", "encoded")]
    out = encode_decode(docs, path, False, rest)
    kind = docs.schema["doc_id"].dataType
    return out.select(F.col("doc_id").cast(kind).alias("doc_id"), *[F.col(f"rest.`{c}`").alias(c) for c in rest],
                      F.struct("n_tokens", "ids_sha256", "decoded_sha256").alias("encoded"))
