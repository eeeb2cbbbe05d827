"""Repeated byte passages across documents, found by suffix sorting.

A byte goes when a string of ``length`` bytes that covers it also starts in a
document with a smaller id, judged on the input.  Exact, and no task ever
holds more than a chunk of documents or a share of the anchors:

1. Texts are dealt into chunks by id.  Every window of ``length`` bytes has
   one anchor: its byte string of ``ANCHOR`` bytes with the least hash (the
   leftmost of equals), so equal windows have equal anchors.  A chunk sends
   each of its anchors once, to the anchor's part; a passage of a third of
   all documents costs one entry a chunk.
2. A part answers which anchors occur in two documents or more, and which of
   them have more than HOT_RUNS runs (counted per chunk).
3. For those, a chunk sends each distinct run (the bytes of consecutive
   windows with one anchor) once, with the least id that has it.  At a hot
   anchor it sends the windows as runs of their own under the hash of their
   bytes: equal windows still meet, but the anchor is spread over all parts.
4. A part sorts the runs.  Where an anchor has one run only, all its windows
   begin in the same documents.  Runs that differ are laid end to end, the
   anchor as one symbol, and suffix-sorted (``gsaca``); neighbours that share
   a window's symbols have equal windows, and the least id of each such
   stretch is their verdict.
5. The verdict goes back as bits: windows that begin in a document
   below the chunk's least one with the run.  A chunk marks those, and for documents other than its
   least one with a run, all of the run's windows.

Rows: every input row stays; a null text is empty, texts below ``length``
bytes keep all bytes.  Rows that share an id do not remove from each other.
A row with a null id neither loses bytes nor makes others lose any.  An empty
table gives an empty result.  Other columns pass through unchanged.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm import common as C
from basketry.llm.gsaca import suffix_array

ANCHOR = 24
LENGTH = 50
POS_BITS = 24
SLICE = 256 << 10
CHUNK = 2 << 20
#: Symbols that are suffix-sorted together.
SORT_BLOCK = 4096
#: Runs of one anchor, over all chunks, that may come to one part.
HOT_RUNS = 1024
_U = np.uint64


def anchor_hash(buf: np.ndarray) -> np.ndarray:
    """Hash of the ANCHOR bytes at each position, doubled up from single bytes."""
    b = C.BASE
    h1 = C.BYTE_VALUE[buf]
    h2 = h1[:-1] * _U(b) + h1[1:]
    h4 = h2[:-2] * _U(pow(b, 2, 1 << 64)) + h2[2:]
    h8 = h4[:-4] * _U(pow(b, 4, 1 << 64)) + h4[4:]
    h16 = h8[:-8] * _U(pow(b, 8, 1 << 64)) + h8[8:]
    h = h16[:-8] * _U(pow(b, 8, 1 << 64)) + h8[16:]
    h ^= h >> _U(31)
    h *= _U(0xBF58476D1CE4E5B9)
    h ^= h >> _U(27)
    h *= _U(0x94D049BB133111EB)
    return h


def sliding_min(v: np.ndarray, width: int) -> np.ndarray:
    have = 1
    while 2 * have <= width:
        v = np.minimum(v[:-have], v[have:])
        have *= 2
    return np.minimum(v[:len(v) - (width - have)], v[width - have:]) if width > have else v


def runs(buf: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """``(key, first, last, at, doc)``: anchors with the first and last window start that have them.

    ``at`` is the anchor's own position.  No window crosses rows.
    """
    if len(buf) < length:
        e = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), e, e, e, e
    h = anchor_hash(buf)
    low = _U((1 << POS_BITS) - 1)
    least = sliding_min((h & ~low) | np.arange(len(h), dtype=np.uint64), length - ANCHOR + 1)
    pos = (least & low).astype(np.int64)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[:len(pos)]
    valid = np.arange(len(pos)) + length <= offsets[1:][row]
    change = np.ones(len(pos), bool)
    change[1:] = (pos[1:] != pos[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(change & valid)
    stop = np.ones(len(pos), bool)
    stop[:-1] = change[1:] | ~valid[1:]
    last = np.flatnonzero(stop & valid)
    return h[pos[first]], first, last, pos[first], row[first]


def pieces(texts: pa.Array, length: int):
    """``(row range, buffer, offsets, shift)`` of slices; a very long text comes in pieces that overlap."""
    for lo, hi in C.slices(texts, SLICE):
        buf, offs = C.buffer(texts.slice(lo, hi - lo))
        step = 4 << 20
        if hi - lo > 1 or len(buf) <= step:
            yield lo, hi, buf, offs, 0
        else:
            for at in range(0, max(1, len(buf) - length + 1), step):
                part = buf[at:at + step + length - 1]
                yield lo, hi, part, np.array([0, len(part)]), at


def _ids(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    ids = table.column("doc_id").combine_chunks()
    known = ids.is_valid().to_numpy(zero_copy_only=False)
    return ids.fill_null(0).to_numpy(zero_copy_only=False), known


def _texts(table: pa.Table) -> pa.Array:
    return table.column("text").combine_chunks()


def _dealt(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For sorted keys: the parts that occur and where each begins and ends."""
    part = (keys >> _U(64 - bits)).astype(np.int64)
    at = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])) if len(part) else np.zeros(0, np.int64)
    return part[at], at, np.append(at[1:], len(part))


ANCHORS = "part int, c int, keys binary, many binary, more binary"


def _anchors(bits: int, length: int):
    """Each anchor of a chunk once, whether two of its documents have it, and its runs beyond the first."""
    drop = _U(32 - bits)

    def run(key, table):
        ids, known = _ids(table)
        keys, docs, names = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
        for lo, _, buf, offs, _ in pieces(_texts(table), length):
            k, first, last, _, row = runs(buf, offs, length)
            keep = known[lo + row]
            keys.append((k[keep] >> drop) << drop)
            docs.append(ids[lo + row[keep]])
            if keep.any():
                names.append(_run_key(C.prefix_hash(buf), k[keep], first[keep], last[keep], length))
        k, d, rk = np.concatenate(keys), np.concatenate(docs), np.concatenate(names)
        order = np.argsort(k)
        k, d, rk = k[order], d[order], rk[order]
        new = np.concatenate([[True], k[1:] != k[:-1]]) if len(k) else np.zeros(0, bool)
        at = np.flatnonzero(new)
        more = _more_runs(at, rk)
        k = k[at]
        many = np.minimum.reduceat(d, at) != np.maximum.reduceat(d, at) if len(at) else new
        parts, s, e = _dealt(k, bits)
        low = ((k >> drop) & _U(0xFFFFFFFF)).astype(np.uint32)
        return pa.table({"part": pa.array(parts, pa.int32()), "c": pa.array([key[0].as_py()] * len(parts), pa.int32()),
                         "keys": pa.array([low[a:b].tobytes() for a, b in zip(s, e)], pa.binary()),
                         "many": pa.array([np.packbits(many[a:b]).tobytes() for a, b in zip(s, e)], pa.binary()),
                         "more": pa.array([_sparse(more[a:b]) for a, b in zip(s, e)], pa.binary())})

    return run


def _more_runs(at: np.ndarray, rk: np.ndarray) -> np.ndarray:
    """For groups that begin at ``at``: how many distinct runs each has beyond its first."""
    size = np.diff(np.append(at, len(rk)))
    group = np.repeat(np.arange(len(at)), size)
    several = np.repeat(size > 1, size)
    g, x = group[several], rk[several]
    order = np.lexsort((x, g))
    g, x = g[order], x[order]
    return np.bincount(g[1:][(g[1:] == g[:-1]) & (x[1:] != x[:-1])], minlength=len(at))


def _sparse(counts: np.ndarray) -> bytes:
    """Places and values of the counts that are not zero."""
    at = np.flatnonzero(counts)
    return np.concatenate([at, counts[at]]).astype(np.uint32).tobytes()


def _dense(data: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros(n, np.int64)
    out[data[:len(data) // 2]] = data[len(data) // 2:]
    return out


def _blobs(table: pa.Table, name: str, kind) -> list[np.ndarray]:
    return [np.frombuffer(x, kind) for x in table.column(name).to_pylist()]


SHARED = "c int, part int, keys binary, hot binary"


def _shared(key, table):
    """For each chunk the anchors of this part that occur in two documents anywhere, and places of the hot ones."""
    blobs = _blobs(table, "keys", np.uint32)
    c = table.column("c").to_numpy()
    many = np.concatenate([np.unpackbits(m, count=len(k)).astype(bool)
                           for m, k in zip(_blobs(table, "many", np.uint8), blobs)])
    which = np.repeat(np.arange(len(blobs)), [len(b) for b in blobs])
    packed = (np.concatenate(blobs).astype(np.uint64) << _U(32)) | np.arange(len(which), dtype=np.uint64)
    packed.sort()
    k, i = packed >> _U(32), (packed & _U(0xFFFFFFFF)).astype(np.int64)
    new = np.concatenate([[True], k[1:] != k[:-1]])
    group = np.cumsum(new) - 1
    shared = (np.bincount(group) > 1) | (np.bincount(group, weights=many[i]) > 0)
    more = np.concatenate([_dense(x, len(k)) for x, k in zip(_blobs(table, "more", np.uint32), blobs)])
    many_runs = np.bincount(group, weights=1 + more[i]) > HOT_RUNS
    hit, warm = np.zeros(len(which), bool), np.zeros(len(which), bool)
    hit[i] = shared[group]
    warm[i] = many_runs[group]
    ends = np.cumsum([len(b) for b in blobs])
    out = []
    for j, (b, e) in enumerate(zip(blobs, ends)):
        mine = hit[e - len(b):e]
        if mine.any():
            out.append((int(c[j]), b[mine], np.flatnonzero(warm[e - len(b):e][mine]).astype(np.uint32)))
    return pa.table({"c": pa.array([j for j, _, _ in out], pa.int32()),
                     "part": pa.array([key[0].as_py()] * len(out), pa.int32()),
                     "keys": pa.array([b.tobytes() for _, b, _ in out], pa.binary()),
                     "hot": pa.array([h.tobytes() for _, _, h in out], pa.binary())})


RUNS = "part int, c int, key binary, run binary, docs binary, doc binary, at binary, size binary, text binary, hot binary"


def _run_key(prefix: np.ndarray, key: np.ndarray, first: np.ndarray, last: np.ndarray, length: int) -> np.ndarray:
    return C.mix(C.range_hash(prefix, first, last + length) + key)


def _windows(prefix: np.ndarray, hot: np.ndarray, length: int, k: np.ndarray, first: np.ndarray, last: np.ndarray,
             at: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, ...]:
    """``(key, first, last, at, row, anchor)``: runs at hot anchors fall into their windows, keyed by the window's bytes."""
    w = np.where(hot, last - first + 1, 1)
    place = np.arange(int(w.sum())) - np.repeat(np.cumsum(w) - w, w)
    anchor, first, last, at, row, alone = (np.repeat(x, w) for x in (k, first, last, at, row, hot))
    key, first, last = anchor.copy(), first + place, np.where(alone, first + place, last)
    f, middle = first[alone], first[alone] + length // 2
    left, right = C.range_hash(prefix, f, middle), C.range_hash(prefix, middle, f + length)
    key[alone] = C.mix(C.mix(left + anchor[alone]) + right)
    return key, first, last, at, row, np.where(alone, anchor, _U(0))


def _place(docs: np.ndarray):
    return np.uint16 if len(docs) <= 1 << 16 else np.uint32


def _least_rows(k: np.ndarray, rk: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """An order by run and document, where each run begins in it, and whether it has two documents."""
    order = np.lexsort((doc, rk, k))
    new = np.concatenate([[True], (k[order][1:] != k[order][:-1]) | (rk[order][1:] != rk[order][:-1])])
    at = np.flatnonzero(new)
    last = np.append(at[1:], len(order)) - 1
    return order, at, doc[order[at]] != doc[order[last]]


def _doc_lists(table: pa.Table) -> list[np.ndarray]:
    return [u[np.frombuffer(x, _place(u))] for u, x in
            zip(_blobs(table, "docs", np.int64), table.column("doc").to_pylist())]


def _runs(bits: int, length: int):
    """The distinct runs of a chunk at shared anchors, with the least id of each."""
    drop = _U(32 - bits)

    def run(key, docs, shared):
        cols: list[tuple] = []
        if docs.num_rows and shared.num_rows:
            ids, known = _ids(docs)
            wanted = np.concatenate([(np.uint64(p) << _U(64 - bits)) | (b.astype(np.uint64) << drop) for p, b in
                                     zip(shared.column("part").to_pylist(), _blobs(shared, "keys", np.uint32))])
            hot = np.zeros(len(wanted), bool)
            ends = np.cumsum([len(b) for b in _blobs(shared, "keys", np.uint32)])
            for e, n, x in zip(ends, np.diff(ends, prepend=0), _blobs(shared, "hot", np.uint32)):
                hot[e - n + x] = True
            by = np.argsort(wanted)
            wanted, hot = wanted[by], hot[by]
            for lo, _, buf, offs, _ in pieces(_texts(docs), length):
                k, first, last, at, row = runs(buf, offs, length)
                cut = (k >> drop) << drop
                j = np.minimum(np.searchsorted(wanted, cut), len(wanted) - 1)
                keep = (wanted[j] == cut) & known[lo + row]
                k, first, last, at, row, warm = (x[keep] for x in (k, first, last, at, row, hot[j]))
                if not len(k):
                    continue
                prefix = C.prefix_hash(buf)
                anchor = np.zeros(len(k), np.uint64)
                if warm.any():
                    k, first, last, at, row, anchor = _windows(prefix, warm, length, k, first, last, at, row)
                rk = _run_key(prefix, k, first, last, length)
                order, at_first, several = _least_rows(k, rk, ids[lo + row])
                o = order[at_first]
                size = last[o] + length - first[o]
                text = [bytes(buf[a:p]) + bytes(buf[p + ANCHOR:a + s])  # the anchor itself is known by its key
                        for a, p, s in zip(first[o].tolist(), at[o].tolist(), size.tolist())]
                cols.append((k[o], rk[o], ids[lo + row[o]], at[o] - first[o], size, several, anchor[o], text))
        if not cols:
            return pa.Table.from_batches([], pa.schema([("part", pa.int32()), ("c", pa.int32())] + [
                (n, pa.binary()) for n in ("key", "run", "docs", "doc", "at", "size", "text", "hot")]))
        k, rk, doc, at, size, more, anchor = (np.concatenate([x[n] for x in cols]) for n in range(7))
        text = [t for x in cols for t in x[7]]
        order, at_first, several = _least_rows(k, rk, doc)
        more = several | np.maximum.reduceat(more[order], at_first)
        o = order[at_first]
        k, rk, doc, at, size = k[o], rk[o], doc[o], (at[o] + 128 * more).astype(np.uint8), size[o].astype(np.uint8)
        text, anchor = [text[j] for j in o], anchor[o]
        parts, s, e = _dealt(k, bits)
        cut = lambda x: pa.array([x[a:b].tobytes() for a, b in zip(s, e)], pa.binary())
        names = [np.unique(doc[a:b], return_inverse=True) for a, b in zip(s, e)]
        return pa.table({"part": pa.array(parts, pa.int32()), "c": pa.array([key[0].as_py()] * len(parts), pa.int32()),
                         "key": cut(k), "run": cut(rk), "docs": pa.array([u.astype(np.int64).tobytes() for u, _ in names], pa.binary()),
                         "doc": pa.array([i.astype(_place(u)).tobytes() for u, i in names], pa.binary()), "at": cut(at), "size": cut(size),
                         "text": pa.array([b"".join(text[a:b]) for a, b in zip(s, e)], pa.binary()),
                         "hot": pa.array([np.unique(anchor[a:b][anchor[a:b] > 0]).tobytes() for a, b in zip(s, e)], pa.binary())})

    return run


VERDICTS = "c int, run binary, docs binary, doc binary, gone binary, hot binary"


def window_verdicts(strings: list[np.ndarray], docs: np.ndarray, width: int) -> list[np.ndarray]:
    """Least id of each window of ``width`` symbols of each string, over all strings that hold it."""
    sizes = np.array([len(s) for s in strings])
    flat = np.zeros(int(sizes.sum()) + len(strings), np.int64)  # a separator (0) ends each string
    begin = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    for b, s in zip(begin.tolist(), strings):
        flat[b:b + len(s)] = s
    owner = np.repeat(np.arange(len(strings)), sizes + 1)
    left = np.repeat(begin + sizes, sizes + 1) - np.arange(len(flat))
    sa = suffix_array(flat)
    sa = sa[left[sa] >= width]
    view = np.lib.stride_tricks.sliding_window_view(flat, width)
    new = np.ones(len(sa), bool)
    for a in range(1, len(sa), 8192):
        b = min(len(sa), a + 8192)
        new[a:b] = (view[sa[a:b]] != view[sa[a - 1:b - 1]]).any(axis=1)
    least = np.full(len(flat), -1, np.int64)
    if len(sa):
        at = np.flatnonzero(new)
        group = np.cumsum(new) - 1
        least[sa] = np.minimum.reduceat(docs[owner[sa]], at)[group]
    return [least[b:b + n - width + 1] for b, n in zip(begin.tolist(), sizes.tolist())]


def _verdicts(length: int):
    width = length - ANCHOR + 1  # the anchor is one symbol

    def run(key, table):
        c = table.column("c").to_numpy()
        kb = _blobs(table, "key", np.uint64)
        k, rk = np.concatenate(kb), np.concatenate(_blobs(table, "run", np.uint64))
        doc = np.concatenate(_doc_lists(table))
        at, size = np.concatenate(_blobs(table, "at", np.uint8)), np.concatenate(_blobs(table, "size", np.uint8)).astype(np.int64)
        more, at = at >= 128, at & 127
        text = np.concatenate(_blobs(table, "text", np.uint8))
        begin = np.concatenate([[0], np.cumsum(size - ANCHOR)[:-1]])
        stop = np.cumsum([len(x) for x in kb]).tolist()
        order = np.lexsort((rk, k))
        new_key = np.concatenate([[True], k[order][1:] != k[order][:-1]])
        new_run = new_key | np.concatenate([[True], rk[order][1:] != rk[order][:-1]])
        starts = np.flatnonzero(new_run)
        run_of = np.empty(len(k), np.int64)
        run_of[order] = np.cumsum(new_run) - 1
        least = np.minimum.reduceat(doc[order], starts)
        sample = order[starts]
        of_key = np.cumsum(new_key[starts]) - 1
        several = np.bincount(of_key)[of_key] > 1
        windows = np.where(several, size[sample] - length + 1, 1)
        offs = np.concatenate([[0], np.cumsum(windows)])
        flat = np.repeat(least, windows)
        rows = np.flatnonzero(several)
        edge = np.flatnonzero(np.concatenate([[True], of_key[rows][1:] != of_key[rows][:-1]])) if len(rows) else []
        block: list[int] = []
        total = 0

        def sort_block() -> None:
            strings = []
            for j in block:
                i = sample[j]
                s = np.empty(size[i] - ANCHOR + 1, np.int64)
                s[:at[i]] = text[begin[i]:begin[i] + at[i]]
                s[at[i]] = 300 + of_key[j]
                s[at[i] + 1:] = text[begin[i] + at[i]:begin[i] + size[i] - ANCHOR]
                strings.append(s + 1)
            for j, v in zip(block, window_verdicts(strings, least[block], width)):
                flat[offs[j]:offs[j + 1]] = v

        for a, b in zip(edge, [*edge[1:], len(rows)]):
            block += rows[a:b].tolist()
            total += int(size[sample[rows[a:b]]].sum())
            if total >= SORT_BLOCK:
                sort_block()
                block, total = [], 0
        if block:
            sort_block()
        out: dict[str, list] = {n: [] for n in ("c", "run", "docs", "doc", "gone", "hot")}
        hot = table.column("hot").to_pylist()
        for j, cc in enumerate(c.tolist()):
            here = slice(stop[j] - len(kb[j]), stop[j])
            mine, own = run_of[here], doc[here]
            n = windows[mine]
            idx = np.repeat(offs[mine] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            lower = flat[idx] < np.repeat(own, n)  # the window begins in a smaller document
            place = np.arange(len(lower)) - np.repeat(np.cumsum(n) - n, n)
            bit = np.add.reduceat(np.where(lower, _U(1) << place.astype(np.uint64), _U(0)), np.cumsum(n) - n)
            bit[(n == 1) & (bit == 1)] = _U(C.MASK)  # one verdict for all windows
            say = (bit > 0) | more[here]
            u, i = np.unique(own[say], return_inverse=True)
            out["c"].append(cc)
            out["run"].append(rk[here][say].tobytes())
            out["docs"].append(u.astype(np.int64).tobytes())
            out["doc"].append(i.astype(_place(u)).tobytes())
            out["gone"].append(bit[say].tobytes())
            out["hot"].append(hot[j] if say.any() else b"")
        return pa.table({n: pa.array(v, pa.int32() if n == "c" else pa.binary()) for n, v in out.items()})

    return run


def _marks(length: int, with_text: bool, rest: bool):
    def run(key, docs, verdicts):
        ids, known = _ids(docs)
        texts = _texts(docs)
        rk = np.concatenate([np.zeros(0, np.uint64), *_blobs(verdicts, "run", np.uint64)])
        bits = np.concatenate([np.zeros(0, np.uint64), *_blobs(verdicts, "gone", np.uint64)])
        least = np.concatenate([np.zeros(0, np.int64), *_doc_lists(verdicts)])
        order = np.argsort(rk)
        rk, bits, least = rk[order], bits[order], least[order]
        hot = np.unique(np.concatenate([np.zeros(0, np.uint64), *_blobs(verdicts, "hot", np.uint64)]))
        n_bytes, n_removed, n_spans, sha, kept = [], [], [], [], []
        for lo, hi in C.slices(texts, SLICE):
            buf, offs = C.buffer(texts.slice(lo, hi - lo))
            cover = np.zeros(len(buf) + 1, np.int32)
            if len(rk):
                for _, _, b, o, shift in pieces(texts.slice(lo, hi - lo), length):
                    k, first, last, at, row = runs(b, o, length)
                    keep = known[lo + row]
                    k, first, last, at, row = (x[keep] for x in (k, first, last, at, row))
                    if not len(k):
                        continue
                    prefix = C.prefix_hash(b)
                    warm = np.isin(k, hot)
                    if warm.any():
                        k, first, last, at, row, _ = _windows(prefix, warm, length, k, first, last, at, row)
                    r = _run_key(prefix, k, first, last, length)
                    j = np.minimum(np.searchsorted(rk, r), len(rk) - 1)
                    hit = np.flatnonzero(rk[j] == r)
                    j, f, w = j[hit], first[hit], last[hit] - first[hit] + 1
                    place = np.arange(int(w.sum())) - np.repeat(np.cumsum(w) - w, w)
                    lower = (np.repeat(bits[j], w) >> place.astype(np.uint64)) & _U(1) > 0
                    # the chunk's least document with the run keeps what begins in no smaller one; its others lose it
                    later = np.repeat(least[j] < ids[lo + row[hit]], w)
                    gone = (np.repeat(f, w) + place)[lower | later] + shift
                    np.add.at(cover, gone, 1)
                    np.add.at(cover, gone + length, -1)
            lost = np.cumsum(cover[:-1]) > 0
            rise = lost.copy()
            rise[1:] &= ~lost[:-1]
            inner = offs[:-1][np.diff(offs) > 0]
            rise[inner] = lost[inner]
            gone_at = np.concatenate([[0], np.cumsum(lost)])
            rise_at = np.concatenate([[0], np.cumsum(rise)])
            n_bytes.append(np.diff(offs))
            n_removed.append(gone_at[offs[1:]] - gone_at[offs[:-1]])
            n_spans.append(rise_at[offs[1:]] - rise_at[offs[:-1]])
            for a, b, m in zip(offs[:-1].tolist(), offs[1:].tolist(), n_removed[-1].tolist()):
                left = buf[a:b][~lost[a:b]].tobytes() if m else buf[a:b].tobytes()
                sha.append(hashlib.sha256(left).hexdigest())
                if with_text:
                    kept.append(left.decode("utf-8", "ignore"))
        long = lambda x: pa.array(np.concatenate([np.zeros(0, np.int64), *x]), pa.int64())
        out = {"doc_id": docs.column("doc_id"), "n_bytes": long(n_bytes), "n_removed": long(n_removed),
               "n_spans": long(n_spans), "kept_sha256": pa.array(sha, pa.string())}
        if with_text:
            out["kept"] = pa.array(kept, pa.string())
        if rest:
            out["rest"] = docs.column("rest")
        return pa.table(out)

    return run


def repeats(docs: DataFrame, length: int = LENGTH, with_text: bool = False, rest: list[str] | None = None) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256)``, one row per input row.

    ``with_text`` adds the remaining bytes as text, ``kept``; ``rest`` names columns
    carried along unchanged in a struct ``rest``.  ``length`` is 32 to 87.
    """
    if not 32 <= length <= 87:
        raise ValueError("length must be from 32 to 87")
    n_bytes = C.text_bytes(docs)
    chunks = max(math.ceil(n_bytes / CHUNK), min(2 * docs.sparkSession.sparkContext.defaultParallelism, 1 + (n_bytes >> 17)))
    bits = min(31, max(5, (n_bytes >> 21).bit_length()))  # parts follow the input; 31 is the width of their number
    cols = [F.col("doc_id").cast("long").alias("doc_id"), "text",
            F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)).cast("int").alias("c")]
    if rest:
        cols.append(F.struct(*[F.col(f"`{x}`") for x in rest]).alias("rest"))
    dealt = docs.select(*cols)
    anchors = dealt.groupBy("c").applyInArrow(_anchors(bits, length), ANCHORS)
    shared = anchors.groupBy("part").applyInArrow(_shared, SHARED)
    found = dealt.groupBy("c").cogroup(shared.groupBy("c")).applyInArrow(_runs(bits, length), RUNS)
    verdicts = found.groupBy("part").applyInArrow(_verdicts(length), VERDICTS)
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    schema += ", kept string" * with_text
    if rest:
        schema += f", rest {dealt.schema['rest'].dataType.simpleString()}"
    return dealt.groupBy("c").cogroup(verdicts.groupBy("c")).applyInArrow(_marks(length, with_text, bool(rest)), schema)


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``docs`` with each text cut down to its remaining bytes; characters cut in two are dropped.

    All columns and all rows stay; a text that loses nothing is returned as it
    is, and a null text becomes the empty text.
    """
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    out = repeats(docs, length, True, rest)
    kind = docs.schema["doc_id"].dataType
    return out.select(F.col("doc_id").cast(kind).alias("doc_id"), F.col("kept").alias("text"),
                      *[F.col(f"rest.`{c}`").alias(c) for c in rest]).select(*[F.col(f"`{c}`") for c in docs.columns])
