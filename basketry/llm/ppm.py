"""Language-model scores by prediction by partial matching over byte contexts.

The model is a trie of byte contexts up to ORDER bytes with the counts of the
byte that follows, learned from all training texts (a start pad before, an end
symbol after each).  A byte is coded at the longest context that has seen it;
each context that has not is left by an escape (method C: as likely as its
number of distinct symbols), and symbols of the longer context are excluded
below it.  Because every context's symbols are among its suffix's symbols, the
excluded mass of a context is a number kept at the trie's node.  Unseen
symbols share what is left evenly.  ``score`` is the log10 probability of the
whole text and its end.

``base_score`` is the smoothed unigram score over lower-cased words and one end
token: the sum of log10((c + 0.5) / (N + 0.5 * (V + 1))).

Counts are exact and spread: texts are dealt into chunks; a chunk sends each
of its distinct grams and words once with its training count, to the parts
that they fall to and no others; grams meet by their last two context bytes,
words by hash, so a part holds all of a node's children; it answers each chunk
with the log probability of the chunk's grams and the counts of its words.
Byte pairs with at least 1/SPLIT of all positions are split by a third context
byte; what follows such a pair (256 counts) is then known to every part.  What
goes through the driver has a fixed size: the byte pairs (65,536 counts), what
follows the split ones (at most 256 * SPLIT counts) and two totals of words.

ORDER bytes of context and the symbol are one 64-bit key; the number of
distinct keys keeps growing with the input.  Keys travel as differences of the
sorted keys, all numbers as compressed byte planes.

Rows: every input row stays.  A null or empty text has no words, one end
token, and the score of the end symbol after the pad.  A null id is part of
the training rows or not as the caller's mark says.  Without training rows
every byte has probability 1/256.  An empty table gives an empty result.
Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm import common as C

ORDER, PAD, END, SYMBOLS = 6, 254, 255, 256
SPLIT = 1024
SLICE = 1 << 20
#: Bytes of text in a chunk: the more, the fewer grams are sent more than once.
CHUNK = 16 << 20
#: Rows that are scored together: a row's place among them fits the 8 bits that a key leaves free.
BLOCK = 256
#: Distinct word hashes that a task of the first scan holds before it hands them on.
HELD = 1 << 19
END_WORD = np.uint64(1)
_U = np.uint64


def framed(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts with pads before and an end symbol after each; the coded positions and their rows."""
    n = len(offsets) - 1
    size = np.diff(offsets)
    start = offsets[:-1] + np.arange(n) * (ORDER + 1)
    out = np.full(int(offsets[-1]) + n * (ORDER + 1), PAD, np.uint8)
    row = np.repeat(np.arange(n), size + 1)
    at = np.arange(len(row)) + ORDER * (row + 1)
    end = start + ORDER + size
    keep = np.ones(len(row), bool)
    keep[np.cumsum(size + 1) - 1] = False
    out[at[keep]] = buf
    out[end] = END
    return out, at, row


def gram_keys(text: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Context, last byte first, then the symbol: 8 bits each."""
    wide = text.astype(np.uint64)
    key = np.zeros(len(text), np.uint64)
    for k in range(1, ORDER + 1):
        key[k:] |= wide[:-k] << _U(8 * (ORDER + 1 - k))
    return (key | wide)[at]


def _rows(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).combine_chunks().to_numpy(zero_copy_only=False)


def _merge(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    k, c = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(k, kind="stable")
    k, c = k[order], c[order]
    at = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]])) if len(k) else np.zeros(0, np.int64)
    return k[at], np.add.reduceat(c, at) if len(at) else c


def _distinct(keys: list[np.ndarray]) -> np.ndarray:
    k = np.concatenate(keys)
    k.sort()
    return k[np.concatenate([[True], k[1:] != k[:-1]])] if len(k) else k


def merged(pieces: Iterator, merge, empty):
    """``merge`` over all pieces; equal numbers of them meet, so little more than the result is held."""
    held: list[tuple[int, object]] = []
    for one in pieces:
        n = 1
        while held and held[-1][0] == n:
            one = merge(held.pop()[1], one)
            n *= 2
        held.append((n, one))
    out = empty
    while held:
        out = merge(held.pop()[1], out)
    return out


def _counted(keys: np.ndarray, learn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and how often each occurs in training rows."""
    packed = (keys << _U(1)) | learn
    packed.sort()
    k = packed >> _U(1)
    at = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
    return k[at], np.add.reduceat((packed & _U(1)).astype(np.int64), at)


def _words(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased words and one end word per row, and their rows."""
    low = C.LOWER[buf]
    start, end = C.word_spans(low, offs)
    h = C.range_hash(C.prefix_hash(low), start, end) if len(start) else np.zeros(0, np.uint64)
    row = np.searchsorted(offs, start, "right") - 1
    n = len(offs) - 1
    return (np.concatenate([h | _U(2), np.full(n, END_WORD)]),  # bit 1 set: no word is the end word
            np.concatenate([row, np.arange(n)]))


def _gram_part(keys: np.ndarray, parts: int, hot: np.ndarray) -> np.ndarray:
    """Parts of grams: by the last two context bytes, where those are ``hot`` by the last three."""
    two = keys >> _U(8 * (ORDER - 1))
    three = (keys >> _U(8 * (ORDER - 2))) | _U(1 << 24)
    return (C.mix(np.where(hot[two.astype(np.int64)], three, two)) % _U(parts)).astype(np.int64)


def _word_part(keys: np.ndarray, parts: int) -> np.ndarray:
    return (C.mix(keys) % _U(parts)).astype(np.int64)


def _squeeze(values: np.ndarray) -> bytes:
    """Numbers as compressed byte planes."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T)
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def _spread(blob: bytes, n: int, dtype) -> np.ndarray:
    """What ``_squeeze`` took, ``n`` numbers of ``dtype``."""
    width = np.dtype(dtype).itemsize
    planes = np.frombuffer(pa.decompress(blob, n * width, codec="zstd", asbytes=True), np.uint8).reshape(width, n)
    return np.ascontiguousarray(planes.T).view(dtype).ravel()


def _chunk(table: pa.Table) -> Iterator[tuple]:
    texts, learn = table.column("text").combine_chunks(), _rows(table, "learn").astype(np.uint64)
    for lo, hi in C.slices(texts, SLICE):
        buf, offs = C.buffer(texts.slice(lo, hi - lo))
        yield lo, hi, buf, offs, learn[lo:hi]


def _vocabulary(table: pa.Table) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
    """Sorted distinct grams and words of a chunk with their training counts."""
    def pieces():
        for _, _, buf, offs, learn in _chunk(table):
            text, at, row = framed(buf, offs)
            h, word_row = _words(buf, offs)
            order = np.argsort(h)
            h, flag = h[order], learn[word_row[order]].astype(np.int64)
            first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
            yield _counted(gram_keys(text, at), learn[row]), (h[first], np.add.reduceat(flag, first))

    none = (np.zeros(0, np.uint64), np.zeros(0, np.int64))
    return merged(pieces(), lambda x, y: tuple(_merge([a, c], [b, d]) for (a, b), (c, d) in zip(x, y)), (none, none))


def _keys(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct grams and words of a chunk."""
    def pieces():
        for _, _, buf, offs, _ in _chunk(table):
            text, at, _ = framed(buf, offs)
            yield _distinct([gram_keys(text, at)]), _distinct([_words(buf, offs)[0]])

    none = np.zeros(0, np.uint64)
    return merged(pieces(), lambda x, y: tuple(_distinct([a, b]) for a, b in zip(x, y)), (none, none))


SENT = "kind int, part int, c int, n int, keys binary, counts binary"


def _places(k: np.ndarray, of: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each part that has keys, with the places of its keys (ascending as the keys are)."""
    order = np.argsort(of, kind="stable")
    cut = np.flatnonzero(np.diff(of[order])) + 1
    for places in np.split(order, cut) if len(order) else ():
        yield int(of[places[0]]), places


def _send(parts: int, known):
    def run(key, table):
        out: dict[str, list] = {n: [] for n in ("kind", "part", "c", "n", "keys", "counts")}
        for kind, (k, n) in enumerate(_vocabulary(table)):
            n = n.astype(np.uint32)
            for p, at in _places(k, _word_part(k, parts) if kind else _gram_part(k, parts, known.value.hot)):
                row = (kind, p, key[0].as_py(), len(at), _squeeze(np.diff(k[at], prepend=_U(0))), _squeeze(n[at]))
                for name, v in zip(out, row):
                    out[name].append(v)
        return pa.table({n: pa.array(v, pa.binary() if n in ("keys", "counts") else pa.int32()) for n, v in out.items()})

    return run


class Known:
    """What every part knows: counts of byte pairs, which contexts of two bytes are split and what follows those, word totals."""

    def __init__(self) -> None:
        self.pairs = np.zeros((SYMBOLS, SYMBOLS), np.int64)
        self.hot = np.zeros(SYMBOLS * SYMBOLS, bool)
        self.keys, self.counts = np.zeros(0, np.uint64), np.zeros(0)
        self.tokens = self.words = 0


class Trie:
    """Counts of ``(context, symbol)`` for each order, from the deepest grams and the byte pairs."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, known: Known) -> None:
        pairs = known.pairs
        seen = counts > 0
        k, n = keys[seen], counts[seen].astype(np.float64)
        self.table: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for o in range(ORDER, 1, -1):
            if o < ORDER:
                k, n = _merge([((k >> _U(16)) << _U(8)) | (k & _U(255))], [n])
            if o == 2:  # a split context has children in other parts too
                own = ~known.hot[(k >> _U(8)).astype(np.int64)]
                k, n = _merge([k[own], known.keys], [n[own], known.counts])
            self.table[o] = (k, n)
        a, b = np.nonzero(pairs)
        self.table[1] = ((a.astype(np.uint64) << _U(8)) | b.astype(np.uint64), pairs[a, b].astype(np.float64))
        single = pairs.sum(axis=0)
        s = np.flatnonzero(single)
        self.table[0] = (s.astype(np.uint64), single[s].astype(np.float64))
        self.node: dict[int, tuple[np.ndarray, ...]] = {}
        for o in range(ORDER + 1):  # contexts: occurrences, distinct symbols, mass that they exclude one order below
            k, n = self.table[o]
            ctx, of, kinds = np.unique(k >> _U(8), return_inverse=True, return_counts=True)
            below = np.zeros(len(ctx))
            if o:
                lower = ((k >> _U(16)) << _U(8)) | (k & _U(255)) if o > 1 else k & _U(255)
                below = np.bincount(of, weights=self.count(o - 1, lower), minlength=len(ctx))
            self.node[o] = (ctx, np.bincount(of, weights=n, minlength=len(ctx)), kinds.astype(np.float64), below)

    def count(self, o: int, keys: np.ndarray) -> np.ndarray:
        k, n = self.table[o]
        if not len(k):
            return np.zeros(len(keys))
        j = np.minimum(np.searchsorted(k, keys), len(k) - 1)
        return np.where(k[j] == keys, n[j], 0.0)

    def context(self, o: int, ctx: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        c, n, t, below = self.node[o]
        if not len(c):
            return (np.zeros(len(ctx)),) * 3
        j = np.minimum(np.searchsorted(c, ctx), len(c) - 1)
        hit = c[j] == ctx
        return np.where(hit, n[j], 0.0), np.where(hit, t[j], 0.0), np.where(hit, below[j], 0.0)

    def log10(self, keys: np.ndarray) -> np.ndarray:
        """log10 probability of each gram's symbol in its context."""
        out = np.zeros(len(keys))
        open_ = np.ones(len(keys), bool)
        mass, kinds_above = np.zeros(len(keys)), np.zeros(len(keys))
        symbol = keys & _U(255)
        for o in range(ORDER, -1, -1):
            ctx = keys >> _U(8 * (ORDER + 1 - o)) if o else np.zeros(len(keys), np.uint64)
            n, t, below = self.context(o, ctx)
            found = self.count(o, (ctx << _U(8)) | symbol if o else symbol)
            total, fresh = n - mass, t - kinds_above
            live = open_ & (fresh > 0)
            whole = np.where(live, total + fresh, 1.0)
            here = live & (found > 0)
            out += np.log10(np.where(here, found, np.where(live, fresh, 1.0)) / whole)
            open_ &= ~here
            mass, kinds_above = below, t
        left = SYMBOLS - kinds_above
        return out - np.where(open_, np.log10(np.maximum(left, 1)), 0.0)


REPLY = "c int, kind int, part int, n int, which binary, answers binary"


def _answer(known):
    def run(key, table):
        kind, part = key[0].as_py(), key[1].as_py()
        sizes = table.column("n").to_pylist()
        keys = [np.cumsum(_spread(x, n, np.uint64)) for x, n in zip(table.column("keys").to_pylist(), sizes)]
        counts = [_spread(x, n, np.uint32).astype(np.int64) for x, n in zip(table.column("counts").to_pylist(), sizes)]
        k, n = _merge(keys, counts)
        value = n.astype(np.uint64) if kind else Trie(k, n, known.value).log10(k)
        distinct, of = np.unique(value, return_inverse=True)  # few: grams of equal counts have equal answers
        out: dict[str, list] = {"n": [], "which": [], "answers": []}
        for x in keys:
            u, i = np.unique(of[np.searchsorted(k, x)], return_inverse=True)
            for name, v in zip(out, (len(u), _squeeze(i.astype(np.uint32)), _squeeze(distinct[u]))):
                out[name].append(v)
        m = table.num_rows
        return pa.table({"c": table.column("c").cast(pa.int32()), "kind": pa.array([kind] * m, pa.int32()),
                         "part": pa.array([part] * m, pa.int32()), "n": pa.array(out["n"], pa.int32()),
                         "which": pa.array(out["which"], pa.binary()), "answers": pa.array(out["answers"], pa.binary())})

    return run


def _row_sums(buf: np.ndarray, offs: np.ndarray, keys: np.ndarray, logs: np.ndarray) -> np.ndarray:
    """Sums over each of at most BLOCK rows of the ``logs`` of its grams."""
    text, at, row = framed(buf, offs)
    packed = (gram_keys(text, at) << _U(8)) | row.astype(np.uint64)
    packed.sort()
    k = packed >> _U(8)
    first = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
    each = np.repeat(logs[np.searchsorted(keys, k[first])], np.diff(np.append(first, len(k))))
    return np.bincount((packed & _U(255)).astype(np.int64), weights=each, minlength=len(offs) - 1)


def _score(parts: int, known):
    def run(key, docs, reply):
        gk, wk = _keys(docs)
        total_n, total_v = known.value.tokens, known.value.words
        answers = {(kind, p): got for kind, p, *got in zip(*(reply.column(x).to_pylist() for x in ("kind", "part", "n", "which", "answers")))}
        value = [np.zeros(len(gk)), np.zeros(len(wk), np.uint64)]
        for which, (k, of) in enumerate(((gk, _gram_part(gk, parts, known.value.hot)), (wk, _word_part(wk, parts)))):
            for p, at in _places(k, of):
                n, i, got = answers.pop((which, p))
                value[which][at] = _spread(got, n, value[which].dtype)[_spread(i, len(at), np.uint32)]
        norm = math.log10(total_n + 0.5 * (total_v + 1))
        n_tokens, n_known, base, score = [], [], [], []
        for lo, hi, buf, offs, _ in _chunk(docs):
            n = hi - lo
            for at in range(0, n, BLOCK):
                some = offs[at:at + BLOCK + 1]
                score.append(_row_sums(buf[some[0]:some[-1]], some - some[0], gk, value[0]))
            h, row = _words(buf, offs)
            u, of = np.unique(h, return_inverse=True)
            c = value[1][np.searchsorted(wk, u)].astype(np.float64)
            n_tokens.append(np.bincount(row, minlength=n))
            n_known.append(np.bincount(row, weights=(c > 0)[of], minlength=n).astype(np.int64))
            base.append(np.bincount(row, weights=(np.log10(c + 0.5) - norm)[of], minlength=n))
        cat = lambda x, t: pa.array(np.concatenate(x), t)
        return pa.table({"doc_id": docs.column("doc_id"), "learn": docs.column("learn"), "n_tokens": cat(n_tokens, pa.int64()),
                         "n_known": cat(n_known, pa.int64()), "train_tokens": pa.array([total_n] * docs.num_rows, pa.int64()),
                         "base_score": cat(base, pa.float64()), "score": cat(score, pa.float64())})

    return run


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of byte pairs, one batch a task."""
    total = np.zeros(SYMBOLS * SYMBOLS, np.int64)
    for b in batches:
        texts = C.column(b, "text")
        for lo, hi in C.slices(texts, SLICE):
            text, at, _ = framed(*C.buffer(texts.slice(lo, hi - lo)))
            total += np.bincount((text[at - 1].astype(np.int64) << 8) | text[at], minlength=len(total))
    hit = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(hit, pa.int32()), pa.array(total[hit])], ["pair", "n"])


def _gathered(hot: np.ndarray):
    """``(kind, key, n)``: counts of what follows the split contexts (0) and of words (1), added up while they fit HELD."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.uint64), np.zeros(0, np.int64))] * 2

        def rows():
            for kind, (k, n) in enumerate(held):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(k), kind, np.int32)), pa.array(k.view(np.int64)), pa.array(n)],
                                                 ["kind", "key", "n"])

        for b in batches:
            texts = C.column(b, "text")
            for lo, hi in C.slices(texts, SLICE):
                buf, offs = C.buffer(texts.slice(lo, hi - lo))
                text, at, _ = framed(buf, offs)
                wide = text.astype(np.uint64)
                context = (wide[at - 1] << _U(8)) | wide[at - 2]
                three = ((context << _U(8)) | wide[at])[hot[context.astype(np.int64)]]
                for kind, keys in enumerate((three, _words(buf, offs)[0])):
                    keys.sort()
                    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
                    held[kind] = _merge([held[kind][0], keys[first]], [held[kind][1], np.diff(np.append(first, len(keys)))])
                if max(len(k) for k, _ in held) > HELD:
                    yield from rows()
                    held[:] = [(k[:0], n[:0]) for k, n in held]
        yield from rows()

    return run


def _known(training: DataFrame) -> Known:
    """Counts of fixed size over all training texts, from two scans of them."""
    out, texts = Known(), training.select("text")
    for r in texts.mapInArrow(_pairs, "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n")).collect():  # at most 65,536
        out.pairs[r.pair >> 8, r.pair & 255] = r.n
    often = (out.pairs > 0) & (out.pairs * SPLIT >= out.pairs.sum())
    out.hot = often.T.ravel()  # a context has its last byte first
    counted = texts.mapInArrow(_gathered(out.hot), "kind int, key long, n long").groupBy("kind", "key").agg(F.sum("n").alias("n"))
    small = counted.groupBy(F.when(F.col("kind") == 0, F.col("key")).alias("key")).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("kinds"))
    got = {r.key: (r.n, r.kinds) for r in small.collect()}  # at most 256 * SPLIT rows and the totals of the words
    out.tokens, out.words = got.pop(None, (0, 0))
    out.keys = np.array(sorted(got), np.uint64)
    out.counts = np.array([got[k][0] for k in sorted(got)], np.float64)
    return out


def ppm_scores(docs: DataFrame, learn: Column) -> DataFrame:
    """``(doc_id, learn, n_tokens, n_known, train_tokens, base_score, score)``, one row per input row."""
    spark = docs.sparkSession
    n_bytes = C.text_bytes(docs)
    chunks = C.chunk_count(n_bytes, spark, CHUNK)
    parts = max(16, math.ceil(n_bytes / (16 << 20)))
    dealt = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.coalesce(learn, F.lit(False)).alias("learn"),
                        F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)).cast("int").alias("c"))
    known = spark.sparkContext.broadcast(_known(docs.where(F.coalesce(learn, F.lit(False)))))  # of fixed size
    sent = dealt.groupBy("c").applyInArrow(_send(parts, known), SENT)
    reply = sent.groupBy("kind", "part").applyInArrow(_answer(known), REPLY)
    return dealt.groupBy("c").cogroup(reply.groupBy("c")).applyInArrow(
        _score(parts, known), "doc_id long, learn boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
