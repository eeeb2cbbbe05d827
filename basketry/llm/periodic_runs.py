"""Periodic runs of words, by recompression.

A run is a stretch of consecutive words with smallest period q (words q apart
are identical) and length >= max(``least``, 2 q) that no neighbouring word
extends keeping period q.

The words of a slice of texts are numbered, each text between marks that occur
once, and compressed into one run-length grammar (``recompression``).  A run of
period p and length >= 2 p contains a place i = k p of the harmonic grid, and
the words at i and i + p are identical; each such candidate is extended exactly
to both sides by common extensions on the grammar.  The candidate of the first
grid place in a run gives the run; runs found again under a multiple of their
period have the same ends, where the smallest period stays.

Each text is one row's work; memory is linear in a slice of texts or the
longest text.  No shuffle.

Rows: every input row stays, repeated ids too, each judged on its own text.  A
null text is empty and has no words and no runs.  An empty table gives an
empty result.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm import common as C
from basketry.llm.recompression import extend, extend_back, grammar

#: Bytes of text whose words share a grammar, and grid candidates looked at in one go.
SLICE, CANDIDATES = 1 << 20, 1 << 19
LEAST = 12


def grid(begin: np.ndarray, size: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``(text, place, period)`` of all grid candidates of texts at ``begin`` with ``size`` words, piece by piece."""
    texts = np.flatnonzero(size > 1)
    most = size[texts] // 2
    edge = np.concatenate([[0], np.cumsum(most)])
    for lo in range(0, int(edge[-1]), CANDIDATES):  # pairs of a text and a period
        pair = np.arange(lo, min(lo + CANDIDATES, int(edge[-1])))
        of = np.searchsorted(edge, pair, "right") - 1
        period = pair - edge[of] + 1
        text = texts[of]
        places = (size[text] - 1) // period
        upto = np.concatenate([[0], np.cumsum(places)])
        at = 0
        while at < len(pair):
            to = max(at + 1, int(np.searchsorted(upto, upto[at] + CANDIDATES, "right")) - 1)
            to = min(to, len(pair))
            n = places[at:to]
            p = np.repeat(period[at:to], n)
            k = np.arange(len(p)) - np.repeat(upto[at:to] - upto[at], n)
            t = np.repeat(text[at:to], n)
            yield t, begin[t] + k * p, p
            at = to


def runs_of(words: np.ndarray, begin: np.ndarray, size: np.ndarray, least: int = LEAST) -> np.ndarray:
    """Rows ``(text, start, length, period)`` of all runs, by text, start and period.

    ``words`` is the sequence of all texts with a symbol that occurs once
    before each and after the last; ``begin`` and ``size`` say where texts are.
    """
    levels = grammar(words)
    found = [np.zeros((0, 4), np.int64)]
    for text, place, period in grid(begin, size):
        same = words[place] == words[place + period]
        text, place, period = text[same], place[same], period[same]
        if not len(text):
            continue
        ahead = extend(levels, place, place + period)
        # the first grid place of a run lies less than a period behind its start
        need = np.maximum(least, 2 * period) - period
        some = ahead + period - 1 >= need
        text, place, period, ahead, need = text[some], place[some], period[some], ahead[some], need[some]
        behind = extend_back(levels, place - 1, place + period - 1)
        some = (behind < period) & (ahead + behind >= need)
        text, place, period = text[some], place[some], period[some]
        found.append(np.column_stack([text, place - behind[some] - begin[text], (period + ahead[some] + behind[some]), period]))
    out = np.concatenate(found)
    out = out[np.lexsort((out[:, 3], out[:, 2], out[:, 1], out[:, 0]))]
    keep = np.ones(len(out), bool)
    keep[1:] = (out[1:, :3] != out[:-1, :3]).any(axis=1)  # equal ends: the smallest period
    out = out[keep]
    return out[np.lexsort((out[:, 3], out[:, 1], out[:, 0]))]


def coded(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct words, the number of each word in order, and the words of each text."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    ends = lists.offsets.to_numpy().astype(np.int64)
    one = lists.flatten().dictionary_encode()
    words, codes = one.dictionary.to_pylist(), one.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    row = np.repeat(np.arange(len(texts)), np.diff(ends))
    if "" in words:
        real = codes != words.index("")
        codes, row = codes[real], row[real]
    return words, codes, np.bincount(row, minlength=len(texts))


def marked(codes: np.ndarray, size: np.ndarray, distinct: int) -> tuple[np.ndarray, np.ndarray]:
    """The sequence with marks before each text and at the end, and where each text begins."""
    begin = np.cumsum(size) - size + np.arange(1, len(size) + 1)
    out = np.empty(len(codes) + len(size) + 1, np.int64)
    mark = np.append(begin - 1, len(out) - 1)
    inner = np.ones(len(out), bool)
    inner[mark] = False
    out[inner] = codes
    out[mark] = distinct + np.arange(len(mark))
    return out, begin


def _rows(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, texts = C.column(b, "doc_id"), C.column(b, "text")
            for lo, hi in C.slices(texts, SLICE):
                words, codes, size = coded(texts.slice(lo, hi - lo))
                seq, begin = marked(codes, size, len(words))
                found = runs_of(seq, begin, size, least)
                # words that some run covers after its first period
                cover = np.zeros(len(seq) + 1, np.int64)
                np.add.at(cover, begin[found[:, 0]] + found[:, 1] + found[:, 3], 1)
                np.add.at(cover, begin[found[:, 0]] + found[:, 1] + found[:, 2], -1)
                kept = np.cumsum(cover)[:-1] == 0
                collapsed = [" ".join([words[c] for c in seq[a:a + n][kept[a:a + n]].tolist()]) for a, n in zip(begin.tolist(), size.tolist())]
                edge = np.searchsorted(found[:, 0], np.arange(hi - lo + 1)).astype(np.int32)
                spans = pa.StructArray.from_arrays([pa.array(found[:, k]) for k in (1, 2, 3)], ["start", "length", "period"])
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(lo, hi - lo), pa.array(size.astype(np.int64)), pa.ListArray.from_arrays(pa.array(edge), spans),
                     pa.array(collapsed, pa.string())], ["doc_id", "n_words", "runs", "collapsed"])

    return run


def periodic_runs(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """``(doc_id, n_words, runs, collapsed)``, one row per input row.

    ``runs`` are ``(start, length, period)`` by start, then period;
    ``collapsed`` is the text without the words that a run covers after its
    first period, joined by one space.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(_rows(least), "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string")


def tail_repeated(text: Column, doc_id: Column) -> Column:
    """The text with its tail made periodic, for one document in ten (by crc32 of the id); the others as they are.

    With h = crc32(decimal doc_id), g = floor(h / 10) and n words, where
    h % 10 = 0 each word i >= a = g % n becomes word a + (i - a) % p,
    p = 1 + floor((n - a) / (3 + g % 8)).  A null id changes nothing.
    """
    h = F.crc32(doc_id.cast("string"))
    g = F.floor(h / 10).cast("long")
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")

    def repeated(w: Column) -> Column:
        n = F.size(w).cast("long")
        a = F.pmod(g, n)
        p = F.lit(1).cast("long") + F.floor((n - a) / (F.lit(3) + F.pmod(g, F.lit(8)))).cast("long")
        tail = F.transform(F.sequence(a, n - 1), lambda i: F.get(w, (a + F.pmod(i - a, p)).cast("int")))
        return F.when(n > 0, F.concat_ws(" ", F.slice(w, 1, a.cast("int")), tail)).otherwise(F.lit(""))

    # the words are split once: the body sees them as a variable
    new = F.element_at(F.transform(F.array(words), repeated), 1)
    return F.when(F.pmod(h, F.lit(10)) == 0, new).otherwise(text)


def run_digests(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256)`` of the texts with repeated tails."""
    found = periodic_runs(docs.withColumn("text", tail_repeated(F.col("text"), F.col("doc_id"))))
    longest = F.element_at(F.array_sort(F.transform("runs", lambda r: F.struct(
        (-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period"), r["length"].alias("length")))), 1)
    best = F.when(F.size("runs") > 0, longest)
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    text = F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise(F.lit(""))
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("b"), "collapsed", text.alias("lines")).select(
        "doc_id", "n_runs", "b.start", "b.length", "b.period",
        F.floor(F.lit(1000) * F.col("b.length") / F.col("b.period")).cast("long").alias("exponent_milli"),
        F.sha2("lines", 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
