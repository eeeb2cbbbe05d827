"""Document quality by a regularised quadratic discriminant.

1. Each whole text gives ``FEATURES`` statistics (shares of upper case, signs,
   repeated words and lines, word lengths, ...), each transformed (logit of a
   share, logarithm of a count) so that a class looks more like a normal
   cloud.  They are written once.
2. Counts, sums and outer products of each class over the labelled training
   rows are added up per task and then once more: one small row per task.
3. Class covariances shrink towards the pooled one (``towards_pooled``) and
   the pooled one towards its diagonal (``towards_diagonal``); their Cholesky
   factors are computed once.
4. A row's score is the logistic of the difference of the two log densities
   (Mahalanobis distances by the factors, log determinants, log priors).

Labels are joined by document id and learned only where the caller's mark is
true.  Rows: every input row stays.  A null text is empty and gets the score
that its statistics give.  Null labels and labels other than 0 and 1 do not
count; several labels of one document all count.  Without training rows of
both classes every score is the share of label 1 among them, or 0.5.  An
empty table gives an empty result.  Other columns pass through or are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm import common as C

SLICE = 1 << 20
_CLASS = np.zeros((256, 6), np.float32)  # upper, lower, digit, sign, white space, beyond ASCII
_CLASS[65:91, 0] = 1
_CLASS[97:123, 1] = 1
_CLASS[48:58, 2] = 1
_CLASS[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)], 3] = 1
_CLASS[[32, *range(9, 14)], 4] = 1
_CLASS[128:, 5] = 1
_SIGNS = [ord(c) for c in "!|*#%&$.,"]

FEATURES = ["words", "bytes_per_word", "upper", "digit", "sign", "beyond_ascii", "newline",
            *[f"sign_{c}" for c in ("exclamation", "bar", "star", "hash", "percent", "and", "dollar", "stop", "comma")],
            "distinct_words", "same_as_before", "same_as_two_before", "top_word", "short_words", "long_words",
            "bare_signs", "capitals", "repeated_pairs", "distinct_lines"]


def _logit(x: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Log odds of a share x / n, with half a count on either side."""
    return np.log((x + 0.5) / (np.maximum(n - x, 0) + 0.5))


def _sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def _distinct(hashes: np.ndarray, row: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of each row, and how often its most frequent one occurs."""
    if not len(hashes):
        return np.zeros(n), np.zeros(n)
    key = (hashes >> np.uint64(20)) | (row.astype(np.uint64) << np.uint64(44))
    key.sort()
    new = np.concatenate([[True], key[1:] != key[:-1]])
    at = np.flatnonzero(new)
    of = (key[at] >> np.uint64(44)).astype(np.int64)
    most = np.zeros(n)
    np.maximum.at(most, of, np.diff(np.append(at, len(key))))
    return np.bincount(of, minlength=n).astype(float), most


def features(texts: pa.Array) -> np.ndarray:
    """Matrix of transformed statistics, a row per text."""
    buf, offs = C.buffer(texts)
    n = len(offs) - 1
    size = np.diff(offs).astype(float)
    group = [_sums(_CLASS[buf, k], offs) for k in range(6)]
    letters = group[0] + group[1]
    start, end = C.word_spans(buf, offs)
    row = np.searchsorted(offs, start, "right") - 1
    first = np.searchsorted(start, offs)
    words = np.diff(first).astype(float)
    hashes = C.range_hash(C.prefix_hash(buf), start, end) if len(start) else np.zeros(0, np.uint64)
    length = end - start
    per_word = lambda mask: np.bincount(row[mask], minlength=n).astype(float)
    same = [np.zeros(len(start), bool), np.zeros(len(start), bool)]
    for k in (1, 2):
        same[k - 1][k:] = (hashes[k:] == hashes[:-k]) & (row[k:] == row[:-k])
    distinct, top = _distinct(hashes, row, n)
    pair = hashes[:-1] * np.uint64(3) + hashes[1:]
    inside = row[1:] == row[:-1]
    pairs, _ = _distinct(C.mix(pair[inside]), row[:-1][inside], n)
    n_pairs = np.maximum(words - 1, 0)
    line_end = np.unique(np.concatenate([offs, np.flatnonzero(buf == 10) + 1]))
    a, b = line_end[:-1], line_end[1:]
    lines = C.range_hash(C.prefix_hash(buf), a, b) if len(a) else np.zeros(0, np.uint64)
    line_row = np.searchsorted(offs, a, "right") - 1
    n_lines = np.bincount(line_row, minlength=n).astype(float) if len(a) else np.zeros(n)
    d_lines, _ = _distinct(lines, line_row, n)
    cols = [np.log1p(words), np.log1p(size / np.maximum(words, 1)), _logit(group[0], letters), _logit(group[2], size),
            _logit(group[3], size), _logit(group[5], size), _logit(_sums(buf == 10, offs), words),
            *[_logit(_sums(buf == s, offs), words) for s in _SIGNS],
            _logit(words - distinct, words), _logit(per_word(same[0]), words), _logit(per_word(same[1]), words),
            _logit(top, words), _logit(per_word(length <= 3), words), _logit(per_word(length >= 16), words),
            _logit(per_word((length == 1) & (_CLASS[buf[start], 3] > 0)), words),
            _logit(per_word(_CLASS[buf[start], 0] > 0), words), _logit(n_pairs - pairs, n_pairs),
            _logit(n_lines - d_lines, n_lines)]
    return np.stack(cols, axis=1) if n else np.zeros((0, len(cols)))


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        names = [x for x in b.schema.names if x != "text"]
        texts = C.column(b, "text")
        for lo, hi in C.slices(texts, SLICE):
            x = features(texts.slice(lo, hi - lo))
            flat = pa.ListArray.from_arrays(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32), x.ravel())
            yield pa.RecordBatch.from_arrays([*[C.column(b, c).slice(lo, hi - lo) for c in names], flat], [*names, "x"])


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each class: rows, sums and outer products about a fixed origin, one row a task."""
    d = len(FEATURES)
    total = {0: np.zeros(1 + d + d * d), 1: np.zeros(1 + d + d * d)}
    for b in batches:
        x = C.column(b, "x").flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
        y = C.column(b, "y").to_numpy(zero_copy_only=False)
        for k in (0, 1):
            z = x[y == k]
            total[k] += np.concatenate([[len(z)], z.sum(axis=0), (z.T @ z).ravel()])
    yield pa.RecordBatch.from_arrays([pa.array([0, 1], pa.int32()), pa.array([total[0].tolist(), total[1].tolist()])], ["y", "m"])


class Discriminant:
    """Two class densities; ``score`` is the posterior of label 1."""

    def __init__(self, moments: dict[int, np.ndarray], towards_pooled: float, towards_diagonal: float) -> None:
        d = len(FEATURES)
        n = {k: moments[k][0] if k in moments else 0.0 for k in (0, 1)}
        self.share = n[1] / (n[0] + n[1]) if n[0] + n[1] else 0.5
        self.parts = None
        if min(n.values()) < 2:
            return
        mean = {k: moments[k][1:1 + d] / n[k] for k in n}
        scatter = {k: moments[k][1 + d:].reshape(d, d) - n[k] * np.outer(mean[k], mean[k]) for k in n}
        pooled = (scatter[0] + scatter[1]) / (n[0] + n[1])
        pooled += np.eye(d) * (1e-6 + 1e-3 * np.trace(pooled) / d)
        calm = (1 - towards_diagonal) * pooled + towards_diagonal * np.diag(np.diag(pooled))
        self.parts = []
        for k in (0, 1):
            cov = (1 - towards_pooled) * scatter[k] / n[k] + towards_pooled * calm
            low = np.linalg.cholesky(cov)
            self.parts.append((mean[k], np.linalg.inv(low), np.log(n[k]) - np.log(np.diag(low)).sum()))

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.parts is None:
            return np.full(len(x), self.share)
        logs = []
        for mean, inverse, const in self.parts:
            z = (x - mean) @ inverse.T
            logs.append(const - 0.5 * (z * z).sum(axis=1))
        return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -500, 500)))


def _scored(model: Discriminant):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            names = [x for x in b.schema.names if x != "x"]
            x = C.column(b, "x").flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([*[C.column(b, c) for c in names], pa.array(model.score(x))], [*names, "score"])

    return run


def _measured(docs: DataFrame, learn: Column, scope: C.Scope) -> DataFrame:
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), learn.alias("learn"), "text")
    return scope.table(rows.mapInArrow(_measure, "doc_id long, learn boolean, x array<double>"))


def fit(measured: DataFrame, labels: DataFrame, towards_pooled: float, towards_diagonal: float) -> Discriminant:
    """The two densities of the labelled rows marked ``learn``."""
    known = labels.where("label in (0, 1)").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("label").cast("int").alias("y"))
    moments = (measured.where("learn").join(known, "doc_id").select("x", "y")
               .mapInArrow(_moments, "y int, m array<double>"))
    added = moments.select("y", F.posexplode("m").alias("at", "v")).groupBy("y", "at").agg(F.sum("v").alias("v"))
    table = {k: np.zeros(1 + len(FEATURES) * (1 + len(FEATURES))) for k in (0, 1)}
    for r in added.collect():  # the moments of two classes: as many numbers at any size
        table[r.y][r.at] = r.v
    return Discriminant(table, towards_pooled, towards_diagonal)


def quality_scores(docs: DataFrame, labels: DataFrame, learn: Column, towards_pooled: float = 0.5,
                   towards_diagonal: float = 0.1) -> DataFrame:
    """``(doc_id, learn, score)``, one row per input row; score in [0, 1], higher: label 1 likelier.

    ``labels`` has ``doc_id, label``; ``learn`` marks the rows whose labels may
    be learned.
    """
    with C.tables() as t:
        measured = _measured(docs, learn, t)
        model = fit(measured, labels, towards_pooled, towards_diagonal)
        return C.staged(measured.mapInArrow(_scored(model), "doc_id long, learn boolean, score double"))


def _kept(model: Discriminant, at_least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = C.column(b, "text")
            for lo, hi in C.slices(texts, SLICE):
                good = model.score(features(texts.slice(lo, hi - lo))) >= at_least
                yield b.slice(lo, hi - lo).filter(pa.array(good))

    return run


def keep_good(docs: DataFrame, labels: DataFrame, learn: Column, at_least: float = 0.5,
              towards_pooled: float = 0.5, towards_diagonal: float = 0.1) -> DataFrame:
    """The rows of ``docs``, all columns, whose score reaches ``at_least``; no row is shuffled with its text."""
    with C.tables() as t:
        model = fit(_measured(docs, learn, t), labels, towards_pooled, towards_diagonal)
    return docs.mapInArrow(_kept(model, at_least), docs.schema)
