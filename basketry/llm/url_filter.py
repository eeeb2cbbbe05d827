"""URL filter: rules first, then logistic regression on hashed character n-grams.

Host and path of a URL are matched against rules ``(rule, action)``: a rule
``example.org/es/`` fits its host and all subdomains where the URL's path
starts with ``/es/``; the longest rule that fits wins (of equally long ones
the one with the longer host).  Where no rule fits, a logistic regression
decides.  Its features are the character n-grams (2 to 5) of the host and of
the path, each with marks at both ends, hashed into 2**16 places per part and
n-gram length class; a URL's counts are scaled to length one.  The weights
come from a small labelled table of URLs (``url_labels`` unless another is
given; of a large one the ``sample`` rows with the least hash), by accelerated
gradient steps on the ridge loss until they stand still.

One scan without a shuffle: only the URL column is read, the rules and the
weights travel with the task.

Rows: every input row stays, repeated ids and repeated URLs too.  A null URL
or one without ``://`` has the empty host and path; no rule fits it unless a
rule has the empty host, and the regression scores the two empty strings.
Rows of the labelled table with a null URL, a null label or one other than 0
and 1 do not count; without both classes every score is the share of label 1
among them, or 0.  An empty table gives an empty result.  Other columns are
ignored.  A URL of any length is read whole.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm import common as C
from basketry.llm.url_labels import ALLOW, BLOCK

#: Labelled rows used at most.
SAMPLE = 20_000
GRAMS = (2, 3, 4, 5)
PLACES = 1 << 16
RIDGE, STEPS, STILL = 1e-4, 2000, 1e-9
SLICE = 1 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    """Between the first ``://`` and ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return F.translate(F.coalesce(F.regexp_extract(url, _URL, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


class Rules:
    """Rules by host; a host is looked up by its endings, a path by its beginnings."""

    def __init__(self, rules: Sequence[tuple[str, str]]) -> None:
        self.by_host: dict[str, dict[str, tuple[str, str]]] = {}
        for rule, action in rules:
            host, slash, path = rule.partition("/")
            self.by_host.setdefault(host.translate(str.maketrans(UPPER, LOWER)), {})[slash + path] = (rule, action)
        self.labels = max((h.count(".") + 1 for h in self.by_host), default=0)
        self.sizes = {h: sorted({len(p) for p in paths}, reverse=True) for h, paths in self.by_host.items()}

    def hosts(self, host: str) -> list[str]:
        """The rule hosts that ``host`` is or lies under, longest first."""
        out, at = [], len(host)
        for _ in range(self.labels):
            at = host.rfind(".", 0, at) if at >= 0 else -1
            if host[at + 1:] in self.by_host:
                out.append(host[at + 1:])
            if at < 0:
                break
        return out[::-1]

    def find(self, hosts: list[str], path: str) -> tuple[str | None, str | None]:
        """The longest rule of ``hosts`` that fits ``path``."""
        best: tuple[str | None, str | None] = (None, None)
        for h in hosts:
            for n in self.sizes[h]:
                hit = self.by_host[h].get(path[:n]) if n <= len(path) else None
                if hit is not None:
                    if best[0] is None or len(hit[0]) > len(best[0]):
                        best = hit
                    break
        return best


def _grams(texts: Sequence[str], salt: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and place of every n-gram of every text, in the order of rows within a length."""
    marked = [f"\x02{t}\x03" for t in texts]
    code = np.frombuffer("".join(marked).encode("utf-32-le"), np.uint32).astype(np.uint64)
    size = np.fromiter(map(len, marked), np.int64, len(marked))
    row = np.repeat(np.arange(len(marked)), size)
    h, rows, places = np.full(len(code), salt, np.uint64), [], []
    for n in range(1, max(GRAMS) + 1):
        if len(code) < n:
            break
        h = C.mix(h[:len(code) - n + 1] * np.uint64(0x9E3779B97F4A7C15) + code[n - 1:])
        if n in GRAMS:
            inside = row[:len(h)] == row[n - 1:]
            rows.append(row[:len(h)][inside])
            places.append((h[inside] % np.uint64(PLACES)).astype(np.int64))
    return np.concatenate([np.zeros(0, np.int64), *rows]), np.concatenate([np.zeros(0, np.int64), *places])


def features(hosts: Sequence[str], paths: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(row, place, value)`` of the n-gram counts, each row scaled to length one, plus one for the constant."""
    n = len(hosts)
    rh, ph = _grams(hosts, 1)
    rp, pp = _grams(paths, 2)
    key, count = np.unique(np.concatenate([rh * 2 * PLACES + ph, rp * 2 * PLACES + PLACES + pp]), return_counts=True)
    row, place = key // (2 * PLACES), key % (2 * PLACES)
    value = count / np.sqrt(np.bincount(row, weights=count.astype(float) ** 2, minlength=n))[row]
    return (np.concatenate([row, np.arange(n)]), np.concatenate([place, np.full(n, 2 * PLACES)]), np.concatenate([value, np.ones(n)]))


def margins(weights: np.ndarray, hosts: Sequence[str], paths: Sequence[str]) -> np.ndarray:
    row, place, value = features(hosts, paths)
    return np.bincount(row, weights=value * weights[place], minlength=len(hosts))


def fit(hosts: Sequence[str], paths: Sequence[str], y: np.ndarray) -> np.ndarray:
    """Weights that minimise the mean logistic loss plus a ridge, the constant left free."""
    row, place, value = features(hosts, paths)
    used, at = np.unique(place, return_inverse=True)  # places without an n-gram keep the weight 0
    n, w = len(y), np.zeros(len(used))
    penalty = np.where(used == 2 * PLACES, 0.0, RIDGE)
    step, look, t = 1.0 / (0.25 * 2 + RIDGE), w.copy(), 1.0  # rows have squared length 2 with the constant
    for _ in range(STEPS):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(row, weights=value * look[at], minlength=n), -60, 60)))
        gradient = np.bincount(at, weights=value * (p - y)[row], minlength=len(w)) / n + penalty * look
        new = look - step * gradient
        still = np.abs(new - w).max() < STILL
        nxt = (1 + np.sqrt(1 + 4 * t * t)) / 2
        look, w, t = new + (t - 1) / nxt * (new - w), new, nxt
        if still:
            break
    out = np.zeros(2 * PLACES + 1)
    out[used] = w
    return out


def labelled_urls(spark) -> DataFrame:
    """The small table of this package: ``(url, label)``, label 1 is to be blocked."""
    return spark.createDataFrame([(u, 1) for u in BLOCK] + [(u, 0) for u in ALLOW], "url string, label int")


def learn(labelled: DataFrame, sample: int = SAMPLE) -> tuple[np.ndarray | None, float]:
    """Weights, and the share of label 1 for a table that lacks a class."""
    rows = labelled.where("label in (0, 1) and url is not null").select(
        host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), F.col("label").cast("int").alias("y"))
    seen = rows.orderBy(F.xxhash64("host", "path"), "host", "path", "y").limit(sample).collect()  # at most ``sample`` rows
    y = np.array([r.y for r in seen], float)
    if not 0 < y.sum() < len(y):
        return None, float(y.mean()) if len(y) else 0.0
    return fit([r.host for r in seen], [r.path for r in seen], y), float(y.mean())


def _judge(rules: Rules, weights: np.ndarray | None, share: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            both = pc.binary_join_element_wise(C.column(b, "host"), C.column(b, "path"), "")
            for lo, hi in C.slices(both, SLICE):
                host, path = (C.column(b, c).slice(lo, hi - lo) for c in ("host", "path"))
                coded = host.dictionary_encode()
                known = [rules.hosts(h) for h in coded.dictionary.to_pylist()]
                hosts, paths = host.to_pylist(), path.to_pylist()
                found = [rules.find(known[k], p) for k, p in zip(coded.indices.to_pylist(), paths)]
                if weights is None:
                    score = np.full(hi - lo, share)
                else:
                    score = 1 / (1 + np.exp(-np.clip(margins(weights, hosts, paths), -60, 60)))
                verdict = [action or ("block" if s >= 0.5 else "allow") for (_, action), s in zip(found, score.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [C.column(b, "page_id").slice(lo, hi - lo), host, path, pa.array([r for r, _ in found], pa.string()),
                     pa.array(verdict, pa.string()), pa.array(score)], ["page_id", "host", "path", "rule", "verdict", "score"])

    return run


def judge_urls(pages: DataFrame, rules: Sequence[tuple[str, str]], labelled: DataFrame | None = None, sample: int = SAMPLE) -> DataFrame:
    """``(page_id, host, path, rule, verdict, score)``, one row per input row; score is the chance that a URL is to be blocked."""
    weights, share = learn(labelled_urls(pages.sparkSession) if labelled is None else labelled, sample)
    rows = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    kind = pages.schema["page_id"].dataType.simpleString()
    return rows.mapInArrow(_judge(Rules(rules), weights, share),
                           f"page_id {kind}, host string, path string, rule string, verdict string, score double")
