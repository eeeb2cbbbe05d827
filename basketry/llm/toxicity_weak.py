"""Toxicity by weak supervision: voters, a generative label model, a linear classifier.

1. Voters.  Lexicon voters are words and word beginnings (4 to 7 letters)
   mined from labelled training rows: far more frequent in texts labelled 1.
   A fixed word list and patterns (shouting, rows of exclamation marks, masked
   words) vote as well.  A voter fires on a whole text or is silent.
2. The label model takes the voters and the given label as noisy witnesses of
   a hidden class.  It estimates each one's rates in both classes by
   expectation maximisation; witnesses that move together within a class (a
   stem and its longer forms) are weighted down by their correlations.
3. A logistic classifier on voters and hit counts learns the posterior
   labels and scores every whole text in one scan without a shuffle.

Mining and fitting use at most ``sample`` labelled training rows, those with
the least hash of their id; counts over them are partial/final aggregates.

Rows: every input row stays.  A null text is empty: nothing fires.  Null
labels and labels other than 0 and 1 do not count; several labels of one
document all count.  Without training rows of both classes every score is the
share of label 1 among them, or 0.5.  An empty table gives an empty result.
Other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm import common as C

SAMPLE = 20_000
LENGTHS = (4, 5, 6, 7)
SLICE = 4 << 20
#: Insults of everyday English, a voter of its own (fixed values).
INSULTS = frozenset("""
idiot idiots idiotic stupid moron morons moronic loser losers dumb dumbass fool fools scum trash garbage worthless
pathetic disgusting ugly clown jerk jerks freak creep pig pigs filth filthy vermin retard bastard bitch asshole
""".split())
_MASKED = re.compile(r"\b[A-Za-z][*@#$]{2,}[A-Za-z]+\b")
_EDGE = "\"'`.,;:!?()[]{}<>|*#%&$-_/\\~^+=…«»“”‘’"
PATTERNS = ("insults", "shouting", "exclamations", "masked")


def terms_of(word: str) -> list[str]:
    """The word itself (as ``=word``) and its beginnings (as ``word^``)."""
    core = word.strip(_EDGE).lower()
    if len(core) < 3 or not core.isalpha():
        return []
    return ["=" + core, *[core[:n] + "^" for n in LENGTHS if len(core) > n]]


def _coded(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct words of some texts, the code of each word and its text."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    ends = lists.offsets.to_numpy().astype(np.int64)
    coded = lists.flatten().dictionary_encode()
    row = np.repeat(np.arange(len(texts)), np.diff(ends))
    return coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False), row


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents that have each term."""
    total: Counter[str] = Counter()
    for b in batches:
        for t in C.column(b, "text").to_pylist():
            words = set((t or "").split())
            total.update({x for w in words for x in terms_of(w)})
    yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], ["term", "n"])


def uneven(n: int, others: int, n_toxic: int, n_clean: int, looked: int) -> bool:
    """At least 20 times as frequent in toxic texts; among ``looked`` terms fewer than half a one would be by chance."""
    if n / n_toxic < 20 * (others + 0.5) / (n_clean + 1):
        return False
    share = n_toxic / (n_toxic + n_clean)
    # the binomial tail is at most its first term over 1 - the ratio of its terms
    log = (math.lgamma(n + others + 1) - math.lgamma(n + 1) - math.lgamma(others + 1)
           + n * math.log(share) + others * math.log(1 - share))
    return log + math.log(2 * looked) < 0


def _uneven_rows(n_toxic: int, n_clean: int, looked: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, others = b.column("n").to_pylist(), b.column("others").to_pylist()
            yield b.filter(pa.array([uneven(x, y, n_toxic, n_clean, looked) for x, y in zip(n, others)], pa.bool_()))

    return run


def pick_voters(toxic: dict[str, int], clean: dict[str, int], n_toxic: int, n_clean: int, looked: int | None = None) -> list[str]:
    """Terms that are ``uneven``; of nested ones with equal counts the longest.

    ``looked`` is the number of terms that were looked at, where ``toxic`` holds only some of them.
    """
    looked = len(toxic) if looked is None else looked
    good = {t: n for t, n in toxic.items() if uneven(n, clean.get(t, 0), n_toxic, n_clean, looked)}
    picked = []
    for t, n in good.items():
        stem = t[1:] if t[0] == "=" else t[:-1]
        longer = [x for x in good if x != t and good[x] >= n and (
            (x[0] == "=" and x[1:].startswith(stem) and t[0] != "=") or (x[-1] == "^" and t[-1] == "^" and x[:-1].startswith(stem)))]
        if not longer:
            picked.append(t)
    return sorted(picked, key=lambda t: (-good[t], t))


class Voters:
    """What fires on a text: lexicon terms in their order, then PATTERNS."""

    def __init__(self, terms: list[str]) -> None:
        self.place = {t: k for k, t in enumerate(terms)}
        self.names = [*terms, *PATTERNS]

    def hits(self, texts: pa.Array) -> np.ndarray:
        """Times that each voter fires on each text."""
        words, codes, row = _coded(texts)
        n, v = len(texts), len(self.names)
        out = np.zeros((n, v))
        place, insults = self.place, len(self.place)
        code, voter = [], []
        for k, w in enumerate(words):
            for t in terms_of(w):
                p = place.get(t)
                if p is not None:
                    code.append(k)
                    voter.append(p)
                if t[0] == "=" and t[1:] in INSULTS:
                    code.append(k)
                    voter.append(insults)
        if code:
            order = np.argsort(codes, kind="stable")
            edge = np.searchsorted(codes[order], np.arange(len(words) + 1))
            for k, p in zip(code, voter):
                np.add.at(out[:, p], row[order[edge[k]:edge[k + 1]]], 1)
        buf, offs = C.buffer(texts)
        for k, lut in (("upper", (65, 91)), ("lower", (97, 123))):
            total = np.concatenate([[0], np.cumsum((buf >= lut[0]) & (buf < lut[1]))])
            if k == "upper":
                upper = total[offs[1:]] - total[offs[:-1]]
            else:
                lower = total[offs[1:]] - total[offs[:-1]]
        out[:, insults + 1] = (upper + lower >= 40) & (upper >= 0.6 * (upper + lower))
        text = pc.fill_null(texts, "")
        out[:, insults + 2] = pc.count_substring(text, "!!!").to_numpy(zero_copy_only=False) >= 3
        maybe = pc.match_substring_regex(text, r"[A-Za-z][*@#$]{2,}[A-Za-z]").to_numpy(zero_copy_only=False)
        for i in np.flatnonzero(maybe).tolist():
            out[i, insults + 3] = len(_MASKED.findall(text[i].as_py()))
        return out


def features(hits: np.ndarray) -> np.ndarray:
    """Voters that fire, the logarithm of all lexicon hits, and one."""
    return np.column_stack([hits > 0, np.log1p(hits[:, :hits.shape[1] - len(PATTERNS)].sum(axis=1)), np.ones(len(hits))])


def label_model(votes: np.ndarray, labels: np.ndarray, times: np.ndarray, rounds: int = 30) -> np.ndarray:
    """Posterior of the hidden class from the voters and the given label as one more witness.

    A row is a pattern of votes and a label, ``times`` how many texts have it.
    """
    n = times.sum()
    post = 0.9 * labels + 0.05
    for _ in range(rounds):
        in1, in0 = times * post, times * (1 - post)
        share = np.clip(in1.sum() / n, 1e-4, 1 - 1e-4)
        a = (in1 @ votes + 0.5) / (in1.sum() + 1)
        b = (in0 @ votes + 0.05) / (in0.sum() + 0.5)
        gold1 = np.clip((in1 @ labels + 0.9) / (in1.sum() + 1), 0.5, 0.99)
        gold0 = np.clip((in0 @ (1 - labels) + 0.9) / (in0.sum() + 1), 0.5, 0.99)
        # correlations within the classes: witnesses that say the same thing share one say
        dev = votes - np.outer(post, a) - np.outer(1 - post, b)
        cov = (dev * times[:, None]).T @ dev / n
        sd = np.sqrt(np.diag(cov)) + 1e-12
        rho = cov / np.outer(sd, sd)
        weight = 1 / np.where(rho > 0.2, rho, 0).sum(axis=1).clip(1)
        fires, silent = weight * np.log(a / b), weight * np.log((1 - a).clip(1e-6) / (1 - b).clip(1e-6))
        logit = np.log(share / (1 - share)) + votes @ fires + (1 - votes) @ silent
        logit += np.where(labels == 1, np.log(gold1 / (1 - gold0)), np.log((1 - gold1) / gold0))
        post = 1 / (1 + np.exp(-np.clip(logit, -60, 60)))
    return post


def logistic(x: np.ndarray, y: np.ndarray, times: np.ndarray, ridge: float = 0.05, rounds: int = 50) -> np.ndarray:
    """Weights of a ridge logistic regression on soft labels of rows that occur ``times`` times, by Newton steps."""
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -60, 60)))
        gradient = x.T @ (times * (p - y)) + penalty * w
        hessian = (x * (times * (p * (1 - p) + 1e-9))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(hessian, gradient)
        w -= np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-8:
            break
    return w


def _hit_rows(voters: Voters):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, y = C.column(b, "text"), C.column(b, "y")
            for lo, hi in C.slices(texts, SLICE):
                h = voters.hits(texts.slice(lo, hi - lo)).astype(np.float32)
                yield pa.RecordBatch.from_arrays([y.slice(lo, hi - lo), pa.array([r.tobytes() for r in h], pa.binary())], ["y", "hits"])

    return run


def _score(voters: Voters, weights: np.ndarray | None, share: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = C.column(b, "text")
            names = [c for c in b.schema.names if c != "text"]
            for lo, hi in C.slices(texts, SLICE):
                if weights is None:
                    s = np.full(hi - lo, share)
                else:
                    x = features(voters.hits(texts.slice(lo, hi - lo)))
                    s = 1 / (1 + np.exp(-np.clip(x @ weights, -60, 60)))
                yield pa.RecordBatch.from_arrays([*[C.column(b, c).slice(lo, hi - lo) for c in names], pa.array(s)], [*names, "score"])

    return run


def toxicity_scores(docs: DataFrame, labels: DataFrame, learn: Column, sample: int = SAMPLE) -> DataFrame:
    """``(doc_id, learn, score)``, one row per input row; score in [0, 1], higher: label 1 likelier.

    ``labels`` has ``doc_id, label``; ``learn`` marks the rows of ``docs``
    whose labels may be learned (an expression of ``doc_id``).
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), learn.alias("learn"), "text")
    known = labels.where("label in (0, 1) and doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("label").cast("int").alias("y"))
    known = known.withColumn("learn", learn).where("learn").drop("learn").orderBy(F.xxhash64("doc_id"), "doc_id", "y").limit(sample)
    with C.tables() as t:
        picked = t.table(rows.where("learn").select("doc_id", "text").join(F.broadcast(known), "doc_id").select("y", "text"))
        n = {r.y: r.n for r in picked.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
        share = n.get(1, 0) / max(1, sum(n.values())) if n else 0.5
        voters, weights = Voters([]), None
        if n.get(0) and n.get(1):
            count = lambda y: (picked.where(F.col("y") == y).select("text").mapInArrow(_term_counts, "term string, n long")
                               .groupBy("term").agg(F.sum("n").alias("n")))
            terms = t.table(count(1))
            both = terms.join(count(0).withColumnRenamed("n", "others"), "term", "left").fillna(0, ["others"])
            looked = terms.count()
            found = both.select("term", "n", "others").mapInArrow(_uneven_rows(n[1], n[0], looked), "term string, n long, others long").collect()
            toxic, clean = {r.term: r.n for r in found}, {r.term: r.others for r in found}
            voters = Voters(pick_voters(toxic, clean, n[1], n[0], looked))
            # equal rows of hits with their count: at most ``sample``, fewer by far as most texts fire nothing
            seen = picked.mapInArrow(_hit_rows(voters), "y int, hits binary").groupBy("y", "hits").agg(F.count(F.lit(1)).alias("times")).orderBy("y", "hits").collect()
            hits = np.frombuffer(b"".join(bytes(r.hits) for r in seen), np.float32).reshape(len(seen), -1).astype(float)
            y = np.array([r.y for r in seen], float)
            times = np.array([r.times for r in seen], float)
            weights = logistic(features(hits), label_model((hits > 0).astype(float), y, times), times)
    return rows.mapInArrow(_score(voters, weights, share), "doc_id long, learn boolean, score double")
