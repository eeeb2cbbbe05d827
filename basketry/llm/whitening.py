"""Embedding whitening by spectrum slicing.

Each component c of a vector becomes the integer x = floor(64 c) + 1000000;
the fit list holds each distinct x vector of a dimension once.  Mean and
covariance are exact sums over it, centred (at the rounded mean) before they
are multiplied.

The leading eigenvalues of the covariance V are isolated by spectrum slicing:
V is brought to tridiagonal form by reflections, and the signs of the pivots
of the LDL' factorisation of V - s I count the eigenvalues above a shift s
(Sylvester's law of inertia; many shifts at once).  An interval that holds one
eigenvalue and is narrow against its distance to others starts a Rayleigh
quotient iteration, which converges cubically; a result that leaves the
interval is refused and the interval is cut further, so the counts certify the
number of each component.  Eigenvalues that agree to working precision form a
cluster, whose space is found by inverse iteration with several vectors; any
orthonormal basis of it serves.

Three scans of the fit list (sums, products, the check of the whitened
covariance) return at most dim**2 sums each; the solver sees V alone.  The
same components whiten all rows in one scan without a shuffle.

Rows: vectors that are null or hold null or non-finite components are dropped;
all others stay, repeated ids and null ids too.  Vectors of different
dimensions have fit lists and components of their own; there are min(16, dim)
components, none for the empty vector.  x is held within the range of a long;
a deviation beyond a long is null.  A component without variance (eigenvalue
at most 1e-12 of the trace) has a null ``whitened`` and is left out of the
check; ``explained`` is null where the trace is 0, ``identity_error`` where no
component has variance.  An empty table gives an empty result.  Other columns
are ignored.
"""

from __future__ import annotations

import dataclasses
import decimal
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm import common as C
from basketry.llm.vectors import matrices, usable

SCALE, OFFSET, COMPONENTS = 64.0, 1_000_000, 16
#: An eigenvalue below this share of the trace has no variance; two closer than this are one cluster.
FLAT, CLUSTER = 1e-12, 1e-13
#: Digits of a sum that a decimal column holds.
DIGITS = 38
EXACT = float(1 << 53)
LONG = (1 << 63) - 1


def whole(x: np.ndarray) -> np.ndarray:
    """floor(64 c) + 1000000 as int64, held within its range."""
    with np.errstate(over="ignore"):
        f = np.floor(x * SCALE) + 0.0
    edge = float(1 << 62)
    out = np.where(np.abs(f) < edge, f, 0.0).astype(np.int64) + OFFSET
    for r, k in zip(*np.nonzero(np.abs(f) >= edge)):
        big = LONG if f[r, k] > 0 else -LONG - 1
        out[r, k] = min(LONG, max(-LONG - 1, int(f[r, k]) + OFFSET)) if np.isfinite(f[r, k]) else big
    return out


# --- the spectrum of a symmetric matrix ------------------------------------------------

def tridiagonal(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and off-diagonal of a tridiagonal matrix similar to ``v``, by reflections."""
    a = v.copy()
    d = len(a)
    for k in range(d - 2):
        x = a[k + 1:, k].copy()
        norm = np.linalg.norm(x)
        if norm == 0.0 or np.linalg.norm(x[1:]) == 0.0:
            continue
        x[0] += np.copysign(norm, x[0])
        x /= np.linalg.norm(x)
        block = a[k + 1:, k + 1:]
        p = block @ x
        q = p - (x @ p) * x
        block -= 2.0 * (np.outer(x, q) + np.outer(q, x))
        a[k + 1:, k] -= 2.0 * x * (x @ a[k + 1:, k])
        a[k, k + 1:] = a[k + 1:, k]
    return np.diag(a).copy(), np.diag(a, 1).copy()


def above(diag: np.ndarray, off: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """Eigenvalues above each shift: positive pivots of LDL' of the shifted matrix."""
    tiny = np.finfo(float).tiny / np.finfo(float).eps
    floor = max(tiny, np.finfo(float).eps * np.finfo(float).eps * float(np.abs(off).max(initial=0.0)) ** 2)
    count = np.zeros(len(shifts), np.int64)
    pivot = np.ones(len(shifts))
    square = np.concatenate([[0.0], off ** 2])
    for a, b in zip(diag.tolist(), square.tolist()):
        pivot = a - shifts - b / pivot
        pivot = np.where(np.abs(pivot) < floor, -floor, pivot)
        count += pivot > 0
    return count


def _against(basis: list[np.ndarray], x: np.ndarray) -> np.ndarray:
    """``x`` without its parts along ``basis``, of length one."""
    for _ in range(2):
        for u in basis:
            x = x - (u @ x) * u
        x = x / np.linalg.norm(x)
    return x


def _solve(v: np.ndarray, shift: float, x: np.ndarray, scale: float) -> np.ndarray:
    """(V - shift I)^-1 x; an exactly singular matrix is moved by a rounding error."""
    for k in range(4):
        try:
            out = np.linalg.solve(v - (shift + k * np.finfo(float).eps * scale) * np.eye(len(v)), x)
            if np.isfinite(out).all():
                return out
        except np.linalg.LinAlgError:
            pass
    raise ArithmeticError("the shifted matrix stays singular")


def rayleigh(v: np.ndarray, shift: float, basis: list[np.ndarray], rng, scale: float) -> tuple[float, float, np.ndarray]:
    """Rayleigh quotient iteration that starts from a fixed shift, away from ``basis``: residual, value and vector."""
    x = _against(basis, rng.standard_normal(len(v)))
    for _ in range(2):
        x = _against(basis, _solve(v, shift, x, scale))
    best = (np.inf, 0.0, x)
    small = 16 * np.finfo(float).eps * scale
    for _ in range(12):
        e = float(x @ (v @ x))
        residual = float(np.linalg.norm(v @ x - e * x))
        if residual >= best[0] and best[0] <= small:
            break
        if residual < best[0]:
            best = (residual, e, x)
        if residual == 0.0:
            break
        x = _against(basis, _solve(v, e, x, scale))
    return best


def leading(v: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues of a symmetric matrix, falling, and their unit eigenvectors as rows."""
    scale = float(np.abs(v).sum(axis=1).max(initial=0.0))
    d = len(v)
    if scale == 0.0:
        return np.zeros(k), np.eye(d)[:k]
    diag, off = tridiagonal(v)
    rng = np.random.default_rng([d, 64])
    reach = np.abs(np.concatenate([[0.0], off])) + np.abs(np.concatenate([off, [0.0]]))
    low, high = float((diag - reach).min()), float((diag + reach).max())
    pad = 1e-9 * scale
    values: list[float] = []
    basis: list[np.ndarray] = []
    marks = {low - pad: d, high + pad: 0}  # shift: eigenvalues above it

    def cut(a: float, b: float) -> None:
        inner = np.linspace(a, b, 18)[1:-1]
        marks.update(zip(inner.tolist(), above(diag, off, inner).tolist()))

    while len(values) < k:
        nth = len(values) + 1
        lo = max(s for s, n in marks.items() if n >= nth)
        hi = min(s for s, n in marks.items() if n < nth and s > lo)
        inside = marks[lo] - marks[hi]
        if hi - lo <= CLUSTER * scale or np.nextafter(lo, hi) >= hi:
            # a cluster: as many vectors as the counts say, any basis of their space
            mid = 0.5 * (lo + hi)
            for _ in range(min(inside, k - len(values))):
                x = _against(basis, rng.standard_normal(d))
                for _ in range(3):
                    x = _against(basis, _solve(v, mid, x, scale))
                basis.append(x)
                values.append(float(x @ (v @ x)))
            continue
        below = max((s for s, n in marks.items() if n > marks[lo]), default=low - pad)
        beyond = min((s for s, n in marks.items() if n < marks[hi]), default=high + pad)
        gap = min(lo - below if below < lo else np.inf, beyond - hi if beyond > hi else np.inf)
        if inside == 1 and hi - lo <= max(0.5 * gap, 64 * CLUSTER * scale):
            residual, e, x = rayleigh(v, 0.5 * (lo + hi), basis, rng, scale)
            slack = 8 * np.finfo(float).eps * scale * d
            if residual <= slack and lo - slack <= e <= hi + slack:
                values.append(e)
                basis.append(x)
                continue
        cut(lo, hi)
    return np.array(values), np.array(basis).reshape(k, d)


# --- sums over the fit list --------------------------------------------------------------

@dataclasses.dataclass
class Model:
    """What whitens the vectors of one dimension; ``low`` is the rounded mean, ``part`` the rest of it."""

    n: int
    sums: list[int]
    low: np.ndarray
    part: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    error: float | None = None

    def whitened(self, x: np.ndarray) -> np.ndarray:
        """(x - S/n) projected on each component, over the root of its eigenvalue; NaN without variance."""
        fine = self.values > FLAT * self.trace
        root = np.where(fine, np.sqrt(np.where(fine, self.values, 1.0)), np.nan)
        return (centred(x, self.low) - self.part) @ self.vectors.T / root

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n x - S)**2, exactly; None beyond a long."""
        rest = [s - self.n * int(c) for s, c in zip(self.sums, self.low)]
        y = centred(x, self.low)
        most = self.n * float(np.abs(y).max(initial=0.0)) + max(map(abs, rest), default=0)
        if most * most * max(1, x.shape[1]) < 2.0 ** 62:
            z = self.n * y.astype(np.int64) - np.array(rest, np.int64)
            return (z * z).sum(axis=1).tolist()
        out = []
        for row in x.tolist():
            total = sum((self.n * v - s) ** 2 for v, s in zip(row, self.sums))
            out.append(total if total <= LONG else None)
        return out


def centred(x: np.ndarray, low: np.ndarray) -> np.ndarray:
    """x - low as doubles; exact below 2**53."""
    if x.size and (np.abs(x.astype(np.float64)).max() >= 2.0 ** 61 or np.abs(low.astype(np.float64)).max() >= 2.0 ** 61):
        return (x.astype(object) - low.astype(object)).astype(np.float64)
    return (x - low).astype(np.float64)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each x vector as bytes: two a component, less the offset, where all fit (a rule of the vector alone), else eight."""
    for b in batches:
        for _, m in matrices(C.column(b, "x")):
            w = whole(m)
            fits = ((w > OFFSET - (1 << 15)) & (w < OFFSET + (1 << 15))).all(axis=1)
            near = np.where(fits[:, None], w, OFFSET) - OFFSET
            small = [r.tobytes() if f else b"" for r, f in zip(near.astype(np.int16), fits.tolist())]
            wide = [b"" if f else r.tobytes() for r, f in zip(w, fits.tolist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(w), m.shape[1], np.int32)), pa.array(small, pa.binary()), pa.array(wide, pa.binary())],
                ["dim", "small", "wide"])


def _fit_rows(b: pa.RecordBatch) -> Iterator[np.ndarray]:
    """The x vectors of packed rows of one dimension at a time, as int64 matrices."""
    dims = C.column(b, "dim").to_numpy()
    small, wide = C.column(b, "small").to_pylist(), C.column(b, "wide").to_pylist()
    for d in np.unique(dims).tolist():
        at = np.flatnonzero(dims == d).tolist()
        s, w = b"".join([small[i] for i in at]), b"".join([wide[i] for i in at])
        if s:
            yield np.frombuffer(s, np.int16).reshape(-1, d).astype(np.int64) + OFFSET
        if w:
            yield np.frombuffer(w, np.int64).reshape(-1, d)


def _decimals(values: list[int]) -> pa.Array:
    with decimal.localcontext() as ctx:
        ctx.prec = DIGITS
        return pa.array([decimal.Decimal(v) for v in values], pa.decimal128(DIGITS, 0))


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, list[int]] = {}
    for b in batches:
        for x in _fit_rows(b):
            high, rest = x >> 32, x & 0xFFFFFFFF
            part = [(int(h) << 32) + int(r) for h, r in zip(high.sum(axis=0), rest.sum(axis=0))]
            held = total.setdefault(x.shape[1], [0] * x.shape[1])
            total[x.shape[1]] = [p + q for p, q in zip(held, part)]
    for d, s in total.items():
        yield pa.RecordBatch.from_arrays([pa.array([d] * d, pa.int32()), pa.array(range(d), pa.int32()), _decimals(s)], ["dim", "i", "s"])


def _products(lows: dict[int, np.ndarray]):
    """Sums of the products of centred components: whole numbers, exact in doubles below 2**53."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for x in _fit_rows(b):
                y = centred(x, lows[x.shape[1]])
                total[x.shape[1]] = total.get(x.shape[1], 0.0) + y.T @ y
        for d, m in total.items():
            i, j = np.triu_indices(d)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(i), d, np.int32)), pa.array(i.astype(np.int32)),
                                              pa.array(j.astype(np.int32)), pa.array(m[i, j])], ["dim", "i", "j", "v"])

    return run


def _checked(models: dict[int, Model]):
    """Sums and products of the whitened fit list, whose covariance should be the identity."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for x in _fit_rows(b):
                w = np.nan_to_num(models[x.shape[1]].whitened(x))
                w = np.column_stack([w, np.ones(len(w))])  # the last row and column add up the means
                total[x.shape[1]] = total.get(x.shape[1], 0.0) + w.T @ w
        for d, m in total.items():
            i, j = np.triu_indices(len(m))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(i), d, np.int32)), pa.array(i.astype(np.int32)),
                                              pa.array(j.astype(np.int32)), pa.array(m[i, j])], ["dim", "i", "j", "v"])

    return run


def _matrices(sums: DataFrame, size: dict[int, int]) -> dict[int, np.ndarray]:
    """Symmetric matrices of each dimension from their added-up entries (at most size**2 rows)."""
    out = {d: np.zeros((k, k)) for d, k in size.items()}
    for r in sums.groupBy("dim", "i", "j").agg(F.sum("v").alias("v")).collect():
        out[r.dim][r.i, r.j] = out[r.dim][r.j, r.i] = r.v
    return out


def models_of(fit: DataFrame, components: int = COMPONENTS) -> dict[int, Model]:
    """The components of each dimension of the fit list ``(dim, small, wide)``."""
    n = {r.dim: r.n for r in fit.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).collect() if r.dim > 0}
    sums = {d: [0] * d for d in n}
    for r in fit.mapInArrow(_sums, f"dim int, i int, s decimal({DIGITS},0)").groupBy("dim", "i").agg(F.sum("s").alias("s")).collect():
        sums[r.dim][r.i] = int(r.s)
    lows = {d: np.array([(2 * s + n[d]) // (2 * n[d]) for s in sums[d]], np.int64) for d in n}
    entries = "dim int, i int, j int, v double"
    found = _matrices(fit.mapInArrow(_products(lows), entries), {d: d for d in n})
    out = {}
    for d, m in found.items():
        part = np.array([(s - n[d] * int(c)) / n[d] for s, c in zip(sums[d], lows[d])])
        v = m / n[d] - np.outer(part, part)
        values, vectors = leading(v, min(components, d))
        out[d] = Model(n[d], sums[d], lows[d], part, values, vectors, float(np.trace(v)))
    seen = _matrices(fit.mapInArrow(_checked(out), entries), {d: len(m.values) + 1 for d, m in out.items()})
    for d, m in out.items():
        fine = m.values > FLAT * m.trace
        mean = seen[d][:-1, -1] / m.n
        cov = (seen[d][:-1, :-1] / m.n - np.outer(mean, mean))[np.ix_(fine, fine)]
        m.error = float(np.abs(cov - np.eye(len(cov))).max()) if fine.any() else None
    return out


def _whiten(models: dict[int, Model]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = C.column(b, "vec_id")
            for rows, v in matrices(C.column(b, "x")):
                m = models.get(v.shape[1])
                if m is None:
                    continue
                x = whole(v)
                w, k, n = m.whitened(x), len(m.values), len(x)
                at = pa.array(np.repeat(rows, k))
                share = m.values / m.trace if m.trace > 0 else np.full(k, np.nan)
                each = lambda values: pa.array(np.tile(values, n), pa.float64(), mask=np.isnan(np.tile(values, n)))
                yield pa.RecordBatch.from_arrays(
                    [ids.take(at), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), n)), pa.array(np.full(n * k, m.n, np.int64)),
                     pa.array(m.deviations(x), pa.int64()).take(pa.array(np.repeat(np.arange(n), k))),
                     pa.array(w.ravel(), pa.float64(), mask=np.isnan(w.ravel())), each(share),
                     pa.array([m.error] * (n * k), pa.float64())],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return run


def whiten(vectors: DataFrame, components: int = COMPONENTS, vector: str = "embedding") -> DataFrame:
    """``(vec_id, component, n, deviation, whitened, explained, identity_error)``: a row per kept vector and component."""
    rows = vectors.where(usable(vector)).select(F.col("vec_id").cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("x"))
    with C.tables() as t:
        fit = t.table(rows.select("x").mapInArrow(_packed, "dim int, small binary, wide binary").distinct())
        models = models_of(fit, components)
    return rows.mapInArrow(_whiten(models), "vec_id long, component int, n long, deviation long, whitened double, "
                                            "explained double, identity_error double")
