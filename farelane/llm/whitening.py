"""Embedding whitening: leading principal components by spectrum slicing.

Vectors become integers, floor(256 c); the fit list holds each distinct vector
once.  Its count and sums are exact; the covariance is summed up from centred
vectors, a partial matrix in each task.  The matrix (dimension x dimension,
whatever the number of rows) comes to the driver, where the leading eigenpairs
are found one by one:

1. an LDL^T factorisation of V - sigma I (symmetric pivoting, 1 x 1 and 2 x 2
   blocks) has as many positive pivots as V has eigenvalues above sigma
   (Sylvester's law of inertia); bisection by these counts isolates the k-th;
2. Rayleigh quotient iteration from inside the bracket converges cubically;
3. counts just above and below the value it finds certify its number; where
   they don't, the bracket is halved once more.

Every row is then projected on the components in its own task.
"""

from __future__ import annotations

import decimal
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelane.session import materialize

COMPONENTS = 4
#: Eigenvalues up to this part of the trace count as 0.
ZERO = 1e-13
_ALPHA = (1 + 17 ** 0.5) / 8


def inertia(a: np.ndarray) -> tuple[int, int, int]:
    """(positive, negative, zero) eigenvalues of a symmetric matrix, from the
    blocks of its LDL^T factorisation with Bunch-Kaufman pivoting."""
    a = np.array(a, np.float64)
    n, k, pos, neg = len(a), 0, 0, 0

    def swap(i: int, j: int) -> None:
        if i != j:
            a[[i, j]] = a[[j, i]]
            a[:, [i, j]] = a[:, [j, i]]

    while k < n:
        size, d = 1, abs(a[k, k])
        below = np.abs(a[k + 1:, k])
        if len(below) and (lam := below.max()) > 0 and d < _ALPHA * lam:
            r = k + 1 + int(below.argmax())
            row = np.abs(a[k:, r])
            row[r - k] = 0
            sigma = row.max()
            if d * sigma < _ALPHA * lam * lam:
                if abs(a[r, r]) >= _ALPHA * sigma:
                    swap(k, r)
                else:
                    swap(k + 1, r)
                    size = 2
        if size == 1:
            p = a[k, k]
            pos, neg = pos + (p > 0), neg + (p < 0)
            if p != 0 and k + 1 < n:
                c = a[k + 1:, k]
                a[k + 1:, k + 1:] -= np.outer(c, c) / p
        else:
            pos, neg = pos + 1, neg + 1  # such a block has a negative determinant
            c = a[k + 2:, k:k + 2]
            if len(c):
                a[k + 2:, k + 2:] -= c @ np.linalg.solve(a[k:k + 2, k:k + 2], c.T)
        k += size
    return int(pos), int(neg), n - int(pos) - int(neg)


def above(v: np.ndarray, sigma: float) -> int:
    """Eigenvalues of ``v`` above ``sigma``."""
    return inertia(v - sigma * np.eye(len(v)))[0]


def rayleigh(v: np.ndarray, x: np.ndarray, shift: float, found: list[np.ndarray], tol: float) -> tuple[float, np.ndarray, float]:
    """(value, vector, residual): a step of inverse iteration at ``shift``,
    then Rayleigh quotient iteration, orthogonal to the vectors found."""
    eye, rho, res = np.eye(len(v)), shift, np.inf
    for step in range(12):
        for nudge in (0.0, 1e-15, 1e-14):
            try:
                y = np.linalg.solve(v - (rho + nudge * tol * 1e14) * eye, x)
            except np.linalg.LinAlgError:
                continue
            if np.isfinite(y).all():
                break
        else:
            return rho, x, res
        y /= np.abs(y).max()
        for _ in range(2):
            for f in found:
                y -= (f @ y) * f
        if not (size := np.linalg.norm(y)) > 0:
            return rho, x, res
        x = y / size
        vx = v @ x
        rho = float(x @ vx)
        last, res = res, float(np.linalg.norm(vx - rho * x))
        if res <= tol or (step > 3 and res >= last):
            break
    return rho, x, res


def leading(v: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` largest eigenvalues of a covariance, falling, and their
    unit eigenvectors as rows.  The largest entry of a vector is positive.
    Eigenvalues that don't differ in double precision share their space."""
    d = len(v)
    v = (v + v.T) / 2
    size = float(np.abs(v).sum(axis=1).max()) if d else 0.0
    values, vectors = [], []
    if size == 0:
        return np.zeros(min(count, d)), np.eye(d)[:min(count, d)]
    tol = 1e-14 * size
    start = np.random.default_rng(11).normal(size=d)
    top = size * (1 + 1e-12)
    for k in range(1, min(count, d) + 1):
        lo, hi = -tol * d, top
        while True:
            mid = (lo + hi) / 2
            n = above(v, mid)
            lo, hi = (mid, hi) if n >= k else (lo, mid)
            tight = hi - lo <= 4 * tol
            if not tight and (hi - lo > 1e-3 * size or (above(v, lo), above(v, hi)) != (k, k - 1)):
                if hi - lo > 1e-9 * size:
                    continue  # not alone in its bracket yet
            rho, x, res = rayleigh(v, start, (lo + hi) / 2, vectors, tol)
            slack = max(4 * res, 4 * tol)
            if tight or (lo - slack <= rho <= hi + slack and res <= 1e-11 * size
                         and above(v, rho + slack) <= k - 1 and above(v, rho - slack) >= k):
                break
        x = x * (1 if x[np.abs(x).argmax()] > 0 else -1)
        values.append(max(0.0, rho))
        vectors.append(x)
        top = min(top, rho + slack)
    return np.array(values), np.array(vectors)


@dataclass
class Whitening:
    """Fit of the vectors of one length: ``n`` of the fit list, ``sums`` by
    dimension (exact), ``values`` and ``vectors`` of the components, ``trace``."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    def scales(self) -> np.ndarray:
        """1 / sqrt(e); NaN where the eigenvalue is 0."""
        ok = self.values > ZERO * self.trace
        return np.where(ok, 1 / np.sqrt(np.where(ok, self.values, 1.0)), np.nan)

    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums], np.float64)

    def project(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean()) @ self.vectors.T) * self.scales()

    def deviations(self, x: np.ndarray) -> list[int]:
        """Exact sums over the dimensions of (n x - S) squared."""
        ss = sum(s * s for s in self.sums)
        big = max(map(abs, self.sums), default=0), int(np.abs(x).max(initial=0))
        if max(big) * big[1] * x.shape[1] < 2 ** 62:
            xx, xs = (x * x).sum(axis=1), x @ np.array(self.sums, np.int64)
        else:
            xx, xs = (x.astype(object) ** 2).sum(axis=1), x.astype(object) @ np.array(self.sums, object)
        return [self.n * self.n * int(a) - 2 * self.n * int(b) + ss for a, b in zip(xx, xs)]


def integer_rows(df: DataFrame, embedding: str = "embedding") -> DataFrame:
    """``df`` with ``x`` (longs floor(256 c)) and ``dim``, without the rows
    whose vector is null or holds null or non-finite entries."""
    v = F.col(embedding).cast("array<double>")
    whole = df.withColumn("x", v).filter(
        F.col("x").isNotNull() & F.forall("x", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf"))))
    return whole.withColumn("x", F.transform("x", lambda e: F.floor(e * 256))).withColumn("dim", F.size("x"))


def _by_length(batches, start, add):
    """Folds ``add(state, rows)`` over the batches, by vector length."""
    state: dict[int, object] = {}
    for pdf in batches:
        dims = pdf["x"].map(len).to_numpy()
        for d in np.unique(dims):
            x = np.stack(pdf["x"].to_numpy()[dims == d]).astype(np.int64).reshape(-1, int(d))
            state[int(d)] = add(state.get(int(d), None) if int(d) in state else start(int(d)), x)
    return state


def _sums(batches):
    # Python integers over the batches, so that they can't overflow unseen
    got = _by_length(batches, lambda d: [0] * (d + 1),
                     lambda s, x: [s[0] + len(x), *(a + int(b) for a, b in zip(s[1:], x.sum(axis=0)))])
    rows = [(d, i, v) for d, s in got.items() for i, v in enumerate(s)]
    yield pd.DataFrame(rows, columns=["dim", "i", "v"])


def _products(maps: dict):
    """Sums of products, upper triangle, of the mapped rows of a task; ``maps``
    is by vector length."""
    def run(batches):
        got = _by_length(batches, lambda d: 0.0, lambda s, x: s + (lambda y: y.T @ y)(maps[x.shape[1]](x)))
        for d, c in got.items():
            i, j = np.triu_indices(len(c))
            yield pd.DataFrame({"dim": d, "i": i, "j": j, "v": c[i, j]})
    return run


def _matrices(fit_list: DataFrame, maps: dict, sizes: dict) -> dict[int, np.ndarray]:
    cells = (fit_list.select("x").mapInPandas(_products(maps), "dim int, i int, j int, v double")
             .groupBy("dim", "i", "j").agg(F.sum("v").alias("v")).collect())
    out = {d: np.zeros((k, k)) for d, k in sizes.items()}
    for r in cells:
        out[r["dim"]][r["i"], r["j"]] = out[r["dim"]][r["j"], r["i"]] = r["v"]
    return out


def fit(fit_list: DataFrame, components: int = COMPONENTS) -> dict[int, Whitening]:
    """Whitening of the vectors ``x`` of ``fit_list``, by vector length (empty
    vectors have none).  To the driver come, for each length d, d + 1 sums and
    d (d + 1) / 2 cells, however many rows there are."""
    fit_list = fit_list.filter(F.size("x") > 0)
    sums: dict[int, dict[int, int]] = {}
    for r in (fit_list.select("x").mapInPandas(_sums, "dim int, i int, v long").groupBy("dim", "i")
              .agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v")).collect()):
        sums.setdefault(r["dim"], {})[r["i"]] = int(r["v"])
    means = {d: np.array([s[i + 1] / s[0] for i in range(d)], np.float64) for d, s in sums.items()}
    centred = {d: (lambda x, m=m: x - m) for d, m in means.items()}
    out = {}
    for d, c in _matrices(fit_list, centred, {d: d for d in sums}).items():
        v = c / sums[d][0]
        values, vectors = leading(v, components)
        out[d] = Whitening(sums[d][0], [sums[d][i + 1] for i in range(d)], values, vectors, float(np.trace(v)))
    return out


def identity_errors(fit_list: DataFrame, models: dict[int, Whitening]) -> dict[int, float]:
    """Largest absolute entry of (covariance of the whitened fit list - identity),
    measured on the whitened rows; components of eigenvalue 0 are left out."""
    def ones(m: Whitening):
        ok = np.isfinite(m.scales())
        return lambda x: np.concatenate([m.project(x)[:, ok], np.ones((len(x), 1))], axis=1)
    sizes = {d: int(np.isfinite(m.scales()).sum()) + 1 for d, m in models.items()}
    out = {}
    for d, c in _matrices(fit_list.filter(F.size("x") > 0), {d: ones(m) for d, m in models.items()}, sizes).items():
        c = c / models[d].n
        out[d] = float(np.abs(c[:-1, :-1] - np.outer(c[:-1, -1], c[:-1, -1]) - np.eye(len(c) - 1)).max(initial=0.0))
    return out


def _apply(models: dict[int, Whitening]):
    @F.pandas_udf("struct<deviation:decimal(38,0),whitened:array<double>>")
    def run(xs: pd.Series) -> pd.DataFrame:
        dims = xs.map(len).to_numpy()
        dev, out = np.empty(len(xs), object), np.empty(len(xs), object)
        for d in np.unique(dims):
            at = np.flatnonzero(dims == d)
            if d == 0:
                out[at] = [[] for _ in at]
                continue
            x = np.stack(xs.to_numpy()[at]).astype(np.int64)
            m = models[int(d)]
            w = m.project(x)
            dev[at] = [decimal.Decimal(v) for v in m.deviations(x)]
            out[at] = [[None if np.isnan(e) else e for e in r] for r in w.tolist()] if np.isnan(w).any() else list(w)
        return pd.DataFrame({"deviation": dev, "whitened": out})
    return run


def whiten(df: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row per row of ``df`` and component (1 to ``components``, fewer if
    the vectors have fewer dimensions): ``vec_id``, ``component``, ``n`` (length
    of the fit list), ``deviation`` (decimal, exact: sum of (n x - S) squared),
    ``whitened``, ``explained``, ``identity_error``.

    Rows whose vector is null or holds null or non-finite entries are left out;
    an empty vector has no component, so no row.  Repeated rows are all
    returned, but count once in the fit, as all equal integer vectors do;
    a null vec_id is kept.  Vectors of different lengths are fitted apart.
    A component whose eigenvalue is 0 (one vector only, fewer distinct vectors
    than components) has a null ``whitened``; ``explained`` is null if the
    trace is 0.  Equal eigenvalues have any basis of their space.  Components
    within 2 ** 40 are expected.  An empty table gives an empty result."""
    spark = df.sparkSession
    rows = materialize(integer_rows(df.select(F.col(vec_id).alias("vec_id"), F.col(embedding).alias("embedding")))
                       .select("vec_id", "x", "dim"))
    fit_list = materialize(rows.select("x").distinct())
    models = fit(fit_list, components)
    errors = identity_errors(fit_list, models)
    # one row per vector length and component
    table = [(d, k + 1, m.n, float(m.values[k] / m.trace) if m.trace > 0 else None, errors[d])
             for d, m in models.items() for k in range(len(m.values))]
    table = spark.createDataFrame(table, "m_dim int, component int, n long, explained double, identity_error double")
    done = rows.select("vec_id", "dim", _apply(models)("x").alias("w")).select(
        "vec_id", "dim", "w.deviation", F.posexplode("w.whitened").alias("at", "whitened"))
    return (done.join(F.broadcast(table), (F.col("dim") == F.col("m_dim")) & (F.col("at") + 1 == F.col("component")))
            .select("vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"))


def whitened_digest(df: DataFrame) -> DataFrame:
    """:func:`whiten` with the deviation as a long (null where a long can't
    hold it)."""
    return whiten(df).withColumn("deviation", F.expr("try_cast(deviation AS BIGINT)"))
