"""Variance-component null models: y = Xb + g + e with g of covariance sg * K and e of variance se.

Everything is rotated by the eigenvectors of K, so that the variance of each element is v = sg * lambda + se.
Each phenotype is one small problem (samples by covariates) and is solved in one call within a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from .optim import minimise_box, minimise_interval

METHODS = ("fastlmm", "pml", "mpl", "reml", "ml")
SCHEMA = "collection string, phenotype string, method string, log_likelihood double, heritability double, genetic_variance double, error_variance double, beta array<double>, se array<double>, residuals array<double>, variance array<double>"
PENALTY = 1e4
#: Phenotypes that are searched at once, and whose weights are made at once on the driver.
BATCH, GATHERED = 32, 4096


def eigen(kinship: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, largest first, and vectors of a kinship matrix; a low rank raises.

    One eigenvalue may be 0: dosages that are centred over these very samples add up to 0.
    """
    values, vectors = np.linalg.eigh(kinship)
    if (values <= 1e-10 * max(values[-1], 1e-300)).sum() > 1:
        raise ValueError("the kinship matrix is not of full rank")
    return np.maximum(values[::-1], 0.0), vectors[:, ::-1]


def eigen_of_factor(r: np.ndarray, n_variants: int) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, largest first, and vectors of R'R / n_variants by singular values of the triangular factor, which
    loses no digits to squaring; a low rank (but for one value) raises."""
    _, values, right = np.linalg.svd(r)
    if (values <= np.finfo(float).eps * max(r.shape) * values.max(initial=0.0)).sum() > 1:
        raise ValueError("the triangular factor is not of full rank")
    return values**2 / n_variants, right.T


def subset(gram: np.ndarray, n_variants: int, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues and vectors for some of the samples: rows and columns of the matrix of all of them."""
    return eigen(gram[np.ix_(rows, rows)] / n_variants)


class Terms:
    """Weighted least squares at given variances."""

    def __init__(self, lam: np.ndarray, x: np.ndarray, y: np.ndarray, error: float, genetic: float) -> None:
        self.v = genetic * lam + error
        root = np.sqrt(self.v)
        self.x, self.y = x / root[:, None], y / root
        self.beta = np.linalg.lstsq(self.x, self.y, rcond=None)[0]
        self.r = self.y - self.x @ self.beta
        self.log_v, self.deviance = float(np.log(self.v).sum()), float(self.r @ self.r)


def _softplus(x: np.ndarray) -> np.ndarray:
    scaled = PENALTY * x
    return np.where(scaled > 20, x, np.log1p(np.exp(np.minimum(scaled, 20))) / PENALTY)


def objective(method: str, lam: np.ndarray, x: np.ndarray, y: np.ndarray):
    """-2 log likelihood (without constants) of (error, genetic) for the methods with two free variances."""
    most = 2 * float(np.var(y)) if len(y) else 1.0

    def value(theta: np.ndarray) -> float:
        t = Terms(lam, x, y, max(theta[0], 1e-12), max(theta[1], 0.0))
        penalty = PENALTY * float((_softplus(-theta) + _softplus(theta - most)).sum())
        if method == "reml":
            return t.log_v + float(t.y @ t.r) + np.linalg.slogdet(t.x.T @ t.x)[1] + penalty
        out = t.log_v + t.deviance + penalty
        return out - 2 * float(np.log(np.maximum(theta, 1e-12)).sum()) if method == "mpl" else out

    return value


def fit_fastlmm(lam: np.ndarray, x: np.ndarray, y: np.ndarray) -> tuple[float, float, float]:
    """(error, genetic, value): one search over log10 of their ratio, in brackets of 0.2."""
    n, var = len(y), max(float(np.var(y)), 1e-12)

    def value(log_ratio: float) -> float:
        t = Terms(lam, x, y, 10**log_ratio, 1.0)
        return n + t.log_v + n * np.log(t.deviance / n)

    low, high = -4 - np.log10(var), max(np.log10(var), -3.8 - np.log10(var))
    edges = np.append(np.arange(low, high, 0.2), high)
    x_best, best = min((minimise_interval(value, a, b) for a, b in zip(edges[:-1], edges[1:], strict=True)), key=lambda p: p[1])
    scale = float(np.mean(Terms(lam, x, y, 10**x_best, 1.0).r ** 2))
    return 10**x_best * scale, scale, float(best)


def profile(lam: np.ndarray, x: np.ndarray, y: np.ndarray, log_ratio: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(-2 log likelihood without constants, mean squared residual) of columns of y at log10 ratios of the variances, all at once.

    log_ratio is phenotypes by places; sums over samples are matrix products.
    """
    n, k = x.shape
    p, places = log_ratio.shape
    w = 1 / (lam + 10 ** log_ratio.ravel()[:, None])
    cross = (w @ (x[:, :, None] * x[:, None, :]).reshape(n, k * k)).reshape(-1, k, k)
    own = np.repeat(np.arange(p), places)
    wy = w * y.T[own]
    right = wy @ x
    beta = np.linalg.solve(cross, right[:, :, None])[:, :, 0]
    r = y.T[own] - beta @ x.T
    deviance = (w * r * r).sum(1)
    value = n - np.log(w).sum(1) + n * np.log(deviance / n)
    return value.reshape(p, places), (deviance / n).reshape(p, places)


def fit_fastlmm_many(lam: np.ndarray, x: np.ndarray, y: np.ndarray, steps: int = 48) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """fit_fastlmm() of every column of y: all brackets of all columns are searched at once by golden sections."""
    var = np.maximum(y.var(0), 1e-12)
    low, high = -4 - np.log10(var), np.maximum(np.log10(var), -3.8 - np.log10(var))
    count = max(1, int(np.ceil(((high - low) / 0.2).max())))
    edges = np.minimum(low[:, None] + 0.2 * np.arange(count + 1), high[:, None])
    a, b = edges[:, :-1].copy(), edges[:, 1:].copy()
    gold = (5**0.5 - 1) / 2
    c, d = b - gold * (b - a), a + gold * (b - a)
    fc, fd = profile(lam, x, y, c)[0], profile(lam, x, y, d)[0]
    for _ in range(steps):
        left = fc <= fd
        a, b = np.where(left, a, c), np.where(left, d, b)
        new = np.where(left, b - gold * (b - a), a + gold * (b - a))
        f = profile(lam, x, y, new)[0]
        c, d, fc, fd = np.where(left, new, d), np.where(left, c, new), np.where(left, f, fd), np.where(left, fc, f)
    at = np.where(fc <= fd, c, d)
    value = np.minimum(fc, fd)
    # the ends of the whole range count too
    at, value = np.hstack([at, low[:, None], high[:, None]]), np.hstack([value, profile(lam, x, y, np.stack([low, high], 1))[0]])
    best = value.argmin(1)
    row = np.arange(y.shape[1])
    at, value = at[row, best], value[row, best]
    scale = profile(lam, x, y, at[:, None])[1][:, 0]
    return 10**at * scale, scale, value


def fit(method: str, lam: np.ndarray, x: np.ndarray, y: np.ndarray, standard_se: bool = False, known: tuple[float, float, float] | None = None) -> dict:
    """One null model from the rotated covariates x and phenotype y; without `standard_se` the historical
    standard errors s**2 * sqrt(diag(inverse)), with it sqrt(s**2 * diag(inverse)). known is what fit_fastlmm() gives, if
    that has been found already."""
    if method == "fastlmm":
        error, genetic, value = known or fit_fastlmm(lam, x, y)
    else:
        var = float(np.var(y))
        f = objective("pml" if method == "ml" else method, lam, x, y)
        e, g, _ = known or fit_fastlmm(lam, x, y)
        starts = np.array([[e, g], *([a * var, b * var] for a in (0.1, 0.5, 1.0) for b in (0.1, 0.5, 1.0))])
        theta, value = minimise_box(f, starts, np.array([1e-4 * min(1.0, var), 0.0]), np.array([2 * var, 2 * var]))
        error, genetic = float(theta[0]), float(theta[1])
    t = Terms(lam, x, y, error, genetic)
    inverse = np.diag(np.linalg.inv(t.x.T @ t.x))
    s2 = t.deviance / max(1, len(y) - x.shape[1])
    if method == "ml":
        se = curvature_se(lam, x, y, error, genetic, t.beta)
    else:
        se = np.sqrt(s2 * inverse) if standard_se else s2 * np.sqrt(inverse)
    return {
        "log_likelihood": -0.5 * value, "heritability": genetic / (genetic + error), "genetic_variance": genetic, "error_variance": error,
        "beta": t.beta.tolist(), "se": se.tolist(), "residuals": t.r.tolist(), "variance": t.v.tolist(),
    }


def curvature(lam: np.ndarray, x: np.ndarray, y: np.ndarray, error: float, genetic: float, beta: np.ndarray) -> np.ndarray:
    """Second derivatives of -2 log likelihood (without penalty) by error variance, genetic variance and all of beta."""
    v = genetic * lam + error
    r = y - x @ beta
    by = np.column_stack([np.ones(len(lam)), lam])  # of v, by the two variances
    out = np.empty((2 + len(beta), 2 + len(beta)))
    out[:2, :2] = (by * (2 * r**2 / v**3 - 1 / v**2)[:, None]).T @ by
    out[2:, :2] = 2 * x.T @ (by * (r / v**2)[:, None])
    out[:2, 2:] = out[2:, :2].T
    out[2:, 2:] = 2 * x.T @ (x / v[:, None])
    return out


def curvature_se(lam: np.ndarray, x: np.ndarray, y: np.ndarray, error: float, genetic: float, beta: np.ndarray) -> np.ndarray:
    """Standard errors of beta from the inverse of the whole curvature; NaN where that has no positive diagonal."""
    with np.errstate(invalid="ignore"):
        return np.sqrt(np.diag(np.linalg.inv(curvature(lam, x, y, error, genetic, beta)))[2:])


def scatter(vectors: np.ndarray, own: list[str], union: list[str]) -> np.ndarray:
    """Rows of a collection's eigenvectors at their samples' places among all samples; 0 for samples that it lacks."""
    place = {s: i for i, s in enumerate(union)}
    out = np.zeros((len(union), vectors.shape[1]))
    out[[place[s] for s in own]] = vectors
    return out


def fit_all(phenotypes: DataFrame, eigens: dict[str, tuple[np.ndarray, np.ndarray]], covariates: dict[str, np.ndarray], method: str = "fastlmm", partitions: int = 64) -> DataFrame:
    """One row for each of phenotypes (collection, phenotype, y: values in the collection's sample order).

    eigens and covariates (first column the intercept; the others are centred) are by collection and broadcast: they
    grow with samples, not with variants or phenotypes. A fit that fails gives NULLs.
    """
    if method not in METHODS:
        raise ValueError(f"method is one of {', '.join(METHODS)}")
    shared = phenotypes.sparkSession.sparkContext.broadcast((eigens, covariates))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        eigens, covariates = shared.value
        for f in frames:
            rows = []
            for collection, own in f.groupby("collection", sort=False):
                lam, q = eigens[collection]
                x = np.array(covariates[collection], float)
                x[:, 1:] -= x[:, 1:].mean(0)
                x, y = q.T @ x, q.T @ np.array(own["y"].tolist(), float).T
                for at in range(0, y.shape[1], BATCH):
                    part = y[:, at : at + BATCH]
                    try:
                        known = list(zip(*(v.tolist() for v in fit_fastlmm_many(lam, x, part)), strict=True))
                    except (np.linalg.LinAlgError, ValueError, FloatingPointError):
                        known = [None] * part.shape[1]  # one by one, so that one that fails leaves the others
                    for j, phenotype in enumerate(own["phenotype"].iloc[at : at + BATCH]):
                        try:
                            got = fit(method, lam, x, part[:, j], known=known[j])
                        except (np.linalg.LinAlgError, ValueError, FloatingPointError):
                            got = dict.fromkeys(("log_likelihood", "heritability", "genetic_variance", "error_variance", "beta", "se", "residuals", "variance"))
                        rows.append({"collection": collection, "phenotype": phenotype, "method": method} | got)
            yield pd.DataFrame(rows)

    return phenotypes.select("collection", "phenotype", "y").repartition(partitions).mapInPandas(run, SCHEMA)


class Variances:
    """Variances of each element (samples by phenotypes), kept as two numbers a phenotype; called with a slice of the
    phenotypes, it gives 1 / v of these."""

    def __init__(self, lam: np.ndarray, genetic: np.ndarray, error: np.ndarray) -> None:
        self.lam, self.genetic, self.error = lam, genetic, error

    def of(self, columns: slice) -> np.ndarray:
        return self.genetic[columns] * self.lam[:, None] + self.error[columns]

    def __call__(self, columns: slice) -> np.ndarray:
        return 1 / self.of(columns)


def gathered(fits: DataFrame, lam: np.ndarray, q: np.ndarray) -> tuple[list[str], np.ndarray, Variances]:
    """Phenotypes in their order, score_weights() and variances of one collection's models; fits that failed are left
    out. They come as Arrow buffers, not as a Python number for each value, and without the variances of all elements."""
    got = fits.where("variance is not null").select("phenotype", "residuals", "genetic_variance", "error_variance").toArrow().combine_chunks()
    names = got.column("phenotype").to_pylist()
    order = np.array(sorted(range(len(names)), key=names.__getitem__), np.int64)
    r = np.asarray(got.column("residuals").combine_chunks().flatten()).reshape(-1, q.shape[1])
    v = Variances(lam, *(np.asarray(got.column(c).combine_chunks())[order] for c in ("genetic_variance", "error_variance")))
    w = np.empty((len(q), len(names)))
    for at in range(0, len(names), GATHERED):
        columns = slice(at, at + GATHERED)
        w[:, columns] = score_weights(q, r[order[columns]].T, v.of(columns))
    return [names[i] for i in order], w, v


def score_weights(q: np.ndarray, residuals: np.ndarray, variance: np.ndarray) -> np.ndarray:
    """Columns w with U = (g - mean) w: q (residuals / sqrt(variance)), all samples by phenotypes."""
    return q @ (residuals / np.sqrt(variance))
