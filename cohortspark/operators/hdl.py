"""Heritability and genetic covariance from summary statistics by likelihood over LD pieces.

Pieces of the LD reference are rows (piece, snps, a2, lam, ld_scores, vectors); effects are rotated by the
eigenvectors of each piece. Jobs are rows; what is in the results already is left out by an anti-join, so a run that
broke off goes on where it stopped.
"""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortspark.functions import genetics as G

from .optim import minimise_box
from .variables import quantiles

#: Fixed values of the likelihood: size of the reference panel and least scaled eigenvalue.
REFERENCE_N, LEAST = 335265, float(np.exp(-18.0))
SCHEMA = "phenotype1 string, phenotype2 string, piecewise_index smallint, jackknife_index smallint, slope double, intercept double"


def marginal_effects(reference: DataFrame, sumstats: DataFrame) -> DataFrame:
    """piece, ord, snp, phenotype, effect: every reference SNP of every phenotype, in the reference's order; 0 where missing."""
    phenotypes = sumstats.select("phenotype").distinct()
    wanted = reference.crossJoin(F.broadcast(phenotypes))
    found = wanted.join(sumstats.where("z is not null"), ["snp", "phenotype"], "left")
    return found.select("piece", "ord", "snp", "phenotype", G.marginal_effect(F.col("z"), F.col("n"), F.col("allele"), F.col("ref_allele")).alias("effect"))


def sample_counts(sumstats: DataFrame) -> DataFrame:
    """phenotype, least and median sample count."""
    least = sumstats.groupBy("phenotype").agg(F.min("n").alias("n_min"))
    return least.join(quantiles(sumstats, (0.5,), "phenotype", value="n").select("phenotype", F.col("q0").alias("n_median")), "phenotype")


def rotate(effects: DataFrame, pieces: DataFrame) -> DataFrame:
    """piece, phenotype, lam, snp_count, rotated: effects of a piece in its eigenvectors' coordinates.

    A piece's eigenvectors meet its effects of all phenotypes in one task, once and not once a phenotype.
    """
    schema = "piece int, phenotype string, lam array<double>, snp_count int, rotated array<double>"

    def run(own: pd.DataFrame, piece: pd.DataFrame) -> pd.DataFrame:
        if not len(own) or not len(piece):
            return pd.DataFrame({"piece": [], "phenotype": [], "lam": [], "snp_count": [], "rotated": []})
        vectors, lam = np.array(piece["vectors"].iloc[0].tolist(), float), np.asarray(piece["lam"].iloc[0], float)
        wide = own.sort_values("ord").pivot(index="ord", columns="phenotype", values="effect")
        out = (vectors.T @ wide.to_numpy(float)).T
        return pd.DataFrame({"piece": int(piece["piece"].iloc[0]), "phenotype": wide.columns, "lam": [lam.tolist()] * len(out), "snp_count": len(wide), "rotated": out.tolist()})

    own = effects.select(F.col("piece").cast("int"), "ord", "phenotype", "effect").groupBy("piece")
    return own.cogroup(pieces.select(F.col("piece").cast("int"), "lam", "vectors").groupBy("piece")).applyInPandas(run, schema)


def scaled(slope: float, intercept: float, lam: np.ndarray, m: float, n: float) -> np.ndarray:
    return np.maximum(slope / m * lam**2 - slope * lam / REFERENCE_N + intercept * lam / n, LEAST)


def estimate1(lam: np.ndarray, b: np.ndarray, m: float, n: float, start: np.ndarray | None = None) -> np.ndarray:
    """(slope, intercept) of one phenotype: heritability within [0, 1], intercept within [0, 10]."""
    n = max(n, 1.0)

    def value(p: np.ndarray) -> float:
        s = scaled(p[0], p[1], lam, m, n)
        return float(np.log(s).sum() + (b**2 / s).sum())

    starts = [[h, c] for h in (0.01, 0.2, 0.6) for c in (0.5, 1.0, 1.5)]
    return minimise_box(value, np.array(([start.tolist()] if start is not None else []) + starts, float), np.zeros(2), np.array([1.0, 10.0]))[0]


def estimate2(lam: np.ndarray, b1: np.ndarray, b2: np.ndarray, m: float, n1: float, n2: float, n_min: float, p1: np.ndarray, p2: np.ndarray, start: np.ndarray | None = None) -> np.ndarray:
    """(slope, intercept) of two phenotypes given their own: genetic covariance within [-1, 1]."""
    n12 = n1 * n2 / n_min
    s1, s2 = scaled(*p1, lam, m, n1), scaled(*p2, lam, m, n2)

    def value(p: np.ndarray) -> float:
        cross = p[0] / m * lam**2 + p[1] * lam / n12
        s = np.maximum(s2 - cross**2 / s1, LEAST)
        return float(np.log(s).sum() + ((b2 - cross / s1 * b1) ** 2 / s).sum())

    starts = [[h, c] for h in (-0.2, 0.0, 0.2) for c in (-0.2, 0.0, 0.2)]
    return minimise_box(value, np.array(([start.tolist()] if start is not None else []) + starts, float), np.array([-1.0, -10.0]), np.array([1.0, 10.0]))[0]


def jobs(phenotypes: DataFrame, pieces: DataFrame, step: str, done: DataFrame | None = None) -> DataFrame:
    """phenotype1, phenotype2, piecewise_index, jackknife_index still to do.

    `piecewise` has a job for each piece, `jackknife` one for each left-out piece and one, with a NULL index, for none;
    pairs of different phenotypes come in one order.
    """
    a, b = phenotypes.select(F.col("phenotype").alias("phenotype1")), phenotypes.select(F.col("phenotype").alias("phenotype2"))
    pairs = a.join(b, F.col("phenotype1") <= F.col("phenotype2"))
    index = pieces.select(F.col("piece").cast("smallint").alias("p"))
    none = F.lit(None).cast("smallint")
    if step == "piecewise":
        out = pairs.crossJoin(index).select("phenotype1", "phenotype2", F.col("p").alias("piecewise_index"), none.alias("jackknife_index"))
    else:
        all_ = index.unionAll(index.limit(1).select(none))
        out = pairs.crossJoin(all_).select("phenotype1", "phenotype2", none.alias("piecewise_index"), F.col("p").alias("jackknife_index"))
    if done is None:
        return out
    o, d = out.alias("o"), done.alias("d")
    same = [F.col(f"o.{c}").eqNullSafe(F.col(f"d.{c}")) for c in out.columns]
    return o.join(d, same, "left_anti")


def estimate(rotated: DataFrame, counts: DataFrame, todo: DataFrame, starts: DataFrame | None = None, group: int = 16) -> DataFrame:
    """Results of the jobs; starts (phenotype1, phenotype2, slope, intercept) are tried first, as totals() of the pieces gives them.

    Phenotypes are dealt out to groups of about `group`; a pair of groups is one task's work. It holds the rotated effects
    of two groups only (eigenvalues of the reference, a fixed number a phenotype), so a phenotype's effects are copied
    once for every group and not once for every job.
    """
    n = counts.select("phenotype").distinct().count()
    groups = max(1, -(-n // group))
    of = lambda c: F.pmod(F.xxhash64(c), F.lit(groups)).cast("int")
    low, high = F.least(of("phenotype1"), of("phenotype2")), F.greatest(of("phenotype1"), of("phenotype2"))
    jobs_ = todo.withColumns({"g": low, "h": high})
    if starts is not None:
        s = starts.select(F.col("phenotype1").alias("s1"), F.col("phenotype2").alias("s2"), F.col("slope").alias("start_slope"), F.col("intercept").alias("start_intercept"))
        jobs_ = jobs_.join(s, (F.col("phenotype1") == F.col("s1")) & (F.col("phenotype2") == F.col("s2")), "left").drop("s1", "s2")
    else:
        jobs_ = jobs_.withColumns({"start_slope": F.lit(None).cast("double"), "start_intercept": F.lit(None).cast("double")})
    data = rotated.join(counts, "phenotype").withColumn("g", of("phenotype")).withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    data = data.select(F.least("g", "other").alias("g"), F.greatest("g", "other").alias("h"), "piece", "phenotype", "lam", "snp_count", "rotated", "n_min", "n_median")
    return jobs_.groupBy("g", "h").cogroup(data.groupBy("g", "h")).applyInPandas(_solve, SCHEMA)


def _solve(todo: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
    data: dict[str, dict[int, tuple]] = {}
    sizes: dict[str, tuple[float, float]] = {}
    for r in rows.itertuples(index=False):
        data.setdefault(r.phenotype, {})[r.piece] = (np.asarray(r.lam, float), np.asarray(r.rotated, float), r.snp_count)
        sizes[r.phenotype] = (float(r.n_min), float(r.n_median))
    known: dict[tuple, np.ndarray] = {}

    def gather(name: str, pieces: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray, float]:
        own = data[name]
        return np.concatenate([own[p][0] for p in pieces]), np.concatenate([own[p][1] for p in pieces]), float(sum(own[p][2] for p in pieces))

    def single(name: str, pieces: tuple[int, ...], start: np.ndarray | None = None) -> np.ndarray:
        if (name, pieces) not in known:
            known[name, pieces] = estimate1(*gather(name, pieces), sizes[name][1], start)
        return known[name, pieces]

    out = []
    for j in todo.itertuples(index=False):
        pieces = (int(j.piecewise_index),) if not pd.isna(j.piecewise_index) else tuple(p for p in sorted(data[j.phenotype1]) if pd.isna(j.jackknife_index) or p != j.jackknife_index)
        start = None if pd.isna(j.start_slope) else np.array([j.start_slope, 0.0 if pd.isna(j.start_intercept) else j.start_intercept])
        if j.phenotype1 == j.phenotype2:
            out.append(single(j.phenotype1, pieces, start))
            continue
        lam, b1, m = gather(j.phenotype1, pieces)
        _, b2, _ = gather(j.phenotype2, pieces)
        (min1, n1), (min2, n2) = sizes[j.phenotype1], sizes[j.phenotype2]
        out.append(estimate2(lam, b1, b2, m, n1, n2, min(min1, min2), single(j.phenotype1, pieces), single(j.phenotype2, pieces), start))
    done = todo[["phenotype1", "phenotype2", "piecewise_index", "jackknife_index"]]
    return done.assign(slope=[x[0] for x in out], intercept=[x[1] for x in out])


def starts(estimates: DataFrame) -> DataFrame:
    """phenotype1, phenotype2, slope (summed over the pieces) and intercept (their mean): where whole-genome jobs begin."""
    per = estimates.where("piecewise_index is not null").groupBy("phenotype1", "phenotype2")
    return per.agg(F.sum("slope").alias("slope"), F.avg("intercept").alias("intercept"))


def piece_ranges(pieces: DataFrame) -> DataFrame:
    """piece, first_snp, last_snp, first_value, last_value (one past): where each piece's SNPs and eigenvalues lie in all of them."""
    sizes = pieces.select("piece", F.size("vectors").alias("s"), F.size("lam").alias("e"))
    up_to = Window.orderBy("piece").rowsBetween(Window.unboundedPreceding, 0)  # the pieces of the reference: a fixed number
    ends = sizes.select("piece", "s", "e", F.sum("s").over(up_to).alias("last_snp"), F.sum("e").over(up_to).alias("last_value"))
    return ends.select("piece", (F.col("last_snp") - F.col("s")).alias("first_snp"), "last_snp", (F.col("last_value") - F.col("e")).alias("first_value"), "last_value")


def own_estimates(estimates: DataFrame) -> DataFrame:
    """Whole-genome estimates of single phenotypes: both names equal, no index."""
    return estimates.where("phenotype1 = phenotype2 and piecewise_index is null and jackknife_index is null").select(F.col("phenotype1").alias("phenotype"), "slope", "intercept")


def totals(estimates: DataFrame) -> DataFrame:
    """phenotype1, phenotype2, slope: sums over the pieces."""
    return estimates.where("piecewise_index is not null").groupBy("phenotype1", "phenotype2").agg(F.sum("slope").alias("slope"))


def jackknife_error(estimates: DataFrame) -> DataFrame:
    """phenotype1, phenotype2, variance of the leave-one-out slopes, scaled as a jackknife does."""
    per = estimates.where("jackknife_index is not null").groupBy("phenotype1", "phenotype2").agg(F.count("*").alias("k"), F.var_pop("slope").alias("v"))
    return per.select("phenotype1", "phenotype2", ((F.col("k") - 1) * F.col("v")).alias("variance"))


def pairs(names: list[str]) -> list[tuple[str, str]]:
    return list(itertools.combinations(names, 2))
