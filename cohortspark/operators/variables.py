"""Phenotypes and covariates: combining tables, aligning samples, missing-value patterns, covariance.

Wide tables have a `sample_id` and one column a variable; long ones are (sample_id, variable, value) without NULLs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortspark import lineage
from cohortspark.functions import stats

from . import blocks

#: Groups that are sent to all tasks; beyond that they are joined by a shuffle.
BROADCAST_GROUPS = 100_000


def combine_first(left: DataFrame, right: DataFrame, key: str = "sample_id") -> DataFrame:
    """Union of rows and columns; where both have a value the left one counts."""
    a, b = left.alias("a"), right.alias("b")
    names = [*left.columns, *(c for c in right.columns if c not in left.columns)]
    both = a.join(b, F.col(f"a.{key}") == F.col(f"b.{key}"), "full")

    def pick(c: str) -> Column:
        sides = [F.col(f"{s}.{c}") for s, df in (("a", left), ("b", right)) if c in df.columns]
        return F.coalesce(*sides).alias(c)

    return both.select(*(pick(c) for c in names))


def combine(frames: list[DataFrame], key: str = "sample_id") -> DataFrame:
    return reduce(lambda a, b: combine_first(a, b, key), frames)


def common_samples(tables: list[DataFrame], key: str = "sample_id") -> DataFrame:
    """Samples of every table; an empty result is left to the caller to judge."""
    return reduce(lambda a, b: a.intersect(b), [t.select(key) for t in tables])


def align(genotyped: DataFrame, phenotypes: DataFrame, covariates: DataFrame, key: str = "sample_id") -> DataFrame:
    """Samples that all three have, with phenotypes and covariates; genotyped gives order by its `ord`."""
    return genotyped.join(phenotypes, key).join(covariates, key)


def drop_missing(df: DataFrame, columns: list[str], strategy: str) -> DataFrame:
    """`complete_samples` keeps rows with all values, `listwise_deletion` rows with any (the historical meaning)."""
    return df.dropna(how={"complete_samples": "any", "listwise_deletion": "all"}[strategy], subset=columns)


def with_intercept(df: DataFrame, covariates: list[str]) -> DataFrame:
    """A column of ones in front, unless the first covariate is one everywhere."""
    first = df.agg(F.bool_and(F.abs(F.col(covariates[0]) - 1) < 1e-8)).head()[0] if covariates else False
    return df if first else df.withColumn("intercept", F.lit(1.0))


def column_spread(df: DataFrame, columns: list[str]) -> DataFrame:
    """variable, n, variance (population) and constant, a row for each column, from one scan."""
    aggs = [a for c in columns for a in (F.count(c).alias(f"n_{c}"), F.var_pop(c).alias(f"v_{c}"))]
    one = df.agg(*aggs)
    rows = F.array(*(F.struct(F.lit(c).alias("variable"), F.col(f"n_{c}").alias("n"), F.col(f"v_{c}").alias("variance")) for c in columns))
    out = one.select(F.explode(rows).alias("r")).select("r.*")
    return out.withColumn("constant", F.abs("variance") <= 1e-8)


def drop_constant(df: DataFrame, covariates: list[str], keep_first: bool = True) -> DataFrame:
    """Without covariates of zero variance; the first one (the intercept) stays."""
    gone = {r.variable for r in column_spread(df, covariates).where("constant").collect()}
    if keep_first and covariates:
        gone.discard(covariates[0])
    return df.drop(*gone)


def missing_patterns(long: DataFrame) -> DataFrame:
    """variable, pattern: variables with values for the same samples share a pattern.

    The pattern is a pair of order-free 64-bit sums and the count of the samples that are there; it needs no list
    of samples in any row.
    """
    h = F.xxhash64("sample_id")
    lanes = [F.sum(F.pmod(F.xxhash64(h, F.lit(i)), F.lit(1 << 40))) for i in (1, 2)]
    per = long.where("value is not null").groupBy("variable").agg(F.count("*").alias("n"), lanes[0].alias("a"), lanes[1].alias("b"))
    return per.select("variable", "n", F.concat_ws("-", F.col("n").cast("string"), F.hex("a"), F.hex("b")).alias("pattern"))


def pattern_groups(long: DataFrame) -> DataFrame:
    """n (samples), variables (sorted): one row for each pattern; patterns without a sample do not exist."""
    return missing_patterns(long).groupBy("pattern", "n").agg(F.sort_array(F.collect_list("variable")).alias("variables")).drop("pattern")


def covariance(long: DataFrame, rows: int = 4096) -> DataFrame:
    """a, b, n, covariance: over the samples with both, about each variable's own mean, divided by n - 1.

    This is the covariance of masked arrays, not that of the common samples' means. Each sample's values become one row of
    pairs (variable, deviation); tasks add up cross products of masked blocks of samples, and the blocks are added in a
    tree, so that no row is made for a pair of values. A block has (variables by variables) elements.
    """
    spark = long.sparkSession
    known = long.where("value is not null")
    means = {r.variable: float(r["mean"]) for r in known.groupBy("variable").agg(F.avg("value").alias("mean")).collect()}  # one a variable: the matrix has as many columns
    names = sorted(means)
    place = {v: i for i, v in enumerate(names)}
    shared = spark.sparkContext.broadcast((place, np.array([means[v] for v in names])))
    by_sample = known.groupBy("sample_id").agg(F.collect_list("variable").alias("names"), F.collect_list(F.col("value").cast("double")).alias("values"))

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, mean = shared.value
        size = len(mean)
        sums, counts = np.zeros((size, size)), np.zeros((size, size))
        for b in batches:
            for part in (b.slice(i, rows) for i in range(0, b.num_rows, rows)):
                lists = part.column(0)
                row = np.repeat(np.arange(part.num_rows), lists.value_lengths().to_numpy(zero_copy_only=False))
                col = np.fromiter((place[v] for v in lists.flatten().to_pylist()), np.int64, len(row))
                x, m = np.zeros((part.num_rows, size)), np.zeros((part.num_rows, size))
                x[row, col] = part.column(1).flatten().to_numpy(zero_copy_only=False) - mean[col]
                m[row, col] = 1.0
                sums += x.T @ x
                counts += m.T @ m
        yield blocks.batch({"key": 0}, np.stack([sums, counts]))

    if not names:
        return spark.createDataFrame([], "a string, b string, n long, covariance double")
    total = blocks.add_up(by_sample.select("names", "values").mapInArrow(partial, f"key int, {blocks.SCHEMA}"), ["key"])

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for sums, counts in (blocks.array(x).reshape(2, len(names), len(names)) for x in b.column(0).to_pylist()):
                i, j = np.nonzero(np.triu(counts > 0))
                n = counts[i, j]
                value = np.divide(sums[i, j], n - 1, out=np.zeros(len(n)), where=n > 1)
                pick = pa.array(names)
                yield pa.RecordBatch.from_arrays([pick.take(pa.array(i)), pick.take(pa.array(j)), pa.array(n.astype(np.int64)), pa.array(value, mask=n <= 1)], names=["a", "b", "n", "covariance"])

    return total.select("block").mapInArrow(pairs, "a string, b string, n long, covariance double")


def correlation(cov: DataFrame) -> DataFrame:
    """a, b, correlation from covariance()."""
    d = cov.where("a = b").select(F.col("a").alias("v"), F.sqrt("covariance").alias("sd"))
    both = cov.join(F.broadcast(d.toDF("a", "sa")), "a").join(F.broadcast(d.toDF("b", "sb")), "b")
    return both.select("a", "b", F.try_divide("covariance", F.col("sa") * F.col("sb")).alias("correlation"))


def quantiles(long: DataFrame, shares: tuple[float, ...], *keys: str, value: str = "value") -> DataFrame:
    """keys, n and q0, q1, …: exact quantiles by linear interpolation, for groups of any size.

    Values are sorted once, over all tasks, and a group's quantiles are the values at its ranks: no group meets in one
    task, and a frequent value is spread like any other.
    """
    known = long.where(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("_x"))
    order = lineage.ranked(known.withColumn("_tie", F.monotonically_increasing_id()), *keys, "_x", "_tie", name="_rank")
    groups = lineage.written(order.groupBy(*keys).agg(F.min("_rank").alias("_first"), F.count("*").alias("n")), "groups")
    place = [F.lit(p) * (F.col("n") - 1) for p in shares]
    wanted = F.array_distinct(F.array(*(x for p in place for x in (F.floor(p), F.ceil(p)))))
    groups = groups.withColumn("_at", wanted)
    side = F.broadcast(groups) if groups.count() <= BROADCAST_GROUPS else groups.hint("merge")
    if keys:
        same = reduce(lambda a, b: a & b, (F.col(f"o.{k}").eqNullSafe(F.col(f"g.{k}")) for k in keys))
    else:
        same = F.lit(True)
    found = order.alias("o").join(side.alias("g"), same & F.array_contains("_at", F.col("_rank") - F.col("_first")))
    found = found.select(*(F.col(f"g.{k}").alias(k) for k in keys), "n", (F.col("_rank") - F.col("_first")).alias("_k"), "_x")
    at = lambda k: F.max(F.when(F.col("_k") == k, F.col("_x")))
    cells = [x for i, p in enumerate(place) for x in (at(F.floor(p)).alias(f"_lo{i}"), at(F.ceil(p)).alias(f"_hi{i}"))]
    out = found.groupBy(*keys, "n").agg(*cells)
    between = [(F.col(f"_lo{i}") + (p - F.floor(p)) * (F.col(f"_hi{i}") - F.col(f"_lo{i}"))).alias(f"q{i}") for i, p in enumerate(place)]
    return out.select(*keys, "n", *between)


def summaries(long: DataFrame, *keys: str) -> DataFrame:
    """keys, n, the five quantiles, mean and variance of value; for groups of any size."""
    q = quantiles(long, stats.QUARTILES, *keys)
    q = q.select(*(F.col(k).alias(f"_{k}") for k in keys), *(F.col(f"q{i}").alias(c) for i, c in enumerate(stats.SUMMARY)))
    all_ = long.groupBy(*keys).agg(F.count("value").alias("n"), *stats.moments(F.col("value")))
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    return all_.join(q, same, "left").select(*keys, "n", *stats.SUMMARY, "mean", "variance")


def lambda_gc(chi2: DataFrame, value: str = "chi2") -> DataFrame:
    """lambda_gc: the median over that of the chi-squared distribution."""
    return quantiles(chi2, (0.5,), value=value).select((F.col("q0") / stats.CHI2_MEDIAN).alias("lambda_gc"))
