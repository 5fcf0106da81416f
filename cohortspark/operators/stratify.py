"""Stratification of cohorts: ancestry by principal components, ranges, class products, masked phenotypes."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Reference populations and their super-populations.
SUPER_POPULATIONS = {"ASW": "AFR", "LWK": "AFR", "MKK": "AFR", "YRI": "AFR", "CEU": "EUR", "TSI": "EUR", "CHB": "EAS", "CHD": "EAS", "JPT": "EAS", "GIH": "SAS", "MEX": "AMR"}


def sample_name(fid: Column, iid: Column, mode: str) -> Column:
    """The four ways to write a sample's id."""
    return {"both_with_underscore": F.concat_ws("_", fid, iid), "double_iid": F.concat_ws("_", iid, iid), "iid": iid, "fid": fid}[mode]


def rename(sample: Column, replacements: list[tuple[str, str]] = (), ignore_case: bool = False, alphanumeric: bool = False) -> Column:
    """Trims, replaces patterns in order, and optionally lowers case and drops all but letters and digits."""
    out = F.trim(sample)
    for pattern, new in replacements:
        out = F.regexp_replace(out, pattern, new)
    if ignore_case:
        out = F.lower(out)
    return F.regexp_replace(out, r"[^\p{L}\p{N}]", "") if alphanumeric else out


def match_samples(wanted: DataFrame, panel: DataFrame) -> DataFrame:
    """wanted (sample) with the panel's fid and iid: by iid if that fits, else by fid_iid; NULL where none does."""
    by_iid = panel.select(F.col("iid").alias("_k"), F.struct("fid", "iid").alias("_a"))
    by_both = panel.select(F.concat_ws("_", "fid", "iid").alias("_k"), F.struct("fid", "iid").alias("_b"))
    out = wanted.join(by_iid, wanted["sample"] == F.col("_k"), "left").drop("_k").join(by_both, wanted["sample"] == F.col("_k"), "left").drop("_k")
    found = F.coalesce("_a", "_b")
    return out.select(*wanted.columns, found["fid"].alias("fid"), found["iid"].alias("iid"))


def range_classes(df: DataFrame, value: str, ranges: list[tuple[str, float, float]], *keep: str) -> DataFrame:
    """A row (keep, class) for every range low <= value < high that holds the value; ranges may overlap."""
    tests = F.array(*(F.when((F.col(value) >= lo) & (F.col(value) < hi), F.lit(name)) for name, lo, hi in ranges))
    return df.select(*keep, F.explode(F.array_compact(tests)).alias("class"))


def prune(classes: DataFrame, minimum: int, variable: str = "variable") -> DataFrame:
    """Only classes with at least minimum samples."""
    big = classes.groupBy(variable, "class").agg(F.countDistinct("sample").alias("_n")).where(F.col("_n") >= minimum).select(variable, "class")
    return classes.join(big, [variable, "class"], "left_semi")


def with_mixed(classes: DataFrame, variable: str = "variable") -> DataFrame:
    """Adds the class `mixed`, the union of all, for variables with more than one class."""
    several = classes.groupBy(variable).agg(F.countDistinct("class").alias("_n")).where("_n > 1").select(variable)
    return classes.unionByName(classes.join(several, variable, "left_semi").withColumn("class", F.lit("mixed")).distinct())


def class_products(classes: DataFrame, variables: list[str], minimum: int) -> DataFrame:
    """A row (one column a variable, n) for each combination of classes with enough samples in all of them."""
    out = None
    for v in variables:
        own = classes.where(F.col("variable") == v).select("sample", F.col("class").alias(v))
        out = own if out is None else out.join(own, "sample")
    return out.groupBy(*variables).agg(F.countDistinct("sample").alias("n")).where(F.col("n") >= minimum)


def masked(phenotypes: DataFrame, classes: DataFrame, name: str, members: DataFrame, columns: list[str]) -> DataFrame:
    """Copies of the columns as {name}_{column} that are NULL for samples that are no members."""
    inside = members.select("sample").distinct().withColumn("_in", F.lit(True))
    return phenotypes.join(inside, "sample", "left").select(*phenotypes.columns, *(F.when(F.col("_in"), F.col(c)).alias(f"{name}_{c}") for c in columns))


def membership(samples: DataFrame, reference: DataFrame, components: list[str], deviations: float = 6.0) -> DataFrame:
    """sample, population: members by the normal density of each reference population.

    A sample is a member if its multivariate log density exceeds that of a standard normal value `deviations` from
    the mean (the historical cutoff). Means and covariances of each population are one aggregation; the few numbers
    of each population are inverted on the driver and become expressions.
    """
    import numpy as np

    k = len(components)
    aggs = [F.avg(c).alias(f"m{i}") for i, c in enumerate(components)]
    aggs += [F.covar_samp(components[i], components[j]).alias(f"c{i}_{j}") for i in range(k) for j in range(i, k)]
    cutoff = -0.5 * deviations**2 - 0.5 * math.log(2 * math.pi)
    tests = []
    for r in reference.groupBy("population").agg(*aggs).orderBy("population").collect():
        cov = np.array([[r[f"c{min(i, j)}_{max(i, j)}"] for j in range(k)] for i in range(k)], float)
        sign, logdet = np.linalg.slogdet(cov) if np.isfinite(cov).all() else (0.0, 0.0)
        if sign <= 0:
            raise ValueError(f"the components of population {r.population} have no covariance of full rank")
        inverse = np.linalg.inv(cov)
        d = [F.col(c) - F.lit(r[f"m{i}"]) for i, c in enumerate(components)]
        distance = sum((d[i] * d[j] * float(inverse[i, j]) for i in range(k) for j in range(k)), F.lit(0.0))
        density = -0.5 * (distance + logdet + k * math.log(2 * math.pi))
        tests.append(F.when(density > cutoff, F.lit(r.population)))
    return samples.select("sample", F.explode(F.array_compact(F.array(*tests))).alias("population"))
