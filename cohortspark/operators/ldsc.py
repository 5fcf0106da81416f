"""Heritability by regression of association chi-squared on LD scores, with a block jackknife.

Weighted least squares needs five sums; they are kept by block of neighbouring SNPs, so that leaving a block out is a
subtraction. One aggregation over the SNPs, the rest over the blocks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SUMS = ("w", "x", "y", "xx", "xy")


def blocks(snps: DataFrame, count: int) -> DataFrame:
    """snps (chromosome, position, …) with `block`: `count` ranges of about equal numbers, in the genome's order."""
    place = F.col("chromosome").cast("bigint") * 1_000_000_000 + F.col("position")
    cut = snps.agg(F.percentile_approx(place, [(i + 1) / count for i in range(max(1, count - 1))], 100_000).alias("_cuts"))
    return snps.crossJoin(F.broadcast(cut)).withColumn("block", F.size(F.filter("_cuts", lambda c: c < place))).drop("_cuts")


def block_sums(snps: DataFrame, *keys: str) -> DataFrame:
    """keys, block and the sums of snps (block, chi2, ld, weight)."""
    w, x, y = F.col("weight"), F.col("ld"), F.col("chi2")
    return snps.groupBy(*keys, "block").agg(F.sum(w).alias("w"), F.sum(w * x).alias("x"), F.sum(w * y).alias("y"), F.sum(w * x * x).alias("xx"), F.sum(w * x * y).alias("xy"), F.count("*").alias("m"))


def _slope(s: dict[str, Column]) -> Column:
    return F.try_divide(s["w"] * s["xy"] - s["x"] * s["y"], s["w"] * s["xx"] - s["x"] * s["x"])


def regression(sums: DataFrame, *keys: str) -> DataFrame:
    """keys, slope, intercept, slope_se (from leaving blocks out), blocks, m."""
    over = Window.partitionBy(*keys)
    all_ = {c: F.sum(c).over(over) for c in SUMS}
    own = sums.select(*keys, "block", "m", *(F.col(c).alias(f"_b{c}") for c in SUMS), *(all_[c].alias(c) for c in SUMS))
    full, rest = {c: F.col(c) for c in SUMS}, {c: F.col(c) - F.col(f"_b{c}") for c in SUMS}
    each = own.select(*keys, "m", _slope(full).alias("slope"), _slope(rest).alias("_left"), *SUMS)
    out = each.groupBy(*keys).agg(
        F.first("slope").alias("slope"), F.first((F.col("y") - F.col("slope") * F.col("x")) / F.col("w")).alias("intercept"),
        F.sqrt((F.count("*") - 1) * F.var_pop("_left")).alias("slope_se"), F.count("*").alias("blocks"), F.sum("m").alias("m"),
    )
    return out


def heritability(regressions: DataFrame, n: Column) -> DataFrame:
    """Adds h2 = slope * m / n and its standard error."""
    return regressions.withColumns({"h2": F.col("slope") * F.col("m") / n, "h2_se": F.col("slope_se") * F.col("m") / n})
