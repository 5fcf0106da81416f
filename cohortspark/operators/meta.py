"""Fixed-effect meta-analysis over studies, quality filters and the merge of many result tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortspark import lineage
from cohortspark.functions import genetics as G

from .variables import quantiles


def study_filter(scores: DataFrame, maf: Column, r2: Column, n: Column, minor_alleles: float = 5.0, r2_cutoff: float = 0.6) -> DataFrame:
    """Variants with enough minor alleles (MAF at least minor_alleles / 2n) and quality, and a score that is not 0."""
    enough = maf >= F.lit(minor_alleles) / (2 * n)
    return scores.where(enough & (r2 >= r2_cutoff) & F.col("u").isNotNull() & ~G.is_close(F.col("u"), 0.0))


def align_alleles(rows: DataFrame) -> DataFrame:
    """Brings rows (ref, alt, effect, freq) to one orientation of each marker: alleles in order, the effect turned with them."""
    swap = F.col("ref") > F.col("alt")
    return rows.select(
        *(c for c in rows.columns if c not in ("ref", "alt", "effect", "freq")),
        F.lower(F.least("ref", "alt")).alias("allele1"),
        F.lower(F.greatest("ref", "alt")).alias("allele2"),
        F.when(swap, -F.col("effect")).otherwise(F.col("effect")).alias("effect"),
        F.when(swap, 1 - F.col("freq")).otherwise(F.col("freq")).alias("freq"),
    )


def fixed_effect(rows: DataFrame, keys: list[str], studies: list[str]) -> DataFrame:
    """Inverse-variance meta-analysis of rows (keys, study, effect, std_err, freq, n), at most one a marker and study.

    Weights 1 / se**2; heterogeneity Q from sums of w, wb and wb**2, so that all is one map-side combined aggregation.
    Frequencies are weighted by n. The direction has a character for each of `studies` in their order: + - 0, ? for none.
    """
    w, b = F.pow("std_err", F.lit(-2.0)), F.col("effect")
    sign = F.when(b > 0, "+").when(b < 0, "-").otherwise("0")
    marks = [F.coalesce(F.max(F.when(F.col("study") == s, sign)), F.lit("?")).alias(f"_d{i}") for i, s in enumerate(studies)]
    sums = rows.groupBy(*keys).agg(
        F.sum(w).alias("_w"), F.sum(w * b).alias("_wb"), F.sum(w * b * b).alias("_wbb"), F.count("*").alias("_k"),
        F.sum(F.col("n") * F.col("freq")).alias("_nf"), F.sum(F.col("n") * F.col("freq") * F.col("freq")).alias("_nff"),
        F.min("freq").alias("min_freq"), F.max("freq").alias("max_freq"), F.sum("n").alias("sample_count"), *marks,
    )
    out = sums.withColumns({"effect": F.try_divide("_wb", "_w"), "std_err": F.when(F.col("_w") > 0, F.pow("_w", F.lit(-0.5))), "freq1": F.try_divide("_nf", "sample_count")})
    q = F.greatest(F.col("_wbb") - F.col("_wb") * F.col("effect"), F.lit(0.0))
    out = out.withColumns({"het_chisq": q, "het_df": F.col("_k") - 1, "chi2": F.pow(F.col("effect") / F.col("std_err"), F.lit(2.0))})
    i2 = F.when(F.col("het_chisq") > 0, F.greatest(F.lit(0.0), (F.col("het_chisq") - F.col("het_df")) / F.col("het_chisq")) * 100).otherwise(0.0)
    spread = F.sqrt(F.greatest(F.try_divide("_nff", "sample_count") - F.col("freq1") * F.col("freq1"), F.lit(0.0)))
    direction = F.concat(*(F.col(f"_d{i}") for i in range(len(studies))))
    return out.select(*keys, "freq1", spread.alias("freq_se"), "min_freq", "max_freq", "effect", "std_err", "chi2", direction.alias("direction"), i2.alias("het_isq"), "het_chisq", "het_df", "sample_count")


def quality_filter(meta: DataFrame, present_only: bool = False) -> DataFrame:
    """Markers seen in over half of the largest sample and in more than one input, without ambiguous ones across 0.5.

    `present_only` counts the studies that have the marker instead of all inputs.
    """
    most = meta.agg((F.max("sample_count") * 0.5).alias("_half"))
    studies = G.studies_present(F.col("direction")) if present_only else F.length("direction")
    unclear = G.strand_ambiguous(F.col("allele1"), F.col("allele2")) & (F.col("min_freq") <= 0.5) & (F.col("max_freq") >= 0.5)
    return meta.crossJoin(F.broadcast(most)).where((F.col("sample_count") > F.col("_half")) & (studies > 1) & ~unclear).drop("_half")


def legend_join(meta: DataFrame, legends: DataFrame, population: str, fallback: str | None = None) -> DataFrame:
    """Adds rsid and the panel's frequency by marker; a panel lacks many markers, which stay."""
    column = population if population in legends.columns else fallback
    return meta.join(legends.select("marker_name", "rsid", F.col(f"`{column}`").alias("panel_freq")), "marker_name", "left")


def panel_frequency(rows: DataFrame) -> DataFrame:
    """Turns freq1 to the panel's alternate allele; rows that fit in neither or both ways raise."""
    same = (F.upper("allele1") == F.upper("a1")) & (F.upper("allele2") == F.upper("a0"))
    swapped = (F.upper("allele1") == F.upper("a0")) & (F.upper("allele2") == F.upper("a1"))
    freq = F.when(same == swapped, F.raise_error(F.lit("alleles do not fit the panel")).cast("double")).when(swapped, 1 - F.col("freq1")).otherwise(F.col("freq1"))
    return rows.withColumn("freq", freq)


def merge_tables(tables: dict[str, DataFrame], keys: list[str], columns: list[str]) -> DataFrame:
    """Full outer merge of any number of tables: union and one aggregation, {name}_{column} for each table."""
    parts = None
    for name, df in tables.items():
        part = df.select(*keys, F.lit(name).alias("_t"), *columns)
        parts = part if parts is None else parts.unionByName(part)
    values = [F.max(F.when(F.col("_t") == name, F.col(c))).alias(f"{name}_{c}") for name in tables for c in columns]
    return parts.groupBy(*keys).agg(*values)


def qq_points(p: DataFrame, value: str = "chi2") -> DataFrame:
    """rank, expected and observed, largest first: expected is the quantile (rank - 0.5) / n of the uniform law."""
    known = p.where(F.col(value).isNotNull()).select(F.col(value).alias("observed"), F.monotonically_increasing_id().alias("_tie"))
    order = lineage.ranked(known, F.desc("observed"), "_tie", name="_rank")
    n = order.agg(F.count("*").alias("_n"))
    rank = (F.col("_rank") + 1).cast("bigint")
    return order.crossJoin(F.broadcast(n)).select(rank.alias("rank"), ((rank - 0.5) / F.col("_n")).alias("expected"), "observed")  # n is one row


def se_n(rows: DataFrame, *keys: str) -> DataFrame:
    """keys, n and se (the median standard error) of rows (keys, std_err): the points of the sample-size check."""
    q = quantiles(rows, (0.5,), *keys, value="std_err")
    return q.select(*keys, "n", F.col("q0").alias("se"))


def se_n_fit(points: DataFrame) -> DataFrame:
    """slope and intercept of 1 / se on the root of n, over points with both."""
    x, y = F.sqrt("n"), 1 / F.col("se")
    return points.where("n > 0 and se > 0").agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"))


def study_boxes(per_study: DataFrame, statistic: str, counts: DataFrame) -> DataFrame:
    """study, sample_count and the five quantiles of a statistic, studies with fewer samples first: a forest plot's data."""
    own = per_study.where(F.col("statistic") == statistic).join(counts, "study")
    return own.select("study", "sample_count", "minimum", "lower_quartile", "median", "upper_quartile", "maximum").orderBy("sample_count", "study")


def frequency_pairs(rows: DataFrame) -> DataFrame:
    """study, panel and own frequency of markers (study, freq1, allele1, allele2, a0, a1, panel_freq), turned to the panel's alleles."""
    return panel_frequency(rows.where("panel_freq is not null")).select("study", F.col("panel_freq"), F.col("freq"))
