"""Seeded cohorts for tests and demonstrations, made in parallel."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _uniform(seed: int, *columns: str) -> F.Column:
    """Uniform on [0, 1) that depends on the seed and the columns only, not on the partitioning."""
    return F.pmod(F.xxhash64(F.lit(seed), *columns), F.lit(1 << 52)) / float(1 << 52)


def genotypes(spark: SparkSession, variants: int, samples: int, chromosomes: int = 22, seed: int = 1337) -> DataFrame:
    """chromosome, position, ref, alt, r2, dosages of variants in equilibrium, frequencies from 0.05 to 0.5."""
    v = spark.range(variants).withColumn("p", 0.05 + 0.45 * _uniform(seed, "id"))
    alleles = lambda k: (F.pmod(F.xxhash64(F.lit(seed + k), F.col("id"), F.col("i")), F.lit(1 << 52)) / float(1 << 52) < F.col("p")).cast("double")
    cells = v.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(samples - 1)))).select("id", "p", "i", (alleles(1) + alleles(2)).alias("d"))
    rows = cells.groupBy("id").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "d"))), lambda c: c["d"]).alias("dosages"))
    return rows.select((F.col("id") % chromosomes + 1).cast("smallint").alias("chromosome"), (F.expr(f"id div {chromosomes}") * 100 + 1).alias("position"), F.lit("A").alias("ref"), F.lit("G").alias("alt"), F.lit(0.9).alias("r2"), "dosages")


def traits(genotype: DataFrame, phenotypes: int = 6, causal: int = 1000, heritability: float = 0.6, seed: int = 1337) -> DataFrame:
    """sample, variable, value: sums of effects of `causal` variants and noise with the given share of variance."""
    order = F.xxhash64(F.lit(seed), "chromosome", "position")
    chosen = genotype.orderBy(order).limit(causal)
    cells = chosen.select("chromosome", "position", F.posexplode("dosages").alias("sample", "d"))
    cells = cells.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(phenotypes - 1))))
    effect = _uniform(seed + 5, "chromosome", "position", "k") - 0.5
    genetic = cells.groupBy("sample", "k").agg(F.sum(effect * F.col("d")).alias("g"))
    spread = genetic.groupBy("k").agg(F.avg("g").alias("m"), F.stddev_pop("g").alias("s"))
    pi = 3.141592653589793
    noise = F.sqrt(-2 * F.log(1 - _uniform(seed + 7, "sample", "k"))) * F.cos(2 * pi * _uniform(seed + 8, "sample", "k"))
    value = heritability**0.5 * (F.col("g") - F.col("m")) / F.col("s") + (1 - heritability) ** 0.5 * noise
    return genetic.join(F.broadcast(spread), "k").select("sample", F.concat(F.lit("phenotype-"), F.col("k").cast("string")).alias("variable"), value.alias("value"))


def with_missing(values: DataFrame, patterns: int = 3, rate: float = 0.05, seed: int = 1337) -> DataFrame:
    """Removes values by patterns: each variable has one of `patterns` patterns, which lacks `rate` of the samples."""
    pattern = F.pmod(F.xxhash64(F.lit(seed), "variable"), F.lit(patterns))
    with_pattern = values.withColumn("_p", pattern)
    return with_pattern.where(_uniform(seed + 9, "_p", "sample") >= rate).drop("_p")
