"""Simulated cohorts, LD-score regression, result tables."""

import numpy as np
from pyspark.sql import functions as F

from cohortspark.operators import ldsc, simulate, variables
from cohortspark.sources import results


def test_simulation(spark):
    g = simulate.genotypes(spark, 200, 40, chromosomes=4)
    rows = g.orderBy("chromosome", "position").collect()
    assert len(rows) == 200
    assert {len(r.dosages) for r in rows} == {40}
    assert {d for r in rows for d in r.dosages} == {0.0, 1.0, 2.0}
    again = simulate.genotypes(spark, 200, 40, chromosomes=4).repartition(7).orderBy("chromosome", "position").collect()
    assert rows == again
    t = simulate.with_missing(simulate.traits(g, 6, 50), patterns=3, rate=0.1)
    per = {r.variable: r.n for r in t.groupBy("variable").agg(F.count("*").alias("n")).collect()}
    assert len(per) == 6
    assert min(per.values()) < 40
    groups = variables.pattern_groups(t.select(F.col("sample").alias("sample_id"), "variable", "value"))
    assert groups.count() <= 3


def test_regression(spark):
    rng = np.random.default_rng(1)
    ld = rng.uniform(1, 50, 4000)
    chi2 = (1 + 0.02 * ld) * rng.chisquare(1, 4000)
    df = spark.createDataFrame([(1, int(i), float(a), float(b), 1.0) for i, (a, b) in enumerate(zip(ld, chi2, strict=True))], "chromosome int, position long, ld double, chi2 double, weight double")
    out = ldsc.heritability(ldsc.regression(ldsc.block_sums(ldsc.blocks(df, 50))), F.lit(10_000)).head()
    slope, intercept = np.polyfit(ld, chi2, 1)
    assert np.isclose(out.slope, slope)
    assert np.isclose(out.intercept, intercept)
    assert out.blocks == 50
    assert abs(out.slope - 0.02) < 4 * out.slope_se
    assert np.isclose(out.h2, slope * 4000 / 10_000)


def test_results(spark, tmp_path):
    df = spark.createDataFrame([(1, 2.0), (22, 3.0)], "chromosome int, u double")
    results.write_scores(df, str(tmp_path / "s"))
    assert spark.read.parquet(str(tmp_path / "s")).where("chromosome = 22").count() == 1
    for state in ("pending", "score_complete"):
        results.record_state(spark, str(tmp_path / "t"), "chunk-0", "all", state)
    assert results.states(spark, str(tmp_path / "t")).head().state == "score_complete"
    calls = []
    for _ in range(2):
        key = results.digest({"maf": 0.05}, [str(tmp_path / "s")], spark)
        results.cached(spark, str(tmp_path / "c"), "x", key, lambda: calls.append(1) or df)
    assert len(calls) == 1
    assert results.digest({"maf": 0.01}) != results.digest({"maf": 0.05})
    results.write_once(df, str(tmp_path / "o"))
    results.write_once(df.limit(0), str(tmp_path / "o"))
    assert spark.read.parquet(str(tmp_path / "o")).count() == 2
    results.append_estimates(df, str(tmp_path / "e"))
    results.append_estimates(df, str(tmp_path / "e"))
    assert spark.read.parquet(str(tmp_path / "e")).count() == 4
    results.write_jobs(df.withColumn("k", F.lit("v")), str(tmp_path / "j"), ["k"])
    assert spark.read.json(str(tmp_path / "j")).count() == 2
