"""Expressions on small facts."""

import math

import numpy as np
from pyspark.sql import functions as F

from cohortspark.functions import genetics as G
from cohortspark.functions import stats
from cohortspark.functions import tags as T
from cohortspark.operators import index


def test_variant_mask(spark):
    """A frequency a rounding error below the cutoff passes, a NULL frequency never does, a NULL quality always."""
    rows = [("none", None, 0.9), ("rare", 0.02, 0.9), ("just", 0.05 - 1e-12, 0.9), ("folded", 0.96, 0.9), ("common", 0.4, None), ("poor", 0.4, 0.3)]
    df = spark.createDataFrame(rows, "name string, af double, r2 double")
    kept = df.where(G.variant_mask([F.col("af")], F.col("r2"), 0.05, 0.5))
    assert {r.name for r in kept.collect()} == {"just", "common"}
    close = df.where(G.greater_or_close(F.col("af"), 0.05))
    assert {r.name for r in close.collect()} == {"just", "folded", "common", "poor"}
    assert df.where(G.variant_mask([F.col("af")], F.col("r2"), float("-inf"), float("-inf"))).count() == 5


def test_chromosomes(spark):
    names = ["7", "x", "NC_000003.12", "scaffold9"]
    df = spark.createDataFrame([(n,) for n in names], "c string").select("c", G.chromosome_to_int(F.col("c")).alias("n"))
    assert {r.c: r.n for r in df.collect()} == {"7": 7, "x": 23, "NC_000003.12": 3, "scaffold9": None}
    key = spark.range(1).select(G.marker_key(F.lit("X:77:C:T")).alias("x"), G.marker_key(F.lit("4:901:G:GA")).alias("n")).head()
    assert key.x == "X:000000000077:C:T"
    assert key.n == "04:000000000901:G:GA"


def test_threshold_segments(spark):
    rows = G.threshold_segments(spark).collect()
    assert len(rows) == 46
    first = next(r for r in rows if r.chromosome == 1 and r.line == "genome_wide")
    gap = sum(G.HG19_LENGTHS) / 500
    assert math.isclose(first.height, 8)
    assert math.isclose(first.x_start, gap)
    assert math.isclose(first.x_end, G.HG19_LENGTHS[0] - gap)


def test_chi2_tail():
    assert math.isclose(stats.chi2_sf(2.5, 1).item(), math.erfc(math.sqrt(1.25)), rel_tol=1e-13)
    # with two degrees of freedom the tail is exp(-x / 2), with four exp(-x / 2) (1 + x / 2)
    x = np.array([1e-9, 0.3, 1.0, 2.9, 3.1, 10.0, 80.0, 700.0, 1400.0])
    assert np.allclose(stats.chi2_sf(x, 2), np.exp(-x / 2), rtol=1e-12, atol=0)
    assert np.allclose(stats.chi2_sf(x, 4), np.exp(-x / 2) * (1 + x / 2), rtol=1e-12, atol=0)
    odd = stats.chi2_sf(np.array([np.nan, -1.0, 0.0, 5.0, 1e6]), np.array([1, 3, 3, 0, 3]))
    assert np.isnan(odd[[0, 3]]).all()
    assert odd[[1, 2, 4]].tolist() == [1.0, 1.0, 0.0]
    p, log = stats.p_of(np.array([0.0, 4.0, 1330.0, 5000.0, np.nan]))
    assert p[:2].tolist() == [1.0, math.erfc(math.sqrt(2))]
    # the asymptotic branch meets the direct one
    assert abs(log[2] - math.log10(math.erfc(math.sqrt(665)))) < 1e-4
    assert log[3] < -1000
    assert np.isnan(p[4])
    assert np.isnan(log[4])


def test_tails_as_columns(spark):
    df = spark.createDataFrame([(1.0, 1), (None, 1), (3.0, None), (-0.0, 2)], "x double, k int")
    got = df.select(stats.p_value("x").alias("p"), stats.chi2_tail("x", "k").alias("t")).collect()
    assert math.isclose(got[0].p.p, math.erfc(math.sqrt(0.5)))
    assert math.isclose(got[0].p.log10_p, math.log10(got[0].p.p))
    assert (got[1].p.p, got[1].p.log10_p, got[1].t, got[2].t, got[3].t) == (None, None, None, None, 1.0)


def test_tags(spark):
    """Pieces without a hyphen belong to the key after them, or, at the end, are the suffix."""
    names = ["lab-07_mean_speed-fast_arm-left_raw_copy", "lab-12_site-north_phase-2_map"]
    df = spark.createDataFrame([(n,) for n in names], "name string").select("name", T.parse(F.col("name")).alias("t"))
    got = {r.name: dict(r.t) for r in df.collect()}
    assert got[names[0]] == {"lab": "07", "mean_speed": "fast", "arm": "left", "suffix": "raw_copy"}
    assert got[names[1]] == {"lab": "12", "site": "north", "phase": "2", "suffix": "map"}
    assert {r.f for r in df.select(T.format_tags(F.col("t")).alias("f")).collect()} == set(names)


def test_alternatives(spark):
    """Phenotypes of one class answer for the union of classes, unless the study has the union itself."""
    names = [("w", "ds-1_arm-left_site-n"), ("x", "ds-2_arm-right_site-s"), ("y", "ds-3_arm-any_site-any"), ("z", "ds-4_arm-left_site-any")]
    tag = index.build(spark.createDataFrame(names, "phenotype string, name string"))
    for key, value in (("arm", "left"), ("arm", "right"), ("site", "n"), ("site", "s")):
        tag = tag.unionByName(index.alternative(tag, key, value, "any"))
    assert sorted(r.phenotype for r in index.query(tag, arm="any", site="any").collect()) == ["w", "x", "y", "z"]
    assert index.query(tag, lab="0*").count() == 0
    assert {r.phenotype for r in index.query(tag, suffix=None).collect()} == set("wxyz")


def test_empty_summary(spark):
    df = spark.createDataFrame([(1, 4.0), (2, None)], "k int, x double").groupBy("k").agg(*stats.summary(F.col("x"))).orderBy("k").collect()
    assert df[0].variance == 0.0
    assert df[1].variance is None
    q = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (10.0,)], "x double").agg(*stats.summary(F.col("x"))).head()
    assert (q.minimum, q.lower_quartile, q.median, q.upper_quartile, q.maximum) == (1, 1.75, 3, 5.5, 10)
