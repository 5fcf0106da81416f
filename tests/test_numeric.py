"""Block numerics against numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortspark.operators import association, hdl, meta, nullmodel, optim, variables


@pytest.fixture(scope="module")
def cohort():
    rng = np.random.default_rng(3)
    g = rng.binomial(2, 0.3, (300, 20)).astype(float) + rng.uniform(-0.05, 0.05, (300, 20))
    return np.clip(g, 0, 2), rng.integers(1, 5, 300)


@pytest.fixture(scope="module")
def variants(spark, cohort):
    g, c = cohort
    return spark.createDataFrame([(i, int(k), x.tolist()) for i, (x, k) in enumerate(zip(g, c, strict=True))], "id int, chromosome long, dosages array<double>").repartition(3)


def matrices(df, key="chromosome"):
    out = {}
    for r in df.orderBy(key, "i").collect():
        out.setdefault(r[key], []).append(r["values"])
    return {k: np.array(v) for k, v in out.items()}


def test_gram_and_leave_one_out(variants, cohort):
    g, c = cohort
    z = association.standardise(g)
    grams = association.gram(variants)
    own = matrices(grams)
    for k, m in own.items():
        assert np.allclose(m, z[c == k].T @ z[c == k])
    rest = matrices(association.leave_one_out(grams))
    for k, m in rest.items():
        assert np.allclose(m, z[c != k].T @ z[c != k])
    for k, r in matrices(association.triangular(variants)).items():
        assert np.allclose(r.T @ r, own[k])


def test_constant_variant_raises():
    with pytest.raises(ValueError):
        association.standardise(np.zeros((1, 5)))


def test_score_equals_rotation(variants, cohort):
    g, _ = cohort
    rng = np.random.default_rng(4)
    z = association.standardise(g)
    lam, q = nullmodel.eigen(z.T @ z / len(z) + 0.01 * np.eye(20))
    x = np.column_stack([np.ones(20), rng.normal(size=20)])
    y = rng.normal(size=(20, 2))
    fits = [nullmodel.fit("fastlmm", lam, q.T @ x, q.T @ y[:, j]) for j in range(2)]
    r, v = (np.array([f[c] for f in fits]).T for c in ("residuals", "variance"))
    got = association.score_block(variants, nullmodel.score_weights(q, r, v), q, v, ["a", "b"], ["id"]).orderBy("id", "phenotype").collect()
    rotated = q.T @ (g - g.mean(1, keepdims=True)).T
    u, var = rotated.T @ (r / np.sqrt(v)), (rotated**2).T @ (1 / v)
    assert np.allclose([x.u for x in got], u.ravel())
    assert np.allclose([x.v for x in got], var.ravel())


def test_scores_come_in_bounded_batches():
    """Many phenotypes times many variants: no batch of scores grows with either, and none is lost."""
    import pyarrow as pa

    rng = np.random.default_rng(41)
    g, w, q, v = rng.uniform(0, 2, (700, 6)), rng.normal(size=(6, 1100)), rng.normal(size=(6, 6)), rng.uniform(1, 2, (6, 1100))
    names = [str(i) for i in range(1100)]
    batch = pa.RecordBatch.from_arrays([pa.array(np.arange(700)), association.lists(g)], names=["id", "dosages"])
    got = list(association.scored(iter([batch]), {"c": (np.arange(6), w, q, 1 / v, names)}, ["id"], "dosages"))
    assert max(b.num_rows for b in got) <= association.SCORES < 700 * 1100
    table = pa.Table.from_batches(got).to_pandas()
    assert len(table) == 700 * 1100
    centred = g - g.mean(1, keepdims=True)
    at = table.id.to_numpy(), table.phenotype.astype(int).to_numpy()
    for column, of in (("u", centred @ w), ("v", (centred @ q) ** 2 @ (1 / v))):
        m = np.full((700, 1100), np.nan)
        m[at] = table[column]
        assert np.allclose(m, of)


def test_fitted_scores_of_every_pair(spark):
    """Every vector as a phenotype of every vector: a row for each, equal to what the fits give one by one."""
    from cohortspark.plans import catalogue

    small = "/root/testdata/sf0.001"
    y, lam, q, x = catalogue._cohort(spark, small)
    got = catalogue.QUERIES["score_test_fitted"](spark, small)
    assert got.agg(F.count("*"), F.countDistinct("vec_id", "phenotype")).head() == (500 * 500, 500 * 500)
    some = y.where("phenotype in ('3', '77', '410')").toPandas().set_index("phenotype")["y"]
    x[:, 1:] -= x[:, 1:].mean(0)
    for p, own in some.items():
        fit = nullmodel.fit("fastlmm", lam, q.T @ x, q.T @ np.array(own))
        for r in got.where((F.col("phenotype") == p) & F.col("vec_id").isin(*map(int, some.index))).collect():
            z = q.T @ (np.array(some[str(r.vec_id)]) - np.mean(some[str(r.vec_id)]))
            assert np.isclose(r.u, z @ (np.array(fit["residuals"]) / np.sqrt(fit["variance"])), rtol=1e-4, atol=1e-6)
            assert np.isclose(r.v, (z**2 / np.array(fit["variance"])).sum(), rtol=1e-4)


def test_fitted_models_are_handed_on_small(spark, monkeypatch):
    """What every task gets of a fitted model is its weights, not the variances of all elements too; scores are those of
    the whole matrices."""
    import pickle

    from pyspark import SparkContext

    from cohortspark.plans import catalogue, inputs

    small, sent, send = "/root/testdata/sf0.001", [], SparkContext.broadcast
    monkeypatch.setattr(SparkContext, "broadcast", lambda self, value: sent.append(len(pickle.dumps(value))) or send(self, value))
    got = catalogue.QUERIES["score_test_fitted"](spark, small).toPandas()
    assert 500 * 64 * 8 < max(sent) < 500 * 80 * 8
    y, lam, q, x = catalogue._cohort(spark, small)
    fits = nullmodel.fit_all(y, {"all": (lam, q)}, {"all": x}, partitions=8).toPandas().set_index("phenotype").sort_index()
    r, v = (np.array(fits[c].tolist()).T for c in ("residuals", "variance"))
    g = inputs.dosages(spark, small).select("vec_id", "dosages").toPandas().set_index("vec_id").sort_index()
    g = np.array(g["dosages"].tolist())
    g -= g.mean(1, keepdims=True)
    for column, of in (("u", g @ (q @ (r / np.sqrt(v)))), ("v", (g @ q) ** 2 @ (1 / v))):
        assert np.allclose(got.pivot(index="vec_id", columns="phenotype", values=column).to_numpy(), of, rtol=1e-9, atol=1e-9)


def test_null_models_agree_and_recover():
    rng = np.random.default_rng(5)
    n = 400
    lam, q = nullmodel.eigen(np.cov(rng.normal(size=(n, 2 * n))) + 0.01 * np.eye(n))
    lam = lam * np.linspace(0.2, 3, n)[::-1]
    x = np.column_stack([np.ones(n), rng.normal(size=n)])
    y = x @ [1.0, 2.0] + rng.normal(size=n) * np.sqrt(0.6 * lam + 0.4)
    got = {m: nullmodel.fit(m, lam, x, y) for m in nullmodel.METHODS}
    assert abs(got["fastlmm"]["heritability"] - 0.6) < 0.25
    assert np.allclose(got["fastlmm"]["beta"], [1, 2], atol=0.3)
    assert abs(got["pml"]["heritability"] - got["fastlmm"]["heritability"]) < 0.02
    grid = [nullmodel.objective("pml", lam, x, y)(np.array([e, g])) for e in np.linspace(0.05, 1.5, 30) for g in np.linspace(0.05, 1.5, 30)]
    assert -2 * got["pml"]["log_likelihood"] <= min(grid) + 1e-6


def test_many_at_once():
    """The search over all columns finds what the search over one finds."""
    rng = np.random.default_rng(15)
    n = 70
    lam = np.sort(rng.uniform(0, 4, n))[::-1]
    x = np.column_stack([np.ones(n), rng.normal(size=n)])
    scale = np.array([0.05, 1.0, 30.0, 1.0, 2.0])
    y = (x @ rng.normal(size=(2, 5)) + rng.normal(size=(n, 5)) * np.sqrt(np.array([0.0, 0.3, 0.6, 0.9, 5.0]) * lam[:, None] + 0.4)) * scale
    error, genetic, value = nullmodel.fit_fastlmm_many(lam, x, y)
    for j in range(5):
        e, g, v = nullmodel.fit_fastlmm(lam, x, y[:, j])
        assert value[j] <= v + 1e-7
        assert abs(value[j] - v) < 1e-6
        assert np.allclose([error[j], genetic[j]], [e, g], rtol=1e-3)


def test_minimisers():
    at, value = optim.minimise_interval(lambda t: (t - 0.3) ** 2 + 1, -1, 2)
    assert abs(at - 0.3) < 1e-6
    assert abs(value - 1) < 1e-12
    p, _ = optim.minimise_box(lambda t: (t[0] - 5) ** 2 + (t[1] + 1) ** 2, np.array([[0.0, 0.0]]), np.array([-2.0, -2.0]), np.array([2.0, 2.0]))
    assert np.allclose(p, [2, -1], atol=1e-4)


def test_heritability_is_found():
    rng = np.random.default_rng(6)
    lam = rng.uniform(0.1, 20, 3000)
    m, n = 3000.0, 5000.0
    b = rng.normal(size=3000) * np.sqrt(hdl.scaled(0.4, 1.0, lam, m, n))
    slope, intercept = hdl.estimate1(lam, b, m, n)
    assert abs(slope - 0.4) < 0.06
    assert abs(intercept - 1) < 0.3
    b2 = 0.5 * b + rng.normal(size=3000) * np.sqrt(hdl.scaled(0.2, 1.0, lam, m, n))
    p1, p2 = hdl.estimate1(lam, b, m, n), hdl.estimate1(lam, b2, m, n)
    cross = hdl.estimate2(lam, b, b2, m, n, n, n, p1, p2)
    assert abs(cross[0] - 0.2) < 0.08


def test_meta(spark):
    rows = [("m", "a", "A", "G", 0.5, 0.1, 0.2, 10), ("m", "b", "G", "A", -0.3, 0.2, 0.7, 30), ("o", "a", "C", "T", 0.1, 0.1, 0.5, 10)]
    df = spark.createDataFrame(rows, "marker string, study string, ref string, alt string, effect double, std_err double, freq double, n long")
    got = {r.marker: r for r in meta.fixed_effect(meta.align_alleles(df), ["marker", "allele1", "allele2"], ["a", "b"]).collect()}
    w = np.array([100, 25])
    effect = (w * [0.5, 0.3]).sum() / w.sum()
    r = got["m"]
    assert np.isclose(r.effect, effect)
    assert np.isclose(r.std_err, w.sum() ** -0.5)
    assert np.isclose(r.het_chisq, (w * (np.array([0.5, 0.3]) - effect) ** 2).sum())
    assert (r.direction, r.sample_count, r.het_df) == ("++", 40, 1)
    assert np.isclose(r.freq1, (0.2 * 10 + 0.3 * 30) / 40)
    one = got["o"]  # one study stays as it is
    assert np.isclose(one.effect, 0.1)
    assert (one.het_chisq, one.direction) == (0.0, "+?")


def test_masked_covariance(spark):
    rng = np.random.default_rng(7)
    x = np.where(rng.uniform(size=(50, 3)) < 0.2, np.nan, rng.normal(size=(50, 3)))
    long = spark.createDataFrame([(i, "abc"[j], float(x[i, j])) for i in range(50) for j in range(3) if not np.isnan(x[i, j])], "sample_id int, variable string, value double")
    want = np.ma.cov(np.ma.masked_invalid(x), rowvar=False, allow_masked=True)
    for r in variables.covariance(long).collect():
        assert np.isclose(r.covariance, want["abc".index(r.a), "abc".index(r.b)])
    single = spark.createDataFrame([(1, "a", 2.0)], "sample_id int, variable string, value double")
    assert variables.covariance(single).head().covariance is None
    assert variables.covariance(long.where("false")).count() == 0


def test_resume(spark):
    pieces = spark.createDataFrame([(0,), (1,)], "piece int")
    names = spark.createDataFrame([("x",), ("y",)], "phenotype string")
    all_ = hdl.jobs(names, pieces, "jackknife")
    assert all_.count() == 9
    assert hdl.jobs(names, pieces, "jackknife", all_.where(F.col("jackknife_index").isNull())).count() == 6


def test_gram_in_tiles(variants, cohort):
    """Tiles that do not divide the samples, more parts than meet at once, and factors of few rows."""
    g, c = cohort
    z = association.standardise(g)
    many = variants.repartition(40)
    for k, m in matrices(association.gram(many, tile=7)).items():
        assert np.allclose(m, z[c == k].T @ z[c == k])
    for k, r in matrices(association.triangular(many)).items():
        assert np.allclose(r.T @ r, z[c == k].T @ z[c == k])


def test_samples_by_place(spark, cohort):
    g, _ = cohort
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(g)], "id int, dosages array<double>")
    places = np.array([3, 0, 17])
    got = association.take_samples(df, places).orderBy("id").collect()
    assert np.allclose([r.dosages for r in got], g[:, places])
    got = association.frequencies(df, {"all": np.arange(20), "some": places, "none": np.array([], int)}).orderBy("id").collect()
    assert np.allclose([r["all"] for r in got], g.mean(1) / 2)
    assert np.allclose([r["some"] for r in got], g[:, places].mean(1) / 2)
    assert {r["none"] for r in got} == {0.0}


def test_quantiles(spark):
    """Exact quantiles of groups of all sizes, with one frequent value, NULL keys and NULL values."""
    rng = np.random.default_rng(8)
    rows = [("a", float(x)) for x in rng.normal(size=1001)] + [("b", 5.0)] * 700 + [("b", float(x)) for x in range(10)] + [(None, 1.0), (None, 4.0), ("c", 2.0), ("d", None)]
    df = spark.createDataFrame(rows, "k string, value double")
    shares = (0.0, 0.1, 0.25, 0.5, 0.9, 1.0)
    got = {r.k: r for r in variables.quantiles(df, shares, "k").collect()}
    assert set(got) == {"a", "b", None, "c"}
    for k, r in got.items():
        own = [v for key, v in rows if key == k]
        assert r.n == len(own)
        assert np.allclose([r[f"q{i}"] for i in range(len(shares))], np.quantile(own, shares))
    s = {r.k: r for r in variables.summaries(df, "k").collect()}
    assert (s["d"].n, s["d"].median, s["d"].variance) == (0, None, None)
    assert (s["c"].n, s["c"].median, s["c"].variance) == (1, 2.0, 0.0)
    assert np.isclose(s["a"].variance, np.var([v for k, v in rows if k == "a"], ddof=1))
    assert variables.quantiles(df.where("false"), (0.5,), "k").count() == 0


def test_ranks(spark):
    from cohortspark import lineage

    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("x"), F.lit(1).alias("one"))
    got = lineage.ranked(df.repartition(7), F.desc("x")).collect()
    assert sorted((r["rank"], r.x) for r in got) == [(i, 999 - i) for i in range(1000)]
    points = meta.qq_points(df.select(F.col("one").cast("double").alias("chi2"))).collect()
    assert sorted(r["rank"] for r in points) == list(range(1, 1001))


def test_curvature_errors():
    """Standard errors of the explicit likelihood by differences of its value."""
    rng = np.random.default_rng(10)
    n = 60
    lam = rng.uniform(0.1, 3, n)
    x = np.column_stack([np.ones(n), rng.normal(size=n)])
    y = x @ [1.0, -0.5] + rng.normal(size=n) * np.sqrt(0.5 * lam + 0.5)

    def value(t):
        v = t[1] * lam + t[0]
        return float(np.log(v).sum() + ((y - x @ t[2:]) ** 2 / v).sum())

    at, h = np.array([0.6, 0.4, 1.1, -0.4]), 1e-4
    step = np.eye(4) * h
    want = [[(value(at + a + b) - value(at + a - b) - value(at - a + b) + value(at - a - b)) / (4 * h * h) for b in step] for a in step]
    assert np.allclose(nullmodel.curvature(lam, x, y, at[0], at[1], at[2:]), want, rtol=1e-4, atol=1e-3)
    fit = nullmodel.fit("ml", lam, x, y)
    full = nullmodel.curvature(lam, x, y, fit["error_variance"], fit["genetic_variance"], np.array(fit["beta"]))
    assert np.allclose(fit["se"], np.sqrt(np.diag(np.linalg.inv(full))[2:]))


def test_eigen_of_factor():
    rng = np.random.default_rng(11)
    z = rng.normal(size=(50, 8))
    values, vectors = nullmodel.eigen_of_factor(np.linalg.qr(z, mode="r"), 50)
    want, _ = nullmodel.eigen(z.T @ z / 50)
    assert np.allclose(values, want)
    assert np.allclose(vectors * values @ vectors.T, z.T @ z / 50)
    with pytest.raises(ValueError, match="full rank"):
        nullmodel.eigen_of_factor(np.linalg.qr(np.hstack([z, z[:, :2]]), mode="r"), 50)
    wide = nullmodel.scatter(vectors, list("abcdefgh"), list("hxgfedcba"))
    assert np.allclose(wide[0], vectors[7])
    assert (wide[1] == 0).all()


def test_estimates_in_groups(spark):
    """The jobs' results do not depend on how phenotypes are dealt out; starts of the pieces' sums are looked up by pair."""
    rng = np.random.default_rng(12)
    pieces = spark.createDataFrame([(p, rng.uniform(0.5, 3, 6).tolist(), np.eye(6).tolist()) for p in range(2)], "piece int, lam array<double>, vectors array<array<double>>")
    effects = spark.createDataFrame([(p, i, f"t{k}", float(rng.normal())) for p in range(2) for i in range(6) for k in range(5)], "piece int, ord int, phenotype string, effect double")
    counts = spark.createDataFrame([(f"t{k}", 900.0, 1000.0) for k in range(5)], "phenotype string, n_min double, n_median double")
    rotated = hdl.rotate(effects, pieces)
    assert rotated.count() == 10
    todo = hdl.jobs(counts.select("phenotype"), pieces, "piecewise")
    order = ["phenotype1", "phenotype2", "piecewise_index"]
    one = hdl.estimate(rotated, counts, todo, group=99).orderBy(*order).collect()
    two = hdl.estimate(rotated, counts, todo, group=2).orderBy(*order).collect()
    assert len(one) == 30
    assert np.allclose([(r.slope, r.intercept) for r in one], [(r.slope, r.intercept) for r in two])
    begin = hdl.starts(spark.createDataFrame(one, hdl.SCHEMA))
    assert begin.count() == 15
    whole = hdl.estimate(rotated, counts, hdl.jobs(counts.select("phenotype"), pieces, "jackknife"), begin, group=2)
    assert whole.count() == 45
    assert hdl.own_estimates(whole).count() == 5
    ranges = hdl.piece_ranges(pieces).orderBy("piece").collect()
    assert [tuple(r) for r in ranges] == [(0, 0, 6, 0, 6), (1, 6, 12, 6, 12)]


def test_membership_needs_full_rank(spark):
    from cohortspark.operators import stratify

    ref = spark.createDataFrame([("p", 1.0, 2.0), ("p", 2.0, 4.0), ("p", 3.0, 6.0)], "population string, C1 double, C2 double")
    with pytest.raises(ValueError, match="population p"):
        stratify.membership(ref.selectExpr("1 as sample", "C1", "C2"), ref, ["C1", "C2"])


def test_population_of_all_components(spark):
    """Membership by many correlated components, against the density in numpy."""
    from cohortspark.operators import stratify

    rng = np.random.default_rng(13)
    mix = rng.normal(size=(6, 6))
    ref = {p: rng.normal(size=(80, 6)) @ mix + k for k, p in enumerate("ab")}
    names = [f"C{i}" for i in range(6)]
    schema = ", ".join(f"{n} double" for n in names)
    reference = spark.createDataFrame([(p, *map(float, x)) for p, m in ref.items() for x in m], f"population string, {schema}")
    samples = rng.normal(size=(100, 6)) @ mix + 0.5
    got = stratify.membership(spark.createDataFrame([(i, *map(float, x)) for i, x in enumerate(samples)], f"sample int, {schema}"), reference, names, deviations=4.0)
    want = set()
    for p, m in ref.items():
        cov = np.cov(m, rowvar=False)
        d = samples - m.mean(0)
        density = -0.5 * ((d @ np.linalg.inv(cov) * d).sum(1) + np.linalg.slogdet(cov)[1] + 6 * np.log(2 * np.pi))
        want |= {(i, p) for i in np.flatnonzero(density > -8 - 0.5 * np.log(2 * np.pi)).tolist()}
    assert {(r.sample, r.population) for r in got.collect()} == want


def test_models_of_all_rows(spark):
    """Every vector is a phenotype of the null models, and all pairs of labels and pieces are estimated."""
    from cohortspark.plans import catalogue, inputs

    d = "/root/testdata/sf0.001"
    e = inputs.table(spark, d, "embeddings")
    y = catalogue._cohort(spark, d)[0]
    assert y.select("phenotype").distinct().count() == e.select("vec_id").distinct().count()
    n = e.select("label").distinct().count()
    assert catalogue.QUERIES["hdl_piecewise"](spark, d).count() == 3 * n * (n + 1) // 2
