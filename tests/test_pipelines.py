"""Programs end to end on small simulated cohorts."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortspark.plans import pipelines as P


@pytest.fixture(scope="module")
def cohort(tmp_path_factory):
    d = tmp_path_factory.mktemp("cohort")
    rng = np.random.default_rng(9)
    n, names = 60, [f"s{i:02d}" for i in range(60)]
    causal = None
    for c in (21, 22):
        g = rng.binomial(2, rng.uniform(0.2, 0.5, (80, 1)), (80, n)).astype(float)
        causal = g[7] if c == 22 else causal
        lines = ["##x", "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\t" + "\t".join(names)]
        lines += [f"{c}\t{100 + i}\t.\tA\tG\t.\tPASS\tIMPUTED;R2=0.9\tDS\t" + "\t".join(str(x) for x in row) for i, row in enumerate(g)]
        (d / f"chr{c}.vcf").write_text("\n".join(lines) + "\n")
    y = 3 * causal + rng.normal(size=n)
    other = rng.normal(size=n)
    with (d / "pheno.tsv").open("w") as f:
        f.write("id\ty\tz\n" + "".join(f"{s}\t{a}\t{'n/a' if i % 10 == 0 else b}\n" for i, (s, a, b) in enumerate(zip(names, y, other, strict=True))))
    with (d / "covar.tsv").open("w") as f:
        f.write("id\tage\tfixed\n" + "".join(f"{s}\t{a}\t1337\n" for s, a in zip(names, rng.uniform(20, 60, n), strict=True)))
    return d


def test_score(spark, cohort):
    out = P.score(spark, [str(cohort / f"chr{c}.vcf") for c in (21, 22)], [str(cohort / "pheno.tsv")], [str(cohort / "covar.tsv")], P.ScoreOptions(chromosomes=[22]))
    scores = out["scores"].toPandas()
    assert len(scores) == 160
    assert set(scores.phenotype) == {"y", "z"}
    best = scores[scores.phenotype == "y"].assign(chi2=lambda d: d.u**2 / d.v).sort_values("chi2").iloc[-1]
    assert best.position == 107
    models = out["null_models"].toPandas()
    assert set(models.collection) == {"collection-00", "collection-01"}
    assert {len(b) for b in models.beta} == {2}  # intercept and age; the constant covariate is gone
    assert sorted(len(r) for r in models.residuals) == [54, 60]
    wide = P.wide_scores(out["scores"])
    assert {"y_stat-u", "z_stat-v"} <= set(wide.columns)
    assert wide.count() == 80
    plots = P.plot_data(out["scores"].where("phenotype = 'y'"))
    assert plots["qq"].count() == plots["manhattan"].count() > 70
    assert plots["inflation"].head()[0] > 0


def test_meta(spark):
    rows = [(s, c, p, "A", "C", 0.3, 0.9, 5.0 + p, 20.0, 100) for s in ("a", "b") for c in (1, 2) for p in (1, 2, 3)] + [("a", 1, 9, "A", "C", 0.001, 0.9, 3.0, 5.0, 100), ("b", 1, 8, "A", "C", 0.3, 0.1, 3.0, 5.0, 100)]
    df = spark.createDataFrame(rows, "study string, chromosome int, position long, ref string, alt string, aaf double, r2 double, u double, v double, n long")
    legends = spark.createDataFrame([("1:2:A:C", "rs2", 0.25)], "marker_name string, rsid string, eur double")
    out = P.meta_worker(df, ["a", "b"], legends, "eur")
    got = out["result"].collect()
    assert [r.marker_name for r in got] == [f"{c}:{p}:A:C" for c in (1, 2) for p in (1, 2, 3)]
    assert np.allclose([r.effect for r in got], [(5 + r.position) / 20 for r in got])
    assert [r.rsid for r in got] == [None, "rs2", None, None, None, None]
    per = {(r.study, r.statistic): r for r in out["studies"].collect()}
    assert len(per) == 8
    assert per["a", "r2"].n == 6
    assert per["a", "log10_p"].maximum < 0
    counts = spark.createDataFrame([("a", 100), ("b", 50)], "study string, sample_count long")
    plots = P.meta_plots(out, counts)
    assert [r.study for r in plots["boxes"].collect()] == ["b", "a"]
    assert sorted((r.study, r.n) for r in plots["se_n"].collect()) == [("a", 100), ("b", 50)]
    assert [(r.panel_freq, round(r.freq, 6)) for r in plots["frequencies"].collect()] == [(0.25, 0.7 if got[0].allele1 == "a" and got[0].freq1 == 0.3 else 0.3)]


def test_study_names(spark, tmp_path):
    from cohortspark.operators import index

    d = tmp_path / "ds-north_wave-2_raw"
    (d / "deep").mkdir(parents=True)
    (d / "deep" / "chr1.metadata.yaml").write_text("chunk-0:\n  all:\n    status: score_complete\n    sample_count: 7\n    phenotypes:\n      arm-left_z: {minimum: 0.0, mean: 1.5}\n    covariates:\n      age: {mean: 1.0}\n")
    (d / "deep" / "chr2.metadata.yaml").write_text("x: {}\n")
    names = P.study_names(spark, [str(d)], [("left", "any")])
    (row,) = names.collect()
    assert (row.phenotype, row.name, row.vc, row.prefix, row.sample_count, row["mean"]) == ("ds-north_wave-2_arm-any_z", "ds-north_wave-2_arm-left_z", "all", "ds-north_wave-2", "7", "1.5")
    assert row.path.endswith("/deep")
    tags = {r.key: r.value for r in index.build(names, {"vc": "vc", "sample_count": "sample_count"}).collect()}
    assert tags == {"ds": "north", "wave": "2", "arm": "left", "suffix": "z", "vc": "all", "sample_count": "7"}


def test_jobs(spark):
    names = spark.createDataFrame([(f"p{i}", f"ds-s{i}_feat-{'x' if i < 5 else 'y'}_stat-z") for i in range(10)], "phenotype string, name string")
    out = P.meta_prepare(names, ["feat", "stat"])
    assert {tuple(r.members) for r in out["jobs"].collect()} == {tuple(f"p{i}" for i in range(5)), tuple(f"p{i}" for i in range(5, 10))}
    both = P.meta_prepare(names, ["feat"], alternatives=[("feat", "x", "all"), ("feat", "y", "all")])
    assert {r.feat: len(r.members) for r in both["jobs"].collect()} == {"x": 5, "y": 5, "all": 10}
    with pytest.raises(ValueError, match="study"):
        P.meta_prepare(names.withColumn("name", F.regexp_replace("name", "s[0-9]", "s1")), ["feat"])


def test_stratify(spark, tmp_path):
    rng = np.random.default_rng(1)
    lines = ["FID,IID,SOL,C1,C2"]
    for pop, at in (("CEU", 0.0), ("YRI", 5.0)):
        lines += [f"{pop},r{pop}{i},0,{a + at},{b}" for i, (a, b) in enumerate(rng.normal(0, 0.3, (40, 2)))]
    lines += [f"f,s{i},0,{0.0 if i < 30 else 5.0},0.0" for i in range(60)]
    (tmp_path / "mds.csv").write_text("\n".join(lines) + "\n")
    (tmp_path / "p.tsv").write_text("id\ty\n" + "".join(f"s{i}\t{i}\n" for i in range(60)))
    (tmp_path / "c.tsv").write_text("id\tage\n" + "".join(f"s{i}\t{10 + i}\n" for i in range(60)))
    out = P.stratified(spark, str(tmp_path / "mds.csv"), [str(tmp_path / "p.tsv")], [str(tmp_path / "c.tsv")], {"age": [("young", 0, 50), ("old", 50, 99)]}, deviations=3.0, minimum_subsample=5, minimum=15, add_components=True)
    p = out["phenotypes"].toPandas().set_index("sample_id")
    assert "age-mixed_population-mixed_y" in p.columns
    assert p["age-young_population-CEU_y"].count() == 30
    assert p["age-mixed_population-YRI_y"].count() == 30
    assert out["covariates"].columns == ["sample_id", "age", "C1", "C2"]


def test_heritability(spark):
    rng = np.random.default_rng(2)
    pieces = spark.createDataFrame([(p, rng.uniform(0.5, 2, 4).tolist(), np.eye(4).tolist()) for p in range(2)], "piece int, lam array<double>, vectors array<array<double>>")
    reference = spark.createDataFrame([(p, i, f"rs{p}{i}", "A") for p in range(2) for i in range(4)], "piece int, ord int, snp string, ref_allele string")
    sums = spark.createDataFrame([(t, f"rs{p}{i}", float(rng.normal()), 1000.0, "AG"[i % 2]) for t in "xy" for p in range(2) for i in range(3)], "phenotype string, snp string, z double, n double, allele string")
    first = P.heritability(reference, pieces, sums, ["piecewise"])
    assert first["estimates"].count() == 6
    done = spark.createDataFrame(first["estimates"].collect(), first["estimates"].schema)
    again = P.heritability(reference, pieces, sums, ["piecewise", "jackknife"], done)
    assert again["estimates"].count() == 6 + 9
    assert again["totals"].count() == 3
    assert again["errors"].count() == 3
