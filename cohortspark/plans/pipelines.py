"""The programs: each takes a session and plain options and returns named DataFrames.

Cohort-sized things (samples by variables, samples by samples) come to the driver, where they are fitted to one
another; everything with a row for each variant stays distributed.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortspark import lineage
from cohortspark.functions import genetics as G
from cohortspark.functions import stats
from cohortspark.functions import tags as T
from cohortspark.operators import association, hdl, index, meta, nullmodel, stratify, variables
from cohortspark.sources import tables, vcf


@dataclass
class Collection:
    """Phenotypes with values for the same samples, their covariates (the intercept first), in one sample order."""

    name: str
    samples: list[str]
    phenotypes: list[str]
    covariates: list[str]
    y: np.ndarray
    x: np.ndarray


@dataclass
class ScoreOptions:
    """Defaults of the association program."""

    kinship_maf: float = 0.05
    kinship_r2: float = float("-inf")
    score_maf: float = float("-inf")
    score_r2: float = 0.5
    method: str = "fastlmm"
    missing: str = "listwise_deletion"
    chromosomes: list[int] = field(default_factory=list)


def load_genotypes(spark: SparkSession, paths: list[str]) -> tuple[DataFrame, list[str]]:
    """Variants of all files with the dosages of the samples that every file has, in the first file's order."""
    found = [vcf.read_vcf(spark, p) for p in paths]
    for (df, _), path in zip(found, paths, strict=True):
        vcf.check_chromosome(df, path)
    others = [set(s) for _, s in found[1:]]
    common = [s for s in found[0][1] if all(s in o for o in others)]
    if not common:
        raise ValueError("the files have no sample in common")
    out = None
    for df, samples in found:
        place = {s: i for i, s in enumerate(samples)}
        chosen = [place[s] for s in common]
        if chosen != list(range(len(samples))):
            df = association.take_samples(df, np.array(chosen))
        out = df if out is None else out.unionByName(df)
    return out, common


def collections(phenotypes: DataFrame, covariates: DataFrame, samples: list[str], missing: str) -> list[Collection]:
    """Splits phenotypes by their missing-value pattern, most phenotypes first."""
    names = [c for c in phenotypes.columns if c != "sample_id"]
    extra = [c for c in covariates.columns if c != "sample_id"]
    wide = phenotypes.join(covariates, "sample_id").toPandas().set_index("sample_id")
    wide = wide.loc[[s for s in samples if s in wide.index]]
    finite = wide.notna().all(axis=1) if missing == "complete_samples" else wide.notna().any(axis=1)
    wide = wide[finite]
    first_is_one = bool(extra) and np.allclose(wide[extra[0]], 1)
    groups: dict[bytes, list[str]] = {}
    for p in sorted(names):
        groups.setdefault(wide[p].notna().to_numpy().tobytes(), []).append(p)
    out = []
    for i, (pattern, members) in enumerate(sorted(groups.items())):
        here = wide[np.frombuffer(pattern, bool)]
        if not len(here):
            continue
        if here[extra].isna().any(axis=None):
            raise ValueError("covariates have missing values that no phenotype shares")
        kept = [c for j, c in enumerate(extra) if (first_is_one and j == 0) or here[c].var(ddof=0) > 1e-8]
        x = here[kept].to_numpy(float)
        if not first_is_one:
            x, kept = np.column_stack([np.ones(len(here)), x]), ["intercept", *kept]
        out.append(Collection(f"collection-{i:02d}", here.index.tolist(), members, kept, here[members].to_numpy(float), x))
    return sorted(out, key=lambda c: -len(c.phenotypes))


def with_frequencies(variants: DataFrame, samples: list[str], groups: list[Collection]) -> DataFrame:
    """Adds the allele frequency of all samples and of each collection."""
    place = {s: i for i, s in enumerate(samples)}
    members = {"aaf": np.arange(len(samples))} | {f"{c.name}_aaf": np.array([place[s] for s in c.samples]) for c in groups}
    return association.frequencies(variants.drop("aaf"), members)


def score(spark: SparkSession, vcf_paths: list[str], phenotype_paths: list[str], covariate_paths: list[str], options: ScoreOptions | None = None) -> dict[str, DataFrame]:
    """Association of every variant with every phenotype: scores, null_models, covariance, summaries.

    The files are parsed once, into a table by chromosome with all frequencies; one scan of it gives the relatedness of
    every chromosome, which is collected once, and one scan of each chromosome scores all collections. The scores of all
    chromosomes are one DataFrame, whose parts run at the same time.
    """
    o = options or ScoreOptions()
    variants, samples = load_genotypes(spark, vcf_paths)
    phenotypes, covariates = tables.read_variables(spark, phenotype_paths), tables.read_variables(spark, covariate_paths)
    groups = collections(phenotypes, covariates, samples, o.missing)
    place = {s: i for i, s in enumerate(samples)}
    path = f"{lineage.shared_dir(spark)}/variants-{uuid.uuid4().hex}"
    parsed = with_frequencies(variants, samples, groups)
    parsed.write.partitionBy("chromosome").option("compression", "zstd").parquet(path)
    parsed = spark.read.schema(parsed.schema).parquet(path)
    columns = [F.col("aaf"), *(F.col(f"{c.name}_aaf") for c in groups)]
    kin = parsed.where(G.variant_mask(columns, F.col("r2"), o.kinship_maf, o.kinship_r2, "min")).where(F.col("chromosome") != 23)
    grams = lineage.written(association.gram(kin), "kinship")
    own: dict[int, int] = {}
    matrices: dict[int, np.ndarray] = {}
    for r in grams.collect():  # samples**2 numbers a chromosome, whatever the number of variants
        own[r.chromosome] = r.n_variants
        matrices.setdefault(r.chromosome, np.zeros((len(samples), len(samples))))[r.i] = r["values"]
    total, count = sum(matrices.values()), sum(own.values())
    chosen = o.chromosomes or [r.chromosome for r in parsed.select("chromosome").distinct().orderBy("chromosome").collect()]
    scores, models = None, None
    keep = ["chromosome", "position", "ref", "alt", "is_imputed", "r2"]
    for chromosome in chosen:
        rest, m = total - matrices.get(chromosome, 0), count - own.get(chromosome, 0)
        at = {c.name: np.array([place[s] for s in c.samples]) for c in groups}
        eigens = {c.name: nullmodel.subset(rest, max(m, 1), at[c.name]) for c in groups}
        y = spark.createDataFrame([(c.name, p, c.y[:, j].tolist()) for c in groups for j, p in enumerate(c.phenotypes)], "collection string, phenotype string, y array<double>")
        fits = nullmodel.fit_all(y, eigens, {c.name: c.x for c in groups}, o.method, partitions=min(64, sum(len(c.phenotypes) for c in groups)))
        fits = lineage.written(fits.withColumn("chromosome", F.lit(chromosome)), "null-models")
        models = fits if models is None else models.unionByName(fits)
        found: dict[str, list] = {}
        for f in fits.where("variance is not null").orderBy("phenotype").collect():
            found.setdefault(f.collection, []).append(f)
        weights = {}
        for name, got in found.items():
            r, v = (np.array([f[x] for f in got]).T for x in ("residuals", "variance"))
            q = eigens[name][1]
            weights[name] = (at[name], nullmodel.score_weights(q, r, v), q, v, [f.phenotype for f in got])
        if not weights:
            continue
        mine = parsed.where(F.col("chromosome") == chromosome).where(G.variant_mask(columns, F.col("r2"), o.score_maf, o.score_r2))
        part = association.score_blocks(mine, weights, [*keep, *(f"{n}_aaf" for n in weights)])
        own_aaf = F.coalesce(*(F.when(F.col("collection") == n, F.col(f"{n}_aaf")) for n in weights))
        part = part.select(*keep, own_aaf.alias("aaf"), "collection", "phenotype", "u", "v")
        scores = part if scores is None else scores.unionByName(part)
    long = tables.long_form(phenotypes.join(covariates, "sample_id", "full"), [c for c in [*phenotypes.columns, *covariates.columns] if c != "sample_id"])
    return {"scores": scores, "null_models": models, "covariance": variables.covariance(long), "summaries": variables.summaries(long, "variable"), "kinship": grams}


def wide_scores(scores: DataFrame) -> DataFrame:
    """One row a variant with {phenotype}_stat-u and {phenotype}_stat-v, for exchange."""
    names = [r.phenotype for r in scores.select("phenotype").distinct().orderBy("phenotype").collect()]
    values = [F.max(F.when(F.col("phenotype") == p, F.col(s))).alias(f"{p}_stat-{s}") for p in names for s in ("u", "v")]
    return scores.groupBy("chromosome", "position", "ref", "alt", "is_imputed", "r2").agg(*values)


def stratified(spark: SparkSession, mds: str, phenotype_paths: list[str], covariate_paths: list[str], ranges: dict[str, list[tuple[str, float, float]]] | None = None, deviations: float = 6.0, by: str | None = "population", minimum_subsample: int = 10, minimum: int = 50, ignore: set[str] = frozenset(), add_components: bool = False) -> dict[str, DataFrame]:
    """Phenotypes with a masked copy of each column for every product of classes with enough samples, and covariates."""
    samples, reference = tables.read_mds(spark, mds, set(stratify.SUPER_POPULATIONS))
    components = [c for c in samples.columns if c.startswith("C")]
    phenotypes, covariates = tables.read_variables(spark, phenotype_paths), tables.read_variables(spark, covariate_paths)
    own = stratify.match_samples(phenotypes.select(F.col("sample_id").alias("sample")), samples).where("iid is not null")
    located = own.join(samples, ["fid", "iid"])
    parts = []
    if by is not None:
        used = reference.where(~F.col("population").isin(*ignore)) if ignore else reference
        found = stratify.membership(located, used, components, deviations)
        name = F.col("population")
        if by == "super_population":
            name = F.create_map(*(F.lit(x) for kv in stratify.SUPER_POPULATIONS.items() for x in kv))[F.col("population")]
        parts.append(found.select("sample", F.lit(by).alias("variable"), name.alias("class")).distinct())
    for column, classes in (ranges or {}).items():
        table = covariates if column in covariates.columns else phenotypes
        parts.append(stratify.range_classes(table, column, classes, "sample_id").select(F.col("sample_id").alias("sample"), F.lit(column).alias("variable"), "class"))
    out = phenotypes.withColumnRenamed("sample_id", "sample")
    if parts:
        all_ = parts[0]
        for p in parts[1:]:
            all_ = all_.unionByName(p)
        all_ = stratify.prune(stratify.with_mixed(stratify.prune(all_, minimum_subsample)), minimum).cache()
        names = [r.variable for r in all_.select("variable").distinct().orderBy("variable").collect()]
        for row in stratify.class_products(all_, names, minimum).orderBy(*names).collect() if names else []:
            members = out.select("sample")
            for v in names:
                members = members.join(all_.where((F.col("variable") == v) & (F.col("class") == row[v])), "sample", "left_semi")
            out = stratify.masked(out, all_, "_".join(f"{v}-{row[v]}" for v in names), members, [c for c in phenotypes.columns if c != "sample_id"])
    if add_components:
        covariates = covariates.join(located.select(F.col("sample").alias("sample_id"), *components), "sample_id", "left")
    return {"phenotypes": out.withColumnRenamed("sample", "sample_id"), "covariates": covariates}


def meta_prepare(names: DataFrame, group_by: list[str], extra: dict[str, str] | None = None, removals: list[dict] = (), replace_keys: list[tuple[str, str]] = (), drop_keys: list[str] = (), replace_values: list[tuple[str, str, str]] = (), alternatives: list[tuple[str, str, str]] = (), minimum: int = 5) -> dict[str, DataFrame]:
    """Jobs of phenotypes (phenotype, name): one for each distinct member set. A study twice in a job raises."""
    tag = index.rewrite(index.build(names, extra), list(removals), list(replace_keys), list(drop_keys), list(replace_values)).cache()
    other = None
    for a in alternatives:
        # a later alternative sees what earlier ones added
        seen = tag if other is None else tag.unionByName(other)
        new = index.alternative(seen, *a, ignore=tuple(extra or {}))
        other = new if other is None else other.unionByName(new)
    grouped = index.groups(tag, group_by, other, minimum)
    jobs = index.member_sets(grouped, group_by, other).cache()
    twice = index.duplicate_studies(jobs, tag, group_by).head()
    if twice is not None:
        raise ValueError(f"study {twice.study} has {twice.n} phenotypes in one group")
    return {"jobs": jobs, "tags": tag, "report": index.value_report(tag)}


#: Descriptive statistics that become tags of a phenotype.
STATISTICS = ("minimum", "lower_quartile", "median", "upper_quartile", "maximum", "mean", "variance")


def study_names(spark: SparkSession, directories: list[str], replace: list[tuple[str, str]] = ()) -> DataFrame:
    """phenotype, name, vc, path, prefix, sample_count and statistics of all phenotypes of studies, for index.build().

    A directory's name holds the study's tags (its suffix does not count), and the metadata of chromosome 1 below it the
    phenotypes. `name` is the tags with the phenotype's name behind them; in `phenotype`, substrings are replaced besides.
    """
    out = None
    for d in directories:
        found = tables.read_summary(spark, d, "chr1.metadata.yaml*").where("role = 'phenotypes'")
        tags = F.map_filter(T.parse(F.lit(d.rstrip("/").rsplit("/", 1)[-1])), lambda k, v: k != "suffix")
        prefix = F.array_join(F.transform(F.map_entries(tags), lambda e: F.concat_ws("-", e["key"], e["value"])), "_")
        name = F.concat_ws("_", prefix, F.col("variable"))
        phenotype = name
        for old, new in replace:
            phenotype = F.replace(phenotype, F.lit(old), F.lit(new))
        folder = F.regexp_replace("path", "/[^/]*$", "")
        own = found.select(phenotype.alias("phenotype"), name.alias("name"), F.col("collection").alias("vc"), folder.alias("path"), prefix.alias("prefix"), F.col("sample_count").cast("string").alias("sample_count"), *(F.col(c).cast("string").alias(c) for c in STATISTICS))
        out = own if out is None else out.unionByName(own)
    return out


def meta_worker(scores: DataFrame, studies: list[str], legends: DataFrame | None = None, population: str = "all.aaf", fallback: str | None = None) -> dict[str, DataFrame]:
    """Meta-analysis of scores (study, chromosome, position, ref, alt, aaf, r2, u, v, n): result, studies, panel frequencies."""
    kept = meta.study_filter(scores, G.minor_allele_frequency(F.col("aaf")), F.col("r2"), F.col("n"))
    effect, std_err = G.effect(F.col("u"), F.col("v")), G.standard_error(F.col("v"))
    rows = kept.select("study", "chromosome", "position", "ref", "alt", effect.alias("effect"), std_err.alias("std_err"), F.col("aaf").alias("freq"), "n", "r2", G.chi_squared(F.col("u"), F.col("v")).alias("chi2"))
    # one row a statistic, so that all are sorted once; n is the number of variants
    wide = rows.select("study", "effect", "std_err", "r2", stats.p_value("chi2")["log10_p"].alias("log10_p"))
    per_study = variables.summaries(wide.unpivot("study", ["effect", "std_err", "r2", "log10_p"], "statistic", "value"), "study", "statistic")
    rows = rows.drop("chi2")
    result = meta.fixed_effect(meta.align_alleles(rows), ["chromosome", "position", "allele1", "allele2"], studies)
    result = meta.quality_filter(result)
    p = result.withColumn("_p", stats.p_value("chi2")).withColumn("het_p_value", stats.chi2_tail("het_chisq", "het_df"))
    p = p.withColumns({"p_value": F.col("_p.p"), "log10_p": F.col("_p.log10_p"), "marker_name": G.variant_id(G.chromosome_from_int(F.col("chromosome")), F.col("position"), F.upper("allele1"), F.upper("allele2"))}).drop("_p")
    if legends is not None:
        p = meta.legend_join(p, legends, population, fallback)
    return {"result": p.orderBy(G.marker_key(F.col("marker_name"))), "studies": per_study}


def meta_plots(worker: dict[str, DataFrame], counts: DataFrame) -> dict[str, DataFrame]:
    """Data of the plots of meta_worker()'s result; counts has study and sample_count: boxes of qualities (studies with fewer
    samples first), the sample-size check with its line, and own against panel frequencies where there are legends."""
    studies, result = worker["studies"], worker["result"]
    points = studies.where("statistic = 'std_err'").join(counts, "study").select("study", F.col("sample_count").alias("n"), F.col("median").alias("se"))
    out = {"boxes": meta.study_boxes(studies, "r2", counts), "se_n": points, "se_n_line": meta.se_n_fit(points)}
    if "panel_freq" in result.columns:
        part = F.split("marker_name", ":")  # the panel names markers by its own alleles
        out["frequencies"] = meta.frequency_pairs(result.select(F.lit("meta").alias("study"), "freq1", "allele1", "allele2", part[2].alias("a0"), part[3].alias("a1"), "panel_freq"))
    return out


def plot_data(scores: DataFrame, maf: float = 0.005, r2: float = 0.5) -> dict[str, DataFrame]:
    """Manhattan points, quantile-quantile points and inflation of one phenotype's scores."""
    u, v = F.col("u"), F.col("v")
    kept = scores.where(G.variant_mask([F.col("aaf")], F.col("r2"), maf, r2)).where(u.isNotNull() & ~G.is_close(u, 0.0))
    chi2 = kept.withColumn("chi2", G.chi_squared(u, v))
    points = chi2.select("chromosome", G.genome_position(F.col("chromosome"), F.col("position")).alias("x"), (-stats.p_value("chi2")["log10_p"]).alias("y"))
    return {"manhattan": points, "qq": meta.qq_points(chi2.select("chi2")), "inflation": variables.lambda_gc(chi2), "axis": G.chromosome_table(scores.sparkSession)}


def heritability(reference: DataFrame, pieces: DataFrame, sumstats: DataFrame, steps: list[str], done: DataFrame | None = None) -> dict[str, DataFrame]:
    """Estimates of all jobs that are not done yet, and their sums and jackknife variances.

    A step that follows the pieces begins its searches at the pieces' sums.
    """
    rotated = lineage.written(hdl.rotate(hdl.marginal_effects(reference, sumstats), pieces), "rotated")
    counts = lineage.written(hdl.sample_counts(sumstats), "sample-counts")
    names = sumstats.select("phenotype").distinct()
    out = done
    for step in steps:
        begin = None if out is None or step == "piecewise" else hdl.starts(out)
        new = lineage.written(hdl.estimate(rotated, counts, hdl.jobs(names, pieces, step, done), begin), f"estimates-{step}")
        out = new if out is None else out.unionByName(new)
    return {"estimates": out, "totals": hdl.totals(out), "errors": hdl.jackknife_error(out)}
