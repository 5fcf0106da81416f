"""Catalogue queries that write a table in an exchange format, read it again by the library's reader, and return that.

Their DuckDB twins know nothing of files: what is read must be what the tables hold.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortspark import lineage
from cohortspark.functions import genetics as G
from cohortspark.operators import hdl, index, meta, variables
from cohortspark.sources import results, rmw, tables, vcf

from . import inputs as I
from .catalogue import UNIT, query


def _path(spark: SparkSession, name: str) -> str:
    return f"{lineage.shared_dir(spark)}/{uuid.uuid4().hex}/{name}"


def _text(lines: DataFrame, head: list[str], path: str, compression: str = "none") -> str:
    """Lines (`value`) below a head, as one directory whose parts each begin with the head."""

    def run(frames):
        import pandas as pd

        yield pd.DataFrame({"value": head})
        yield from frames

    lines.mapInPandas(run, "value string").coalesce(1).write.option("compression", compression).text(path)
    return path


@query(f"""WITH {I.DOSAGES} SELECT CAST(chromosome AS SMALLINT) AS chromosome, vec_id AS position, 'A' AS ref, 'C' AS alt, vec_id % 2 = 0 AS is_imputed, CASE WHEN vec_id % 5 <> 0 THEN vec_id / 1000000.0::DOUBLE END AS r2,
  CASE WHEN vec_id % 3 = 0 THEN 'DS' ELSE 'GT:DS' END AS format, list_transform(q, lambda x: x / 10000.0::DOUBLE) AS dosages FROM dosages""")
def vcf_dosages(spark, d):
    """Dosage text with two orders of fields, missing qualities and 64 samples."""
    third, info = F.col("vec_id") % 3 == 0, F.concat(F.when(F.col("vec_id") % 2 == 0, "IMPUTED;").otherwise("TYPED;"), F.lit("R2="), F.when(F.col("vec_id") % 5 != 0, (F.col("vec_id") / 1000000.0).cast("string")).otherwise("nan"))
    cells = F.transform("dosages", lambda x: F.when(third, x.cast("string")).otherwise(F.concat(F.lit("0|0:"), x.cast("string"))))
    rows = I.dosages(spark, d)
    lines = rows.select(F.concat_ws("\t", F.col("chromosome").cast("string"), F.col("vec_id").cast("string"), F.lit("."), F.lit("A"), F.lit("C"), F.lit("."), F.lit("PASS"), info, F.when(third, "DS").otherwise("GT:DS"), F.array_join(cells, "\t")).alias("value"))
    names = [*vcf.MANDATORY, *(f"s{i}" for i in range(64))]
    path = _text(lines, ["##fileformat=VCFv4.2", "#" + "\t".join(names)], _path(spark, "all.vcf"))
    found, samples = vcf.read_vcf(spark, path)
    assert samples == names[len(vcf.MANDATORY) :]
    return found.select("chromosome", "position", "ref", "alt", "is_imputed", "r2", "format", "dosages")


@query(f"WITH {I.DOSAGES} SELECT vec_id AS position, list_transform([3, 17, 40], lambda i: q[i + 1] / 10000.0::DOUBLE) AS dosages FROM dosages")
def vcf_some_samples(spark, d):
    """Three of the samples, in the file's order whatever the order asked for."""
    lines = I.dosages(spark, d).select(F.concat_ws("\t", F.lit("1"), F.col("vec_id").cast("string"), F.lit("."), F.lit("A"), F.lit("C"), F.lit("."), F.lit("PASS"), F.lit("R2=1"), F.lit("DS"), F.array_join(F.transform("dosages", lambda x: x.cast("string")), "\t")).alias("value"))
    head = ["#" + "\t".join([*vcf.MANDATORY, *(f"s{i}" for i in range(64))])]
    path = _text(lines, head, _path(spark, "some.vcf"), "gzip")
    return vcf.read_vcf(spark, path, ["s40", "s3", "other", "s17"])[0].select("position", "dosages")


@query(f"WITH {I.SCORES}, {I.MARKERS} SELECT chromosome || ':' || position AS marker, CAST(study AS VARCHAR) AS study, CAST(u AS VARCHAR) AS u, CAST(v AS VARCHAR) AS v FROM markers")
def score_text_round_trip(spark, d):
    rows = I.marker_scores(spark, d).select(F.concat_ws(":", "chromosome", "position").alias("marker"), F.col("study").cast("string").alias("study"), "u", "v", "d")
    path = _path(spark, "scores.txt.gz")
    tables.write_score(rows, path, "gzip_text", {"method": "fastlmm"})
    back, metadata = tables.read_score(spark, path, ["marker", "study", "u", "v"])
    assert metadata == {"method": "fastlmm"}
    return back


@query(f"""WITH {I.SCORES} SELECT CAST(chromosome AS VARCHAR) AS "CHROM", position AS "POS", sample AS "N_INFORMATIVE", aaf AS "ALL_AF", u::DOUBLE AS "U_STAT", sqrt(v::DOUBLE) AS "SQRT_V_STAT", 1 AS "N_HET" FROM scores""")
def scorefile_round_trip(spark, d):
    rows = I.scores(spark, d).select("chromosome", "position", "ref", "alt", "aaf", F.col("u").cast("double").alias("u"), F.col("v").cast("double").alias("v"), F.col("sample").alias("n"))
    path = _path(spark, "a.score")
    rmw.write_scorefile(rmw.record(rows), path, {"program_name": "cohortspark", "samples": 7, "covariates": ["age"], "heritability": [0.5]})
    back, header = rmw.read_scorefile(spark, path)
    assert (header["samples"], header["covariates"], header["heritability"]) == (7, ["age"], [0.5])
    return back.select("CHROM", "POS", "N_INFORMATIVE", "ALL_AF", "U_STAT", "SQRT_V_STAT", "N_HET")


_NUMBERS = {"freq1": "d", "freq_se": "d", "min_freq": "d", "max_freq": "d", "effect": "u", "std_err": "v", "p_value": "v", "het_isq": "d", "het_chisq": "u", "het_p_value": "v"}


@query(f"""WITH {I.SCORES}, {I.MARKERS} SELECT chromosome || ':' || position || ':' || study AS marker_name, 'a' AS allele1, 'c' AS allele2, {", ".join(f"{c}::DOUBLE / 8 AS {n}" for n, c in _NUMBERS.items())},
  '+-?' AS direction, CAST(study AS INTEGER) AS het_df, CAST(n AS INTEGER) AS sample_count FROM markers""")
def meta_table_round_trip(spark, d):
    name = F.concat_ws(":", "chromosome", "position", "study").alias("marker_name")
    numbers = [(F.col(c).cast("double") / 8).alias(n) for n, c in _NUMBERS.items()]
    rows = I.marker_scores(spark, d).select(name, F.lit("a").alias("allele1"), F.lit("c").alias("allele2"), *numbers, F.lit("+-?").alias("direction"), F.col("study").cast("int").alias("het_df"), F.col("n").cast("int").alias("sample_count"))
    path = _path(spark, "meta.tbl")
    results.write_meta(rows, path)
    return results.read_meta(spark, path)


@query(f"""WITH {I.PHENOTYPES} SELECT CAST(sample_id AS VARCHAR) AS sample_id, max(CASE WHEN variable = 'priority_1' THEN value / 4.0::DOUBLE END) AS p1, max(CASE WHEN variable = 'priority_2' THEN value / 4.0::DOUBLE END) AS p2
FROM pheno WHERE variable IN ('priority_1', 'priority_2') GROUP BY sample_id""")
def variables_round_trip(spark, d):
    """Two files, each with one column of its own, combined by sample."""
    paths = []
    for k in "12":
        own = I.phenotypes(spark, d).where(F.col("variable") == f"priority_{k}").select("sample_id", (F.col("value") / 4.0).alias(f"p{k}"))
        paths.append(_path(spark, f"p{k}.tsv"))
        tables.write_variables(own, paths[-1])
    return tables.read_variables(spark, paths)


@query("SELECT CAST(c_custkey AS VARCHAR) AS id FROM customer")
def plink_samples(spark, d):
    c = I.table(spark, d, "customer")
    lines = c.select(F.concat_ws(" ", F.col("c_nationkey").cast("string"), F.col("c_custkey").cast("string"), F.lit("0 0 1 -9")).alias("value"))
    path = _path(spark, "a.fam")
    lines.write.text(path)
    return tables.read_plink(spark, path)


@query("""SELECT '5:' || p_partkey || ':A:G' AS marker_name, CASE WHEN p_partkey % 3 = 0 THEN 'rs' || p_partkey END AS rsid, 'A' AS a0, 'G' AS a1, p_size / 64.0::DOUBLE AS eur FROM part""")
def legend_read(spark, d):
    k = F.col("p_partkey").cast("string")
    name = F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit("rs"), k, F.lit(":"), k, F.lit(":A:G"))).otherwise(F.concat(F.lit("5:"), k, F.lit(":A:G")))
    rows = I.table(spark, d, "part").select(name.alias("id"), k.alias("position"), F.lit("A").alias("a0"), F.lit("G").alias("a1"), (F.col("p_size") / 64.0).alias("eur.aaf"))
    path = _path(spark, "legend")
    rows.write.option("sep", " ").option("header", True).option("compression", "gzip").csv(path)
    found = tables.read_legends(spark, {5: path})
    return found.select("marker_name", "rsid", "a0", "a1", F.col("`eur.aaf`").alias("eur"))


@query("""SELECT CASE WHEN vec_id % 4 = 0 THEN 'CEU' WHEN vec_id % 4 = 1 THEN 'YRI' ELSE 'none' END AS population, count(*) AS n, round(sum(CAST(embedding[1] AS DOUBLE)), 6) AS total FROM embeddings GROUP BY 1""")
def component_panel(spark, d):
    """Reference rows of two populations and the study's own rows, told apart by the reader."""
    v = F.col("vec_id")
    fid = F.when(v % 4 == 0, " CEU").when(v % 4 == 1, "YRI ").otherwise("me")
    rows = I.table(spark, d, "embeddings").select(fid.alias("FID"), F.concat(F.lit(" i"), v.cast("string")).alias("IID"), F.lit(0).alias("SOL"), *(F.col("embedding")[i].cast("double").alias(f"C{i + 1}") for i in range(2)))
    path = _path(spark, "mds.csv")
    rows.write.option("header", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    own, reference = tables.read_mds(spark, path, {"CEU", "YRI"})
    both = reference.select("population", "C1").unionAll(own.select(F.lit("none"), "C1"))
    return both.groupBy("population").agg(F.count("*").alias("n"), F.round(F.sum("C1"), 6).alias("total"))


@query(f"WITH {I.SCORES}, {I.MARKERS} SELECT 'trait' AS phenotype, chromosome || '-' || position || '-' || study AS snp, d / 8.0::DOUBLE AS z, v::DOUBLE AS n, 'A' AS allele FROM markers WHERE study <> 2")
def sumstats_read(spark, d):
    m = I.marker_scores(spark, d)
    rows = m.select(F.concat_ws("-", "chromosome", "position", "study").alias("SNP"), F.when(F.col("study") != 2, F.col("d") / 8.0).alias("Z"), F.col("v").cast("double").alias("N"), F.lit("A").alias("A2"))
    path = _path(spark, "sumstats")
    rows.write.option("sep", "\t").option("header", True).option("nullValue", "NA").csv(path)
    return tables.read_sumstats(spark, path, "trait")


@query("SELECT n_name AS chunk, 'all' AS collection, CASE WHEN n_nationkey % 2 = 0 THEN 'score_complete' ELSE 'pending' END AS state FROM nation")
def state_log(spark, d):
    """The latest state of each chunk of a log of changes."""
    n = I.table(spark, d, "nation")
    path = _path(spark, "states")
    early = n.select(F.col("n_name").alias("chunk"), F.lit("all").alias("collection"), F.lit("pending").alias("state"), F.lit("2020-01-01 00:00:00").cast("timestamp").alias("at"))
    late = n.where("n_nationkey % 2 = 0").select(F.col("n_name").alias("chunk"), F.lit("all").alias("collection"), F.lit("score_complete").alias("state"), F.lit("2020-01-02 00:00:00").cast("timestamp").alias("at"))
    early.unionAll(late).write.parquet(path)
    return results.states(spark, path)


@query(f"""WITH {I.NAMES} SELECT brand, size_class, count(DISTINCT phenotype) AS members FROM parts WHERE size_class IS NOT NULL GROUP BY 1, 2 HAVING count(DISTINCT phenotype) >= 5""")
def jobs_on_disk(spark, d):
    """Jobs in directories of their keys; a second run leaves them as they are."""
    grouped = index.groups(index.build(I.names(spark, d)), ["brand", "size_class"]).where("size_class is not null")
    path = _path(spark, "jobs")
    assert results.write_jobs(grouped, path, ["brand", "size_class"])
    assert not results.write_jobs(grouped, path, ["brand", "size_class"])
    return spark.read.schema(grouped.schema).json(path).select("brand", "size_class", F.size("members").cast("bigint").alias("members"))


@query(f"""WITH {I.SCORES} SELECT chromosome, position, sample FROM scores WHERE d <> 5 AND r2 >= 0.6 AND CASE WHEN aaf <= 0.5 THEN aaf ELSE 1 - aaf END >= 5.0::DOUBLE / (2 * (v + 3))""")
def study_quality_filter(spark, d):
    rows = I.scores(spark, d).withColumn("u", F.col("u").cast("double"))
    kept = meta.study_filter(rows, G.minor_allele_frequency(F.col("aaf")), F.col("r2"), F.col("v") + 3)
    return kept.select("chromosome", "position", "sample")


@query(f"WITH {I.NAMES} SELECT * FROM tag WHERE phenotype NOT IN (SELECT phenotype FROM tag WHERE key = 'stat' AND value = 'z')")
def tag_remove(spark, d):
    return index.remove(index.build(I.names(spark, d)), stat="z")


@query(f"""WITH {I.SCORES} SELECT 's' || study AS study, count(*) AS sample_count, min(v)::DOUBLE AS minimum, quantile_cont(v::DOUBLE, 0.25) AS lower_quartile, quantile_cont(v::DOUBLE, 0.5) AS median, quantile_cont(v::DOUBLE, 0.75) AS upper_quartile, max(v)::DOUBLE AS maximum
FROM scores GROUP BY study""")
def study_boxes(spark, d):
    """A forest plot's data: studies with fewer samples first."""
    rows = I.scores(spark, d).select(F.concat(F.lit("s"), F.col("study").cast("string")).alias("study"), F.lit("v").alias("statistic"), F.col("v").cast("double").alias("value"))
    counts = rows.groupBy("study").agg(F.count("*").alias("sample_count"))
    return meta.study_boxes(variables.summaries(rows, "study", "statistic"), "v", counts)


@query(f"""WITH {I.SCORES}, {I.MARKERS} SELECT 't' || study AS phenotype, min(n)::DOUBLE AS n_min, quantile_cont(n::DOUBLE, 0.5) AS n_median FROM markers GROUP BY study""")
def sample_counts(spark, d):
    m = I.marker_scores(spark, d).select(F.concat(F.lit("t"), F.col("study").cast("string")).alias("phenotype"), F.col("n").cast("double").alias("n"))
    return hdl.sample_counts(m)


@query("""WITH e AS (SELECT CAST(label AS INTEGER) AS piece, vec_id, list_transform(embedding, lambda x: CAST(round(CAST(x AS DOUBLE) * 1000) AS BIGINT)) AS b FROM embeddings)
SELECT piece, 'v' || vec_id AS phenotype, 64 AS snp_count,
  list_transform(range(0, 3), lambda k: CAST(list_sum(list_transform(b, lambda x, i: x * (((i - 1) * (k + 1)) % 5 - 2))) AS DOUBLE)) AS rotated FROM e""")
def piece_rotation(spark, d):
    """Effects of 64 SNPs a piece in three coordinates; every vector is a phenotype of its label's piece."""
    vectors = [[float((i * (k + 1)) % 5 - 2) for k in range(3)] for i in range(64)]
    e = I.table(spark, d, "embeddings")
    pieces = e.select(F.col("label").cast("int").alias("piece")).distinct().select("piece", F.lit([1.0, 2.0, 3.0]).alias("lam"), F.array(*(F.array(*map(F.lit, v)) for v in vectors)).alias("vectors"))
    effects = e.select(F.col("label").cast("int").alias("piece"), F.concat(F.lit("v"), F.col("vec_id").cast("string")).alias("phenotype"), F.posexplode("embedding").alias("ord", "x"))
    effects = effects.select("piece", "phenotype", "ord", F.round(F.col("x").cast("double") * 1000).alias("effect"))
    return hdl.rotate(effects, pieces).select("piece", "phenotype", "snp_count", "rotated")


def _estimates(spark, d) -> DataFrame:
    """Slopes by study and chromosome, as estimates of pieces and as estimates that leave a piece out."""
    per = I.scores(spark, d).groupBy("study", "chromosome").agg((F.sum("u") / F.sum("v") / UNIT).alias("slope"), F.avg("d").alias("intercept"))
    name, none, at = F.concat(F.lit("t"), F.col("study").cast("string")), F.lit(None).cast("smallint"), F.col("chromosome").cast("smallint")
    one = per.select(name.alias("phenotype1"), name.alias("phenotype2"), at.alias("piecewise_index"), none.alias("jackknife_index"), "slope", "intercept")
    return one.unionAll(per.select(name, name, none, at, "slope", "intercept"))


_ESTIMATES = f"WITH {I.SCORES}, per AS (SELECT 't' || study AS t, chromosome, sum(u)::DOUBLE / sum(v)::DOUBLE / 1234567.0::DOUBLE AS slope, avg(d) AS intercept FROM scores GROUP BY 1, 2)"


@query(_ESTIMATES + " SELECT t AS phenotype1, t AS phenotype2, round((count(*) - 1) * var_pop(slope), 12) AS variance FROM per GROUP BY t")
def jackknife_variance(spark, d):
    return hdl.jackknife_error(_estimates(spark, d)).select("phenotype1", "phenotype2", F.round("variance", 12).alias("variance"))


@query(_ESTIMATES + " SELECT t AS phenotype1, t AS phenotype2, round(sum(slope), 12) AS slope, round(avg(intercept), 9) AS intercept FROM per GROUP BY t")
def piece_starts(spark, d):
    """Sums over pieces, where whole-genome estimates begin."""
    return hdl.starts(_estimates(spark, d)).select("phenotype1", "phenotype2", F.round("slope", 12).alias("slope"), F.round("intercept", 9).alias("intercept"))
