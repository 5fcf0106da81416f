"""Registry of the catalogue queries and their DuckDB twins."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortspark import lineage
from cohortspark.functions import genetics as G
from cohortspark.functions import stats
from cohortspark.functions import tags as T
from cohortspark.operators import association, hdl, index, ldsc, meta, stratify, variables
from cohortspark.sources import rmw, tables

from . import inputs as I

Query = Callable[[SparkSession, str], DataFrame]
#: What effects are divided by: not a round number, so that no value lies half-way between two rounded ones.
UNIT = 1234567.0
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


# ---- variants ----------------------------------------------------------------------------------------------

_CLOSE = "({0} >= {1} OR abs({0} - {1}) <= 1e-8 + 1e-5 * {1})"
_FOLD = "CASE WHEN {0} <= 0.5 THEN {0} ELSE 1 - {0} END"


def _mask_sql(fold: str) -> str:
    maf = f"{fold}({_FOLD.format('aaf')}, {_FOLD.format('aaf2')})"
    return f"""WITH {I.SCORES}, m AS (SELECT *, {maf} AS maf FROM scores)
SELECT chromosome, count(*) AS variants, CAST(sum(position) AS BIGINT) AS positions FROM m
WHERE coalesce({_CLOSE.format("maf", "0.2")}, false) AND (r2 IS NULL OR {_CLOSE.format("r2", "0.75")}) GROUP BY chromosome"""


def _mask(spark: SparkSession, d: str, aggregate: str) -> DataFrame:
    rows = I.scores(spark, d)
    kept = rows.where(G.variant_mask([F.col("aaf"), F.col("aaf2")], F.col("r2"), 0.2, 0.75, aggregate))
    return kept.groupBy("chromosome").agg(F.count("*").alias("variants"), F.sum("position").alias("positions"))


@query(_mask_sql("greatest"))
def variant_mask_max(spark, d):
    return _mask(spark, d, "max")


@query(_mask_sql("least"))
def variant_mask_min(spark, d):
    return _mask(spark, d, "min")


@query(f"""WITH {I.SCORES}, c AS (SELECT DISTINCT CASE chromosome WHEN 7 THEN 'X' WHEN 6 THEN 'NC_000006.12' ELSE CAST(chromosome AS VARCHAR) END AS name FROM scores)
SELECT name, CAST(CASE WHEN name = 'X' THEN 23 WHEN name = 'NC_000006.12' THEN 6 ELSE CAST(name AS INTEGER) END AS SMALLINT) AS number,
  CASE name WHEN 'NC_000006.12' THEN '6' ELSE name END AS label FROM c""")
def chromosome_codec(spark, d):
    c = F.col("chromosome")
    name = F.when(c == 7, "X").when(c == 6, "NC_000006.12").otherwise(c.cast("string"))
    out = I.scores(spark, d).select(name.alias("name")).distinct().withColumn("number", G.chromosome_to_int(F.col("name")))
    return out.withColumn("label", G.chromosome_from_int(F.col("number")))


_MARKER = "CASE chromosome WHEN 7 THEN 'X' ELSE CAST(chromosome AS VARCHAR) END || ':' || position || ':' || ref || ':' || alt"


@query(f"""WITH {I.SCORES}, m AS (SELECT DISTINCT chromosome, position, ref, alt, {_MARKER} AS marker FROM scores)
SELECT marker, CASE chromosome WHEN 7 THEN 'X' ELSE lpad(CAST(chromosome AS VARCHAR), 2, '0') END || ':' || lpad(CAST(position AS VARCHAR), 12, '0') || ':' || ref || ':' || alt AS key
FROM m ORDER BY key""")
def marker_key_sort(spark, d):
    c = F.when(F.col("chromosome") == 7, "X").otherwise(F.col("chromosome").cast("string"))
    ids = I.scores(spark, d).select(G.variant_id(c, F.col("position"), F.col("ref"), F.col("alt")).alias("marker")).distinct()
    return ids.withColumn("key", G.marker_key(F.col("marker"))).orderBy("key")


_LENGTHS = ", ".join(f"({i + 1}, {n})" for i, n in enumerate(G.HG19_LENGTHS))
_OFFSETS = f"""lengths(chromosome, length) AS (VALUES {_LENGTHS}), offsets AS (
  SELECT *, CAST(coalesce(sum(length) OVER (ORDER BY chromosome ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS offs FROM lengths)"""


@query(f"""WITH {I.SCORES}, {_OFFSETS} SELECT DISTINCT s.chromosome, s.position, s.position + o.offs AS genome_position FROM scores s JOIN offsets o ON o.chromosome = s.chromosome""")
def genome_offset(spark, d):
    rows = I.scores(spark, d).select("chromosome", "position").distinct()
    return rows.withColumn("genome_position", G.genome_position(F.col("chromosome"), F.col("position")))


@query(f"""WITH {_OFFSETS} SELECT CAST(chromosome AS INTEGER) AS chromosome, CAST(length AS BIGINT) AS length, offs AS "offset", CAST(offs + length // 2 AS BIGINT) AS middle FROM offsets""")
def chromosome_axis(spark, d):
    return G.chromosome_table(spark)


@query(f"""WITH {_OFFSETS}, gap AS (SELECT sum(length) / 500.0::DOUBLE AS g FROM lengths)
SELECT line, height, CAST(chromosome AS INTEGER) AS chromosome, round(offs + g, 3) AS x_start, round(offs + length + 0.0::DOUBLE - g, 3) AS x_end
FROM offsets, gap, (VALUES ('suggestive', 5.0::DOUBLE), ('genome_wide', 8.0::DOUBLE)) t(line, height)""")
def threshold_segments(spark, d):
    return G.threshold_segments(spark).select("line", F.round("height", 9).alias("height"), "chromosome", F.round("x_start", 3).alias("x_start"), F.round("x_end", 3).alias("x_end"))


@query(f"""WITH {I.SCORES} SELECT ref, alt, count(*) AS n, CASE WHEN (ref IN ('A', 'T') AND alt IN ('A', 'T')) OR (ref IN ('C', 'G') AND alt IN ('C', 'G')) THEN true ELSE false END AS ambiguous
FROM (SELECT translate(ref, 'ANR', 'ATC') AS ref, translate(alt, 'FO', 'TG') AS alt FROM scores) GROUP BY ref, alt""")
def strand_ambiguity(spark, d):
    rows = I.scores(spark, d).select(F.translate("ref", "ANR", "ATC").alias("ref"), F.translate("alt", "FO", "TG").alias("alt"))
    return rows.groupBy("ref", "alt").agg(F.count("*").alias("n")).withColumn("ambiguous", G.strand_ambiguous(F.col("ref"), F.col("alt")))


# ---- scores ------------------------------------------------------------------------------------------------


@query(f"""WITH {I.SCORES} SELECT chromosome, position, sample, u / v::DOUBLE AS beta, 1 / sqrt(v::DOUBLE) AS se FROM scores
WHERE d <> 5 AND least(5 * d, 100 - 5 * d) >= 10 AND r2 >= 0.75""")
def score_beta_se(spark, d):
    u, v = F.col("u").cast("double"), F.col("v").cast("double")
    rows = I.scores(spark, d).where("least(5 * d, 100 - 5 * d) >= 10 and r2 >= 0.75").where(~G.is_close(u, 0.0))
    return rows.select("chromosome", "position", "sample", G.effect(u, v).alias("beta"), G.standard_error(v).alias("se"))


@query(f"WITH {I.SCORES} SELECT chromosome, position, sample, u::DOUBLE * u::DOUBLE / v::DOUBLE AS chi2 FROM scores")
def score_chi2(spark, d):
    return I.scores(spark, d).select("chromosome", "position", "sample", G.chi_squared(F.col("u").cast("double"), F.col("v").cast("double")).alias("chi2"))


def _tail_sql(x: str, df: str) -> str:
    """Upper tail of chi-squared: one less the lower tail's series, all of whose terms are positive; right to 1e-14, 0 far out."""
    terms = f"list_sum(list_transform(range(0, 400), lambda k: exp(({df} / 2.0::DOUBLE + k) * ln({x} / 2) - {x} / 2 - lgamma({df} / 2.0::DOUBLE + k + 1))))"
    return f"CASE WHEN {x} IS NULL OR {df} <= 0 THEN NULL WHEN {x} <= 0 THEN 1.0 WHEN {x} > 250 THEN 0.0 ELSE 1 - {terms} END"


def _log10_sql(x: str) -> str:
    """log10 of the tail with one degree of freedom, by its continued fraction where that is small."""
    fraction = f"list_reduce(range(200, 0, -1), lambda f, k: 1 + k / {x} / f, 1.0::DOUBLE)"
    far = f"(-{x} / 2 - 0.5 * ln(pi() * {x} / 2) - ln({fraction})) / ln(10)"
    return f"CASE WHEN {x} IS NULL THEN NULL WHEN {x} < 8 THEN log10({_tail_sql(x, '1')}) ELSE {far} END"


@query(f"""WITH {I.SCORES}, c AS (SELECT chromosome, position, sample, u::DOUBLE * u::DOUBLE / v::DOUBLE / 1e14 AS x FROM scores)
SELECT chromosome, position, sample, round({_tail_sql("x", "1")}, 10) AS p, round({_log10_sql("x")}, 8) AS log10_p FROM c""")
def score_pvalue(spark, d):
    rows = score_chi2(spark, d).withColumn("chi2", F.col("chi2") / 1e14)
    return rows.select("chromosome", "position", "sample", stats.p_value("chi2").alias("r")).select("chromosome", "position", "sample", F.round("r.p", 10).alias("p"), F.round("r.log10_p", 8).alias("log10_p"))


@query(f"WITH {I.SCORES} SELECT chromosome, position, sample, CASE WHEN v = 1 THEN 0.0 ELSE u::DOUBLE END AS u, CASE WHEN v = 1 THEN 1.0 ELSE (v - 1)::DOUBLE END AS v FROM scores")
def sentinel_zero_v(spark, d):
    rows = I.scores(spark, d)
    return rows.select("chromosome", "position", "sample", G.valid_score(F.col("u").cast("double"), (F.col("v") - 1).cast("double")).alias("s")).select("chromosome", "position", "sample", "s.u", "s.v")


@query(f"""WITH {I.SCORES}, s AS (SELECT *, u::DOUBLE / 1234567.0::DOUBLE AS su FROM scores)
SELECT CASE chromosome WHEN 7 THEN '7' ELSE CAST(chromosome AS VARCHAR) END AS "CHROM", position AS "POS", ref AS "REF", alt AS "ALT", sample AS "N_INFORMATIVE", aaf AS "FOUNDER_AF", aaf AS "ALL_AF",
  CAST(NULL AS DOUBLE) AS "INFORMATIVE_ALT_AC", 1.0::DOUBLE AS "CALL_RATE", 1.0::DOUBLE AS "HWE_PVALUE", 1 AS "N_REF", 1 AS "N_HET", 1 AS "N_ALT",
  round(su, 6) AS "U_STAT", round(sqrt(v::DOUBLE), 9) AS "SQRT_V_STAT", round(su / v, 9) AS "ALT_EFFSIZE", round({_tail_sql("(su * su / v)", "1")}, 9) AS "PVALUE" FROM s""")
def export_projection(spark, d):
    rows = I.scores(spark, d).select(F.col("chromosome"), "position", "ref", "alt", "aaf", (F.col("u") / UNIT).alias("u"), F.col("v").cast("double").alias("v"), F.col("sample").alias("n"))
    out = rmw.record(rows)
    places = {"U_STAT": 6, "SQRT_V_STAT": 9, "ALT_EFFSIZE": 9, "PVALUE": 9}
    return out.select(*(F.round(c, places[c]).alias(c) if c in places else F.col(c) for c in out.columns))


# ---- meta-analysis -----------------------------------------------------------------------------------------

_STUDIES = [0, 1, 2, 3, 4]
_DIRECTION = " || ".join(f"coalesce(max(CASE WHEN study = {s} THEN CASE WHEN u > 0 THEN '+' WHEN u < 0 THEN '-' ELSE '0' END END), '?')" for s in _STUDIES)
_META = f"""WITH {I.SCORES}, {I.MARKERS}, meta AS (
  SELECT chromosome, position, count(*) AS studies, CAST(sum(u) AS BIGINT) AS u, CAST(sum(v) AS BIGINT) AS v, CAST(sum(n) AS BIGINT) AS sample_count, CAST(sum(d) AS BIGINT) AS d,
    min(d) AS min_d, max(d) AS max_d, {_DIRECTION} AS direction FROM markers GROUP BY chromosome, position)"""


def _meta(spark, d) -> DataFrame:
    """With weights v the estimate is sum u / sum v, so all sums are whole numbers."""
    sign = F.when(F.col("u") > 0, "+").when(F.col("u") < 0, "-").otherwise("0")
    marks = [F.coalesce(F.max(F.when(F.col("study") == s, sign)), F.lit("?")) for s in _STUDIES]
    return I.marker_scores(spark, d).groupBy("chromosome", "position").agg(
        F.count("*").alias("studies"), F.sum("u").alias("u"), F.sum("v").alias("v"), F.sum("n").alias("sample_count"), F.sum("d").alias("d"), F.min("d").alias("min_d"), F.max("d").alias("max_d"),
        F.concat(*marks).alias("direction"),
    )


def _effects(spark, d) -> DataFrame:
    """A row for each marker and study, as a study's score table gives it."""
    u, v = F.col("u") / UNIT, F.col("v").cast("double")
    return I.marker_scores(spark, d).select("chromosome", "position", "study", G.effect(u, v).alias("effect"), G.standard_error(v).alias("std_err"), (F.col("d") * 5 / 100.0 / F.col("n")).alias("freq"), "n")


def _combined(spark, d) -> DataFrame:
    return meta.fixed_effect(_effects(spark, d), ["chromosome", "position"], _STUDIES)


@query(_META + """ SELECT chromosome, position, studies, round(u::DOUBLE / 1234567.0::DOUBLE / v::DOUBLE, 6) AS effect, round(1 / sqrt(v::DOUBLE), 9) AS std_err, round((u / 1234567.0::DOUBLE) * (u / 1234567.0::DOUBLE) / v::DOUBLE, 5) AS chi2
FROM meta WHERE studies > 1""")
def meta_fixed_effect(spark, d):
    out = _combined(spark, d).where("het_df > 0")
    return out.select("chromosome", "position", (F.col("het_df") + 1).alias("studies"), F.round("effect", 6).alias("effect"), F.round("std_err", 9).alias("std_err"), F.round("chi2", 5).alias("chi2"))


@query(_META + """, q AS (SELECT m.chromosome, m.position, any_value(m.studies) AS studies, sum(pow((s.u::DOUBLE / s.v - m.u::DOUBLE / m.v) / 1234567.0::DOUBLE, 2) * s.v) AS q
  FROM meta m JOIN markers s ON s.chromosome = m.chromosome AND s.position = m.position GROUP BY 1, 2)
SELECT chromosome, position, studies - 1 AS het_df, round(q, 4) AS het_chisq FROM q WHERE studies > 1""")
def meta_heterogeneity(spark, d):
    return _combined(spark, d).where("het_df > 0").select("chromosome", "position", "het_df", F.round("het_chisq", 4).alias("het_chisq"))


@query(_META + " SELECT chromosome, position, direction, CAST(length(direction) - length(replace(replace(replace(direction, '+', ''), '-', ''), '0', '')) AS INTEGER) AS present FROM meta")
def meta_direction(spark, d):
    return _combined(spark, d).select("chromosome", "position", "direction", G.studies_present(F.col("direction")).alias("present"))


@query(_META + """ SELECT chromosome, position, sample_count, direction FROM meta WHERE 2 * sample_count > (SELECT max(sample_count) FROM meta)
AND length(replace(direction, '?', '')) > 1 AND NOT (chromosome % 2 = 0 AND min_d * 5 <= 50 AND max_d * 5 >= 50)""")
def meta_qc_filter(spark, d):
    alleles = F.when(F.col("chromosome") % 2 == 0, "t").otherwise("c")
    m = _meta(spark, d).withColumns({"allele1": F.lit("a"), "allele2": alleles, "min_freq": F.col("min_d") * 5 / 100.0, "max_freq": F.col("max_d") * 5 / 100.0})
    return meta.quality_filter(m, present_only=True).select("chromosome", "position", "sample_count", "direction")


_FULL = f"""WITH {I.SCORES}, {I.MARKERS}, e AS (
  SELECT chromosome, position, study, u::DOUBLE / 1234567.0::DOUBLE / v AS b, v::DOUBLE AS w, CASE WHEN study % 2 = 0 THEN d * 5 / 100.0::DOUBLE / n ELSE 1 - d * 5 / 100.0::DOUBLE / n END AS f, n,
    CASE WHEN study % 2 = 0 THEN 1 ELSE -1 END AS turn FROM markers
), a AS (SELECT *, turn * b AS t FROM e), g AS (
  SELECT chromosome, position, count(*) - 1 AS het_df, sum(w * t) / sum(w) AS effect, 1 / sqrt(sum(w)) AS std_err, CAST(sum(n) AS BIGINT) AS sample_count, sum(n * f) / sum(n) AS freq1,
    sum(n * f * f) / sum(n) AS ff, min(f) AS min_freq, max(f) AS max_freq, {" || ".join(f"coalesce(max(CASE WHEN study = {s} THEN CASE WHEN t > 0 THEN '+' WHEN t < 0 THEN '-' ELSE '0' END END), '?')" for s in _STUDIES)} AS direction
  FROM a GROUP BY chromosome, position
), h AS (
  SELECT g.chromosome, g.position, sum(w * pow(t - effect, 2)) AS q FROM a JOIN g ON g.chromosome = a.chromosome AND g.position = a.position GROUP BY 1, 2
), r AS (SELECT g.*, q, pow(effect / std_err, 2) AS x FROM g JOIN h ON h.chromosome = g.chromosome AND h.position = g.position)
SELECT chromosome, position, 'a' AS allele1, 'c' AS allele2, round(freq1, 9) AS freq1, round(sqrt(greatest(ff - freq1 * freq1, 0)), 4) AS freq_se, round(min_freq, 9) AS min_freq, round(max_freq, 9) AS max_freq,
  round(effect, 6) AS effect, round(std_err, 9) AS std_err, round(x, 5) AS chi2, direction, CASE WHEN het_df = 0 THEN 0.0 ELSE round(100 * greatest(0, (q - het_df) / q), 3) END AS het_isq, round(q, 4) AS het_chisq,
  het_df, sample_count, round({_tail_sql("(CASE WHEN het_df = 0 THEN NULL ELSE q END)", "het_df")}, 6) AS het_p_value, round({_tail_sql("x", "1")}, 8) AS p_value, round({_log10_sql("x")}, 5) AS log10_p FROM r"""


@query(_FULL)
def meta_full(spark, d):
    """All output columns, from single-study effects by the general operator; odd studies name the alleles the other way."""
    even = F.col("study") % 2 == 0
    rows = _effects(spark, d).withColumns({"ref": F.when(even, "A").otherwise("C"), "alt": F.when(even, "C").otherwise("A")})
    out = meta.fixed_effect(meta.align_alleles(rows), ["chromosome", "position", "allele1", "allele2"], _STUDIES)
    out = out.select("*", stats.p_value("chi2").alias("_p"), stats.chi2_tail("het_chisq", "het_df").alias("het_p_value"))
    out = out.withColumns({"p_value": F.col("_p.p"), "log10_p": F.col("_p.log10_p"), "het_isq": F.when(F.col("het_df") == 0, 0.0).otherwise(F.col("het_isq")), "het_chisq": F.when(F.col("het_df") == 0, 0.0).otherwise(F.col("het_chisq"))}).drop("_p")
    places = {"freq1": 9, "freq_se": 4, "min_freq": 9, "max_freq": 9, "effect": 6, "std_err": 9, "chi2": 5, "het_isq": 3, "het_chisq": 4, "het_p_value": 6, "p_value": 8, "log10_p": 5}
    return out.select(*(F.round(c, places[c]).alias(c) if c in places else F.col(c) for c in out.columns))


@query(f"""WITH {I.SCORES}, s AS (SELECT study, u::DOUBLE / v AS beta FROM scores WHERE d <> 5)
SELECT study, count(*) AS n, min(beta) AS minimum, round(quantile_cont(beta, 0.25), 3) AS lower_quartile, round(quantile_cont(beta, 0.5), 3) AS median, round(quantile_cont(beta, 0.75), 3) AS upper_quartile, max(beta) AS maximum FROM s GROUP BY study""")
def summary_by_study(spark, d):
    rows = I.scores(spark, d).where("d <> 5").select("study", (F.col("u").cast("double") / F.col("v")).alias("value"))
    out = variables.summaries(rows, "study")
    return out.select("study", "n", "minimum", *(F.round(q, 3).alias(q) for q in stats.SUMMARY[1:4]), "maximum")


_PANEL = "panel AS (SELECT p_partkey AS position, CASE WHEN p_partkey % 3 = 0 THEN 'rs' || p_partkey ELSE p_partkey || ':x' END AS id, p_size FROM part WHERE p_partkey % 4 <> 0)"


def _panel(spark, d) -> DataFrame:
    k = F.col("p_partkey")
    return I.table(spark, d, "part").where(k % 4 != 0).select(k.alias("position"), F.when(k % 3 == 0, F.concat(F.lit("rs"), k.cast("string"))).otherwise(F.concat(k.cast("string"), F.lit(":x"))).alias("id"), "p_size")


@query(_META + f", {_PANEL} SELECT chromosome, m.position, id, CAST(p_size AS DOUBLE) AS p_size FROM meta m LEFT JOIN panel p ON p.position = m.position")
def legend_left_join(spark, d):
    marker = F.col("position").cast("string").alias("marker_name")
    legends = _panel(spark, d).select(marker, F.col("id").alias("rsid"), F.col("p_size").cast("double").alias("all.aaf"))
    out = meta.legend_join(_meta(spark, d).select("chromosome", "position", marker), legends, "none.aaf", fallback="all.aaf")
    return out.select("chromosome", "position", F.col("rsid").alias("id"), F.col("panel_freq").alias("p_size"))


@query(f"WITH {I.SCORES}, {_PANEL} SELECT DISTINCT s.chromosome, s.position, p.id FROM scores s JOIN panel p ON p.position = s.position WHERE p.id LIKE 'rs%'")
def snplist_inner_join(spark, d):
    rows = I.scores(spark, d).select("chromosome", "position").distinct()
    return rows.join(_panel(spark, d).where(F.col("id").startswith("rs")), "position").select("chromosome", "position", "id")


@query(f"WITH {_PANEL} SELECT position, CASE WHEN id LIKE 'rs%' THEN id WHEN position = 23 THEN '23' END AS rsid, CASE WHEN id LIKE 'rs%' THEN id WHEN position = 23 THEN '23' ELSE 'm' || position END AS snp FROM panel")
def coalesce_rsid(spark, d):
    rsid = G.legend_rsid(F.col("id"), F.col("position"))
    return _panel(spark, d).select("position", rsid.alias("rsid")).withColumn("snp", G.snp_name(F.col("rsid"), F.concat(F.lit("m"), F.col("position").cast("string"))))


@query(f"""WITH {I.SCORES}, {I.MARKERS} SELECT chromosome, position, {", ".join(f"max(CASE WHEN study = {s} THEN u END) AS s{s}_u, max(CASE WHEN study = {s} THEN v END) AS s{s}_v" for s in _STUDIES)}
FROM markers GROUP BY chromosome, position""")
def marker_full_outer_merge(spark, d):
    rows = I.marker_scores(spark, d)
    return meta.merge_tables({f"s{s}": rows.where(F.col("study") == s) for s in _STUDIES}, ["chromosome", "position"], ["u", "v"])


@query(f"""WITH {I.SCORES} SELECT chromosome, position, sample, CASE WHEN chromosome % 2 = 0 THEN 1 - d * 5 / 100.0::DOUBLE ELSE d * 5 / 100.0::DOUBLE END AS freq FROM scores""")
def allele_swap_eaf(spark, d):
    even = F.col("chromosome") % 2 == 0
    rows = I.scores(spark, d).select("chromosome", "position", "sample", F.when(even, "c").otherwise("a").alias("allele1"), F.when(even, "a").otherwise("c").alias("allele2"), F.lit("A").alias("a1"), F.lit("C").alias("a0"), (F.col("d") * 5 / 100.0).alias("freq1"))
    return meta.panel_frequency(rows).select("chromosome", "position", "sample", "freq")


@query(_META + """, c AS (SELECT u::DOUBLE * u::DOUBLE / v::DOUBLE AS chi2 FROM meta)
SELECT row_number() OVER (ORDER BY chi2 DESC) AS rank, (row_number() OVER (ORDER BY chi2 DESC) - 0.5::DOUBLE) / count(*) OVER () AS expected, chi2 AS observed FROM c""")
def qq_points(spark, d):
    u, v = F.col("u").cast("double"), F.col("v").cast("double")
    return meta.qq_points(_meta(spark, d).select(G.chi_squared(u, v).alias("chi2")))


@query(_META + f" SELECT quantile_cont(u::DOUBLE * u::DOUBLE / v::DOUBLE, 0.5) / {stats.CHI2_MEDIAN!r} AS lambda_gc FROM meta")
def lambda_gc(spark, d):
    u, v = F.col("u").cast("double"), F.col("v").cast("double")
    return variables.lambda_gc(_meta(spark, d).select(G.chi_squared(u, v).alias("chi2")))


@query(f"""WITH {I.SCORES}, {_OFFSETS} SELECT s.chromosome, s.position + o.offs AS x, sample, u::DOUBLE * u::DOUBLE / v::DOUBLE AS chi2 FROM scores s JOIN offsets o ON o.chromosome = s.chromosome
WHERE d <> 5 AND coalesce({_CLOSE.format(_FOLD.format("aaf"), "0.1")}, false) AND (r2 IS NULL OR {_CLOSE.format("r2", "0.75")})""")
def manhattan_points(spark, d):
    u, v = F.col("u").cast("double"), F.col("v").cast("double")
    kept = I.scores(spark, d).where(G.variant_mask([F.col("aaf")], F.col("r2"), 0.1, 0.75)).where(~G.is_close(u, 0.0))
    return kept.select("chromosome", G.genome_position(F.col("chromosome"), F.col("position")).alias("x"), "sample", G.chi_squared(u, v).alias("chi2"))


@query(f"""WITH {I.SCORES}, s AS (SELECT study, chromosome, count(*) AS n, quantile_cont(1 / sqrt(v::DOUBLE), 0.5) AS se FROM scores GROUP BY 1, 2)
SELECT round(regr_slope(1 / se, sqrt(n)), 6) AS slope, round(regr_intercept(1 / se, sqrt(n)), 5) AS intercept FROM s""")
def se_n_regression(spark, d):
    return meta.se_n_fit(meta.se_n(I.scores(spark, d).select("study", "chromosome", (1 / F.sqrt(F.col("v").cast("double"))).alias("std_err")), "study", "chromosome")).select(F.round("slope", 6).alias("slope"), F.round("intercept", 5).alias("intercept"))


@query(f"""WITH {I.SCORES}, {I.MARKERS}, z AS (SELECT chromosome || '-' || study AS phenotype, position, d::DOUBLE AS z, v::DOUBLE AS n, CASE WHEN (position + study) % 2 = 0 THEN 'A' ELSE 'G' END AS allele FROM markers),
names AS (SELECT DISTINCT phenotype FROM z), wanted AS (SELECT p_partkey % 10 AS piece, p_partkey AS ord, 'rs' || p_partkey AS snp, phenotype FROM part, names)
SELECT CAST(piece AS INTEGER) AS piece, ord, snp, w.phenotype, round(coalesce(CASE WHEN allele = 'A' THEN 1.0 ELSE -1.0 END * z / sqrt(n), 0.0), 9) AS effect FROM wanted w LEFT JOIN z ON z.phenotype = w.phenotype AND z.position = w.ord""")
def marginal_effects(spark, d):
    key = F.col("p_partkey")
    name = F.concat(F.lit("rs"), key.cast("string"))
    reference = I.table(spark, d, "part").select((key % 10).cast("int").alias("piece"), key.alias("ord"), name.alias("snp"), F.lit("A").alias("ref_allele"))
    m = I.marker_scores(spark, d)
    allele = F.when((F.col("position") + F.col("study")) % 2 == 0, "A").otherwise("G")
    z = m.select(F.concat_ws("-", "chromosome", "study").alias("phenotype"), F.concat(F.lit("rs"), F.col("position").cast("string")).alias("snp"), F.col("d").cast("double").alias("z"), F.col("v").cast("double").alias("n"), allele.alias("allele"))
    return hdl.marginal_effects(reference, z).select("piece", "ord", "snp", "phenotype", F.round("effect", 9).alias("effect"))


@query(f"""WITH {I.SCORES}, s AS (SELECT study, position % 20 AS block, d::DOUBLE AS ld, v::DOUBLE AS chi2 FROM scores),
b AS (SELECT study, block, count(*)::DOUBLE AS w, sum(ld) AS x, sum(chi2) AS y, sum(ld * ld) AS xx, sum(ld * chi2) AS xy FROM s GROUP BY 1, 2),
t AS (SELECT study, sum(w) AS w, sum(x) AS x, sum(y) AS y, sum(xx) AS xx, sum(xy) AS xy FROM b GROUP BY 1),
j AS (SELECT b.study, (((t.w - b.w) * (t.xy - b.xy) - (t.x - b.x) * (t.y - b.y)) / ((t.w - b.w) * (t.xx - b.xx) - (t.x - b.x) * (t.x - b.x))) AS slope FROM b JOIN t ON t.study = b.study)
SELECT t.study, any_value((t.w * t.xy - t.x * t.y) / (t.w * t.xx - t.x * t.x)) AS slope, round(sqrt((count(*) - 1) * var_pop(j.slope)), 8) AS slope_se, count(*) AS blocks
FROM t JOIN j ON j.study = t.study GROUP BY t.study""")
def ld_score_regression(spark, d):
    s = I.scores(spark, d).select("study", (F.col("position") % 20).alias("block"), F.col("d").cast("double").alias("ld"), F.col("v").cast("double").alias("chi2"), F.lit(1.0).alias("weight"))
    out = ldsc.regression(ldsc.block_sums(s, "study"), "study")
    return out.select("study", "slope", F.round("slope_se", 8).alias("slope_se"), "blocks")


# ---- variables ---------------------------------------------------------------------------------------------


@query(f"""WITH {I.PHENOTYPES} SELECT variable, count(*) AS n, min(value)::DOUBLE AS minimum, quantile_cont(value::DOUBLE, 0.25) AS lower_quartile, quantile_cont(value::DOUBLE, 0.5) AS median,
  quantile_cont(value::DOUBLE, 0.75) AS upper_quartile, max(value)::DOUBLE AS maximum, round(sum(value)::DOUBLE / count(*), 3) AS mean FROM pheno GROUP BY variable""")
def variable_summary(spark, d):
    rows = I.phenotypes(spark, d).withColumn("value", F.col("value").cast("double"))
    return variables.summaries(rows, "variable").select("variable", "n", *stats.SUMMARY, F.round("mean", 3).alias("mean"))


@query("""WITH a AS (SELECT c_custkey AS sample_id, c_nationkey AS x, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_nationkey END AS y FROM customer WHERE c_custkey % 2 = 0),
b AS (SELECT c_custkey AS sample_id, c_nationkey + 100 AS y, c_mktsegment AS z FROM customer WHERE c_custkey % 5 <> 0)
SELECT coalesce(a.sample_id, b.sample_id) AS sample_id, a.x, coalesce(a.y, b.y) AS y, b.z FROM a FULL JOIN b ON a.sample_id = b.sample_id""")
def combine_first_full_outer(spark, d):
    c = I.table(spark, d, "customer").withColumnRenamed("c_custkey", "sample_id")
    a = c.where("sample_id % 2 = 0").select("sample_id", F.col("c_nationkey").alias("x"), F.when(F.col("sample_id") % 3 != 0, F.col("c_nationkey")).alias("y"))
    b = c.where("sample_id % 5 <> 0").select("sample_id", (F.col("c_nationkey") + 100).alias("y"), F.col("c_mktsegment").alias("z"))
    return variables.combine([a, b])


@query("SELECT c_custkey AS sample_id FROM customer INTERSECT SELECT o_custkey FROM orders WHERE o_orderpriority LIKE '1%' INTERSECT SELECT o_custkey FROM orders WHERE o_orderpriority LIKE '2%'")
def sample_intersection(spark, d):
    o = I.table(spark, d, "orders")
    picks = [o.where(F.col("o_orderpriority").startswith(k)).select(F.col("o_custkey").alias("sample_id")) for k in "12"]
    return variables.common_samples([I.table(spark, d, "customer").select(F.col("c_custkey").alias("sample_id")), *picks])


@query(f"""WITH {I.PHENOTYPES} SELECT p.sample_id, p.value AS priority_1, c_nationkey AS covariate FROM pheno p JOIN customer ON c_custkey = p.sample_id
WHERE p.variable = 'priority_1' AND p.sample_id IN (SELECT sample_id FROM pheno WHERE variable = 'priority_2')""")
def sample_alignment_inner(spark, d):
    p = I.phenotypes(spark, d)
    genotyped = p.where("variable = 'priority_2'").select("sample_id")
    wide = p.where("variable = 'priority_1'").select("sample_id", F.col("value").alias("priority_1"))
    return variables.align(genotyped, wide, I.table(spark, d, "customer").select(F.col("c_custkey").alias("sample_id"), F.col("c_nationkey").alias("covariate")))


_WIDE = f"""WITH {I.PHENOTYPES}, wide AS (SELECT c_custkey AS sample_id, {", ".join(f"max(CASE WHEN variable = 'priority_{k}' THEN value END) AS p{k}" for k in "123")}
FROM customer LEFT JOIN pheno ON sample_id = c_custkey GROUP BY c_custkey)"""


def _wide(spark, d) -> DataFrame:
    p = I.phenotypes(spark, d)
    wide = p.groupBy("sample_id").agg(*(F.max(F.when(F.col("variable") == f"priority_{k}", F.col("value"))).alias(f"p{k}") for k in "123"))
    return I.table(spark, d, "customer").select(F.col("c_custkey").alias("sample_id")).join(wide, "sample_id", "left")


@query(_WIDE + " SELECT * FROM wide WHERE p1 IS NOT NULL AND p2 IS NOT NULL AND p3 IS NOT NULL")
def complete_samples(spark, d):
    return variables.drop_missing(_wide(spark, d), ["p1", "p2", "p3"], "complete_samples")


@query(_WIDE + " SELECT * FROM wide WHERE p1 IS NOT NULL OR p2 IS NOT NULL OR p3 IS NOT NULL")
def any_finite_samples(spark, d):
    return variables.drop_missing(_wide(spark, d), ["p1", "p2", "p3"], "listwise_deletion")


@query("""SELECT 'intercept' AS variable, count(*) AS n, true AS constant FROM customer UNION ALL SELECT 'c_nationkey', count(c_nationkey), var_pop(c_nationkey) <= 1e-8 FROM customer
UNION ALL SELECT 'fixed', count(*), true FROM customer""")
def zero_variance_columns(spark, d):
    c = I.table(spark, d, "customer").select("c_nationkey", F.lit(1337.0).alias("fixed"))
    with_one = variables.with_intercept(c, ["c_nationkey"])
    return variables.column_spread(with_one, ["intercept", "c_nationkey", "fixed"]).select("variable", "n", "constant")


@query(f"""WITH {I.PHENOTYPES}, p AS (SELECT variable, count(*) AS n, string_agg(sample_id, ',' ORDER BY sample_id) AS pattern FROM pheno GROUP BY variable)
SELECT n, list_sort(list(variable)) AS variables FROM p GROUP BY n, pattern""")
def missing_pattern_groups(spark, d):
    return variables.pattern_groups(I.phenotypes(spark, d))


_COV = f"""WITH {I.PHENOTYPES}, m AS (SELECT variable, sum(value)::DOUBLE / count(*) AS mean FROM pheno GROUP BY variable),
x AS (SELECT sample_id, p.variable, value - mean AS x FROM pheno p JOIN m ON m.variable = p.variable),
cov AS (SELECT l.variable AS a, r.variable AS b, count(*) AS n, sum(l.x * r.x) / (count(*) - 1) AS covariance FROM x l JOIN x r ON l.sample_id = r.sample_id AND l.variable <= r.variable GROUP BY 1, 2)"""


@query(_COV + " SELECT a, b, n, round(covariance / 1e10, 4) AS covariance FROM cov")
def pairwise_covariance(spark, d):
    return variables.covariance(I.phenotypes(spark, d)).select("a", "b", "n", F.round(F.col("covariance") / 1e10, 4).alias("covariance"))


@query(_COV + ", s AS (SELECT a AS v, sqrt(covariance) AS sd FROM cov WHERE a = b) SELECT a, b, round(covariance / (l.sd * r.sd), 8) AS correlation FROM cov JOIN s l ON l.v = a JOIN s r ON r.v = b")
def correlation_matrix(spark, d):
    return variables.correlation(variables.covariance(I.phenotypes(spark, d))).select("a", "b", F.round("correlation", 8).alias("correlation"))


@query(f"WITH {I.PHENOTYPES} SELECT variable, CAST(sum(value) AS BIGINT) AS total, count(*) AS n FROM pheno GROUP BY ROLLUP (variable)")
def rollup_summary(spark, d):
    return I.phenotypes(spark, d).rollup("variable").agg(F.sum("value").alias("total"), F.count("*").alias("n"))


# ---- dosages -----------------------------------------------------------------------------------------------


@query(f"WITH {I.DOSAGES} SELECT vec_id, chromosome, list_sum(q)::DOUBLE / (2 * len(q) * 10000) AS aaf FROM dosages")
def allele_frequency_all(spark, d):
    total = F.aggregate("q", F.lit(0).cast("bigint"), lambda s, x: s + x)
    return I.dosages(spark, d).select("vec_id", "chromosome", (total.cast("double") / (2 * F.size("q") * 10000)).alias("aaf"))


@query(f"""WITH {I.DOSAGES} SELECT vec_id, list_sum(list_filter(q, lambda x, i: i % 2 = 1))::DOUBLE / (2 * len(list_filter(q, lambda x, i: i % 2 = 1))) / 10000 AS even_aaf,
  list_sum(list_filter(q, lambda x, i: i % 4 = 1))::DOUBLE / (2 * len(list_filter(q, lambda x, i: i % 4 = 1))) / 10000 AS fourth_aaf FROM dosages""")
def allele_frequency_by_collection(spark, d):
    mask = lambda step: F.transform("q", lambda x, i: i % step == 0)
    whole = F.transform("q", lambda x: x.cast("double"))
    return I.dosages(spark, d).select("vec_id", *((association.allele_frequency(whole, mask(k)) / 10000).alias(n) for n, k in (("even_aaf", 2), ("fourth_aaf", 4))))


_STANDARD = f"""WITH {I.DOSAGES}, f AS (SELECT *, list_sum(q)::DOUBLE / len(q) / 10000 AS mean FROM dosages),
c AS (SELECT vec_id, chromosome, unnest(list_transform(q, lambda x: (x / 10000.0::DOUBLE - mean) / sqrt(mean * (1 - mean / 2)))) AS z, unnest(range(0, len(q))) AS i FROM f),
gram AS (SELECT l.chromosome, l.i, r.i AS j, sum(l.z * r.z) AS g FROM c l JOIN c r ON l.vec_id = r.vec_id GROUP BY 1, 2, 3)"""


def _cells(rows: DataFrame) -> DataFrame:
    return rows.select("chromosome", "i", F.posexplode("values").alias("j", "g")).select("chromosome", "i", F.col("j").cast("bigint").alias("j"), F.round("g", 6).alias("g"))


@query(_STANDARD + " SELECT chromosome, i, j, round(g, 6) AS g FROM gram")
def gram_by_chromosome(spark, d):
    return _cells(association.gram(I.dosages(spark, d)))


@query(_STANDARD + " SELECT chromosome, i, j, round(sum(g) OVER (PARTITION BY i, j) - g, 6) AS g FROM gram WHERE chromosome <> 23")
def gram_loco(spark, d):
    return _cells(association.leave_one_out(association.gram(I.dosages(spark, d))))


@query(_STANDARD + " SELECT chromosome, i, j, round(g, 6) AS g FROM gram")
def kinship_triangular(spark, d):
    """R'R of the triangular factors, which is the matrix itself."""
    r = association.triangular(I.dosages(spark, d)).select("chromosome", "i", F.posexplode("values").alias("j", "x"))
    both = r.toDF("chromosome", "k", "i", "x").join(r.toDF("chromosome", "k", "j", "y"), ["chromosome", "k"])
    cells = both.groupBy("chromosome", F.col("i").cast("bigint").alias("i"), F.col("j").cast("bigint").alias("j"))
    return cells.agg(F.round(F.sum(F.col("x") * F.col("y")), 6).alias("g"))


#: Fixed null models for score tests: weights of 3 phenotypes, eigenvectors and variances of 4 coordinates.
_W = "((i + p) % 7 - 3)"
_Q = "((i * (k + 1)) % 5 - 2)"
_V = "((k + 1) * (p + 2) * 1.1::DOUBLE)"


@query(f"""WITH {I.DOSAGES}, s AS (SELECT vec_id, chromosome, q AS g, list_sum(q) AS t, len(q) AS n FROM dosages), m AS (SELECT * FROM s, (SELECT unnest(range(0, 3)) AS p)),
u AS (SELECT *, list_sum(list_transform(g, lambda x, i0: x * {_W.replace("i ", "(i0 - 1) ")})) * n - t * list_sum(list_transform(range(0, n), lambda i: {_W})) AS nu FROM m)
SELECT vec_id, chromosome, 'p' || p AS phenotype, CAST(nu AS BIGINT) AS u FROM u""")
def score_u_closed_form(spark, d):
    """U = g w - mean(g) sum(w), times the sample count: a whole number."""
    out = _score_test(spark, d, F.transform("q", lambda x: x.cast("double")))
    return out.select("vec_id", "chromosome", "phenotype", F.round(F.col("u") * 64).cast("bigint").alias("u"))


@query(f"""WITH {I.DOSAGES}, s AS (SELECT vec_id, chromosome, list_transform(q, lambda x: x / 10000.0::DOUBLE - list_sum(q)::DOUBLE / len(q) / 10000) AS g FROM dosages),
m AS (SELECT vec_id, chromosome, p, list_sum(list_transform(g, lambda x, i0: x * {_W.replace("i ", "(i0 - 1) ")})) AS u,
  list_sum(list_transform(range(0, 4), lambda k: pow(list_sum(list_transform(g, lambda x, i0: x * {_Q.replace("i ", "(i0 - 1) ")})), 2) / {_V})) AS v FROM s, (SELECT unnest(range(0, 3)) AS p))
SELECT vec_id, chromosome, 'p' || p AS phenotype, round(u, 10) AS u, round(v, 7) AS v FROM m""")
def score_test_mixed(spark, d):
    """Score statistics of every variant under fixed null models of three phenotypes."""
    out = _score_test(spark, d, F.col("dosages"))
    return out.select("vec_id", "chromosome", "phenotype", F.round("u", 10).alias("u"), F.round("v", 7).alias("v"))


def _score_test(spark, d, dosages) -> DataFrame:
    import numpy as np

    i, k, p = np.arange(64), np.arange(4), np.arange(3)
    w = ((i[:, None] + p) % 7 - 3).astype(float)
    q = ((i[:, None] * (k + 1)) % 5 - 2).astype(float)
    v = (k[:, None] + 1) * (p + 2) * 1.1
    return association.score_block(I.dosages(spark, d).withColumn("dosages", dosages), w, q, v, ["p0", "p1", "p2"], ["vec_id", "chromosome"])


@query(f"WITH {I.DOSAGES} SELECT vec_id, list_transform([63, 0, 31, 7], lambda i: q[i + 1]) AS chosen FROM dosages WHERE chromosome <> 3 AND chromosome <> 23")
def sample_selection(spark, d):
    rows = I.dosages(spark, d).where("chromosome <> 3 and chromosome <> 23")
    return rows.select("vec_id", association.select_samples(F.col("q"), [63, 0, 31, 7]).alias("chosen"))


# ---- tags and jobs -----------------------------------------------------------------------------------------


def _tag(spark, d) -> DataFrame:
    return index.build(I.names(spark, d))


@query(f"WITH {I.NAMES} SELECT * FROM tag")
def tag_parse(spark, d):
    return _tag(spark, d)


@query(f"WITH {I.NAMES} SELECT phenotype, 'ds-' || ds || '_brand-' || brand || coalesce('_size_class-' || size_class, '') || '_stat-' || stat || coalesce('_' || suffix, '') AS name FROM parts")
def tag_format(spark, d):
    return I.names(spark, d).select("phenotype", T.format_tags(T.parse(F.col("name"))).alias("name"))


@query(f"WITH {I.NAMES} SELECT phenotype FROM parts WHERE brand LIKE 'Brand%1' AND stat = 'z' AND size_class IN ('small', 'mid')")
def tag_query_glob(spark, d):
    return index.query(_tag(spark, d), brand="Brand*1", stat="z", size_class=["small", "mid"])


@query(f"WITH {I.NAMES} SELECT phenotype FROM parts WHERE size_class IS NULL AND suffix IS NOT NULL")
def tag_query_missing_key(spark, d):
    return index.query(_tag(spark, d), size_class=None, suffix="*")


_GROUPS = f"WITH {I.NAMES}, grp AS (SELECT brand, size_class, list_sort(list(DISTINCT phenotype)) AS members FROM parts GROUP BY brand, size_class HAVING count(DISTINCT phenotype) >= 5)"


@query(_GROUPS + " SELECT * FROM grp")
def tag_groups(spark, d):
    return index.groups(_tag(spark, d), ["brand", "size_class"])


@query(f"""WITH {I.NAMES} SELECT phenotype, 'stat' AS key, 'effect' AS value FROM parts p WHERE stat = 'z' AND NOT EXISTS (
SELECT 1 FROM parts o WHERE o.stat = 'effect' AND o.brand = p.brand AND o.size_class IS NOT DISTINCT FROM p.size_class AND o.suffix IS NOT DISTINCT FROM p.suffix)""")
def tag_alternatives(spark, d):
    return index.alternative(_tag(spark, d), "stat", "z", "effect", ignore=("ds",))


@query(f"""WITH {I.NAMES}, alt AS (SELECT brand, size_class, phenotype FROM parts UNION ALL SELECT brand, 'mixed', phenotype FROM parts WHERE size_class = 'small'),
g AS (SELECT brand, size_class, list_sort(list(DISTINCT phenotype)) AS members FROM alt GROUP BY 1, 2 HAVING count(DISTINCT phenotype) >= 5)
SELECT members, count(*) AS tuples, max(brand) AS brand, min(CASE WHEN size_class = 'mixed' THEN NULL ELSE size_class END) AS size_class FROM g GROUP BY members""")
def job_member_sets(spark, d):
    tag = _tag(spark, d)
    other = index.alternative(tag, "size_class", "small", "mixed")
    keys = ["brand", "size_class"]
    return index.member_sets(index.groups(tag, keys, other), keys, other)


@query(_GROUPS + """, f AS (SELECT brand, size_class, unnest(members) AS phenotype FROM grp)
SELECT f.brand, f.size_class, ds AS study, count(*) AS n FROM f JOIN parts p ON p.phenotype = f.phenotype GROUP BY 1, 2, 3 HAVING count(*) > 1""")
def duplicate_study_check(spark, d):
    tag = _tag(spark, d)
    return index.duplicate_studies(index.groups(tag, ["brand", "size_class"]), tag, ["brand", "size_class"])


@query(f"""WITH {I.NAMES} SELECT phenotype, CASE key WHEN 'stat' THEN 'kind' ELSE key END AS key, CASE WHEN key = 'size_class' AND value = 'mid' THEN 'medium' ELSE value END AS value
FROM tag WHERE key <> 'suffix' AND phenotype NOT IN (SELECT phenotype FROM tag WHERE key = 'ds' AND value = 's3')""")
def tag_rewrites(spark, d):
    return index.rewrite(_tag(spark, d), [{"ds": "s3"}], [("stat", "kind")], ["suffix"], [("size_class", "mid", "medium")])


@query(f"""WITH {I.NAMES} SELECT * FROM tag WHERE CAST(phenotype AS BIGINT) % 2 = 0 UNION ALL SELECT phenotype, key, value || '!' FROM tag WHERE CAST(phenotype AS BIGINT) % 3 = 0 AND CAST(phenotype AS BIGINT) % 2 <> 0""")
def tag_union(spark, d):
    tag, number = _tag(spark, d), F.col("phenotype").cast("bigint")
    return index.update(tag.where(number % 2 == 0), tag.where(number % 3 == 0).withColumn("value", F.concat("value", F.lit("!"))))


@query(f"""WITH {I.NAMES} SELECT t.key, t.value, count(DISTINCT t.phenotype) AS phenotypes, count(DISTINCT p.ds) AS studies FROM tag t JOIN parts p ON p.phenotype = t.phenotype GROUP BY 1, 2""")
def studies_by_tag(spark, d):
    return index.value_report(_tag(spark, d))


@query("SELECT a.n_name AS phenotype1, b.n_name AS phenotype2 FROM nation a JOIN nation b ON a.n_name < b.n_name")
def phenotype_pairs(spark, d):
    n = I.table(spark, d, "nation").select("n_name")
    return n.toDF("phenotype1").join(n.toDF("phenotype2"), F.col("phenotype1") < F.col("phenotype2"))


@query("""SELECT a.n_name AS phenotype1, b.n_name AS phenotype2, CAST(r_regionkey AS SMALLINT) AS piecewise_index FROM nation a JOIN nation b ON a.n_name <= b.n_name CROSS JOIN region
WHERE NOT (a.n_nationkey % 2 = 0 AND a.n_name = b.n_name)""")
def resume_anti_join(spark, d):
    nation = I.table(spark, d, "nation")
    pieces = I.table(spark, d, "region").select(F.col("r_regionkey").alias("piece"))
    phenotypes = nation.select(F.col("n_name").alias("phenotype"))
    done = hdl.jobs(nation.where("n_nationkey % 2 = 0").select(F.col("n_name").alias("phenotype")), pieces, "piecewise").where("phenotype1 = phenotype2")
    return hdl.jobs(phenotypes, pieces, "piecewise", done).select("phenotype1", "phenotype2", "piecewise_index")


@query(f"""WITH {I.SCORES}, p AS (SELECT study, chromosome, CAST(sum(u) AS BIGINT) AS s FROM scores GROUP BY 1, 2)
SELECT study, chromosome, CAST(sum(s) OVER (PARTITION BY study) - s AS BIGINT) AS without FROM p""")
def jackknife_leave_one_out(spark, d):
    p = I.scores(spark, d).groupBy("study", "chromosome").agg(F.sum("u").alias("s"))
    total = p.groupBy("study").agg(F.sum("s").alias("t"))
    return p.join(total, "study").select("study", "chromosome", (F.col("t") - F.col("s")).alias("without"))


# ---- stratification ----------------------------------------------------------------------------------------


@query(f"WITH {I.CLASSES} SELECT sample, class FROM classes WHERE variable = 'balance'")
def range_groups(spark, d):
    return I.classes(spark, d).where("variable = 'balance'").select("sample", "class")


@query(f"""WITH {I.CLASSES}, big AS (SELECT variable, class FROM classes GROUP BY 1, 2 HAVING count(DISTINCT sample) >= 10),
kept AS (SELECT c.* FROM classes c SEMI JOIN big b ON b.variable = c.variable AND b.class = c.class),
a AS (SELECT variable, class, sample FROM kept UNION ALL SELECT DISTINCT variable, 'mixed', sample FROM kept WHERE variable IN (SELECT variable FROM kept GROUP BY variable HAVING count(DISTINCT class) > 1))
SELECT variable, class, count(*) AS n FROM a GROUP BY 1, 2""")
def mixed_class(spark, d):
    kept = stratify.prune(I.classes(spark, d), 10)
    return stratify.with_mixed(kept).groupBy("variable", "class").agg(F.count("*").alias("n"))


@query(f"""WITH {I.CLASSES} SELECT a.class AS balance, b.class AS segment, count(DISTINCT a.sample) AS n FROM classes a JOIN classes b ON a.sample = b.sample
WHERE a.variable = 'balance' AND b.variable = 'segment' GROUP BY 1, 2 HAVING count(DISTINCT a.sample) >= 50""")
def class_cross_product(spark, d):
    return stratify.class_products(I.classes(spark, d), ["balance", "segment"], 50)


@query(f"""WITH {I.CLASSES} SELECT c_custkey AS sample, cents, CASE WHEN c_custkey IN (SELECT sample FROM classes WHERE variable = 'balance' AND class = 'low') THEN cents END AS balance_low_cents FROM cust""")
def masked_phenotypes(spark, d):
    c = I.table(spark, d, "customer").select(F.col("c_custkey").alias("sample"), I.hundredths("c_acctbal").alias("cents"))
    classes = I.classes(spark, d)
    return stratify.masked(c, classes, "balance_low", classes.where("variable = 'balance' and class = 'low'"), ["cents"])


@query("""WITH e AS (SELECT vec_id AS sample, CAST(label AS VARCHAR) AS population, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y FROM embeddings),
r AS (SELECT population, avg(x) AS mx, avg(y) AS my, var_samp(x) AS xx, covar_samp(x, y) AS xy, var_samp(y) AS yy FROM e WHERE sample % 3 = 0 GROUP BY population),
d AS (SELECT sample, r.population, (x - mx) AS a, (y - my) AS b, xx, xy, yy, xx * yy - xy * xy AS det FROM e, r)
SELECT sample, population FROM d WHERE -0.5 * ((yy * a * a - 2 * xy * a * b + xx * b * b) / det + ln(det) + 2 * ln(2 * pi())) > -0.5 * 4 - 0.5 * ln(2 * pi())""")
def population_membership(spark, d):
    """By two components, whose covariances are not diagonal; any number of components works alike."""
    e = I.table(spark, d, "embeddings").select(F.col("vec_id").alias("sample"), F.col("label").cast("string").alias("population"), *(F.col("embedding")[i].cast("double").alias(f"C{i + 1}") for i in range(2)))
    return stratify.membership(e.select("sample", "C1", "C2"), e.where("sample % 3 = 0"), ["C1", "C2"], deviations=2.0)


@query("""SELECT n_nationkey, n_name || '_' || n_regionkey AS both_with_underscore, n_regionkey || '_' || n_regionkey AS double_iid, lower(regexp_replace(regexp_replace(trim(n_name), 'A+', '-', 'g'), '[^\\p{L}\\p{N}]', '', 'g')) AS renamed FROM nation""")
def sample_rename(spark, d):
    n = I.table(spark, d, "nation")
    fid, iid = F.col("n_name"), F.col("n_regionkey").cast("string")
    return n.select("n_nationkey", *(stratify.sample_name(fid, iid, m).alias(m) for m in ("both_with_underscore", "double_iid")), stratify.rename(fid, [("A+", "-")], True, True).alias("renamed"))


@query("""WITH s AS (SELECT CASE WHEN c_custkey % 2 = 0 THEN CAST(c_custkey AS VARCHAR) ELSE c_nationkey || '_' || c_custkey END AS sample FROM customer),
p AS (SELECT CAST(c_nationkey AS VARCHAR) AS fid, CAST(c_custkey AS VARCHAR) AS iid FROM customer WHERE c_custkey % 3 <> 0)
SELECT s.sample, coalesce(a.fid, b.fid) AS fid, coalesce(a.iid, b.iid) AS iid FROM s LEFT JOIN p a ON a.iid = s.sample LEFT JOIN p b ON b.fid || '_' || b.iid = s.sample""")
def sample_id_match(spark, d):
    c = I.table(spark, d, "customer")
    fid, iid = F.col("c_nationkey").cast("string"), F.col("c_custkey").cast("string")
    wanted = c.select(F.when(F.col("c_custkey") % 2 == 0, iid).otherwise(F.concat_ws("_", fid, iid)).alias("sample"))
    return stratify.match_samples(wanted, c.where("c_custkey % 3 <> 0").select(fid.alias("fid"), iid.alias("iid")))


# ---- reshaping and text ------------------------------------------------------------------------------------


@query(f"""WITH {I.SCORES}, s AS (SELECT sample, chromosome, position, study, u, v, d FROM scores) SELECT * FROM (UNPIVOT s ON u, v, d INTO NAME "column" VALUE value)""")
def wide_to_long_transpose(spark, d):
    path = f"{lineage.shared_dir(spark)}/transposed-{uuid.uuid4().hex}"
    keys = ["sample", "chromosome", "position", "study"]
    tables.transpose(I.scores(spark, d).select(*keys, "u", "v", "d"), keys, ["u", "v", "d"], path)
    return spark.read.parquet(path)


@query("SELECT c_custkey, c_name, c_nationkey FROM customer")
def convert_verify(spark, d):
    path = f"{lineage.shared_dir(spark)}/converted-{uuid.uuid4().hex}"
    return tables.convert(I.table(spark, d, "customer"), path, dropped={"c_acctbal", "c_mktsegment"})


@query("SELECT DISTINCT event_type, lower(regexp_replace(event_type || 'CountN', '([a-z\\d])([A-Z])', '\\1_\\2', 'g')) AS snake FROM events")
def snake_case_names(spark, d):
    e = I.table(spark, d, "events").select("event_type").distinct()
    return e.withColumn("snake", G.snake_case(F.concat("event_type", F.lit("CountN"))))


@query("SELECT n_nationkey, n_nationkey || '.5 (0.' || n_regionkey || ')' AS h2, 'usually indicates GC correction' AS ratio FROM nation")
def log_scrape(spark, d):
    log = F.concat(F.lit("Start\nTotal Observed scale h2: "), F.col("n_nationkey").cast("string"), F.lit(".5 (0."), F.col("n_regionkey").cast("string"), F.lit(")\nRatio: usually indicates GC correction.\n"))
    return I.table(spark, d, "nation").select("n_nationkey", G.logged_value(log, "Total Observed scale h2").alias("h2"), G.logged_value(log, "Ratio").alias("ratio"))


# ---- models (checked by numeric tests) ---------------------------------------------------------------------


def _cohort(spark, d):
    """64 samples: kinship from the dosages, two covariates, every variant's dosages as a phenotype."""
    import numpy as np

    from cohortspark.operators import nullmodel

    g = association.gram(I.dosages(spark, d)).collect()  # samples**2 numbers a chromosome
    total = np.zeros((64, 64))
    for r in g:
        total[r.i] += r["values"]
    n = sum({r.chromosome: r.n_variants for r in g}.values())
    lam, q = nullmodel.eigen(total / n + 1e-3 * np.eye(64))
    x = np.column_stack([np.ones(64), np.linspace(-1, 1, 64), np.sin(np.arange(64))])
    y = I.dosages(spark, d).select(F.lit("all").alias("collection"), F.col("vec_id").cast("string").alias("phenotype"), F.col("dosages").alias("y"))
    return y, lam, q, x


def _null(method: str):
    def run(spark, d):
        from cohortspark.operators import nullmodel

        y, lam, q, x = _cohort(spark, d)
        return nullmodel.fit_all(y, {"all": (lam, q)}, {"all": x}, method, partitions=8)

    run.__name__ = f"null_model_{method}"
    return run


for _m in ("fastlmm", "pml", "mpl", "reml", "ml"):
    query()(_null(_m))


@query()
def score_test_fitted(spark, d):
    """Score statistics of every variant with every vector as a phenotype, under their fitted null models."""
    from cohortspark.operators import nullmodel

    y, lam, q, x = _cohort(spark, d)
    names, w, v = nullmodel.gathered(nullmodel.fit_all(y, {"all": (lam, q)}, {"all": x}, "fastlmm", partitions=8), lam, q)
    variants = association.dealt(I.dosages(spark, d).select("vec_id", "chromosome", "dosages"), len(names))
    return association.score_block(variants, w, q, v, names, ["vec_id", "chromosome"])


def _hdl(spark, d, step: str) -> DataFrame:
    """Pairs of all labels: the phenotypes are the labels' mean vectors over every row, in all components."""
    import numpy as np

    rng = np.random.Generator(np.random.PCG64(3))
    rows = [(p, rng.uniform(0.2, 3.0, 64).tolist(), np.linalg.qr(rng.normal(size=(64, 64)))[0].tolist()) for p in range(3)]
    pieces = spark.createDataFrame(rows, "piece int, lam array<double>, vectors array<array<double>>")
    e = I.table(spark, d, "embeddings").select("label", F.posexplode("embedding").alias("ord", "z"))
    b = e.groupBy(F.concat(F.lit("t"), F.col("label").cast("string")).alias("phenotype"), "ord").agg(F.avg(F.col("z").cast("double")).alias("z"))
    effects = pieces.select("piece").crossJoin(b).select("piece", "ord", F.lit("").alias("snp"), "phenotype", (F.col("z").cast("double") / 10).alias("effect"))
    counts = b.groupBy("phenotype").agg(F.lit(900.0).alias("n_min"), F.lit(1000.0).alias("n_median"))
    todo = hdl.jobs(b.select("phenotype").distinct(), pieces, step)
    return hdl.estimate(hdl.rotate(effects, pieces), counts, todo, group=4)


@query()
def hdl_piecewise(spark, d):
    return _hdl(spark, d, "piecewise")


@query()
def hdl_jackknife(spark, d):
    return _hdl(spark, d, "jackknife")


from . import exchange  # noqa: E402, F401  registers its queries
