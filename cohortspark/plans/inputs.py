"""How the star-schema tables stand in for genetic inputs, the same way in Spark and in DuckDB.

Two-decimal numbers become scaled whole numbers first; sums and comparisons are made on those, so that both engines
do the same arithmetic on the same bits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def hundredths(c: str) -> Column:
    return F.round(F.col(c) * 100).cast("bigint")


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score rows from lineitem: u is scaled by 10**4; aaf and r2 are NULL on chromosome 7."""
    li = table(spark, sf_dir, "lineitem")
    d, t, price = hundredths("l_discount"), hundredths("l_tax"), hundredths("l_extendedprice")
    known = F.col("l_linenumber") != 7
    return li.select(
        F.col("l_linenumber").cast("bigint").alias("chromosome"), F.col("l_partkey").alias("position"), F.col("l_returnflag").alias("ref"), F.col("l_linestatus").alias("alt"),
        (F.col("l_suppkey") % 5).alias("study"), d.alias("d"), t.alias("t"), (price * (d - 5)).alias("u"), F.round("l_quantity").cast("bigint").alias("v"),
        F.when(known, d * 5 / 100.0).alias("aaf"), F.when(known, t * 6 / 100.0).alias("aaf2"), F.when(known, (100 - 5 * t) / 100.0).alias("r2"),
        F.col("l_orderkey").alias("sample"),
    )


SCORES = """scores AS (
  SELECT CAST(l_linenumber AS BIGINT) AS chromosome, l_partkey AS position, l_returnflag AS ref, l_linestatus AS alt,
    l_suppkey % 5 AS study, d, t, p * (d - 5) AS u, CAST(round(l_quantity) AS BIGINT) AS v,
    CASE WHEN l_linenumber <> 7 THEN d * 5 / 100.0::DOUBLE END AS aaf, CASE WHEN l_linenumber <> 7 THEN t * 6 / 100.0::DOUBLE END AS aaf2,
    CASE WHEN l_linenumber <> 7 THEN (100 - 5 * t) / 100.0::DOUBLE END AS r2, l_orderkey AS sample
  FROM (SELECT *, CAST(round(l_discount * 100) AS BIGINT) AS d, CAST(round(l_tax * 100) AS BIGINT) AS t,
          CAST(round(l_extendedprice * 100) AS BIGINT) AS p FROM lineitem)
)"""


def marker_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Summed scores of each marker (chromosome, position) and study, of masked rows whose score is not 0."""
    rows = scores(spark, sf_dir).where("least(5 * d, 100 - 5 * d) >= 10 and 100 - 5 * t >= 75 and d <> 5")
    return rows.groupBy("chromosome", "position", "study").agg(F.sum("u").alias("u"), F.sum("v").alias("v"), F.sum("d").alias("d"), F.count("*").alias("n"))


MARKERS = """markers AS (
  SELECT chromosome, position, study, CAST(sum(u) AS BIGINT) AS u, CAST(sum(v) AS BIGINT) AS v, CAST(sum(d) AS BIGINT) AS d, count(*) AS n
  FROM scores WHERE least(5 * d, 100 - 5 * d) >= 10 AND 100 - 5 * t >= 75 AND d <> 5
  GROUP BY chromosome, position, study
)"""


def phenotypes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """sample_id, variable, value: cents that a customer spent by order priority; LATE shares URGENT's samples."""
    o = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("sample_id"), F.substring("o_orderpriority", 1, 1).alias("p")).agg(F.sum(hundredths("o_totalprice")).alias("value"))
    base = o.select("sample_id", F.concat(F.lit("priority_"), "p").alias("variable"), "value")
    return base.unionAll(base.where("variable = 'priority_1'").select("sample_id", F.lit("late").alias("variable"), (F.col("value") * 2).alias("value")))


PHENOTYPES = """base AS (
  SELECT o_custkey AS sample_id, 'priority_' || substr(o_orderpriority, 1, 1) AS variable, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS value
  FROM orders GROUP BY 1, 2
), pheno AS (
  SELECT * FROM base UNION ALL SELECT sample_id, 'late', value * 2 FROM base WHERE variable = 'priority_1'
)"""


def dosages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dosages from embeddings, in ten-thousandths as whole numbers (`q`) and as doubles."""
    e = table(spark, sf_dir, "embeddings")
    q = F.transform("embedding", lambda x: F.round(x.cast("double") * 10000).cast("bigint") + 10000)
    return e.select(F.col("vec_id"), (F.col("label") + 1).cast("bigint").alias("chromosome"), q.alias("q"), F.transform(q, lambda x: x / 10000.0).alias("dosages"))


DOSAGES = """dosages AS (
  SELECT vec_id, CAST(label + 1 AS BIGINT) AS chromosome, list_transform(embedding, lambda x: CAST(round(CAST(x AS DOUBLE) * 10000) AS BIGINT) + 10000) AS q
  FROM embeddings
)"""


def names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """phenotype, name: a structured name of each part, with a keyless token inside a key and sometimes a suffix."""
    p = table(spark, sf_dir, "part")
    key = F.col("p_partkey")
    size, brand, kind = F.col("p_size"), F.regexp_replace("p_brand", "[^A-Za-z0-9]", ""), F.regexp_replace("p_type", "[^A-Za-z]", "")
    name = F.concat(
        F.lit("ds-s"), (key % 4).cast("string"), F.lit("_brand-"), brand, F.when(key % 3 != 0, F.concat(F.lit("_size_class-"), F.when(size < 17, "small").when(size < 34, "mid").otherwise("large"))).otherwise(""),
        F.lit("_stat-"), F.when(key % 2 == 0, "z").otherwise("effect"), F.when(key % 5 == 0, F.concat(F.lit("_"), kind)).otherwise(""),
    )
    return p.select(key.cast("string").alias("phenotype"), name.alias("name"))


NAMES = """parts AS (
  SELECT CAST(p_partkey AS VARCHAR) AS phenotype, 's' || (p_partkey % 4) AS ds, regexp_replace(p_brand, '[^A-Za-z0-9]', '', 'g') AS brand,
    CASE WHEN p_partkey % 3 <> 0 THEN CASE WHEN p_size < 17 THEN 'small' WHEN p_size < 34 THEN 'mid' ELSE 'large' END END AS size_class,
    CASE WHEN p_partkey % 2 = 0 THEN 'z' ELSE 'effect' END AS stat, CASE WHEN p_partkey % 5 = 0 THEN regexp_replace(p_type, '[^A-Za-z]', '', 'g') END AS suffix
  FROM part
), tag AS (
  SELECT phenotype, key, value FROM (
    SELECT phenotype, 'ds' AS key, ds AS value FROM parts UNION ALL SELECT phenotype, 'brand', brand FROM parts
    UNION ALL SELECT phenotype, 'size_class', size_class FROM parts UNION ALL SELECT phenotype, 'stat', stat FROM parts
    UNION ALL SELECT phenotype, 'suffix', suffix FROM parts
  ) WHERE value IS NOT NULL
)"""


def classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """sample, variable, class: balance ranges (overlapping) and market segments of customers."""
    from cohortspark.operators import stratify as S

    c = table(spark, sf_dir, "customer").withColumn("cents", hundredths("c_acctbal"))
    ranges = [("low", -10_000_000, 200_000), ("middle", 150_000, 600_000), ("high", 600_000, 10_000_000)]
    balance = S.range_classes(c, "cents", ranges, "c_custkey").select(F.col("c_custkey").alias("sample"), F.lit("balance").alias("variable"), "class")
    return balance.unionAll(c.select(F.col("c_custkey").alias("sample"), F.lit("segment").alias("variable"), F.col("c_mktsegment").alias("class")))


CLASSES = """cust AS (SELECT *, CAST(round(c_acctbal * 100) AS BIGINT) AS cents FROM customer),
classes AS (
  SELECT c_custkey AS sample, 'balance' AS variable, name AS class
  FROM cust JOIN (VALUES ('low', -10000000, 200000), ('middle', 150000, 600000), ('high', 600000, 10000000)) r(name, lo, hi) ON cents >= lo AND cents < hi
  UNION ALL SELECT c_custkey, 'segment', c_mktsegment FROM cust
)"""
