"""Delimited tables in and out: variables, PLINK side files, score arrays, legends, principal components, summaries."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortspark import lineage
from cohortspark.functions import genetics as G
from cohortspark.operators.variables import combine

from . import files, results


def read_variables(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Phenotypes or covariates: the first column is the sample, `n/a` is missing; several files are combined, the first value counts."""

    def one(path: str) -> DataFrame:
        df = spark.read.option("sep", "\t").option("header", True).option("nullValue", "n/a").csv(path)
        key, *rest = df.columns
        return df.select(F.col(f"`{key}`").alias("sample_id"), *(G.not_nan(F.col(f"`{c}`").cast("double")).alias(c) for c in rest))

    return combine([one(p) for p in paths])


def write_variables(df: DataFrame, path: str) -> None:
    df.write.option("sep", "\t").option("header", True).option("nullValue", "n/a").csv(path)


def long_form(df: DataFrame, columns: list[str]) -> DataFrame:
    """sample_id, variable, value; missing values have no row."""
    return df.unpivot("sample_id", columns, "variable", "value").where("value is not null")


def read_plink(spark: SparkSession, path: str) -> DataFrame:
    """`id` of a .pvar (ID), .psam (IID), .bim or .fam (second column) file."""
    if path.endswith((".bim", ".fam")):
        return spark.read.text(path).select(F.split(F.trim("value"), r"\s+")[1].alias("id"))
    name = "ID" if path.endswith(".pvar") else "IID"
    lines = spark.read.text(path)
    names = lines.where(F.col("value").startswith("#") & ~F.col("value").startswith("##")).head().value.lstrip("#").split()
    rows = lines.where(~F.col("value").startswith("#"))
    return rows.select(F.split("value", r"\s+")[names.index(name)].alias("id"))


def read_score_text(spark: SparkSession, path: str, columns: list[str] | None = None) -> tuple[DataFrame, dict]:
    """(table, metadata) of a text array: a `## json` line, a `# ` header line and tab-separated rows; numbers where all are."""
    lines = files.open_text(spark, files.probe(spark, path))
    meta = lines.where(F.col("value").startswith("##")).head()
    names = lines.where(F.col("value").startswith("# ") | F.col("value").rlike("^#[^#]")).head().value.lstrip("# ").split("\t")
    part = F.split("value", "\t")
    rows = lines.where(~F.col("value").startswith("#")).select(*(F.nullif(part[i], F.lit("NA")).alias(n) for i, n in enumerate(names) if columns is None or n in columns))
    return rows, json.loads(meta.value.lstrip("# ")) if meta else {}


def write_score_text(df: DataFrame, path: str, metadata: dict | None = None, compression: str = "none") -> None:
    """A directory of text parts, each with its own metadata and header lines, so that each can be read by itself."""
    names = df.columns
    head = "\n".join([f"## {json.dumps(metadata or {})}", "# " + "\t".join(names)])

    def with_head(frames):
        import pandas as pd

        first = True
        for f in frames:
            yield pd.DataFrame({"value": [head, *f["value"]]}) if first else f
            first = False

    row = F.concat_ws("\t", *(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("NA")) for c in names))
    df.select(row.alias("value")).mapInPandas(with_head, "value string").write.option("compression", compression).text(path)


#: Ways to write a text array, by name, and Spark's codec for each.
METHODS = {"text": "none", "gzip_text": "gzip", "bzip2_text": "bzip2", "zstd_text": "zstd", "zstd_high_text": "zstd", "zstd_ultra_text": "zstd", "parquet": "zstd"}


def write_score(df: DataFrame, path: str, method: str, metadata: dict | None = None) -> None:
    """A score array by a named method."""
    if method not in METHODS:
        raise ValueError(f"method is one of {', '.join(METHODS)}")
    if method == "parquet":
        results.write_table(df, path, metadata)
    else:
        write_score_text(df, path, metadata, METHODS[method])


def read_score(spark: SparkSession, path: str, columns: list[str] | None = None) -> tuple[DataFrame, dict]:
    """(table, metadata) of a score array in any form; a path without suffix is looked for with every known one."""
    found = files.probe(spark, path)
    if found.endswith(".parquet"):
        return results.read_table(spark, found, columns)
    return read_score_text(spark, found, columns)


def select_rows(df: DataFrame, index: list[int], *order: str) -> DataFrame:
    """Rows at the given places in that order, in the order of the places asked for."""
    wanted = df.sparkSession.createDataFrame([(i, k) for k, i in enumerate(index)], "_at long, _ord long")
    return lineage.ranked(df, *order, name="_at").join(F.broadcast(wanted), "_at").orderBy("_ord").drop("_at", "_ord")


def frequency_columns(spark: SparkSession, paths: dict[int, str]) -> tuple[dict[int, list[str]], list[int]]:
    """Allele-frequency columns by chromosome, from schemas alone, and the chromosomes (without X) that have no file."""
    there = {c: p for c, p in paths.items() if files.exists(spark, p)}
    names = {c: [n for n in spark.read.parquet(p).columns if n.endswith("alternate_allele_frequency") or n.endswith("aaf")] for c, p in there.items()}
    return names, sorted(set(range(1, 23)) - set(there))


def collection_names(summary: DataFrame) -> DataFrame:
    """phenotype, collection of a summary table, one row a phenotype of the first chunk."""
    own = summary.where("role = 'phenotypes'")
    return own.groupBy(F.col("variable").alias("phenotype")).agg(F.min_by("collection", "chunk").alias("collection"))


def read_scores(spark: SparkSession, paths: list[str], required: range = range(1, 23)) -> DataFrame:
    """Score tables of all chromosomes as one; all autosomes must be there and all must have the same columns."""
    out = None
    for p in paths:
        df = spark.read.parquet(p)
        if out is not None and set(df.columns) != set(out.columns):
            raise ValueError(f"{p} has other columns than the tables before it")
        out = df if out is None else out.unionByName(df)
    found = {r.chromosome for r in out.select("chromosome").distinct().collect()}
    if missing := set(required) - found:
        raise ValueError(f"chromosomes {sorted(missing)} are missing")
    return out


def convert(source: DataFrame, path: str, dropped: set[str] = frozenset()) -> DataFrame:
    """Writes the table without the dropped columns as Parquet, reads it again and checks that every cell is there."""
    kept = source.select(*(c for c in source.columns if c not in dropped))
    kept.write.option("compression", "zstd").parquet(path)
    back = source.sparkSession.read.parquet(path)
    if kept.exceptAll(back).head(1) or back.exceptAll(kept).head(1):
        raise ValueError("the written table differs from its source")
    return back


def transpose(scores: DataFrame, keys: list[str], columns: list[str], path: str) -> None:
    """One directory of rows for each column."""
    scores.unpivot(keys, columns, "column", "value").write.partitionBy("column").parquet(path)


def read_legends(spark: SparkSession, paths: dict[int, str]) -> DataFrame:
    """Panel legends by chromosome: space separated with id, position, a0, a1 and frequency columns; adds marker_name and rsid."""
    out = None
    for chromosome, path in paths.items():
        df = spark.read.option("sep", " ").option("header", True).csv(path).withColumn("chromosome", F.lit(chromosome))
        out = df if out is None else out.unionByName(df)
    frequencies = [c for c in out.columns if c.endswith(".aaf")]
    name = F.concat_ws(":", F.col("chromosome").cast("string"), "position", "a0", "a1")
    return out.select(name.alias("marker_name"), G.legend_rsid(F.col("id"), F.col("chromosome")).alias("rsid"), "a0", "a1", *(F.col(f"`{c}`").cast("double").alias(c) for c in frequencies))


def read_mds(spark: SparkSession, path: str, populations: set[str]) -> tuple[DataFrame, DataFrame]:
    """(samples, reference) of principal components: rows whose FID is a population code are the reference."""
    df = spark.read.option("header", True).csv(path)
    components = [c for c in df.columns if c.startswith("C") and c[1:].isdigit()]
    df = df.select(F.trim("FID").alias("fid"), F.trim("IID").alias("iid"), *(F.col(c).cast("double").alias(c) for c in components))
    known = F.col("fid").isin(*populations)
    return df.where(~known), df.where(known).withColumnRenamed("fid", "population")


def read_sumstats(spark: SparkSession, path: str, phenotype: str) -> DataFrame:
    """phenotype, snp, z, n, allele of a summary-statistics table; rows without z go."""
    df = spark.read.option("sep", "\t").option("header", True).option("nullValue", "NA").csv(path)
    return df.select(F.lit(phenotype).alias("phenotype"), F.col("SNP").alias("snp"), F.col("Z").cast("double").alias("z"), F.col("N").cast("double").alias("n"), F.col("A2").alias("allele")).where("z is not null")


def read_summary(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """path, chunk, collection, status, sample_count, role, variable and its statistics from nested YAML.

    With a pattern, of all files below the path whose names fit.
    """
    reader = spark.read.format("binaryFile")
    if pattern is not None:
        reader = reader.option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
    raw = reader.load(path).select("path", "content")
    stats = "minimum double, lower_quartile double, median double, upper_quartile double, maximum double, mean double, variance double"

    def rows(frames):
        import gzip

        import pandas as pd
        import yaml

        names = [c.split()[0] for c in stats.split(", ")]
        for f in frames:
            out = []
            for name, content in zip(f["path"], f["content"], strict=True):
                tree = yaml.safe_load(gzip.decompress(content) if name.endswith(".gz") else content)
                for chunk, collections in tree.items():
                    for collection, c in collections.items():
                        for role in ("phenotypes", "covariates"):
                            for variable, s in (c.get(role) or {}).items():
                                s = s.get("summary", s) if isinstance(s, dict) else {}
                                out.append([name, str(chunk), collection, c.get("status"), c.get("sample_count"), role, variable, *(s.get(n) for n in names)])
            yield pd.DataFrame(out, columns=["path", "chunk", "collection", "status", "sample_count", "role", "variable", *names])

    return raw.mapInPandas(rows, f"path string, chunk string, collection string, status string, sample_count long, role string, variable string, {stats}")
