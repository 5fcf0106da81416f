"""Result tables on disk: scores, jobs, estimates, states of a run, and a cache by digest."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import files


def write_scores(scores: DataFrame, path: str) -> None:
    """By chromosome, so that a reader of one opens only its files."""
    scores.write.partitionBy("chromosome").option("compression", "zstd").mode("overwrite").parquet(path)


def write_jobs(jobs: DataFrame, path: str, keys: list[str]) -> bool:
    """In directories of the first six keys; False where the same jobs are there already, which stay as they are."""
    spark = jobs.sparkSession
    if files.exists(spark, f"{path}/_SUCCESS"):
        there = spark.read.schema(jobs.schema).json(path).select(*jobs.columns)
        if not there.exceptAll(jobs).head(1) and not jobs.exceptAll(there).head(1):
            return False
    jobs.write.partitionBy(*keys[:6]).mode("overwrite").json(path)
    return True


def write_table(df: DataFrame, path: str, metadata: dict | None = None, compression: str = "zstd") -> None:
    """Parquet files whose footers carry the metadata, with the schema of the first column."""
    first, *rest = df.columns
    noted = df.select(F.col(f"`{first}`").alias(first, metadata={"table": json.dumps(metadata or {}, sort_keys=True)}), *(F.col(f"`{c}`") for c in rest))
    noted.write.option("compression", compression).parquet(path)


def read_table(spark: SparkSession, path: str, columns: list[str] | None = None) -> tuple[DataFrame, dict]:
    """(table, metadata) of write_table(); only the columns' chunks are read."""
    df = spark.read.parquet(path)
    metadata = json.loads(df.schema.fields[0].metadata.get("table", "{}"))
    return (df.select(*columns) if columns else df), metadata


def write_merged(merged: DataFrame, path: str, batch: int = 100_000) -> None:
    """Wide merged markers in genome order, files of at most `batch` markers."""
    merged.orderBy("chromosome", "position").write.option("compression", "zstd").option("maxRecordsPerFile", batch).parquet(path)


#: Columns of the meta-analysis table on disk and their types.
META = (
    "marker_name string, allele1 string, allele2 string, freq1 double, freq_se double, min_freq double, max_freq double, effect double, std_err double, p_value double, direction string, "
    "het_isq double, het_chisq double, het_df int, het_p_value double, sample_count int"
)


def read_meta(spark: SparkSession, path: str) -> DataFrame:
    """A tab-separated meta-analysis table; its header line is replaced by the fixed names."""
    return spark.read.schema(META).option("sep", "\t").option("header", True).option("enforceSchema", True).option("quote", "").csv(path)


def write_meta(result: DataFrame, path: str) -> None:
    names = [f.split()[0] for f in META.split(", ")]
    result.select(*names).write.option("sep", "\t").option("header", True).option("quote", "").csv(path)


def append_estimates(estimates: DataFrame, path: str) -> None:
    """Adds to what is there; files of at most ten million rows."""
    estimates.write.option("maxRecordsPerFile", 10_000_000).option("compression", "zstd").mode("append").parquet(path)


def write_once(df: DataFrame, path: str) -> None:
    """Leaves a table that exists as it is."""
    df.write.mode("ignore").parquet(path)


STATES = ("pending", "null_model_complete", "score_complete")


def record_state(spark: SparkSession, path: str, chunk: str, collection: str, state: str) -> None:
    """A row for each change of state; the latest counts."""
    if state not in STATES:
        raise ValueError(f"state is one of {', '.join(STATES)}")
    spark.createDataFrame([(chunk, collection, state)], "chunk string, collection string, state string").withColumn("at", F.current_timestamp()).write.mode("append").parquet(path)


def states(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).groupBy("chunk", "collection").agg(F.max_by("state", "at").alias("state"))


def digest(arguments: dict, inputs: list[str] = (), spark: SparkSession | None = None) -> str:
    """Digest of arguments and of the names, sizes and times of the input files."""
    files = []
    for p in inputs:
        meta = spark.read.format("binaryFile").option("pathGlobFilter", "*").load(p).select("path", "length", F.col("modificationTime").cast("string").alias("time"))
        files += sorted(tuple(r) for r in meta.collect())
    return hashlib.sha1(json.dumps([arguments, files], sort_keys=True, default=str).encode()).hexdigest()


def cached(spark: SparkSession, root: str, name: str, key: str, make: Callable[[], DataFrame]) -> DataFrame:
    """The table of this name and digest, made and written if it is not there yet."""
    path = f"{root}/{name}-{key}"
    if not files.exists(spark, f"{path}/_SUCCESS"):
        make().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
