"""Cutting lineage: tables in the folder that driver and executors share, and ranks that survive lost executors."""

from __future__ import annotations

import atexit
import gc
import shutil
import tempfile
import threading
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


#: `lists`: for each settled() that this thread is in, the paths of the tables written since.
_OPEN = threading.local()


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or in local mode one of our own, gone at exit."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    folder = tempfile.mkdtemp(prefix="cohortspark-")
    atexit.register(shutil.rmtree, folder, True)
    spark.conf.set("spark.checkpoint.dir", f"file://{folder}")
    return f"file://{folder}"


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a table in the shared folder: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    for paths in getattr(_OPEN, "lists", [])[-1:]:
        paths.append(path)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Removes written tables that nothing reads any more: whatever was made from them has been written or collected."""
    for t in tables:
        _remove(t.sparkSession, t._written_path)


def _remove(spark: SparkSession, name: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def settled(make: Callable[[], DataFrame], name: str) -> DataFrame:
    """make()'s rows as a written table; all tables that make() wrote are removed, and the shuffle files of its queries.

    Spark removes shuffle files once the driver collects the garbage that refers to them, which may be long after.
    """
    lists = _OPEN.lists = getattr(_OPEN, "lists", [])
    lists.append(paths := [])
    try:
        df = make()
    finally:
        lists.pop()
    spark, out = df.sparkSession, written(df, name)
    del df
    for p in paths:
        _remove(spark, p)
    gc.collect()
    spark._jvm.System.gc()
    return out


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ranked(df: DataFrame, *order: Column | str, name: str = "rank") -> DataFrame:
    """df with each row's number, from 0, in that order.

    The rows are range-partitioned, sorted and written with their places once, so that a task that runs again finds
    the same ranges; the counts of the ranges, at most one a shuffle partition, are summed up and broadcast. Equal rows
    fall into one range: where one value is frequent, end `order` with something that tells its rows apart.
    """
    n = partitions(df.sparkSession)
    placed = written(df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("_place", F.monotonically_increasing_id()), "ranges")
    part, within = F.shiftright("_place", 33), F.col("_place").bitwiseAND((1 << 33) - 1)
    counts = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    base = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    return placed.join(F.broadcast(base), part == F.col("_part")).withColumn(name, F.col("_base") + within).drop("_place", "_part", "_base")
