"""Files by Hadoop paths: what is there, which suffix a stem has, and codecs that Spark's own readers lack."""

from __future__ import annotations

import io
import lzma
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Suffixes of text arrays and tables, in the order in which they are looked for.
SUFFIXES = (".parquet", ".txt.zst", ".txt.gz", ".txt.xz", ".txt.bz2", ".txt.lz4", ".txt")
LINES = 8192


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def is_bfile(spark: SparkSession, stem: str) -> bool:
    """Whether a stem has the three files of a binary genotype set of the first version."""
    return all(exists(spark, f"{stem}{s}") for s in (".bed", ".bim", ".fam"))


def is_pfile(spark: SparkSession, stem: str) -> bool:
    """Whether a stem has the three files of a binary genotype set of the second version."""
    return all(exists(spark, f"{stem}{s}") for s in (".pgen", ".pvar", ".psam"))


def probe(spark: SparkSession, path: str) -> str:
    """The path itself if it has a known suffix or is there, else with the first suffix that is there."""
    if path.endswith(SUFFIXES) or exists(spark, path):
        return path
    for s in SUFFIXES:
        if exists(spark, f"{path}{s}"):
            return f"{path}{s}"
    raise FileNotFoundError(f"{path} with none of {', '.join(SUFFIXES)}")


def open_text(spark: SparkSession, path: str) -> DataFrame:
    """Lines (`value`) of a text file, by its suffix.

    xz and lz4 files are decompressed as a stream, a batch of lines at a time, one task a file; a file may have up to
    2 GB compressed. Everything else is read by Spark, which splits it where the codec can be split.
    """
    if not path.endswith((".xz", ".lz4")):
        return spark.read.text(path)
    raw = spark.read.format("binaryFile").load(path).select("path", "content")

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, content in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                data = io.BytesIO(content)
                stream = lzma.open(data) if name.endswith(".xz") else pa.CompressedInputStream(data, "lz4")
                held: list[str] = []
                for line in io.TextIOWrapper(io.BufferedReader(stream), "utf-8", newline="\n"):
                    held.append(line.rstrip("\r\n"))
                    if len(held) == LINES:
                        yield pa.RecordBatch.from_arrays([pa.array(held, pa.string())], names=["value"])
                        held = []
                yield pa.RecordBatch.from_arrays([pa.array(held, pa.string())], names=["value"])

    return raw.mapInArrow(lines, "value string")
