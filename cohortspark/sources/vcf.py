"""Dosage VCF text as DataFrames.

Lines are read by Spark's text source (plain, gzip, bzip2 and zstd files; splittable where the codec is), so all
parsing is column expressions and only the asked-for columns are computed. xz and lz4 files are read as streams.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortspark.functions import genetics as G
from cohortspark.operators import association

from . import files

MANDATORY = ("CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", "FORMAT")


def header(lines: DataFrame) -> list[str]:
    """Column names of the `#` line, checked for the nine mandatory ones in their order."""
    row = lines.where(F.col("value").startswith("#") & ~F.col("value").startswith("##")).head()
    if row is None:
        raise ValueError("the file has no header line")
    names = row.value.lstrip("#").split("\t")
    if tuple(names[: len(MANDATORY)]) != MANDATORY:
        raise ValueError(f"the columns do not begin with {', '.join(MANDATORY)}")
    return names


def info_value(info: Column, key: str) -> Column:
    """A number of the INFO field, the first where a key is repeated; NULL where it is absent or not a number."""
    own = F.filter(F.split(info, ";"), lambda x: x.startswith(f"{key}="))
    return G.not_nan(F.substring(F.get(own, F.lit(0)), len(key) + 2, 1 << 30).try_cast("double"))


def declared(lines: DataFrame) -> set[str]:
    """Keys of the INFO and FORMAT fields that the header declares."""
    rows = lines.where(F.col("value").startswith("##INFO=") | F.col("value").startswith("##FORMAT=")).select("value").collect()
    return {m.group(1) for r in rows if (m := re.search(r"<ID=([^,>]+)", r.value))}


def read_vcf(spark: SparkSession, path: str, samples: list[str] | None = None, strict: bool = False) -> tuple[DataFrame, list[str]]:
    """(variants with `dosages`, samples in the order of the elements).

    samples keeps those of the given ones that the file has, in the file's order. One FORMAT may differ from line to
    line; its DS field must have one value. A malformed line raises when it is read. With `strict`, a header that does not
    declare the fields that are read raises.
    """
    lines = files.open_text(spark, path)
    names = header(lines)
    if strict and (missing := {"AF", "MAF", "IMPUTED", "R2", "DS"} - declared(lines)):
        raise ValueError(f"the header does not declare {', '.join(sorted(missing))}")
    all_ = names[len(MANDATORY) :]
    wanted = [i for i, s in enumerate(all_) if samples is None or s in set(samples)]
    part = F.split(F.col("value"), "\t")
    data = ~F.col("value").startswith("#") & (F.col("value") != "")
    wrong = F.raise_error(F.lit("a line has another number of columns than the header")).cast("array<string>")
    # the test for data lines is in the expression too: pushed-down filters may look at it before the one below
    rows = lines.where(data).select(F.when(~data, F.lit(None)).when(F.size(part) == len(names), part).otherwise(wrong).alias("f"))
    at = F.array_position(F.split(F.col("f")[8], ":"), "DS").cast("int")
    values = F.slice("f", len(MANDATORY) + 1, len(all_))
    dosages = F.transform(values, lambda v: F.try_element_at(F.split(v, ":"), F.col("at")).cast("double"))
    info = F.col("f")[7]
    out = rows.withColumn("at", at).select(
        G.chromosome_to_int(F.col("f")[0]).alias("chromosome"), F.col("f")[1].cast("bigint").alias("position"), F.col("f")[3].alias("ref"), F.col("f")[4].alias("alt"),
        F.array_contains(F.split(info, ";"), "IMPUTED").alias("is_imputed"), info_value(info, "AF").alias("aaf"), info_value(info, "MAF").alias("maf"), info_value(info, "R2").alias("r2"),
        F.col("f")[8].alias("format"), dosages.alias("dosages"),
    )
    if len(wanted) < len(all_):
        out = association.take_samples(out, np.array(wanted))
    return out, [all_[i] for i in wanted]


def check_chromosome(variants: DataFrame, path: str = "") -> int:
    """The file's only chromosome; several raise, and so does a file that is named chrN… after another one."""
    found = [r.chromosome for r in variants.select("chromosome").distinct().limit(2).collect()]
    if len(found) != 1:
        raise ValueError("a file holds exactly one chromosome")
    named = re.match(r"chr(\d+|X)(?!\d)", path.rsplit("/", 1)[-1])
    if named and (23 if named.group(1) == "X" else int(named.group(1))) != found[0]:
        raise ValueError(f"{path} holds chromosome {found[0]}")
    return found[0]
