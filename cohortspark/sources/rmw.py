"""Score files of the single-variant association exchange format, and the pedigree files that go with them."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortspark.functions import genetics as G
from cohortspark.functions import stats

from . import files

#: The columns of the format.
NAMES = ("CHROM", "POS", "REF", "ALT", "N_INFORMATIVE", "FOUNDER_AF", "ALL_AF", "INFORMATIVE_ALT_AC", "CALL_RATE", "HWE_PVALUE", "N_REF", "N_HET", "N_ALT", "U_STAT", "SQRT_V_STAT", "ALT_EFFSIZE", "PVALUE")
TYPES = dict.fromkeys(NAMES, "double") | dict.fromkeys(("CHROM", "REF", "ALT"), "string") | dict.fromkeys(("POS", "N_INFORMATIVE"), "bigint") | dict.fromkeys(("N_REF", "N_HET", "N_ALT"), "int")
#: Titles of the header and the seven statistics of a summary.
SECTIONS = ("CovariateSummaries", "TraitSummaries")
STATISTICS = ("min", "25th", "median", "75th", "max", "mean", "variance")
VARIANCES = {"genetic_variance": "Sigma_g2_Hat", "error_variance": "Sigma_e2_Hat", "heritability": "Heritability"}
_FLAGS = {"ON": True, "OFF": False, "True": True, "False": False}


def record(scores: DataFrame) -> DataFrame:
    """The format's columns of scores (chromosome, position, ref, alt, aaf, u, v, n).

    Counts of genotypes and their test are not known of dosages and have fixed values.
    """
    u, v = F.col("u"), F.col("v")
    values = {
        "CHROM": G.chromosome_from_int(F.col("chromosome")), "POS": F.col("position"), "REF": F.col("ref"), "ALT": F.col("alt"), "N_INFORMATIVE": F.col("n"), "FOUNDER_AF": F.col("aaf"), "ALL_AF": F.col("aaf"),
        "INFORMATIVE_ALT_AC": F.lit(None).cast("double"), "CALL_RATE": F.lit(1.0), "HWE_PVALUE": F.lit(1.0), "N_REF": F.lit(1), "N_HET": F.lit(1), "N_ALT": F.lit(1),
        "U_STAT": u, "SQRT_V_STAT": F.sqrt(v), "ALT_EFFSIZE": G.effect(u, v), "PVALUE": stats.p_value(G.chi_squared(u, v))["p"],
    }
    return scores.select(*(values[n].alias(n) for n in NAMES))


def number(x: float | int | None) -> str:
    """The format's text of a value: NA, whole numbers as they are, others in scientific notation, as short as they can be."""
    if x is None or x != x:
        return "NA"
    return np.format_float_scientific(x) if isinstance(x, float | np.floating) else str(x)


def header_lines(header: dict) -> list[str]:
    """The lines above the records; header as read_scorefile() gives it."""
    out = []
    camel = lambda k: "".join(w.capitalize() for w in k.split("_"))
    plain = [k for k in header if k not in ("covariate_summaries", "trait_summaries", "null_model_estimates", "analyzed_trait", *VARIANCES)]
    for k in plain:
        v = header[k]
        if isinstance(v, bool):
            v = ("ON" if v else "OFF") if k == "inverse_normal" else str(v)
        out.append(f"##{camel(k)}={','.join(v) if isinstance(v, list) else v}")
    row = lambda name, values: "##" + "\t".join([name, *map(number, values)])
    for title, key in zip(SECTIONS, ("covariate_summaries", "trait_summaries"), strict=True):
        out.append("##" + "\t".join([title, *STATISTICS]))
        out += [row(name, values) for name, values in header.get(key, {}).items()]
    out += ["## - NullModelEstimates", "## - Name\tBetaHat\tSE(BetaHat)"]
    out += [row(f" - {name}", [x for pair in zip(beta, se, strict=True) for x in pair]) for name, (beta, se) in header.get("null_model_estimates", {}).items()]
    if header.get("analyzed_trait"):
        out.append(row("AnalyzedTrait", header["analyzed_trait"]))
    for key, title in VARIANCES.items():
        if key in header:
            values = header[key]
            out.append(f"##{title}={number(values[0])}" if key == "heritability" and len(values) == 1 else row(title, values))
    return [*out, "#" + "\t".join(NAMES)]


def parse_header(lines: list[str]) -> dict:
    """The header as a dictionary: counts, flags, lists, summaries by name and estimates (beta, se) by name."""
    out: dict = {"covariate_summaries": {}, "trait_summaries": {}, "null_model_estimates": {}, "analyzed_trait": None}
    section = out["covariate_summaries"]
    floats = lambda cells: [float("nan") if c == "NA" else float(c) for c in cells]
    of_title = {title: key for key, title in VARIANCES.items()}
    for line in lines:
        text = line.removeprefix("##")
        if not line.startswith("##"):
            continue
        if text.startswith(" - "):
            name, *cells = text.removeprefix(" - ").split("\t")
            if cells and cells[0] != "BetaHat":
                values = floats(cells)
                out["null_model_estimates"][name] = (values[::2], values[1::2])
            continue
        name, *cells = text.split("\t")
        if "=" in name:
            key, value = (x.strip() for x in text.split("=", 1))
            if key in of_title:
                out[of_title[key]] = floats([value])
                continue
            snake = "".join(f"_{c.lower()}" if c.isupper() and i and not key[i - 1].isupper() else c.lower() for i, c in enumerate(key))
            if snake == "covariates":
                out[snake] = [x for x in value.replace("\t", ",").split(",") if x]
            else:
                out[snake] = _FLAGS[value] if value in _FLAGS else int(value) if value.lstrip("-").isdigit() and snake != "version" else value
        elif name in SECTIONS:
            section = out["covariate_summaries" if name == SECTIONS[0] else "trait_summaries"]
        elif name in of_title:
            out[of_title[name]] = floats(cells)
        elif name == "AnalyzedTrait":
            out["analyzed_trait"] = floats(cells)
        elif cells:
            section[name] = floats(cells)
    return out


def read_scorefile(spark: SparkSession, path: str) -> tuple[DataFrame, dict]:
    """(records, header); NA is NULL. A path may hold several parts with equal headers."""
    lines = files.open_text(spark, path)
    head = [r.value for r in lines.where(F.col("value").startswith("#")).distinct().limit(100_000).collect()] if path.endswith("/") else [r.value for r in lines.where(F.col("value").startswith("#")).collect()]
    cells = F.split(F.trim("value"), r"\s+")
    rows = lines.where(~F.col("value").startswith("#") & (F.trim("value") != ""))
    return rows.select(*(F.when(cells[i] != "NA", cells[i]).cast(TYPES[n]).alias(n) for i, n in enumerate(NAMES))), parse_header(head)


def write_scorefile(records: DataFrame, path: str, header: dict, compression: str = "none") -> None:
    """A directory of parts in the format, each with the whole header, so that each is a score file by itself."""
    head = header_lines(header)

    def lines(frames):
        yield pd.DataFrame({"value": head})
        for f in frames:
            yield pd.DataFrame({"value": ["\t".join(map(_cell, row)) for row in f.itertuples(index=False)]})

    records.select(*NAMES).mapInPandas(lines, "value string").write.option("compression", compression).text(path)


def _cell(x) -> str:
    return "NA" if x is None or x is pd.NA or x != x else number(x)


def pedigree(samples: DataFrame, phenotype: str, covariates: list[str], key: str = "sample_id") -> DataFrame:
    """Lines (`value`) of a pedigree file: every sample a family of its own, the phenotype and the covariates (no intercept)."""
    text = F.pandas_udf(_texts, "string")
    fixed = [F.col(key).cast("string"), F.col(key).cast("string"), F.lit("0 0 1")]
    return samples.select(F.concat_ws(" ", *fixed, *(text(F.col(f"`{c}`").cast("double")) for c in (phenotype, *covariates))).alias("value"))


def _texts(x: pd.Series) -> pd.Series:
    return x.map(lambda v: number(float(v)) if v is not None and v == v else "NA", na_action=None)


def data_lines(phenotype: str, covariates: list[str]) -> list[str]:
    """Lines of the file that names a pedigree file's columns."""
    return [f"T {phenotype}", *(f"C {c}" for c in covariates)]


def write_pedigree(samples: DataFrame, phenotype: str, covariates: list[str], path: str, key: str = "sample_id") -> tuple[str, str]:
    """The pedigree and its column names as text directories {path}/{phenotype}.ped and .dat."""
    spark = samples.sparkSession
    ped, dat = f"{path}/{phenotype}.ped", f"{path}/{phenotype}.dat"
    pedigree(samples, phenotype, covariates, key).write.text(ped)
    spark.createDataFrame([(x,) for x in data_lines(phenotype, covariates)], "value string").coalesce(1).write.text(dat)
    return ped, dat


def is_close(column: Column, other: Column, rtol: float = 1e-5, atol: float = 1e-8) -> Column:
    """Equal within tolerances, NULLs equal each other: how two summaries or records are compared."""
    return F.coalesce(F.abs(column - other) <= atol + rtol * F.abs(other), column.isNull() & other.isNull())
