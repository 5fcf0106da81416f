"""Column expressions on variants, alleles and association statistics. Missing is always NULL; NaN never enters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Lengths of the chromosomes 1 to 22 and X in the hg19 assembly.
HG19_LENGTHS = (
    249250621, 243199373, 198022430, 191154276, 180915260, 171115067, 159138663, 146364022, 141213431, 135534747, 135006516, 133851895,
    115169878, 107349540, 102531392, 90354753, 81195210, 78077248, 59128983, 63025520, 48129895, 51304566, 155270560,
)
#: P-value lines of a Manhattan plot.
SUGGESTIVE, GENOME_WIDE = 1e-5, 1e-8
RTOL, ATOL = 1e-5, 1e-8


def not_nan(x: Column) -> Column:
    return F.when(F.isnan(x), F.lit(None)).otherwise(x)


def chromosome_to_int(name: Column) -> Column:
    """1 to 22, X as 23, RefSeq accessions by their number; anything else is NULL."""
    plain = F.regexp_replace(F.upper(name), r"^NC_0*|\..*$", "")
    return F.when(plain == "X", F.lit(23)).otherwise(plain.try_cast("int")).cast("smallint")


def chromosome_from_int(number: Column) -> Column:
    return F.when(number == 23, F.lit("X")).otherwise(number.cast("string"))


def variant_id(chromosome: Column, position: Column, ref: Column, alt: Column) -> Column:
    return F.concat_ws(":", chromosome.cast("string"), position.cast("string"), ref, alt)


def marker_key(marker: Column) -> Column:
    """A text key that sorts like the genome: numeric chromosomes padded to 2, positions to 12; X comes after 22."""
    part = F.split(marker, ":")
    chromosome, position = part[0], part[1]
    padded = F.when(chromosome.rlike("^[0-9]+$"), F.lpad(chromosome, 2, "0")).otherwise(chromosome)
    key = F.concat_ws(":", padded, F.lpad(position, 12, "0"), part[2], part[3])
    wrong = (F.length(chromosome) > 2) | (F.length(position) > 12) | (F.size(part) != 4)
    return F.when(wrong, F.raise_error(F.concat(F.lit("malformed marker "), marker))).otherwise(key)


def genome_offset(chromosome: Column) -> Column:
    """Bases before a chromosome when all are laid end to end."""
    ends = [sum(HG19_LENGTHS[:i]) for i in range(len(HG19_LENGTHS))]
    return F.try_element_at(F.array(*(F.lit(x).cast("bigint") for x in ends)), chromosome.cast("int"))


def genome_position(chromosome: Column, position: Column) -> Column:
    return genome_offset(chromosome) + position


def chromosome_table(spark: SparkSession) -> DataFrame:
    """chromosome, length, offset, middle (the axis tick)."""
    rows = [(i + 1, n, sum(HG19_LENGTHS[:i])) for i, n in enumerate(HG19_LENGTHS)]
    return spark.createDataFrame(rows, "chromosome int, length long, offset long").withColumn("middle", F.col("offset") + F.expr("length div 2"))


def threshold_segments(spark: SparkSession) -> DataFrame:
    """line, height (-log10 p), chromosome, x_start, x_end: the p-value lines, with a gap of a 500th of the genome at each chromosome's ends."""
    gap = sum(HG19_LENGTHS) / 500
    lines = F.explode(F.array(*(F.struct(F.lit(n).alias("line"), (-F.log10(F.lit(p))).alias("height")) for n, p in (("suggestive", SUGGESTIVE), ("genome_wide", GENOME_WIDE)))))
    axis = chromosome_table(spark).select("chromosome", (F.col("offset") + gap).alias("x_start"), (F.col("offset") + F.col("length") - gap).alias("x_end"), lines.alias("l"))
    return axis.select("l.line", "l.height", "chromosome", "x_start", "x_end")


def minor_allele_frequency(af: Column) -> Column:
    return F.when(af <= 0.5, af).otherwise(1 - af)


def is_close(x: Column, y: float) -> Column:
    return F.abs(x - F.lit(y)) <= ATOL + RTOL * abs(y)


def greater_or_close(x: Column, cutoff: float) -> Column:
    """x at least cutoff up to rounding; NULL is no."""
    if cutoff == float("-inf"):
        return x.isNotNull()
    return F.coalesce((x >= cutoff) | is_close(x, cutoff), F.lit(False))


def variant_mask(frequencies: list[Column], r2: Column, maf_cutoff: float, r2_cutoff: float, aggregate: str = "max") -> Column:
    """Keeps variants whose largest (or smallest) minor allele frequency and imputation quality reach the cutoffs.

    Missing frequencies are skipped and a variant with none is dropped; a missing quality passes.
    """
    folded = F.array(*(minor_allele_frequency(f) for f in frequencies))
    maf = {"max": F.array_max, "min": F.array_min}[aggregate](folded)
    return greater_or_close(maf, maf_cutoff) & (greater_or_close(r2, r2_cutoff) | r2.isNull())


def effect(u: Column, v: Column) -> Column:
    return F.when(~is_close(v, 0.0), u / v)


def standard_error(v: Column) -> Column:
    return F.when(v > 0, 1 / F.sqrt(v))


def chi_squared(u: Column, v: Column) -> Column:
    """U**2 / V; NULL where either is missing or V is nearly 0."""
    return F.when(~is_close(v, 0.0), u * u / v)


def valid_score(u: Column, v: Column) -> Column:
    """struct(u, v), or the sentinel (0, 1) where V is nearly 0."""
    zero = is_close(v, 0.0)
    return F.struct(F.when(zero, 0.0).otherwise(u).alias("u"), F.when(zero, 1.0).otherwise(v).alias("v"))


def strand_ambiguous(a: Column, b: Column) -> Column:
    a, b = F.lower(a), F.lower(b)
    return (a.isin("a", "t") & b.isin("a", "t")) | (a.isin("c", "g") & b.isin("c", "g"))


def studies_present(direction: Column) -> Column:
    """How many studies a direction string has, without the missing ones."""
    return F.length(direction) - F.length(F.regexp_replace(direction, "[^?]", ""))


def snp_name(rsid: Column, marker: Column) -> Column:
    return F.coalesce(rsid, marker)


def legend_rsid(identifier: Column, chromosome: Column) -> Column:
    """First part of a panel's id; NULL if it is only the chromosome's label."""
    first = F.split(identifier, ":")[0]
    label = F.when(chromosome == 23, F.lit("chrX")).otherwise(chromosome.cast("string"))
    return F.nullif(first, label)


def marginal_effect(z: Column, n: Column, allele: Column, reference_allele: Column) -> Column:
    """z / sqrt(n), its sign turned where the alleles differ; a missing one is 0."""
    sign = F.when(allele == reference_allele, 1.0).otherwise(-1.0)
    return F.coalesce(sign * z / F.sqrt(n), F.lit(0.0)) + 0.0  # no negative zero


def snake_case(name: Column) -> Column:
    return F.lower(F.regexp_replace(name, r"([a-z\d])([A-Z])", "$1_$2"))


def logged_value(log: Column, key: str) -> Column:
    """The value after `key` at the start of a line of a log."""
    return F.nullif(F.regexp_extract(log, rf"(?m)^{key} ?[=:]? ?(.+?)\.?$", 1), F.lit(""))
