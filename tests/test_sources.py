"""Files in and out."""

import gzip
import lzma

import pytest
from pyspark.sql import functions as F

from cohortspark.sources import tables, vcf

VCF = """##fileformat=VCFv4.2
#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\ts1\ts2\ts3
22\t100\t.\tA\tG\t.\tPASS\tIMPUTED;AF=0.25;MAF=0.25;R2=0.9\tGT:DS\t0|0:0.5\t0|1:1\t1|1:0.0
22\t200\t.\tC\tT\t.\tPASS\tAF=nan\tDS:GT\t2:1|1\t0.25:0|0\t1.5:0|1
"""


@pytest.mark.parametrize("suffix", [".vcf", ".vcf.gz", ".vcf.xz"])
def test_vcf(spark, tmp_path, suffix):
    path = tmp_path / f"chr22.dose{suffix}"
    {".vcf": lambda: path.write_text(VCF), ".vcf.gz": lambda: path.write_bytes(gzip.compress(VCF.encode())), ".vcf.xz": lambda: path.write_bytes(lzma.compress(VCF.encode()))}[suffix]()
    df, samples = vcf.read_vcf(spark, str(path))
    a, b = df.orderBy("position").collect()
    assert samples == ["s1", "s2", "s3"]
    assert (a.chromosome, a.position, a.ref, a.alt, a.is_imputed, a.aaf, a.r2) == (22, 100, "A", "G", True, 0.25, 0.9)
    assert a.dosages == [0.5, 1.0, 0.0]
    assert b.dosages == [2.0, 0.25, 1.5]
    assert (b.aaf, b.maf, b.is_imputed) == (None, None, False)
    assert vcf.check_chromosome(df) == 22
    some, kept = vcf.read_vcf(spark, str(path), ["s3", "s1", "s9"])
    assert kept == ["s1", "s3"]
    assert some.orderBy("position").head().dosages == [0.5, 0.0]


def test_bad_vcf(spark, tmp_path):
    (tmp_path / "a.vcf").write_text("#CHROM\tPOS\n")
    with pytest.raises(ValueError):
        vcf.read_vcf(spark, str(tmp_path / "a.vcf"))
    (tmp_path / "b.vcf").write_text(VCF + "22\t300\tshort\n")
    with pytest.raises(Exception, match="number of columns"):
        vcf.read_vcf(spark, str(tmp_path / "b.vcf"))[0].select("dosages").collect()


def test_variables(spark, tmp_path):
    (tmp_path / "a.tsv").write_text("id\tx\ty\n1\t0.5\tn/a\n2\tn/a\t1\n")
    (tmp_path / "b.tsv").write_text("id\ty\tz\n1\t7\t8\n3\t1\t2\n")
    df = tables.read_variables(spark, [str(tmp_path / "a.tsv"), str(tmp_path / "b.tsv")])
    got = {r.sample_id: (r.x, r.y, r.z) for r in df.collect()}
    assert got == {"1": (0.5, 7.0, 8.0), "2": (None, 1.0, None), "3": (None, 1.0, 2.0)}
    assert tables.long_form(df, ["x", "y", "z"]).count() == 6
    tables.write_variables(df.coalesce(1), str(tmp_path / "out"))
    assert tables.read_variables(spark, [str(tmp_path / "out")]).exceptAll(df).count() == 0


def test_plink(spark, tmp_path):
    (tmp_path / "a.pvar").write_text("##x\n#CHROM POS ID REF ALT\n1 5 rs1 A G\n")
    (tmp_path / "a.fam").write_text("f1 i1 0 0 1 -9\nf2 i2 0 0 1 -9\n")
    assert [r.id for r in tables.read_plink(spark, str(tmp_path / "a.pvar")).collect()] == ["rs1"]
    assert [r.id for r in tables.read_plink(spark, str(tmp_path / "a.fam")).collect()] == ["i1", "i2"]


def test_score_text_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a", 1.5), ("b", None)], "name string, x double")
    tables.write_score_text(df, str(tmp_path / "t"), {"method": "fastlmm"}, compression="gzip")
    back, meta = tables.read_score_text(spark, str(tmp_path / "t"))
    assert meta == {"method": "fastlmm"}
    assert {(r.name, r.x) for r in back.collect()} == {("a", "1.5"), ("b", None)}


def test_convert_and_transpose(spark, tmp_path):
    df = spark.createDataFrame([(1, 2.0, 3.0), (2, None, 4.0)], "k int, u double, v double")
    assert tables.convert(df, str(tmp_path / "p"), {"v"}).columns == ["k", "u"]
    tables.transpose(df, ["k"], ["u", "v"], str(tmp_path / "q"))
    assert spark.read.parquet(str(tmp_path / "q")).where(F.col("column") == "v").count() == 2


def test_legends_and_mds(spark, tmp_path):
    (tmp_path / "l").write_text("id position a0 a1 eur.aaf\nrs5:10:A:G 10 A G 0.1\n1:20:C:T 20 C T 0.2\n")
    got = {r.marker_name: r.rsid for r in tables.read_legends(spark, {1: str(tmp_path / "l")}).collect()}
    assert got == {"1:10:A:G": "rs5", "1:20:C:T": None}
    (tmp_path / "m").write_text("FID,IID,SOL,C1,C2\nCEU,a,0,0.1,0.2\nme,b,0,0.3,0.4\n")
    samples, reference = tables.read_mds(spark, str(tmp_path / "m"), {"CEU"})
    assert [r.iid for r in samples.collect()] == ["b"]
    assert [r.population for r in reference.collect()] == ["CEU"]


def test_summary(spark, tmp_path):
    (tmp_path / "s.yaml").write_text("chunk-0:\n  all:\n    status: score_complete\n    sample_count: 5\n    phenotypes:\n      p1: {minimum: 0.0, median: 1.0, mean: 1.5}\n")
    r = tables.read_summary(spark, str(tmp_path / "s.yaml")).head()
    assert (r.collection, r.variable, r.role, r.sample_count, r["mean"], r.variance) == ("all", "p1", "phenotypes", 5, 1.5, None)
