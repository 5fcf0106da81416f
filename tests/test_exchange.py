"""Score files, pedigrees, meta-analysis tables and arrays in their exchange formats."""

import lzma

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cohortspark.sources import files, results, rmw, tables, vcf

HEADER = {
    "program_name": "tool", "version": "1.2", "samples": 5, "make_residuals": False, "covariates": ["age", "site"], "inverse_normal": True,
    "covariate_summaries": {"age": [1.0, 2.0, 3.0, 4.0, 5.0, 3.0, 2.5]}, "trait_summaries": {"height": [0.0, 1.0, 2.0, 3.0, 4.0, 2.0, float("inf")]},
    "null_model_estimates": {"intercept": ([1.5], [0.25]), "age": ([-2.0, 3.0], [0.5, 0.75])}, "analyzed_trait": [0.0, 1.0, 2.0, 3.0, 4.0, 2.0, 1.0],
    "genetic_variance": [0.5], "error_variance": [0.25], "heritability": [0.625],
}


@pytest.fixture
def scores(spark):
    rows = [(1, 10, "A", "G", 0.25, 3.0, 4.0, 50), (23, 20, "C", "T", None, 1e-5, 2.0, 50), (2, 5, "G", "C", 0.5, None, None, 50)]
    return spark.createDataFrame(rows, "chromosome int, position long, ref string, alt string, aaf double, u double, v double, n long")


def test_record(scores):
    got = {r.CHROM: r for r in rmw.record(scores).collect()}
    assert tuple(got["1"].asDict()) == rmw.NAMES
    assert (got["1"].SQRT_V_STAT, got["1"].ALT_EFFSIZE, got["1"].N_HET, got["1"].INFORMATIVE_ALT_AC) == (2.0, 0.75, 1, None)
    assert abs(got["1"].PVALUE - 0.13361440253771584) < 1e-12
    assert got["X"].FOUNDER_AF is None
    assert got["2"].PVALUE is None


def test_scorefile_round_trip(spark, scores, tmp_path):
    assert rmw.parse_header(rmw.header_lines(HEADER)) == HEADER
    records = rmw.record(scores)
    rmw.write_scorefile(records.repartition(2), str(tmp_path / "s"), HEADER)
    back, header = rmw.read_scorefile(spark, str(tmp_path / "s"))
    assert header == HEADER
    assert [f.dataType for f in back.schema] == [f.dataType for f in records.schema]
    assert back.exceptAll(records).count() == records.exceptAll(back).count() == 0
    text = next((tmp_path / "s").glob("part-*")).read_text().splitlines()
    assert text[0] == "##ProgramName=tool"
    assert any(t.startswith("#CHROM\tPOS") for t in text)


def test_numbers():
    assert [rmw.number(x) for x in (None, float("nan"), 3, 1.0, 0.1, -2.5e-300)] == ["NA", "NA", "3", "1.e+00", "1.e-01", "-2.5e-300"]
    assert all(float(rmw.number(x)) == x for x in (0.1 + 0.2, 1 / 3, 5e-324, 1.7976931348623157e308))


def test_pedigree(spark, tmp_path):
    df = spark.createDataFrame([("s1", 1.5, 30.0), ("s2", None, 41.0)], "sample_id string, height double, age double")
    ped, dat = rmw.write_pedigree(df, "height", ["age"], str(tmp_path))
    assert sorted(r.value for r in spark.read.text(ped).collect()) == ["s1 s1 0 0 1 1.5e+00 3.e+01", "s2 s2 0 0 1 NA 4.1e+01"]
    assert [r.value for r in spark.read.text(dat).collect()] == ["T height", "C age"]


def test_meta_table(spark, tmp_path):
    row = ("1:2:A:C", "a", "c", 0.5, 0.1, 0.4, 0.6, 1.5, 0.25, 1e-9, "+-?", 12.5, 3.0, 2, 0.2, 900)
    df = spark.createDataFrame([row, ("2:3:G:T", "g", "t", None, *row[4:])], results.META)
    results.write_meta(df, str(tmp_path / "m"))
    back = results.read_meta(spark, str(tmp_path / "m"))
    assert back.dtypes == df.dtypes
    assert back.exceptAll(df).count() == df.exceptAll(back).count() == 0


def test_tables_with_metadata(spark, tmp_path):
    df = spark.createDataFrame([(1, 2.0, "x"), (2, None, "y")], "k int, u double, name string")
    results.write_table(df, str(tmp_path / "a.parquet"), {"summaries": {"n": 2}, "log": "fine"})
    back, meta = results.read_table(spark, str(tmp_path / "a.parquet"), ["u"])
    assert meta == {"summaries": {"n": 2}, "log": "fine"}
    assert back.columns == ["u"]
    again, meta = tables.read_score(spark, str(tmp_path / "a"))
    assert again.count() == 2
    tables.write_score(df, str(tmp_path / "b"), "gzip_text", {"v": 1})
    assert tables.read_score(spark, str(tmp_path / "b"))[1] == {"v": 1}
    with pytest.raises(ValueError, match="method"):
        tables.write_score(df, str(tmp_path / "c"), "blosc")
    with pytest.raises(FileNotFoundError):
        files.probe(spark, str(tmp_path / "none"))
    results.write_merged(df.select(F.lit(1).alias("chromosome"), F.col("k").alias("position"), "u"), str(tmp_path / "w"), batch=1)
    assert spark.read.parquet(str(tmp_path / "w")).count() == 2


def test_rows_by_place(spark):
    df = spark.createDataFrame([(i, f"v{i}") for i in range(50)], "k int, name string").repartition(3)
    assert [r.name for r in tables.select_rows(df, [7, 0, 49], "k").collect()] == ["v7", "v0", "v49"]


def test_jobs_stay(spark, tmp_path):
    df = spark.createDataFrame([("x", "a"), ("y", "b")], "key string, phenotype string")
    assert results.write_jobs(df, str(tmp_path / "j"), ["key"])
    assert not results.write_jobs(df, str(tmp_path / "j"), ["key"])
    assert results.write_jobs(df.limit(1), str(tmp_path / "j"), ["key"])


def test_genotype_sets(spark, tmp_path):
    for s in (".bed", ".bim", ".fam", ".pgen", ".pvar"):
        (tmp_path / f"set{s}").write_text("")
    assert files.is_bfile(spark, str(tmp_path / "set"))
    assert not files.is_pfile(spark, str(tmp_path / "set"))


def test_streamed_text(spark, tmp_path):
    lines = [f"line {i}" for i in range(20_000)]
    raw = ("\n".join(lines) + "\n").encode()
    (tmp_path / "a.txt.xz").write_bytes(lzma.compress(raw))
    with pa.CompressedOutputStream(str(tmp_path / "a.txt.lz4"), "lz4") as f:
        f.write(raw)
    for suffix in ("xz", "lz4"):
        assert [r.value for r in files.open_text(spark, str(tmp_path / f"a.txt.{suffix}")).collect()] == lines


def test_named_chromosome(spark, tmp_path):
    head = "##INFO=<ID=AF,Number=1>\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\ts1\ts2\n"
    (tmp_path / "chr3.vcf").write_text(head + "4\t1\t.\tA\tG\t.\tPASS\tAF=0.5;AF=0.6;R2=.\tDS\t1\t0\n")
    df, _ = vcf.read_vcf(spark, str(tmp_path / "chr3.vcf"))
    row = df.head()
    assert (row.aaf, row.r2) == (0.5, None)
    assert vcf.check_chromosome(df) == 4
    with pytest.raises(ValueError, match="holds chromosome 4"):
        vcf.check_chromosome(df, str(tmp_path / "chr3.vcf"))
    with pytest.raises(ValueError, match="does not declare DS, IMPUTED, MAF, R2"):
        vcf.read_vcf(spark, str(tmp_path / "chr3.vcf"), strict=True)


def test_frequency_columns(spark, tmp_path):
    df = spark.createDataFrame([(0.5, 1.0)], "c_aaf double, u double")
    paths = {c: str(tmp_path / f"chr{c}") for c in range(1, 24)}
    for c in range(1, 22):
        df.coalesce(1).write.parquet(paths[c])
    names, missing = tables.frequency_columns(spark, paths)
    assert names[1] == ["c_aaf"]
    assert missing == [22]


def test_collection_names(spark):
    rows = [("a", "c1", "phenotypes", "p"), ("b", "c2", "phenotypes", "p"), ("a", "c1", "covariates", "age"), ("a", "c3", "phenotypes", "q")]
    df = spark.createDataFrame(rows, "chunk string, collection string, role string, variable string")
    assert {r.phenotype: r.collection for r in tables.collection_names(df).collect()} == {"p": "c1", "q": "c3"}
