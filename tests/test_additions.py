"""Checks, guards and choices beside the main path of the genomic operators."""

import os

import pytest
from pyspark.sql import functions as F

from helixframe.functions import codons, regions
from helixframe.operators import annotate, contamination, coverage, rangejoin, similarity, variants as ops
from helixframe.sources import warehouse


def test_codons_against_the_table(spark):
    want = {a + b + c: codons.AMINO_ACIDS[16 * i + 4 * j + k] for i, a in enumerate("TCAG") for j, b in enumerate("TCAG") for k, c in enumerate("TCAG")}
    odd = ["", "A", "AC", "ACGT", "AAN", "T|T", "TT|", "|TT", None]
    got = {r.c: r.a for r in spark.createDataFrame([(c,) for c in [*want, *odd]], "c string").select("c", codons.translate(F.col("c")).alias("a")).collect()}
    assert got == want | dict.fromkeys(odd)


def test_two_frequencies_at_a_position_are_an_error(spark):
    freq = spark.createDataFrame([("1", 5, "A", "C", 0.5), ("1", 9, "A", "G", 0.4)], "reference_name string, position long, ref_base string, alt_base string, ref_freq double")
    bases = spark.createDataFrame([("1", 5, "A", 30), ("1", 5, "C", 30), ("1", 5, "C", 30)], "reference_name string, position long, base string, quality int")
    got = {(r.position, r.base, r.n) for r in contamination.pileup(freq, bases).collect()}
    assert got == {(5, "REF", 1), (5, "NONREF", 2), (9, None, 0)}
    with pytest.raises(Exception, match="more than one frequency at 1:5"):
        contamination.pileup(freq.unionByName(freq.limit(1)), bases).collect()


def test_likelihoods_in_one_pass(spark):
    piles = spark.createDataFrame([("1", 5, 0.3, "REF", 20, 7), ("1", 5, 0.3, "NONREF", 30, 2), ("1", 9, 0.6, None, None, 0), ("2", 5, 0.2, "OTHER", 10, 1)], "reference_name string, position long, ref_freq double, base string, quality int, n long")
    f = contamination.Likelihood([(f"{r.reference_name}:{r.position}", r.ref_freq, r.base, r.quality, r.n) for r in piles.collect()])
    got = {r.alpha: r.log_likelihood for r in contamination.log_likelihood(piles, 0.05, 0.2, 0.4).collect()}
    assert got == {a: pytest.approx(f(a)) for a in (0.05, 0.2, 0.4)}


def test_pairs_in_two_steps(spark):
    rows = spark.createDataFrame([(["a", "b", "c"], 1), (["d"], 2), ([], 3), (None, 4)], "names array<string>, k int")
    for same, n in ((False, 3), (True, 7)):
        got = sorted((r.k, r.p.a, r.p.b) for r in similarity._paired(rows, "names", same, "k").collect())
        want = sorted((r.k, p.a, p.b) for r in rows.where("names is not null").select("k", similarity.pairs(F.col("names"), same).alias("ps")).collect() for p in r.ps)
        assert got == want and len(got) == n


def test_quantile_checks(spark):
    coverage.check_quantiles(["a", "b", "c"], 3)
    with pytest.raises(ValueError):
        coverage.check_quantiles(["a", "b", "b"], 3)
    with pytest.raises(ValueError):
        coverage.discrete_quantiles(F.col("x"), 1)


def test_annotation_set_checks():
    ops.check_annotation_sets([("a", "VARIANT", "r"), ("b", "TRANSCRIPT", "r")], {"a": "VARIANT", "b": "TRANSCRIPT"})
    with pytest.raises(ValueError, match="of type GENERIC"):
        ops.check_annotation_sets([("a", "GENERIC", "r")], "VARIANT")
    with pytest.raises(ValueError, match="several reference sets"):
        ops.check_annotation_sets([("a", "VARIANT", "r"), ("b", "VARIANT", "s")], "VARIANT")


def test_bases_are_looked_up_by_interval(spark):
    t = spark.createDataFrame([("t1", "chr1", 5, 9, None), ("t2", "1", 5, 10, "old")], "id string, reference_name string, start long, end long, bases string")
    r = spark.createDataFrame([("1", 5, 9, "ACGT"), ("1", 5, 9, "ACGT"), ("2", 5, 10, "AAAAA")], "reference_name string, start long, end long, bases string")
    assert {x.id: x.bases for x in annotate.with_bases(t, r).collect()} == {"t1": "ACGT", "t2": None}


def test_delete_asks_first(spark, tmp_path):
    path = str(tmp_path / "variants")
    spark.range(10).select(F.concat(F.lit("v"), "id").alias("id"), F.col("id").alias("x")).write.parquet(path)
    ids = spark.createDataFrame([("v1",), ("v4",), ("v99",)], "id string")
    asked = []
    assert ops.delete_from(spark, path, ids, lambda n: asked.append(n)) == 0 and asked == [2]
    assert spark.read.parquet(path).count() == 10
    assert ops.delete_from(spark, path, ids, lambda n: True) == 2
    assert sorted(r.x for r in spark.read.parquet(path).collect()) == [0, 2, 3, 5, 6, 7, 8, 9]
    assert os.listdir(tmp_path) == ["variants"]
    assert ops.delete_from(spark, path, ids, lambda n: True) == 0


def test_merge_strategies(spark):
    schema = "id string, reference_name string, start long, end long, reference_bases string, alternate_bases array<string>, calls array<struct<call_set_name: string, genotype: array<int>>>"
    rows = [("v", "1", 10, 11, "A", ["C"], [("x", [0, 1])]), ("s", "1", 5, 20, "A", [], [("x", [0, 0]), ("y", [0, 0])])]
    df = spark.createDataFrame(rows, schema)
    names = {k: [c.call_set_name for c in rangejoin.merge_segments(df, 100, strategy=k).first().calls] for k in rangejoin.MERGE_STRATEGIES}
    assert names == {"append": ["x", "x", "y"], "fill": ["x", "y"], "keep": ["x"]}
    with pytest.raises(KeyError):
        rangejoin.merge_segments(df, 100, strategy="none")


def test_regions_of_all_references(spark):
    refs = [("chr1", 2_500_000), ("chrX", 10), ("Y", 5)]
    assert regions.all_references(refs, sex_chromosomes=False) == [("chr1", 0, 2_500_000)] and len(regions.all_references(refs)) == 3
    assert regions.split_regions(regions.all_references(refs[:1]))[-1] == ("chr1", 2_000_000, 2_500_000)
    cigar = "array<struct<operation: string, operation_length: long>>"
    reads = spark.createDataFrame([("g", "1", p, [("ALIGNMENT_MATCH", 10)]) for p in (90, 95, 100, 199, 200)] + [("h", "1", 100, [("ALIGNMENT_MATCH", 10)])], f"read_group_set_id string, reference_name string, position long, cigar {cigar}")
    assert sorted(r.position for r in regions.reads_of(reads, ["g"], [("1", 100, 200)]).collect()) == [100, 199]
    assert sorted(r.position for r in regions.reads_of(reads, ["g"], [("1", 100, 200)], whole=True).collect()) == [95, 100, 199]


def test_warehouse_table(spark):
    reads = spark.createDataFrame([("r", "1", 5), ("u", None, None)], "id string, reference_name string, position long").withColumn("cigar", F.lit(None).cast("array<struct<operation: string, operation_length: long>>"))
    spark.sql("DROP TABLE IF EXISTS reads_for_test")
    warehouse.save_table(reads, "reads_for_test")
    assert {(r.id, r.reference) for r in spark.table("reads_for_test").collect()} == {("r", "1"), ("u", "*")}
    spark.sql("DROP TABLE reads_for_test")
