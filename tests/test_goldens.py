"""Small cases with known results for the genomic operators."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from helixframe.functions import codons, regions
from helixframe.functions import reads as R
from helixframe.functions import variants as V
from helixframe.operators import annotate, contamination, coverage, rangejoin, similarity
from helixframe.operators import variants as ops

CALLS = "array<struct<call_set_name: string, genotype: array<int>>>"
VARIANT = f"id string, reference_name string, start long, end long, reference_bases string, alternate_bases array<string>, calls {CALLS}"
LETTER = {"M": "ALIGNMENT_MATCH", "I": "INSERT", "D": "DELETE", "N": "SKIP", "S": "CLIP_SOFT", "H": "CLIP_HARD", "P": "PAD", "=": "SEQUENCE_MATCH", "X": "SEQUENCE_MISMATCH"}
READ = "reference_name string, position long, mapping_quality int, read_group_set_id string, cigar array<struct<operation: string, operation_length: long>>"


def cigar(text):
    import re

    return [(LETTER[o], int(n)) for n, o in re.findall(r"(\d+)(.)", text)]


def test_site_lines(spark):
    lines = ["chrX,2000001,3000000", "chrX\t2000002\t3000000", "chrX 2000003 3000000", "chrX:2000004:3000000", " chrX  2000005     3000000 ", "chrX,2000006,3000000,foo,bar",
             "17,2000000,3000000", "chr9_gl000199_random,2000000,3000000", "GL.123,2000000,3000000", 'track name=pairedReads description="Clone" useScore=1', "some header", ""]
    got = regions.parse_sites(spark.createDataFrame([(x,) for x in lines], "value string")).collect()
    assert len(got) == 9 and {r.reference_name for r in got} == {"chrX", "17", "chr9_gl000199_random", "GL.123"}
    assert {r.start for r in got if r.reference_name == "chrX"} == set(range(2000001, 2000007))


def test_regions():
    assert regions.parse_regions("17:1:9,chr2:3:4") == [("17", 1, 9), ("chr2", 3, 4)]
    assert regions.split_regions([("1", 0, 25)], 10) == [("1", 0, 10), ("1", 10, 20), ("1", 20, 25)]


def test_variant_predicates(spark):
    rows = [(["PASS"], "1", 10.0, "A", ["G"]), (["BAD"], "chrZ", 0.0, "A", []), (["PASS", "q<10"], "chrX", None, "A", ["G", "T"]), (["."], "chr29", 1.0, "AC", ["G"]), (None, None, 5.0, "A", ["GT"])]
    df = spark.createDataFrame(rows, "filter array<string>, reference_name string, quality double, r string, a array<string>")
    got = df.select(V.is_passing(F.col("filter")), V.is_on_chromosome(F.col("reference_name")), V.is_not_low_quality(F.col("quality")), V.is_single_alternate_snp(F.col("r"), F.col("a"))).collect()
    assert [tuple(r) for r in got] == [(True, True, True, True), (False, False, False, False), (False, True, False, False), (True, True, True, False), (False, False, True, False)]


def test_segment_merge(spark):
    own, one, two = [("het", [1, 0]), ("hom", [1, 1])], [("b1 hom", [0, 0]), ("b1 no", [-1, -1])], [("b2 no", [-1, 0])]
    rows = [("snp1", "chr7", 200010, 200011, "A", ["C"], own), ("snp2", "chr7", 200019, 200020, "T", ["G"], own), ("ins", "chr7", 200010, 200011, "A", ["AC"], own),
            ("block1", "chr7", 199005, 202050, "A", [], one), ("block2", "chr7", 200011, 200020, "A", [], two)]
    df = spark.createDataFrame(rows, VARIANT)
    want = {"snp1": ["het", "hom", "b1 hom", "b1 no"], "snp2": ["het", "hom", "b1 hom", "b1 no", "b2 no"], "ins": ["het", "hom"]}
    for size in (7, 1000, 10**6):
        got = {r.id: [c.call_set_name for c in r.calls] for r in rangejoin.merge_segments(df, size).collect()}
        assert got == want
    sites = spark.createDataFrame([("chr7", 200015, 200030), ("chr7", 200018, 200025)], "reference_name string, start long, end long")
    assert [r.id for r in rangejoin.merge_segments(df, 1000, sites).collect()] == ["snp2"]


def test_interval_overlap_counts_each_pair_once(spark):
    rng = np.random.default_rng(1)
    a = [("1", int(s), int(s + n), i) for i, (s, n) in enumerate(zip(rng.integers(0, 300, 40), rng.integers(1, 90, 40)))]
    b = [("1", int(s), int(s + n), i) for i, (s, n) in enumerate(zip(rng.integers(0, 300, 40), rng.integers(1, 90, 40)))]
    left, right = spark.createDataFrame(a, "ref string, s long, e long, i int"), spark.createDataFrame(b, "ref string, t long, u long, j int")
    got = sorted((r.i, r.j) for r in rangejoin.interval_overlap(left, right, ["ref"], "s", "e", "t", "u", 16).select("i", "j").collect())
    assert got == sorted((x[3], y[3]) for x in a for y in b if x[1] < y[2] and y[1] < x[2])


def ibs_rows(spark, rows):
    return spark.createDataFrame([(f"v{i}", "chr7", 10 + i, 11 + i, "T", ["G"], calls) for i, calls in enumerate(rows)], VARIANT)


def test_identity_by_state(spark):
    v = ibs_rows(spark, [[("het-alt", [1, 0]), ("hom-alt", [1, 1]), ("hom-ref", [0, 0]), ("hom-nocall", [-1, -1]), ("ref-nocall", [-1, 0])], [("hom-alt", [1, 1]), ("het-alt", [0, 1]), ("ref-nocall", [0, -1])]])
    got = {(r.s1, r.s2): (r.total, r.n) for r in similarity.identity_by_state(v).collect()}
    assert got == {("het-alt", "ref-nocall"): (1, 2), ("het-alt", "hom-ref"): (0, 1), ("het-alt", "hom-alt"): (1, 2), ("hom-ref", "ref-nocall"): (0, 1), ("hom-alt", "ref-nocall"): (0, 2), ("hom-alt", "hom-ref"): (0, 1)}
    v = ibs_rows(spark, [[("H1", [0, 0]), ("H2", [1, 0]), ("H3", [0, 1])], [("H1", [0, 0]), ("H2", [1, 1]), ("H3", [1, 1])], [("H1", [0, 0]), ("H2", [1]), ("H3", [0])], [("H1", [0, 0]), ("H2", [1, 0, 1]), ("H3", [1, 0, 0])]])
    got = {(r.s1, r.s2): (r.total, r.n) for r in similarity.identity_by_state(v, "shared_ratio").collect()}
    assert got == {("H1", "H2"): (pytest.approx(5 / 6), 4), ("H1", "H3"): (pytest.approx(4 / 3), 4), ("H2", "H3"): (pytest.approx(5 / 3), 4)}
    got = {(r.s1, r.s2): r.total for r in similarity.identity_by_state(v).collect()}
    assert got == {("H1", "H2"): 0, ("H1", "H3"): 0, ("H2", "H3"): 2}


def test_shared_variants_and_coordinates(spark):
    v = ibs_rows(spark, [[("ref", [0, 0]), ("alt1", [1, 0]), ("alt2", [0, 1]), ("alt3", [1, 1])], [("alt1", [1, 0])]])
    got = {(r.s1, r.s2): r.n for r in similarity.shared_variants(v).collect()}
    assert got == {("alt1", "alt1"): 2, ("alt1", "alt2"): 1, ("alt1", "alt3"): 1, ("alt2", "alt2"): 1, ("alt2", "alt3"): 1, ("alt3", "alt3"): 1}
    rng = np.random.default_rng(2)
    points = rng.normal(size=(6, 2))
    points -= points.mean(axis=0)
    out = similarity.principal_coordinates(points @ points.T)
    assert np.allclose(out @ out.T, points @ points.T)
    assert not similarity.principal_coordinates(np.ones((3, 3))).any()
    assert similarity.pcoa(similarity.shared_variants(v), ["ref", "alt1", "alt2", "alt3"]).count() == 4


def test_coverage_means(spark):
    rows = [("chr1", 3, 15, "123", cigar("2I2X2P")), ("chr1", 2, 1, "123", cigar("1D1N1=")), ("*", None, None, "123", None), ("chr1", 4, 1, "321", cigar("4I4M4S"))]
    got = {(r.bucket, r.read_group_set_id, r.mq): r["mean"] for r in coverage.coverage_means(spark.createDataFrame(rows, READ), 2).collect()}
    assert got == {(2, "123", "L"): 1, (2, "123", "M"): 0.5, (2, "123", "A"): 1.5, (4, "123", "L"): 0.5, (4, "123", "M"): 1, (4, "123", "A"): 1.5, (6, "123", "M"): 0.5, (6, "123", "A"): 0.5,
                   (4, "321", "L"): 1, (4, "321", "A"): 1, (6, "321", "L"): 1, (6, "321", "A"): 1}


def test_coverage_quantiles(spark):
    pos = "0 1 2 0 0 0 0 2 3 0 0 0 3 2 0 0 0 0 1 3 0 0 1 0 2"
    mq = "5 15 35 15 35 5 5 15 15 35 5 15 35 35 15 5 15 15 35 35 5 5 5 5 5"
    size = "4 3 1 3 1 4 3 2 1 1 4 2 1 1 3 4 2 1 2 1 4 3 3 2 1"
    rows = [("1", int(p), int(q), f"rgs{i // 5}", cigar(f"{n}M")) for i, (p, q, n) in enumerate(zip(pos.split(), mq.split(), size.split()))]
    q = coverage.coverage_quantiles(coverage.coverage_means(spark.createDataFrame(rows, READ), 2), 3)
    assert {(r.bucket, r.mq): r.quantiles for r in q.collect()} == {
        (0, "L"): [1, 1, 3.5], (0, "M"): [1.5, 1.5, 2], (0, "H"): [0.5, 0.5, 0.5], (0, "A"): [2.5, 3, 3.5],
        (2, "L"): [1, 1, 3], (2, "M"): [0.5, 1.5, 1.5], (2, "H"): [0.5, 1, 1], (2, "A"): [2, 3, 3],
    }
    a = {r.start: (r.end, r.info["A"]) for r in coverage.coverage_annotations(q, 2).collect()}
    assert a == {0: (2, [2.5, 3, 3.5]), 2: (4, [2, 3, 3])}


@pytest.mark.parametrize("seq,text,want", [("A", "1M", [(123, "A", 1)]), ("AG", "2M", [(123, "A", 1), (124, "G", 2)]), ("ACGT", "1I1M1D2M", [(123, "C", 2), (125, "G", 3), (126, "T", 4)]), ("ACGT", "1D2M1I1M", [(124, "A", 1), (125, "C", 2), (126, "T", 4)]), ("ACGTA", "1S1M1P1H2N3X", [(123, "C", 2), (126, "G", 3), (127, "T", 4), (128, "A", 5)])])
def test_cigar_walk(spark, seq, text, want):
    schema = "reference_name string, position long, reverse_strand boolean, aligned_sequence string, aligned_quality array<int>, cigar array<struct<operation: string, operation_length: long>>"
    df = spark.createDataFrame([("chr1", 123, False, seq, list(range(1, len(seq) + 1)), cigar(text))], schema)
    assert sorted((r.position, r.base, r.quality) for r in contamination.aligned_bases(df).collect()) == want
    some = spark.createDataFrame([("1", p) for p in (100, 123, 125, 128)], "reference_name string, position long")
    for size in (2, 256):
        got = contamination.bases_at(some, df, size)
        assert sorted((r.position, r.base, r.quality) for r in got.collect()) == [w for w in want if w[0] in (123, 125, 128)]


def test_sampling(spark):
    got = spark.createDataFrame([("1:125:false",), ("2:124:false",)], "k string").select(R.sample_share(F.col("k")).alias("x")).collect()
    assert [round(r.x, 4) for r in got] == [0.0936, 0.7876]


def test_pileup_and_likelihood(spark):
    freq = spark.createDataFrame([("1", 123, "A", "G", 0.8), ("1", 124, "C", "T", 0.5), ("1", 125, "T", "C", 0.6), ("1", 999, "A", "C", 0.5)], "reference_name string, position long, ref_base string, alt_base string, ref_freq double")
    bases = spark.createDataFrame([("1", 123, False, "A", 3), ("1", 124, False, "T", 4), ("1", 125, False, "G", 5), ("2", 125, False, "G", 5)], "reference_name string, position long, reverse_strand boolean, base string, quality int")
    got = {r.position: (r.base, r.quality, r.n) for r in contamination.pileup(freq, bases).collect()}
    assert got == {123: ("REF", 3, 1), 124: ("NONREF", 4, 1), 125: ("OTHER", 5, 1), 999: (None, None, 0)}
    for base, want in (("REF", 0.3354133333), ("NONREF", 0.20368), ("OTHER", 0.0385066667)):
        f = contamination.Likelihood([("1:1", 0.6, base, 10, 1)])
        assert np.exp(f(0.25)) == pytest.approx(want, rel=1e-6)
        piles = spark.createDataFrame([("1", 1, 0.6, base, 10, 1)], "reference_name string, position long, ref_freq double, base string, quality int, n long")
        assert contamination.log_likelihood(piles, 0.25).first().log_likelihood == pytest.approx(f(0.25), rel=1e-12)


def test_solver():
    assert contamination.grid_bracket(lambda x: -((x - 0.2) ** 2), 0, 1, 0.1) == pytest.approx((0.1, 0.2, 0.3))
    left, best, right = contamination.grid_bracket(lambda x: x, 0, 1, 0.1)
    assert (left, best, right) == pytest.approx((0.9, 1.0, 1.0))
    assert contamination.brent_maximum(lambda x: -((x - 0.47) ** 2), 0.4, 0.5, 0.6) == pytest.approx(0.47, abs=1e-4)
    f = contamination.Likelihood([("1", 0.8, "REF", 200, 900), ("1", 0.8, "NONREF", 200, 100), ("1", 0.8, "OTHER", 1, 2)])
    assert contamination.grid_bracket(f, 0, 0.5, 0.05)[1] == pytest.approx(0.2)


def test_frequency_filter(spark):
    got = spark.createDataFrame([(0.9999,), (0.9901,), (0.9899,)], "f double").select(V.is_informative_frequency(F.col("f"), 0.01)).collect()
    assert [r[0] for r in got] == [False, False, True]


EFFECT_ROW = "position long, allele string, t_start long, reverse boolean, cds struct<start: long, end: long>, exons array<struct<start: long, end: long, frame: int>>, bases string"
PLAIN = (2, False, (2, 9), [(2, 9, 0)])
BACK = (2, True, (3, 18), [(2, 7, 2), (10, 20, 1)], "ACATGACGGTCCCGTAGG"[::-1].translate(str.maketrans("ACGT", "TGCA")))
MULTI = (100, False, (250, 580), [(100, 180, None), (200, 300, 2), (400, 500, 1), (550, 600, 0)], "ACTTGGGTCA" * 60)


@pytest.mark.parametrize("position,allele,tx,want", [
    (3, "C", (*PLAIN, "GATTACA"), "NONSYNONYMOUS_SNP"), (7, "G", (*PLAIN, "ATGTGAA"), "STOP_LOSS"), (5, "T", (*PLAIN, "CCCAAAT"), "STOP_GAIN"), (4, "C", (*PLAIN, "GATTACA"), "SYNONYMOUS_SNP"), (123, "C", (*PLAIN, "GATTACA"), None),
    (16, "G", BACK, "NONSYNONYMOUS_SNP"), (5, "G", BACK, "STOP_LOSS"), (9, "C", BACK, None), (19, "C", BACK, None),
    (150, "C", MULTI, None), (240, "C", MULTI, None), (350, "C", MULTI, None), (250, "T", MULTI, "NONSYNONYMOUS_SNP"), (454, "C", MULTI, "NONSYNONYMOUS_SNP"),
    (3, "C", (2, False, None, [(2, 9, 0)], "GATTACA"), None), (3, "CA", (*PLAIN, "GATTACA"), None), (3, "C", (2, False, (2, 9), [(2, 9, None)], "GATTACA"), None),
])
def test_coding_effect(spark, position, allele, tx, want):
    assert codons.with_effect(spark.createDataFrame([(position, allele, *tx)], EFFECT_ROW)).first().effect == want


def test_private_and_deleted(spark):
    rows = [("a", "1", 1, 2, "A", ["C"], [("x", [0]), ("y", [1])]), ("b", "1", 1, 2, "A", ["C"], [("x", [0]), ("z", [1])]), ("c", "1", 1, 2, "A", ["C"], [])]
    v = spark.createDataFrame(rows, VARIANT)
    assert [r.id for r in ops.private_variants(v, ["x", "y"]).collect()] == ["a"]
    assert sorted(r.id for r in ops.private_variants(v, ["x", "y"], True).collect()) == ["a", "c"]
    ids = ops.listed_ids(spark.createDataFrame([(" a\tfoo",), ("c,bar",), ("",), ("a",)], "value string"))
    left, count = ops.delete_variants(v, ids)
    assert [r.id for r in left.collect()] == ["b"] and count.first().n_deleted == 2
    sets = spark.createDataFrame([("i1", "n1"), ("i2", "n2")], "id string, name string")
    assert ops.resolve_call_sets(sets, ["n2", "n1"]) == ["i2", "i1"]
    for bad in (["n1", "n1"], ["n3"]):
        with pytest.raises(ValueError):
            ops.resolve_call_sets(sets, bad)


def test_annotate_joins_both_kinds(spark):
    v = spark.createDataFrame([("v", "chr1", 3, 4, "A", ["C"], [])], VARIANT)
    known = spark.createDataFrame([("k", "1", 3, 4, ("C", "SNP", "KNOWN", "g", []))], "id string, reference_name string, start long, end long, variant struct<alternate_bases: string, type: string, effect: string, gene_id: string, transcript_ids: array<string>>")
    tx = spark.createDataFrame([("t", "1", 2, 9, None, "GATTACA", ("g", (2, 9), [(2, 9, 0)]))], "id string, reference_name string, start long, end long, reverse_strand boolean, bases string, transcript struct<gene_id: string, coding_sequence: struct<start: long, end: long>, exons: array<struct<start: long, end: long, frame: int>>>")
    got = annotate.annotate(v, known, tx).collect()
    assert [(r.key, sorted(a.effect for a in r.annotations)) for r in got] == [("chr1:3:C:v", ["KNOWN", "NONSYNONYMOUS_SNP"])]
