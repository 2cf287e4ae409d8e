"""SAM and BAM: parsing, writing, index planning, reading back, comparing."""

import pytest
from pyspark.sql import functions as F

from helixframe.operators.diff import diff_headers, diff_reads
from helixframe.sources import bam, sam, text, warehouse

HEADER = "@HD\tVN:1.4\tSO:coordinate\n@SQ\tSN:chr1\tLN:400000\n@SQ\tSN:chr2\tLN:1000\n@RG\tID:g1\tSM:s\tPI:0\n@CO\tmade for a test\n"


def lines():
    out = [f"r{i}\t{99 if i % 3 else 1171}\tchr1\t{1 + i * 379}\t{i % 60}\t2S8M1D3M\t=\t{200 + i * 379}\t50\tACGTNACGTACGT\tIIIIIIIIIIIII\tRG:Z:g1\tNM:i:{i % 5}" for i in range(1000)]
    out += ["u\t4\t*\t0\t0\t*\t*\t0\t0\tACG\t*", "m\t69\tchr2\t7\t0\t*\t=\t7\t0\tAC\tII\tXB:B:c,1,-2\tXF:f:0.5\tXA:A:q", "n\t137\tchr2\t7\t60\t2M\t=\t7\t0\tAC\tII"]
    return out


@pytest.fixture()
def sam_path(tmp_path):
    p = tmp_path / "in.sam"
    p.write_text(HEADER + "\n".join(lines()) + "\n")
    return str(p)


def test_sam_reads(spark, sam_path):
    header = sam.read_header(spark, sam_path)
    assert [s["SN"] for s in header["SQ"]] == ["chr1", "chr2"] and sam.header_text(header) == HEADER
    reads = sam.read_sam(spark, sam_path)
    assert reads.count() == 1003
    r = reads.where("fragment_name = 'r3'").first()
    assert (r.position, r.reverse_strand, r.duplicate_fragment, r.read_group_id, r.mate_reference_name) == (3 * 379, True, True, "g1", "chr1")
    assert [(c.operation, c.operation_length) for c in r.cigar] == [("CLIP_SOFT", 2), ("ALIGNMENT_MATCH", 8), ("DELETE", 1), ("ALIGNMENT_MATCH", 3)] and r.aligned_quality == [40] * 13
    u = reads.where("fragment_name = 'u'").first()
    assert u.reference_name is None and u.position is None and u.cigar is None and u.aligned_quality is None
    assert sam.first_position(reads, header) == ("chr1", 0)
    assert [r.reference_name for r in sam.header_references(spark, header).orderBy("sequence_index").collect()] == ["chr1", "chr2"]
    rows = warehouse.to_rows(reads)
    got = rows.where("id LIKE 'r3:%'").first()
    assert [c.operation for c in got.alignment.cigar] == [3, 1, 4, 1]
    assert rows.where("alignment IS NULL").count() == 1


def test_bam_round_trip(spark, sam_path, tmp_path):
    rows, header = sam.sam_rows(spark, sam_path), sam.read_header(spark, sam_path)
    path = str(tmp_path / "out.bam")
    bam.write_bam(rows, header, path, 3)
    assert bam.read_bam_header(path) == header
    want = sorted(map(tuple, (tuple(map(str, r)) for r in rows.collect())))
    for most in (100, 1 << 30):
        back = bam.read_bam(spark, path, maxShardBytes=str(most))
        assert sorted(tuple(map(str, r)) for r in back.collect()) == want
    assert len(bam.plan(path, [], 2000, True)) > 3
    region = [r.pos for r in bam.read_bam(spark, path, regions="chr1:1000:90000", maxShardBytes="1000", includeUnmapped="false").collect()]
    assert sorted(region) == [1 + i * 379 for i in range(1000) if 1000 <= 1 + i * 379 <= 90000]
    # 1-based, both ends in; shards that meet share no record
    for most in ("1", "1000000"):
        ends = bam.read_bam(spark, path, regions="chr1:1517:3412", maxShardBytes=most, includeUnmapped="false").collect()
        assert sorted(r.pos for r in ends) == [1517, 1896, 2275, 2654, 3033, 3412]
    # shards by loci, and by a rule of one's own
    shards = [s for s in bam.plan(path, [], 1 << 40, False, loci=100_000) if s.reference == "chr1"]
    assert len(shards) == 4 and all(s.end - s.start > 100_000 for s in shards[:-1])
    assert sorted(r.pos for r in bam.read_bam(spark, path, maxShardLoci="100000", includeUnmapped="false").where("rname <> '*'").collect()) == sorted(r[3] for r in places_of(path))
    assert len([s for s in bam.plan(path, [], 0, False, full=lambda width, size: width >= 4 * bam.WINDOW) if s.reference == "chr1"]) == 6
    # a text file that lists files; a path without any
    (tmp_path / "files.txt").write_text("out.bam\n\n")
    assert bam.read_bam(spark, str(tmp_path / "files.txt")).count() == 1003
    with pytest.raises(Exception, match="no .bam file at"):
        bam.read_bam(spark, str(tmp_path / "nothing*")).count()
    reader = bam.BlockReader(path)
    bam.header_of(reader)
    places = []
    for shard in [bam.Shard(path, None, 0, 0, [(reader.tell(), 1 << 60)])]:
        places = [(r[2], r[3]) for r in bam.records(shard, True)]
    assert places == sorted(places, key=lambda x: (["chr1", "chr2", "*"].index(x[0]), x[1]))
    assert bam.chunk_bytes([(1, 20)]) == 19


def places_of(path):
    reader = bam.BlockReader(path)
    bam.header_of(reader)
    return [r for r in bam.records(bam.Shard(path, None, 0, 0, [(reader.tell(), 1 << 60)]), False)]


def test_bam_records_that_cannot_be_read(spark, sam_path, tmp_path, monkeypatch):
    rows, header = sam.sam_rows(spark, sam_path), sam.read_header(spark, sam_path)
    path = str(tmp_path / "bad.bam")
    real = bam.encode
    # a tag of an unknown kind at the end of some records
    def broken(row, index):  # noqa: E301
        raw, *place = real(row, index)
        if row.qname in ("r3", "r8"):
            raw = (int.from_bytes(raw[:4], "little") + 4).to_bytes(4, "little") + raw[4:] + b"XX?1"
        return raw, *place
    names, out = [s["SN"] for s in header["SQ"]], None
    with open(path, "wb") as f:
        out = bam.BlockWriter(f)
        text = sam.header_text(header).encode()
        out.write(b"BAM\1" + len(text).to_bytes(4, "little") + text + len(names).to_bytes(4, "little"))
        for s in header["SQ"]:
            out.write((len(s["SN"]) + 1).to_bytes(4, "little") + s["SN"].encode() + b"\0" + int(s["LN"]).to_bytes(4, "little"))
        for r in rows.collect():
            out.write(broken(r, {n: i for i, n in enumerate(names)})[0])
        out.flush()
        f.write(bam.EOF)
    with pytest.raises(Exception, match="cannot be read"):
        bam.read_bam(spark, path).count()
    left = bam.read_bam(spark, path, mode="dropmalformed")
    assert left.count() == 1001 and left.where("qname IN ('r3', 'r8')").count() == 0
    bad = bam.read_bam(spark, path, mode="MALFORMED").collect()
    assert len(bad) == 2 and all(r.qname.startswith(path) and r.pos is None for r in bad)
    with pytest.raises(Exception, match="mode is one of"):
        bam.read_bam(spark, path, mode="lenient").count()


def test_long_headers(spark, tmp_path):
    p = tmp_path / "long.sam"
    p.write_text("@HD\tVN:1.4\n" + "".join(f"@SQ\tSN:c{i}\tLN:{i + 1}\n" for i in range(2500)) + "r\t0\tc1\t1\t9\t1M\t*\t0\t0\tA\t@\n")
    header = sam.read_header(spark, str(p))
    assert len(header["SQ"]) == 2500
    assert sam.first_contig(header, [("c7", 1, 9), ("c2", 50, 60), ("c2", 3, 4)]) == ("c2", 3, 4) and sam.first_contig(header, []) is None


def test_bam_without_index(spark, sam_path, tmp_path):
    import os

    path = str(tmp_path / "x.bam")
    bam.write_bam(sam.sam_rows(spark, sam_path), sam.read_header(spark, sam_path), path, 2)
    os.remove(path + ".bai")
    assert bam.read_bam(spark, str(tmp_path)).count() == 1003
    assert bam.read_bam(spark, path, includeUnmapped="false").where("rname <> '*'").count() == 1001


def test_diff(spark, sam_path):
    reads = sam.sam_rows(spark, sam_path)
    other = reads.where("qname <> 'r5'").withColumn("mapq", F.when(F.col("qname") == "r7", 1).otherwise(F.col("mapq")))
    got = {(r.qname, r.status, tuple(r.fields or ())) for r in diff_reads(reads, other, ["rname", "pos", "qname"], ["mapq", "seq"]).collect()}
    assert got == {("r5", "first only", ()), ("r7", "different", ("mapq",))}
    a = sam.parse_header(HEADER.splitlines())
    b = {**a, "SQ": a["SQ"][::-1], "RG": [{"ID": "g1", "SM": "s"}]}
    assert diff_headers(a, b) == [] and diff_headers(a, b, ignore_sequence_order=False, zero_insert_is_none=False) == ["sequences", "read groups"]


def test_text_forms(spark, tmp_path):
    p = tmp_path / "family.txt"
    p.write_text("NA12877\nNA12889 NA1\n")
    assert text.call_set_names(spark, path=str(p)) == ["NA12877", "NA12889", "NA1"] and text.call_set_names(spark, "a, b") == ["a", "b"]
    with pytest.raises(ValueError):
        text.call_set_names(spark, "a", str(p))
    v = spark.createDataFrame([("i", "chr1", 1, 2, "A", ["C", "G"])], "id string, reference_name string, start long, end long, reference_bases string, alternate_bases array<string>")
    assert text.private_variant_lines(v).first().value == "i\tchr1\t1\t2\tA\tC,G"
    pts = spark.createDataFrame([("n", -0.5, 1.25)], "name string, x double, y double")
    text.write_lines(text.pcoa_lines(pts), str(tmp_path / "o"), single=True)
    assert [r.value for r in spark.read.text(str(tmp_path / "o")).collect()] == ["n\t\t-0.5\t1.25"]


def test_registered_round_trip_equals_its_sql(spark):
    import duckdb

    import __spark_entry__

    folder = "/root/testdata/sf0.001"
    got = __spark_entry__.queries()["bam_round_trip"](spark, folder)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW lineitem AS SELECT * FROM '{folder}/lineitem.parquet'")
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({__spark_entry__.oracle_sql()['bam_round_trip']})").fetchall()
    assert len(want) > 1000 and sorted(map(tuple, got.collect())) == sorted(want)
