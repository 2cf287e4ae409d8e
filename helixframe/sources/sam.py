"""SAM text as reads, parsed by Spark's own functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import CIGAR_OPERATIONS

#: Bits of the flag column. Fixed values of the format.
PAIRED, PROPER, UNMAPPED, MATE_UNMAPPED, REVERSE, MATE_REVERSE, FIRST, LAST, SECONDARY, FAILED, DUPLICATE, SUPPLEMENTARY = (1 << i for i in range(12))

FIELDS = ["qname", "flag", "rname", "pos", "mapq", "cigar", "rnext", "pnext", "tlen", "seq", "qual"]


def parse_header(lines: list[str]) -> dict:
    """Header lines as {type: [fields] or fields for HD}; comments are texts."""
    out: dict = {}
    for line in lines:
        kind, _, rest = line.rstrip("\n").partition("\t")
        kind = kind[1:]
        if kind == "CO":
            out.setdefault("CO", []).append(rest)
            continue
        fields = dict(f.split(":", 1) for f in rest.split("\t") if ":" in f)
        if kind == "HD":
            out["HD"] = fields
        else:
            out.setdefault(kind, []).append(fields)
    return out


def header_text(header: dict) -> str:
    line = lambda kind, f: "@" + "\t".join([kind, *(f"{k}:{v}" for k, v in f.items())]) + "\n"
    out = line("HD", header["HD"]) if "HD" in header else ""
    for kind in ("SQ", "RG", "PG"):
        out += "".join(line(kind, f) for f in header.get(kind, []))
    return out + "".join(f"@CO\t{c}\n" for c in header.get("CO", []))


def read_header(spark: SparkSession, path: str) -> dict:
    """The header of a SAM file: its leading lines, fetched until one is no header line."""
    lines, n = spark.read.text(path), 1000
    while True:
        first = [r.value for r in lines.take(n)]
        if len(first) < n or not first[-1].startswith("@"):
            return parse_header([x for x in first if x.startswith("@")])
        n *= 10


def header_references(spark: SparkSession, header: dict) -> DataFrame:
    """(reference_name, length, sequence_index) a sequence of the header."""
    rows = [(s["SN"], int(s.get("LN", 0)), i) for i, s in enumerate(header.get("SQ", []))]
    return spark.createDataFrame(rows, "reference_name string, length long, sequence_index int")


def first_contig(header: dict, contigs: list[tuple[str, int, int]]) -> tuple[str, int, int] | None:
    """Of contigs (name, start, end), the first in the order of the header's sequences, then of starts; None if there are none."""
    order = {s["SN"]: i for i, s in enumerate(header.get("SQ", []))}
    return min(contigs, key=lambda c: (order.get(c[0], -1), c[1]), default=None)


def first_position(reads: DataFrame, header: dict) -> tuple[str, int] | None:
    """The first mapped read's place, in the order of the header's sequences."""
    order = {s["SN"]: i for i, s in enumerate(header.get("SQ", []))}
    mapped = reads.where("reference_name IS NOT NULL AND reference_name <> '*'").groupBy("reference_name").agg(F.min("position").alias("p")).collect()
    known = sorted((order[r.reference_name], r.p, r.reference_name) for r in mapped if r.reference_name in order)
    return (known[0][2], known[0][1]) if known else None


def parse_cigar(cigar: Column) -> Column:
    """A cigar text as array<struct<operation, operation_length>>; null for `*`."""
    name = F.create_map(*[F.lit(x) for op, letter, _ in CIGAR_OPERATIONS for x in (letter, op)])
    sizes = F.regexp_extract_all(cigar, F.lit(r"(\d+)([MIDNSHP=X])"), F.lit(1))
    letters = F.regexp_extract_all(cigar, F.lit(r"(\d+)([MIDNSHP=X])"), F.lit(2))
    parsed = F.zip_with(letters, sizes, lambda o, n: F.struct(name[o].alias("operation"), n.cast("long").alias("operation_length")))
    return F.when(cigar != "*", parsed)


def reads_of(rows: DataFrame) -> DataFrame:
    """Flat reads of rows with the columns FIELDS (and tags array<string>): positions 0-based, `*` and 0 as null."""
    flag = lambda bit: F.col("flag").bitwiseAND(bit) != 0
    name = lambda c: F.when(F.col(c) != "*", F.col(c))
    zero = lambda c: F.when(F.col(c) > 0, F.col(c) - 1).cast("long")
    mate = F.when(F.col("rnext") == "=", name("rname")).otherwise(name("rnext"))
    quality = F.when(F.col("qual") != "*", F.transform(F.split("qual", ""), lambda q: F.ascii(q).cast("long") - 33))
    group = F.expr("substring(get(filter(tags, t -> t LIKE 'RG:Z:%'), 0), 6)")
    tag = lambda t: F.expr(f"substring(get(filter(tags, t -> t LIKE '{t}:%'), 0), 6)")
    return rows.select(
        F.concat_ws(":", "qname", F.col("flag").cast("string"), "rname", F.col("pos").cast("string")).alias("id"), F.col("qname").alias("fragment_name"), group.alias("read_group_id"),
        name("rname").alias("reference_name"), zero("pos").alias("position"), flag(REVERSE).alias("reverse_strand"), F.col("mapq").cast("int").alias("mapping_quality"),
        parse_cigar(F.col("cigar")).alias("cigar"), (flag(PROPER) & flag(PAIRED)).alias("proper_placement"), flag(DUPLICATE).alias("duplicate_fragment"),
        flag(FAILED).alias("failed_vendor_quality_checks"), flag(SECONDARY).alias("secondary_alignment"), flag(SUPPLEMENTARY).alias("supplementary_alignment"),
        flag(UNMAPPED).alias("unmapped"), F.col("tlen").cast("long").alias("fragment_length"), F.when(flag(LAST), 1).otherwise(0).cast("long").alias("read_number"),
        F.when(flag(PAIRED), 2).otherwise(1).cast("long").alias("number_reads"), F.when(F.col("seq") != "*", F.col("seq")).alias("aligned_sequence"), quality.alias("aligned_quality"),
        mate.alias("mate_reference_name"), zero("pnext").alias("mate_position"), flag(MATE_REVERSE).alias("mate_reverse_strand"), tag("MD").alias("md"),
    )


def sam_rows(spark: SparkSession, path: str) -> DataFrame:
    """The alignment lines as columns; lines with fewer than eleven fields are dropped."""
    parts = F.split("value", "\t")
    lines = spark.read.text(path).where(~F.col("value").startswith("@") & (F.size(parts) >= 11))
    ints = {"flag", "pos", "mapq", "pnext", "tlen"}
    cols = [F.get(parts, F.lit(i)).cast("int" if f in ints else "string").alias(f) for i, f in enumerate(FIELDS)]
    return lines.select(*cols, F.slice(parts, F.lit(12), F.greatest(F.size(parts) - 11, F.lit(0))).alias("tags"))


def read_sam(spark: SparkSession, path: str) -> DataFrame:
    return reads_of(sam_rows(spark, path))
