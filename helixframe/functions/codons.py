"""The genetic code and the effect of a base change on a transcript."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The standard genetic code. Amino acids of the codons in the order of the bases TCAG; * stops.
BASES = "TCAG"
AMINO_ACIDS = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"


#: Every codon in that order, each with a bar after it.
_CODONS = "".join(f"{a}{b}{c}|" for a in BASES for b in BASES for c in BASES)


def translate(codon: Column) -> Column:
    """The amino acid of a codon; null if it is none. A codon is looked up once, so the expression stays small."""
    at = F.instr(F.lit(_CODONS), F.concat(codon, F.lit("|"))) - 1
    return F.when(F.length(codon) == 3, F.substring(F.lit(AMINO_ACIDS), F.when(at >= 0, at.cast("int").bitwiseAND(~3) / 4).cast("int") + 1, F.lit(1)))


def reverse_complement(bases: Column) -> Column:
    return F.reverse(F.translate(bases, "ACGT", "TGCA"))


def with_effect(rows: DataFrame) -> DataFrame:
    """rows(position, allele, t_start, reverse, cds, exons, bases, ...) with a column effect in place of reverse, cds, exons and bases.

    The effect is SYNONYMOUS_SNP, NONSYNONYMOUS_SNP, STOP_GAIN or STOP_LOSS of a one-base allele; null if it has none on
    the coding sequence. The first exon that holds the position within the coding sequence decides, and must have a
    frame. The codon must lie inside the exon with a base to spare after it. Each step is a projection of its own, so that no
    expression is repeated inside another.
    """
    c = F.col
    inside = lambda e: (e.start <= c("position")) & (c("position") < e.end) & (c("cds.start") <= c("position")) & (c("position") < c("cds.end"))
    keep = [x for x in rows.columns if x not in ("reverse", "cds", "exons", "bases")]
    x = rows.withColumn("exon", F.get(F.filter("exons", inside), F.lit(0)))
    x = x.select(
        *keep, "reverse", "bases", "exon", (c("exon.end") - c("exon.start")).alias("size"),
        F.when(c("reverse"), c("exon.end") - c("position") - 1).otherwise(c("position") - c("exon.start")).alias("offset"),
    )
    x = x.withColumn("within", (c("offset") + c("exon.frame")) % 3).withColumn("at", c("offset") - c("within"))
    # tested where the effect is named, not as a filter: filters may be reordered, and an unknown codon is an error
    usable = F.expr("length(allele) = 1 AND exon.frame IS NOT NULL AND at >= 0 AND size > at + 3")
    x = x.withColumn("usable", F.coalesce(usable, F.lit(False)))
    # the codon's place in the bases as given: counted from the exon's end on the reverse strand
    first = F.when(c("reverse"), c("exon.end") - c("t_start") - c("at") - 3).otherwise(c("exon.start") - c("t_start") + c("at"))
    x = x.withColumn("plain", F.substring("bases", (first + 1).cast("int"), F.lit(3)))
    x = x.withColumn("codon", F.when(c("reverse"), reverse_complement(c("plain"))).otherwise(c("plain")))
    base = F.when(c("reverse"), F.translate("allele", "ACGT", "TGCA")).otherwise(c("allele"))
    x = x.withColumn("changed", F.concat(F.substring("codon", F.lit(1), c("within").cast("int")), base, F.substring("codon", (c("within") + 2).cast("int"), F.lit(3))))
    x = x.withColumn("before", translate(c("codon"))).withColumn("after", translate(c("changed")))
    unknown = F.raise_error(F.concat(F.lit("not a codon: "), F.when(c("before").isNull(), c("codon")).otherwise(c("changed")))).cast("string")
    named = F.when(c("before") == c("after"), "SYNONYMOUS_SNP").when(c("after") == "*", "STOP_GAIN").when(c("before") == "*", "STOP_LOSS").otherwise("NONSYNONYMOUS_SNP")
    return x.select(*keep, F.when(c("usable"), F.when(c("before").isNull() | c("after").isNull(), unknown).otherwise(named)).alias("effect"))
