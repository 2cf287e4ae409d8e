"""Variant annotation: exact matches to known annotations and coding effects on overlapping transcripts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import codons, variants as V
from .rangejoin import interval_overlap


def alleles(variants: DataFrame) -> DataFrame:
    """(reference_name, canonical, start, end, allele, variant_id): a row for each alternate and the reference allele of the SNPs."""
    snps = variants.where(V.is_snp(F.col("reference_bases"), F.col("alternate_bases")))
    every = F.concat("alternate_bases", F.array("reference_bases"))
    return snps.select("reference_name", V.canonical_reference(F.col("reference_name")).alias("canonical"), "start", "end", F.explode(every).alias("allele"), F.col("id").alias("variant_id"))


def exact_matches(variants: DataFrame, known: DataFrame) -> DataFrame:
    """Alleles that a known annotation names at the same interval: an equality join.

    known: (reference_name, start, end, variant struct<alternate_bases, type, effect, gene_id, transcript_ids>); a null start is 0.
    """
    k = known.select(
        V.canonical_reference(F.col("reference_name")).alias("canonical"), F.coalesce("start", F.lit(0)).cast("long").alias("start"), "end",
        F.col("variant.alternate_bases").alias("allele"), "variant",
    )
    a = alleles(variants)
    return a.join(k, ["canonical", "start", "end", "allele"]).select("reference_name", "start", "allele", "variant_id", "variant")


def with_bases(transcripts: DataFrame, references: DataFrame) -> DataFrame:
    """Transcripts with their bases from references(reference_name, start, end, bases), given for the same intervals; none found: null."""
    r = references.select(V.canonical_reference(F.col("reference_name")).alias("_name"), F.col("start").alias("_from"), F.col("end").alias("_to"), F.col("bases").alias("_bases")).distinct()
    on = (V.canonical_reference(F.col("reference_name")) == F.col("_name")) & (F.coalesce("start", F.lit(0)) == F.col("_from")) & (F.col("end") == F.col("_to"))
    kept = [c for c in transcripts.columns if c != "bases"]
    return transcripts.select(*kept).join(r, on, "left").select(*kept, F.col("_bases").alias("bases"))


def transcript_effects(variants: DataFrame, transcripts: DataFrame, bin_size: int = 10_000) -> DataFrame:
    """Non-synonymous effects of alleles on the transcripts they overlap: a binned interval join, no nested loop.

    transcripts: (id, reference_name, start, end, reverse_strand, bases, transcript struct<gene_id, coding_sequence, exons>).
    The effect is computed right after the join; the transcript's bases travel no further. Only rows with an effect leave it.
    Rows outside a coding exon, or with several bases, have none.
    """
    t = transcripts.select(
        V.canonical_reference(F.col("reference_name")).alias("canonical"), F.coalesce("start", F.lit(0)).cast("long").alias("t_start"), F.col("end").alias("t_end"),
        F.coalesce("reverse_strand", F.lit(False)).alias("reverse"), "bases", F.col("id").alias("transcript_id"), F.col("transcript.gene_id").alias("gene_id"),
        F.col("transcript.coding_sequence").alias("cds"), F.col("transcript.exons").alias("exons"),
    )
    met = interval_overlap(alleles(variants), t.withColumnRenamed("canonical", "t_canonical").withColumn("canonical", F.col("t_canonical")).drop("t_canonical"), ["canonical"], "start", "end", "t_start", "t_end", bin_size)
    rows = met.select("reference_name", F.col("start").alias("position"), "allele", "variant_id", "t_start", "reverse", "cds", "exons", "bases", "gene_id", "transcript_id")
    found = codons.with_effect(rows).where("effect <> 'SYNONYMOUS_SNP'").withColumnRenamed("position", "start")
    variant = F.struct(F.col("allele").alias("alternate_bases"), F.lit("SNP").alias("type"), "effect", "gene_id", F.array("transcript_id").alias("transcript_ids"))
    return found.select("reference_name", "start", "allele", "variant_id", variant.alias("variant"))


def annotate(variants: DataFrame, known: DataFrame, transcripts: DataFrame, bin_size: int = 10_000) -> DataFrame:
    """(key, annotations): key is reference:start:allele:id, annotations the sorted list of both kinds' matches."""
    rows = exact_matches(variants, known).unionByName(transcript_effects(variants, transcripts, bin_size))
    key = F.concat_ws(":", "reference_name", F.col("start").cast("string"), "allele", "variant_id")
    return rows.groupBy(key.alias("key")).agg(F.array_sort(F.collect_list("variant")).alias("annotations"))
