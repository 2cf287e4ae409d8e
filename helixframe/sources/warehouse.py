"""The nested warehouse table of reads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import CIGAR_OPERATIONS, READS


def operation_code(operation: Column) -> Column:
    out = F.lit(0)
    for name, _, code in CIGAR_OPERATIONS:
        out = F.when(operation == name, code).otherwise(out)
    return out.cast("long")


def to_rows(reads: DataFrame) -> DataFrame:
    """Flat reads as rows of the warehouse schema (cigar operations by their integer); columns that reads lack are null."""
    has = lambda name, kind: F.col(name).cast(kind) if name in reads.columns else F.lit(None).cast(kind)
    place = lambda ref, pos, rev: F.when(ref.isNotNull(), F.struct(ref.alias("reference_name"), pos.alias("position"), rev.alias("reverse_strand")))
    fields = next(iter(reads.select("cigar").schema)).dataType.elementType.names if "cigar" in reads.columns else []
    bases = (lambda c: c.reference_sequence) if "reference_sequence" in fields else (lambda c: F.lit(None).cast("string"))
    cigar = F.transform("cigar", lambda c: F.struct(operation_code(c.operation).alias("operation"), c.operation_length.cast("long").alias("operation_length"), bases(c).alias("reference_sequence")))
    alignment = F.struct(place(has("reference_name", "string"), has("position", "long"), has("reverse_strand", "boolean")).alias("position"), has("mapping_quality", "long").alias("mapping_quality"), cigar.alias("cigar"))
    mapped = F.col("reference_name").isNotNull() & ~F.col("reference_name").isin("", "*")
    return reads.select(
        has("id", "string").alias("id"), has("read_group_id", "string").alias("read_group_id"), has("read_group_set_id", "string").alias("read_group_set_id"),
        has("fragment_name", "string").alias("fragment_name"), has("proper_placement", "boolean").alias("proper_placement"), has("duplicate_fragment", "boolean").alias("duplicate_fragment"),
        has("fragment_length", "long").alias("fragment_length"), has("read_number", "long").alias("read_number"), has("number_reads", "long").alias("number_reads"),
        has("failed_vendor_quality_checks", "boolean").alias("failed_vendor_quality_checks"), F.when(mapped, alignment).alias("alignment"),
        has("secondary_alignment", "boolean").alias("secondary_alignment"), has("supplementary_alignment", "boolean").alias("supplementary_alignment"),
        has("aligned_sequence", "string").alias("aligned_sequence"), has("aligned_quality", "array<long>").alias("aligned_quality"),
        place(has("mate_reference_name", "string"), has("mate_position", "long"), has("mate_reverse_strand", "boolean")).alias("next_mate_position"),
    )


def save(reads: DataFrame, path: str, mode: str = "error") -> None:
    """Write the rows as Parquet, split by chromosome so that region scans skip files."""
    rows = to_rows(reads).withColumn("reference", F.coalesce("alignment.position.reference_name", F.lit("*")))
    rows.write.mode(mode).partitionBy("reference").parquet(path)


def save_table(reads: DataFrame, name: str, mode: str = "error") -> None:
    """Write the rows as a table of the session's catalog, split by chromosome."""
    rows = to_rows(reads).withColumn("reference", F.coalesce("alignment.position.reference_name", F.lit("*")))
    rows.write.mode(mode).partitionBy("reference").saveAsTable(name)


__all__ = ["READS", "operation_code", "save", "save_table", "to_rows"]
