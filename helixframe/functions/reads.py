"""Predicates and derived values of reads, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .variants import CHROMOSOME

#: Operations that take up reference bases in the coverage length (padding counts there).
COVERING = ("ALIGNMENT_MATCH", "SEQUENCE_MATCH", "SEQUENCE_MISMATCH", "PAD", "DELETE", "SKIP")
_ALIGNED = ("ALIGNMENT_MATCH", "SEQUENCE_MATCH", "SEQUENCE_MISMATCH")
_READ_ONLY = ("INSERT", "CLIP_SOFT")
_REFERENCE_ONLY = ("DELETE", "SKIP")


def is_unmapped(reference_name: Column) -> Column:
    return reference_name.isNull() | reference_name.isin("", "*")


def covered_length(cigar: Column) -> Column:
    return F.aggregate(F.filter(cigar, lambda c: c.operation.isin(*COVERING)), F.lit(0).cast("long"), lambda a, c: a + c.operation_length)


def mapping_class(mapping_quality: Column) -> Column:
    """L below 10 (and for null), M below 30, H from there on."""
    q = F.coalesce(mapping_quality, F.lit(0))
    return F.when(q < 10, "L").when(q < 30, "M").otherwise("H")


def strip_chromosome(reference_name: Column) -> Column:
    """Drop a leading `chr` from the names of numbered and sex chromosomes."""
    return F.when(reference_name.rlike(CHROMOSOME), F.regexp_replace(reference_name, "^chr", "")).otherwise(reference_name)


def runs(cigar: Column) -> Column:
    """Aligned runs array<struct<read, reference, length>>: offsets into the read and from the alignment's start."""
    start = F.struct(F.lit(0).cast("long").alias("read"), F.lit(0).cast("long").alias("reference"), F.array().cast("array<struct<read:bigint,reference:bigint,length:bigint>>").alias("out"))

    def step(s: Column, c: Column) -> Column:
        aligned = c.operation.isin(*_ALIGNED)
        n = c.operation_length.cast("long")
        return F.struct(
            (s.read + F.when(aligned | c.operation.isin(*_READ_ONLY), n).otherwise(F.lit(0).cast("long"))).alias("read"),
            (s.reference + F.when(aligned | c.operation.isin(*_REFERENCE_ONLY), n).otherwise(F.lit(0).cast("long"))).alias("reference"),
            F.when(aligned, F.concat(s.out, F.array(F.struct(s.read.alias("read"), s.reference.alias("reference"), n.alias("length"))))).otherwise(s.out).alias("out"),
        )

    return F.aggregate(cigar, start, step, lambda s: s.out)


def loci_shard(reference_name: Column, position: Column, mate_reference: Column, mate_position: Column, loci: int) -> tuple[Column, Column]:
    """(reference, first locus of the shard) of a read; its mate's where it has no position, else `*` and 0."""
    own, mate = ~is_unmapped(reference_name) & position.isNotNull(), ~is_unmapped(mate_reference) & mate_position.isNotNull()
    name = F.when(own, reference_name).when(mate, mate_reference).otherwise("*")
    at = F.when(own, position).when(mate, mate_position).otherwise(F.lit(0))
    return name, (at - at % loci).cast("long")


def sample_share(key: Column) -> Column:
    """A number in [0, 1] from the first 64 bits of the key's MD5, read as a signed integer: ((x / -2**63) + 1) / 2."""
    signed = F.conv(F.substring(F.md5(key), 1, 16), 16, -10).cast("bigint")
    return (F.lit(1.0) - signed / F.lit(9223372036854775808.0)) * 0.5


def phred_error(quality: Column) -> Column:
    return F.pow(F.lit(10.0), -quality / 10.0)
