"""Regions: parsing and the two ways a row belongs to a shard."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed value. A site line: name, start and end with any non-word characters between; what follows is ignored.
SITE_LINE = r"^\s*([\w\.]+)\W+(\d+)\W+(\d+).*$"


def parse_regions(text: str) -> list[tuple[str, int, int]]:
    """`ref:start:end,...` as half-open regions."""
    out = []
    for part in filter(None, (p.strip() for p in text.split(","))):
        name, start, end = part.rsplit(":", 2)
        out.append((name, int(start), int(end)))
    return out


def parse_sites(lines: DataFrame) -> DataFrame:
    """(reference_name, start, end) of the lines(value) that hold a site; others are dropped."""
    part = lambda i: F.regexp_extract("value", SITE_LINE, i)
    return lines.where(part(1) != "").select(part(1).alias("reference_name"), part(2).cast("long").alias("start"), part(3).cast("long").alias("end"))


def starts_in(reference: Column, position: Column, region: tuple[str, int, int]) -> Column:
    """STRICT: the row starts inside the region, so shards that meet share no row."""
    return (reference == region[0]) & (position >= region[1]) & (position < region[2])


def overlaps(reference: Column, start: Column, end: Column, region: tuple[str, int, int]) -> Column:
    """OVERLAPS: any part of the row is inside the region."""
    return (reference == region[0]) & (start < region[2]) & (end > region[1])


def without_sex_chromosomes(reference: Column) -> Column:
    return ~reference.isin("X", "Y", "chrX", "chrY")


def in_any(reference: Column, position: Column, regions: list[tuple[str, int, int]]) -> Column:
    out = F.lit(False)
    for r in regions:
        out = out | starts_in(reference, position, r)
    return out


def all_references(references: list[tuple[str, int]], sex_chromosomes: bool = True) -> list[tuple[str, int, int]]:
    """Each reference(name, length) whole, as a region; without the sex chromosomes on demand."""
    return [(name, 0, length) for name, length in references if sex_chromosomes or name.removeprefix("chr") not in ("X", "Y")]


def reads_of(reads: DataFrame, read_group_sets: list[str], shards: list[tuple[str, int, int]], whole: bool = False) -> DataFrame:
    """The reads of some read group sets that start in the shards or, if `whole`, overlap them."""
    from .reads import covered_length

    end = F.col("position") + covered_length(F.col("cigar"))
    held = F.lit(False)
    for s in shards:
        held = held | (overlaps(F.col("reference_name"), F.col("position"), end, s) if whole else starts_in(F.col("reference_name"), F.col("position"), s))
    return reads.where(F.col("read_group_set_id").isin(read_group_sets) & held)


#: Bases of a shard of a region, if nothing else is said.
BASES_PER_SHARD = 1_000_000


def split_regions(regions: list[tuple[str, int, int]], bases: int = BASES_PER_SHARD) -> list[tuple[str, int, int]]:
    """Regions cut into shards of at most `bases` bases."""
    return [(name, at, min(at + bases, end)) for name, start, end in regions for at in range(start, end, bases)]
