"""Comparison of two sets of reads and of two headers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def diff_reads(a: DataFrame, b: DataFrame, keys: list[str], compared: list[str]) -> DataFrame:
    """(keys..., status, fields): `first only`, `second only` or `different` with the fields that differ; equal rows are left out.

    Rows that repeat a key are matched in the order of their compared fields. Nulls equal nulls. One exchange a side.
    """
    from pyspark.sql import Window

    order = Window.partitionBy(*keys).orderBy(*compared)
    named = {c: f"_second_{c}" for c in [*keys, *compared]}
    left = a.select(*keys, *compared).withColumn("_n", F.row_number().over(order)).withColumn("_l", F.lit(True))
    right = b.select(*keys, *compared).withColumn("_m", F.row_number().over(order)).withColumn("_r", F.lit(True)).withColumnsRenamed(named)
    on = F.col("_n") == F.col("_m")
    for k in keys:
        on &= F.col(k).eqNullSafe(F.col(named[k]))
    both = left.join(right, on, "full_outer")
    fields = F.filter(F.array(*[F.when(~F.col(c).eqNullSafe(F.col(named[c])), F.lit(c)) for c in compared]), lambda x: x.isNotNull())
    status = F.when(F.col("_r").isNull(), "first only").when(F.col("_l").isNull(), "second only").when(F.size(fields) > 0, "different")
    rows = both.select(*[F.coalesce(k, named[k]).alias(k) for k in keys], status.alias("status"), F.when(status == "different", fields).alias("fields"))
    return rows.where("status is not null")


def diff_headers(a: dict, b: dict, ignore_sequence_order: bool = True, ignore_sequence_properties: bool = True, ignore_version: bool = True, zero_insert_is_none: bool = True) -> list[str]:
    """What differs between two parsed headers (as `sources.sam.parse_header` gives them); empty if they agree."""
    out = []
    if not ignore_version and a.get("HD", {}).get("VN") != b.get("HD", {}).get("VN"):
        out.append("version")
    if a.get("HD", {}).get("SO") != b.get("HD", {}).get("SO"):
        out.append("sort order")
    sa, sb = a.get("SQ", []), b.get("SQ", [])
    if ignore_sequence_order:
        sa, sb = (sorted(s, key=lambda x: x["SN"]) for s in (sa, sb))
    keep = ("SN", "LN") if ignore_sequence_properties else None
    cut = lambda s: [{k: v for k, v in x.items() if keep is None or k in keep} for x in s]
    if cut(sa) != cut(sb):
        out.append("sequences")
    none = lambda g: {k: v for k, v in g.items() if not (zero_insert_is_none and k == "PI" and v == "0")}
    groups = lambda h: sorted((none(g) for g in h.get("RG", [])), key=lambda g: g.get("ID", ""))
    if groups(a) != groups(b):
        out.append("read groups")
    if sorted(a.get("PG", []), key=str) != sorted(b.get("PG", []), key=str):
        out.append("programs")
    if a.get("CO", []) != b.get("CO", []):
        out.append("comments")
    return out
