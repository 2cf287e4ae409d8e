"""Binned interval joins and the merge of non-variant segments into variants."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import variants as V


def bins(start: Column, end: Column, size: int) -> Column:
    """The bins that the half-open interval touches; an empty one touches the bin of its start."""
    first = start - start % size
    return F.sequence(first, F.greatest(first, end - 1 - (end - 1) % size), F.lit(size).cast("long"))


def point_in_interval(points: DataFrame, intervals: DataFrame, keys: list[str], at: str, start: str, end: str, size: int, how: str = "inner") -> DataFrame:
    """Points joined to the intervals that hold them: an equality join on (keys, bin), so no nested loop.

    An interval goes to every bin it touches, a point to one, so no pair is found twice. The hash exchange is by (keys, bin).
    """
    p = points.withColumn("_bin", F.col(at) - F.col(at) % size)
    i = intervals.withColumn("_bin", F.explode(bins(F.col(start), F.col(end), size)))
    on = (p["_bin"] == i["_bin"]) & (i[start] <= p[at]) & (p[at] < i[end])
    for k in keys:
        on &= p[k] == i[k]
    return p.join(i, on, how).drop(p["_bin"]).drop(i["_bin"])


def interval_overlap(left: DataFrame, right: DataFrame, keys: list[str], start: str, end: str, other_start: str, other_end: str, size: int) -> DataFrame:
    """Pairs of intervals that overlap: both go to every bin they touch, a pair counts in the later of their first bins."""
    a = left.withColumn("_bin", F.explode(bins(F.col(start), F.col(end), size)))
    b = right.withColumn("_bin", F.explode(bins(F.col(other_start), F.col(other_end), size)))
    on = (a["_bin"] == b["_bin"]) & (a[start] < b[other_end]) & (b[other_start] < a[end])
    for k in keys:
        on &= a[k] == b[k]
    first = F.greatest(a[start] - a[start] % size, b[other_start] - b[other_start] % size)
    return a.join(b, on & (a["_bin"] == first)).drop(a["_bin"]).drop(b["_bin"])


#: How a SNP's own calls and those of the segments over it (in order of start) become its calls, by name.
MERGE_STRATEGIES: dict[str, Callable[[Column, Column], Column]] = {
    "append": lambda own, added: F.concat(own, added),
    "fill": lambda own, added: F.concat(own, F.filter(added, lambda c: ~F.exists(own, lambda o: o.call_set_name == c.call_set_name))),  # own calls win
    "keep": lambda own, added: own,
}


def merge_segments(variants: DataFrame, size: int = 1000, sites: DataFrame | None = None, strategy: str = "append") -> DataFrame:
    """Variants whose SNPs have the calls of the segments over their start merged in (MERGE_STRATEGIES); segments go.

    Indels keep their own calls. With sites(reference_name, start, end) only variants that overlap a site are given, each once.
    """
    if size <= 0:
        raise ValueError("the bin size must be positive")
    segment = V.is_non_variant_segment(F.col("alternate_bases"))
    rows = variants.where(~segment)
    if sites is not None:
        s = sites.select("reference_name", F.col("start").alias("_s"), F.col("end").alias("_e"))
        a = rows.select("reference_name", "start", "end").distinct().withColumn("_bin", F.explode(bins(F.col("start"), F.col("end"), size)))
        b = s.withColumn("_bin", F.explode(bins(F.col("_s"), F.col("_e"), size)))
        near = a.join(b, ["reference_name", "_bin"]).where("start < _e and _s < end").select("reference_name", "start", "end").distinct()
        rows = rows.join(near, ["reference_name", "start", "end"], "left_semi").select(*variants.columns)
    snp = V.is_snp(F.col("reference_bases"), F.col("alternate_bases"))
    points = rows.where(snp).select("reference_name", "start").distinct().withColumn("_bin", F.col("start") - F.col("start") % size)
    blocks = variants.where(segment).select("reference_name", F.col("start").alias("_from"), F.col("end").alias("_to"), F.col("calls").alias("_calls"), F.explode(bins(F.col("start"), F.col("end"), size)).alias("_bin"))
    over = points.join(blocks, ["reference_name", "_bin"]).where("_from <= start and start < _to")
    added = over.groupBy("reference_name", "start").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("_from", "_to", "_calls"))), lambda x: x["_calls"])).alias("_added"))
    merged = rows.join(added, ["reference_name", "start"], "left")
    calls = F.when(snp & F.col("_added").isNotNull(), MERGE_STRATEGIES[strategy](F.col("calls"), F.col("_added"))).otherwise(F.col("calls"))
    return merged.withColumn("calls", calls).select(*variants.columns)
