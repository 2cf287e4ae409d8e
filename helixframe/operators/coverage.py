"""Read counts and bucketed coverage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import reads as R


def count_reads(reads: DataFrame, keep: Column | None = None) -> DataFrame:
    """One row: the number of reads (for which `keep` holds)."""
    return (reads if keep is None else reads.where(keep)).agg(F.count("*").alias("n_reads"))


def coverage_means(reads: DataFrame, width: int) -> DataFrame:
    """Mean depth of each bucket, read group set and mapping-quality class (A: all).

    reads: (reference_name, position, mapping_quality, read_group_set_id, cigar). A read counts in every bucket it
    touches with the bases inside; the mean is over the full width. The class A is made of the other classes' sums
    after the first aggregation, so reads are exploded once. One exchange; the second sum reuses its partitioning.
    """
    length = R.covered_length(F.col("cigar"))
    r = reads.where(~R.is_unmapped(F.col("reference_name")) & F.col("position").isNotNull() & F.col("cigar").isNotNull())
    r = r.select("reference_name", "position", (F.col("position") + length).alias("stop"), R.mapping_class(F.col("mapping_quality")).alias("mq"), "read_group_set_id").where("stop > position")
    first = F.col("position") - F.col("position") % width
    last = F.col("stop") - 1 - (F.col("stop") - 1) % width
    b = r.withColumn("bucket", F.explode(F.sequence(first, last, F.lit(width).cast("long"))))
    inside = F.least(F.col("bucket") + width, "stop") - F.greatest("bucket", "position")
    by = b.groupBy("reference_name", "bucket", "read_group_set_id").agg(*[F.sum(F.when(F.col("mq") == c, inside)).alias(c) for c in "LMH"])
    classes = F.array(*[F.struct(F.lit(c).alias("mq"), F.col(c).alias("bases")) for c in "LMH"], F.struct(F.lit("A").alias("mq"), (F.coalesce("L", F.lit(0)) + F.coalesce("M", F.lit(0)) + F.coalesce("H", F.lit(0))).alias("bases")))
    rows = by.select("reference_name", "bucket", "read_group_set_id", F.inline(classes)).where("bases is not null")
    return rows.select("reference_name", "bucket", "read_group_set_id", "mq", (F.col("bases") / float(width)).alias("mean"))


def discrete_quantiles(values: Column, n: int) -> Column:
    """n values of an array: least, n - 2 between, greatest; quantile q is the element (q * size - 1) div (n - 1) in order."""
    if n < 2:
        raise ValueError("at least two quantiles: the least and the greatest")
    ordered = F.sort_array(values)
    size = F.size(values)
    at = [F.greatest(F.floor((F.lit(q) * size - 1) / (n - 1)), F.lit(0)).cast("int") for q in range(n)]
    return F.array(*[F.get(ordered, i) for i in at])


def coverage_quantiles(means: DataFrame, n: int) -> DataFrame:
    """(reference_name, bucket, mq, quantiles) over the read group sets of each bucket and class."""
    return means.groupBy("reference_name", "bucket", "mq").agg(F.collect_list("mean").alias("means")).select("reference_name", "bucket", "mq", discrete_quantiles(F.col("means"), n).alias("quantiles"))


def check_quantiles(read_group_sets: list[str], n: int) -> None:
    """Quantiles over read group sets need as many sets as quantiles."""
    if len(set(read_group_sets)) < n:
        raise ValueError(f"{n} quantiles need {n} read group sets or more; there are {len(set(read_group_sets))}")


def coverage_annotations(quantiles: DataFrame, width: int) -> DataFrame:
    """One row a bucket: start, end (start + width, also for the last) and a map of class to quantiles, rounded to six places."""
    rounded = F.transform("quantiles", lambda x: F.floor(x * 1e6 + 0.5) / 1e6)
    rows = quantiles.groupBy("reference_name", "bucket").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("mq", rounded.alias("q"))))).alias("info"))
    return rows.select("reference_name", F.col("bucket").alias("start"), (F.col("bucket") + width).alias("end"), "info")
