"""Text sources and the text forms of results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.regions import parse_sites


def read_sites(spark: SparkSession, path: str) -> DataFrame:
    return parse_sites(spark.read.text(path))


def call_set_names(spark: SparkSession, names: str | None = None, path: str | None = None) -> list[str]:
    """Names from a comma-separated option or from a file of names parted by white space; not from both."""
    if names and path:
        raise ValueError("give call set names or a file of them, not both")
    if names:
        return [n.strip() for n in names.split(",") if n.strip()]
    if path:
        words = spark.read.text(path).select(F.explode(F.split("value", r"\s+")).alias("name")).where("name <> ''")
        return [r.name for r in words.collect()]
    return []


def ibs_lines(ibs: DataFrame) -> DataFrame:
    """s1, s2, score, total, n parted by tabs."""
    return ibs.select(F.concat_ws("\t", "s1", "s2", *[F.col(c).cast("string") for c in ("score", "total", "n")]).alias("value"))


def private_variant_lines(variants: DataFrame) -> DataFrame:
    cols = ["id", "reference_name", F.col("start").cast("string"), F.col("end").cast("string"), "reference_bases", F.array_join("alternate_bases", ",")]
    return variants.select(F.concat_ws("\t", *cols).alias("value"))


def pcoa_lines(points: DataFrame) -> DataFrame:
    return points.select(F.concat("name", F.lit("\t\t"), F.col("x").cast("string"), F.lit("\t"), F.col("y").cast("string")).alias("value"))


def annotation_lines(annotated: DataFrame) -> DataFrame:
    return annotated.select(F.concat("key", F.lit(": "), F.to_json("annotations")).alias("value"))


def contamination_lines(estimates: DataFrame) -> DataFrame:
    return estimates.orderBy(F.desc("grid_step")).select(F.concat(F.col("grid_step").cast("string"), F.lit(": "), F.col("alpha").cast("string")).alias("value"))


def write_lines(lines: DataFrame, path: str, single: bool = False) -> None:
    """Lines as text: sharded, or as one file (for results of a few lines)."""
    (lines.coalesce(1) if single else lines).write.mode("error").text(path)
