"""Private variants, variant deletion, and checks over variant and call sets."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import variants as V


def private_variants(variants: DataFrame, names: list[str], without_calls: bool = False) -> DataFrame:
    """Variants whose calls all belong to the named call sets: a filter on the nested calls, no join."""
    return variants.where(V.all_calls_within(F.col("calls"), F.array(*map(F.lit, names)).cast("array<string>"), without_calls))


def listed_ids(lines: DataFrame) -> DataFrame:
    """(id): the first token of each line(value), cut at white space or commas; empty lines give none."""
    return lines.select(F.regexp_extract("value", r"([^\s,]+)", 1).alias("id")).where("id <> ''").distinct()


def delete_variants(variants: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(what stays, one row with the number of listed variants that were there)."""
    return variants.join(ids, "id", "left_anti"), variants.join(ids, "id", "left_semi").agg(F.count("*").alias("n_deleted"))


def delete_from(spark: SparkSession, path: str, ids: DataFrame, confirm: Callable[[int], bool]) -> int:
    """Rewrite the Parquet table at path without the listed variants, if confirm(number of them) says so; the number deleted.

    The new table is written beside the old one and takes its place by a rename, so a failure before that leaves the old one whole.
    """
    left, gone = delete_variants(spark.read.parquet(path), ids)
    n = gone.first()[0]
    if not n or not confirm(n):
        return 0
    fresh = f"{path.rstrip('/')}.kept-{uuid.uuid4().hex}"
    left.write.parquet(fresh)
    jvm = spark.sparkContext._jvm
    old, new = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(fresh)
    files = old.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    aside = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}.old-{uuid.uuid4().hex}")
    if not files.rename(old, aside) or not files.rename(new, old):
        raise OSError(f"the table at {path} could not be replaced; what it held is at {aside}")
    files.delete(aside, True)
    spark.catalog.refreshByPath(path)
    return n


def check_annotation_sets(sets: list[tuple[str, str, str]], wanted_type: str | dict[str, str]) -> None:
    """sets: (id, type, reference set id). Each must have the type wanted (of all, or by id), and all one reference set."""
    for name, kind, _ in sets:
        wanted = wanted_type if isinstance(wanted_type, str) else wanted_type[name]
        if kind != wanted:
            raise ValueError(f"annotation set {name} is of type {kind}, not {wanted}")
    if len(found := sorted({r for _, _, r in sets})) > 1:
        raise ValueError(f"the annotation sets are of several reference sets: {', '.join(found)}")


def resolve_call_sets(known: DataFrame, names: list[str]) -> list[str]:
    """The ids of named call sets; a name that is given twice, is unknown or is ambiguous is an error. known: (id, name)."""
    if len(set(names)) != len(names):
        raise ValueError("a call set is named twice")
    found: dict[str, list[str]] = {}
    for r in known.where(F.col("name").isin(names)).limit(len(names) * 2 + 1).collect():
        found.setdefault(r["name"], []).append(r["id"])
    if missing := [n for n in names if n not in found]:
        raise ValueError(f"unknown call sets: {', '.join(missing)}")
    if double := [n for n, ids in found.items() if len(ids) > 1]:
        raise ValueError(f"ambiguous call sets: {', '.join(double)}")
    return [found[n][0] for n in names]


def require_one_reference_set(sets: DataFrame) -> DataFrame:
    """sets(reference_set_id) as they are; an error at run time if they name more than one."""
    n = sets.agg(F.countDistinct("reference_set_id").alias("n")).select(F.when(F.col("n") > 1, F.raise_error(F.lit("more than one reference set")).cast("long")).otherwise(F.col("n")).alias("n"))
    return sets.crossJoin(F.broadcast(n)).drop("n")  # n is one row
