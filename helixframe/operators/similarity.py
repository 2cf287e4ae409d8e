"""Pairwise similarity of samples: identity by state, shared variants, principal coordinates."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import variants as V


def pairs(items: Column, with_same: bool = False) -> Column:
    """Unordered pairs array<struct<a, b>> of an array whose elements are sorted and hold no repeats."""
    n = F.size(items)
    first = 0 if with_same else 1

    def of(x: Column, i: Column) -> Column:
        return F.transform(F.slice(items, i + 1 + first, F.greatest(n - i - first, F.lit(0))), lambda y: F.struct(x.alias("a"), y.alias("b")))

    return F.flatten(F.transform(items, of))


def _paired(rows: DataFrame, items: str, with_same: bool, *kept: str) -> DataFrame:
    """(kept..., p struct<a, b>) of every unordered pair in the sorted array column: the first element is exploded, then those
    after it, so that no row holds more than one variant's elements."""
    first = rows.select(*kept, items, F.posexplode(items).alias("_at", "_a"))
    rest = F.slice(items, F.col("_at") + (1 if with_same else 2), F.size(items))
    return first.select(*kept, "_a", F.explode(rest).alias("_b")).select(*kept, F.struct(F.col("_a").alias("a"), F.col("_b").alias("b")).alias("p"))


def shared_minor_alleles(a: Column, b: Column, reference_major: Column) -> Column:
    """1 if both samples carry the minor allele, else 0."""
    both = V.has_minor_allele(a.genotype, reference_major) & V.has_minor_allele(b.genotype, reference_major)
    return F.when(both, 1.0).otherwise(0.0)


def shared_alleles_ratio(a: Column, b: Column, reference_major: Column) -> Column:
    """Positions with equal alleles over the longer genotype's length."""
    same = F.size(F.filter(F.zip_with(a.genotype, b.genotype, lambda x, y: x == y), lambda x: x))
    return same / F.greatest(F.size(a.genotype), F.size(b.genotype))


#: Similarity of two calls by name; each is (call, call, is the reference allele the major one) -> Column.
SIMILARITIES: dict[str, Callable[[Column, Column, Column], Column]] = {"shared_minor": shared_minor_alleles, "shared_ratio": shared_alleles_ratio}


def identity_by_state(variants: DataFrame, similarity: str = "shared_minor") -> DataFrame:
    """(s1, s2, score, total, n) a pair of samples: total similarity over the single-alternate SNPs at which both are called, and their number.

    Pairs are made inside each variant's calls, so the only exchange is that of the partial sums by pair.
    """
    called = F.array_sort(F.transform(V.samples_with_genotype(F.col("calls"), 0), lambda c: F.struct(c.call_set_name.alias("name"), c.genotype.alias("genotype"))))
    snps = variants.where(V.is_single_alternate_snp(F.col("reference_bases"), F.col("alternate_bases")))
    rows = snps.select(V.is_reference_major(F.col("calls")).alias("major"), called.alias("called"))
    rows = _paired(rows, "called", False, "major")
    score = SIMILARITIES[similarity](F.col("p.a"), F.col("p.b"), F.col("major"))
    total = rows.select(F.col("p.a.name").alias("s1"), F.col("p.b.name").alias("s2"), score.alias("x")).groupBy("s1", "s2").agg(F.sum("x").alias("total"), F.count("*").alias("n"))
    return total.select("s1", "s2", (F.col("total") / F.col("n")).alias("score"), "total", "n")


def shared_variants(variants: DataFrame) -> DataFrame:
    """(s1, s2, n): variants at which both samples have an alternate allele; a sample also pairs with itself."""
    names = F.array_sort(F.transform(V.samples_with_genotype(F.col("calls"), 1), lambda c: c.call_set_name))
    rows = _paired(variants.select(names.alias("names")), "names", True)
    return rows.groupBy(F.col("p.a").alias("s1"), F.col("p.b").alias("s2")).agg(F.count("*").alias("n"))


def principal_coordinates(counts: np.ndarray) -> np.ndarray:
    """Rows' coordinates on the two largest positive eigenvalues of the doubly centred symmetric matrix; zero where there is none.

    Signs are fixed: each axis's component of greatest size is positive.
    """
    n = len(counts)
    centred = counts - counts.mean(axis=0, keepdims=True) - counts.mean(axis=1, keepdims=True) + counts.mean()
    values, vectors = np.linalg.eigh((centred + centred.T) / 2)
    out = np.zeros((n, 2))
    axes = [i for i in np.argsort(-values) if values[i] > 1e-9 * max(1.0, abs(values).max())][:2]
    for k, i in enumerate(axes):
        v = vectors[:, i] * np.sqrt(values[i])
        out[:, k] = v if v[np.argmax(np.abs(v).round(12))] > 0 else -v
    return out


def pcoa(shared: DataFrame, names: list[str] | None = None, most: int = 5_000) -> DataFrame:
    """(name, x, y), cut to two places. The matrix of samples is dense and solved on the driver, so their number is checked."""
    spark = shared.sparkSession
    rows = shared.select("s1", "s2", "n").limit(most * (most + 1) // 2 + 1).collect()  # at most a row a pair of names
    names = sorted({x for r in rows for x in (r.s1, r.s2)} if names is None else set(names))
    if len(names) > most or len(rows) > most * (most + 1) // 2:
        raise ValueError(f"there are more than {most} samples")
    at = {s: i for i, s in enumerate(names)}
    matrix = np.zeros((len(names), len(names)))
    for r in rows:
        matrix[at[r.s1], at[r.s2]] = matrix[at[r.s2], at[r.s1]] = r.n
    points = principal_coordinates(matrix) if names else np.zeros((0, 2))
    cut = lambda v: float(np.floor(v * 100 + 1e-9) / 100)
    return spark.createDataFrame([(s, cut(x), cut(y)) for s, (x, y) in zip(names, points.tolist())], "name string, x double, y double")
