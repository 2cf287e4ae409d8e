"""Predicates and derived values of variants, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: names of numbered and sex chromosomes.
CHROMOSOME = r"^(chr)?(X|Y|([12]?\d))$"


def is_passing(filters: Column) -> Column:
    """Exactly one filter, and it is PASS or a dot."""
    return F.coalesce((F.size(filters) == 1) & F.upper(filters[0]).isin("PASS", "."), F.lit(False))


def is_on_chromosome(reference_name: Column) -> Column:
    return F.coalesce(reference_name.rlike(CHROMOSOME), F.lit(False))


def is_not_low_quality(quality: Column) -> Column:
    return F.coalesce(quality, F.lit(0.0)) != 0.0


def is_snp(reference_bases: Column, alternate_bases: Column) -> Column:
    return (F.length(reference_bases) == 1) & (F.size(alternate_bases) > 0) & F.forall(alternate_bases, lambda a: F.length(a) == 1)


def is_single_alternate_snp(reference_bases: Column, alternate_bases: Column) -> Column:
    return (F.size(alternate_bases) == 1) & is_snp(reference_bases, alternate_bases)


def is_non_variant_segment(alternate_bases: Column) -> Column:
    return F.coalesce(F.size(alternate_bases), F.lit(0)) <= 0


def canonical_reference(reference_name: Column) -> Column:
    """The name without any `chr`."""
    return F.replace(reference_name, F.lit("chr"), F.lit(""))


def samples_with_genotype(calls: Column, least: int) -> Column:
    """The calls with some genotype of at least `least`: 0 for called, 1 for an alternate."""
    return F.filter(calls, lambda c: F.exists(c.genotype, lambda g: g >= least))


def is_reference_major(calls: Column) -> Column:
    """At least as many reference as alternate alleles over all calls; no-calls don't count."""
    alleles = F.flatten(F.transform(calls, lambda c: c.genotype))
    return F.size(F.filter(alleles, lambda g: g == 0)) >= F.size(F.filter(alleles, lambda g: g > 0))


def has_minor_allele(genotype: Column, reference_major: Column) -> Column:
    return F.when(reference_major, F.exists(genotype, lambda g: g > 0)).otherwise(F.exists(genotype, lambda g: g == 0))


def all_calls_within(calls: Column, names: Column, without_calls: bool) -> Column:
    """Every call's set is in names (an array); variants without calls pass only if asked for."""
    inside = F.forall(calls, lambda c: F.array_contains(names, c.call_set_name))
    return F.coalesce(inside if without_calls else inside & (F.size(calls) > 0), F.lit(without_calls))


def allele_frequency(info: Column) -> Column:
    """INFO AF's first value; a variant without one is an error."""
    return F.when(F.size(info["AF"]) > 0, info["AF"][0].cast("double")).otherwise(F.raise_error(F.lit("variant has no AF")).cast("double"))


def is_informative_frequency(frequency: Column, least: float) -> Column:
    return (frequency >= least) & (1 - frequency >= least)
