"""Sample contamination: allele frequencies, pileups, likelihood and its maximum."""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import reads as R
from ..functions import variants as V
from .rangejoin import point_in_interval

#: P(observed base | true genotype, read right or wrong). Rows by genotype (reference homozygous, heterozygous,
#: alternate homozygous) and status (right, wrong), columns REF, NONREF, OTHER. Fixed values of the published model.
P_BASE = [
    [1.0, 0.0, 0.0],
    [0.0, 1 / 3, 2 / 3],
    [0.5, 0.5, 0.0],
    [1 / 6, 1 / 6, 2 / 3],
    [0.0, 1.0, 0.0],
    [1 / 3, 0.0, 2 / 3],
]
BASES = ("REF", "NONREF", "OTHER")
#: Steps of the grids on [0, 0.5] at which a maximum is sought, and the search's tolerances and limit.
GRID_STEPS = (0.1, 0.05, 0.01, 0.005, 0.001)
RELATIVE, ABSOLUTE, MOST_STEPS = 1e-4, 1e-5, 1000


def allele_frequencies(variants: DataFrame, least: float = 0.01) -> DataFrame:
    """(reference_name, position, ref_base, alt_base, ref_freq) of passing, non-low-quality single-alternate SNPs on chromosomes.

    Names lose their `chr`, as those of aligned bases do. ref_freq is INFO AF as it is given.
    """
    ok = V.is_passing(F.col("filter")) & V.is_on_chromosome(F.col("reference_name")) & V.is_not_low_quality(F.col("quality"))
    ok &= V.is_single_alternate_snp(F.col("reference_bases"), F.col("alternate_bases"))
    freq = variants.where(ok).select(
        R.strip_chromosome(F.col("reference_name")).alias("reference_name"), F.col("start").alias("position"), F.col("reference_bases").alias("ref_base"),
        F.col("alternate_bases")[0].alias("alt_base"), V.allele_frequency(F.col("info")).alias("ref_freq"),
    )
    return freq.where(V.is_informative_frequency(F.col("ref_freq"), least))


def usable_reads(reads: DataFrame) -> DataFrame:
    ok = V.is_on_chromosome(F.col("reference_name")) & ~F.col("failed_vendor_quality_checks") & ~F.col("duplicate_fragment") & F.col("proper_placement")
    return reads.where(ok & F.col("cigar").isNotNull())


def aligned_bases(reads: DataFrame) -> DataFrame:
    """(reference_name, position, base, quality): one row for each base a cigar aligns."""
    run = reads.select("reference_name", "position", "reverse_strand", "aligned_sequence", "aligned_quality", F.explode(R.runs(F.col("cigar"))).alias("run"))
    at = run.select("reference_name", "position", "reverse_strand", "aligned_sequence", "aligned_quality", "run", F.explode(F.sequence(F.lit(0).cast("long"), F.col("run.length") - 1)).alias("i"))
    offset = (F.col("run.read") + F.col("i")).cast("int")
    return at.select(
        R.strip_chromosome(F.col("reference_name")).alias("reference_name"), (F.col("position") + F.col("run.reference") + F.col("i")).alias("position"), "reverse_strand",
        F.substring("aligned_sequence", offset + 1, F.lit(1)).alias("base"), F.get("aligned_quality", offset).alias("quality"),
    )


def sampled(bases: DataFrame, fraction: float, prefix: str = "") -> DataFrame:
    """The bases of a share of the positions, chosen by a hash of (position, strand), so that pileups stay whole."""
    if fraction >= 1.0:
        return bases
    key = F.concat(F.lit(prefix), "reference_name", F.lit(":"), F.col("position").cast("string"), F.lit(":"), F.col("reverse_strand").cast("string"))
    return bases.where(R.sample_share(key) < fraction)


def pileup(frequencies: DataFrame, bases: DataFrame) -> DataFrame:
    """(reference_name, position, ref_freq, base, quality, n): observed REF, NONREF and OTHER bases of each position with a frequency.

    A left join from the frequencies: a position without bases stays, with a null base and n 0. The bases are summed before the join.
    Two frequencies at one position are an error when the rows are read.
    """
    given = frequencies.groupBy("reference_name", "position").agg(F.count("*").alias("m"), *[F.first(c).alias(c) for c in ("ref_base", "alt_base", "ref_freq")])
    twice = F.raise_error(F.concat(F.lit("more than one frequency at "), "reference_name", F.lit(":"), F.col("position").cast("string"))).cast("double")
    frequencies = given.withColumn("ref_freq", F.when(F.col("m") > 1, twice).otherwise(F.col("ref_freq"))).drop("m")
    seen = bases.groupBy("reference_name", "position", F.col("base").alias("letter"), "quality").agg(F.count("*").alias("k"))
    joined = frequencies.join(seen, ["reference_name", "position"], "left")
    kind = F.when(F.col("letter").isNull(), F.lit(None)).when(F.col("letter") == F.col("ref_base"), "REF").when(F.col("letter") == F.col("alt_base"), "NONREF").otherwise("OTHER")
    return joined.select("reference_name", "position", "ref_freq", kind.alias("base"), "quality", F.col("k").alias("k")).groupBy("reference_name", "position", "ref_freq", "base", "quality").agg(F.coalesce(F.sum("k"), F.lit(0)).alias("n"))


def bases_at(frequencies: DataFrame, reads: DataFrame, bin_size: int = 256) -> DataFrame:
    """The aligned bases at the positions that have a frequency: those positions are joined to the aligned runs that
    hold them, so that reads are never exploded base by base. Gives the columns of `aligned_bases`."""
    run = reads.select(R.strip_chromosome(F.col("reference_name")).alias("reference_name"), "position", "reverse_strand", "aligned_sequence", "aligned_quality", F.explode(R.runs(F.col("cigar"))).alias("run"))
    start = F.col("position") + F.col("run.reference")
    run = run.select("reference_name", start.alias("_start"), (start + F.col("run.length")).alias("_end"), "run.read", "reverse_strand", "aligned_sequence", "aligned_quality")
    at = frequencies.select(F.col("reference_name").alias("_reference"), "position").distinct().withColumnRenamed("_reference", "reference_name")
    held = point_in_interval(at, run, ["reference_name"], "position", "_start", "_end", bin_size)
    offset = (F.col("read") + F.col("position") - F.col("_start")).cast("int")
    return held.select(at["reference_name"], "position", "reverse_strand", F.substring("aligned_sequence", offset + 1, F.lit(1)).alias("base"), F.get("aligned_quality", offset).alias("quality"))


def observation_logs(alpha: float, base: Column, quality: Column) -> dict[tuple[int, int], Column]:
    """log P(observed base) for each pair (true genotype, contaminating genotype), 0 to 2."""
    wrong = R.phred_error(quality)
    chance = []
    for g in range(3):
        right, bad = P_BASE[2 * g], P_BASE[2 * g + 1]
        pick = lambda row: F.when(base == "REF", row[0]).when(base == "NONREF", row[1]).otherwise(row[2])
        chance.append((1 - wrong) * pick(right) + wrong * pick(bad))
    return {(i, j): F.log((1 - alpha) * chance[i] + alpha * chance[j]) for i in range(3) for j in range(3)}


def log_likelihood(piles: DataFrame, *alphas: float) -> DataFrame:
    """(alpha, log_likelihood) over all positions, summed in log space, for all alphas in one pass over the pileup.

    A chance of zero makes a term null, which counts as minus infinity.
    """
    least, genotypes = F.lit(float("-inf")), [(i, j) for i in range(3) for j in range(3)]
    sums = []
    for k, alpha in enumerate(alphas):
        logs = observation_logs(alpha, F.col("base"), F.col("quality"))
        sums += [F.sum(F.when(F.col("base").isNull(), 0.0).otherwise(F.coalesce(logs[g], least)) * F.col("n")).alias(f"l{k}_{g[0]}{g[1]}") for g in genotypes]
    by = piles.where("n > 0 or base is null").groupBy("reference_name", "position", "ref_freq").agg(*sums)
    p = F.col("ref_freq")
    prior = [p * p, p * (1 - p), (1 - p) * (1 - p)]
    terms = F.array(*[F.array(*[F.log(prior[i]) + F.log(prior[j]) + F.col(f"l{k}_{i}{j}") for i, j in genotypes]) for k in range(len(alphas))])
    by = by.select(F.transform(terms, lambda t: F.struct(F.array_max(t).alias("top"), t.alias("terms"))).alias("x"))
    one = lambda x: x.top + F.log(F.aggregate(x.terms, F.lit(0.0), lambda s, t: s + F.exp(t - x.top)))
    totals = by.select(F.transform("x", one).alias("x")).agg(*[F.sum(F.col("x")[k]).alias(f"s{k}") for k in range(len(alphas))])
    return totals.select(F.inline(F.array(*[F.struct(F.lit(float(a)).alias("alpha"), F.col(f"s{k}").alias("log_likelihood")) for k, a in enumerate(alphas)])))


class Likelihood:
    """The same likelihood as a NumPy kernel over collected pileups (a row a position, base and quality)."""

    def __init__(self, rows: list[tuple]):
        """rows: (position key, ref_freq, base or None, quality, n)."""
        at: dict = {}
        self.p = np.array([at.setdefault(k, (len(at), f))[1] for k, f, *_ in rows if k not in at], dtype=float)
        seen = [r for r in rows if r[2] is not None and r[4]]
        self.site = np.array([at[r[0]][0] for r in seen], dtype=int)
        self.n = np.array([r[4] for r in seen], dtype=float)
        wrong = 10.0 ** (-np.array([r[3] for r in seen], dtype=float) / 10)
        kind = np.array([BASES.index(r[2]) for r in seen], dtype=int)
        table = np.array(P_BASE)
        self.chance = [(1 - wrong) * table[2 * g][kind] + wrong * table[2 * g + 1][kind] for g in range(3)] if seen else [np.zeros(0)] * 3

    def __call__(self, alpha: float) -> float:
        prior = [self.p**2, self.p * (1 - self.p), (1 - self.p) ** 2]
        terms = []
        with np.errstate(divide="ignore", invalid="ignore"):
            for i in range(3):
                for j in range(3):
                    logs = self.n * np.log((1 - alpha) * self.chance[i] + alpha * self.chance[j])
                    terms.append(np.log(prior[i]) + np.log(prior[j]) + np.bincount(self.site, weights=logs, minlength=len(self.p)))
            top = np.max(terms, axis=0)
            return float(np.sum(top + np.log(sum(np.exp(t - top) for t in terms))))


def grid_bracket(f: Callable[[float], float], low: float, high: float, step: float) -> tuple[float, float, float]:
    """(left, best, right) around the grid's greatest value; of values within 1e-9 the first wins."""
    best, value = low, f(low)
    n = int(math.floor((high - low) / step + 1e-9))
    for k in range(1, n + 1):
        x = low + k * step
        if (y := f(x)) > value + 1e-9:
            best, value = x, y
    return max(low, best - step), best, min(high, best + step)


def brent_maximum(f: Callable[[float], float], left: float, start: float, right: float) -> float:
    """Brent's method on [left, right] from start: parabolic steps where they are safe, golden section otherwise."""
    golden = 0.5 * (3 - math.sqrt(5))
    a, b = left, right
    x = w = v = start
    fx = fw = fv = -f(x)
    d = e = 0.0
    for _ in range(MOST_STEPS):
        middle = 0.5 * (a + b)
        tol = RELATIVE * abs(x) + ABSOLUTE
        if abs(x - middle) <= 2 * tol - 0.5 * (b - a):
            break
        use_golden = True
        if abs(e) > tol:
            r, q = (x - w) * (fx - fv), (x - v) * (fx - fw)
            p = (x - v) * q - (x - w) * r
            q = 2 * (q - r)
            p, q = (-p, q) if q > 0 else (p, -q)
            last, e = e, d
            if abs(p) < abs(0.5 * q * last) and q * (a - x) < p < q * (b - x):
                d, use_golden = p / q, False
                if min(x + d - a, b - x - d) < 2 * tol:
                    d = math.copysign(tol, middle - x)
        if use_golden:
            e = (b if x < middle else a) - x
            d = golden * e
        u = x + (d if abs(d) >= tol else math.copysign(tol, d))
        fu = -f(u)
        if fu <= fx:
            a, b = (x, b) if u >= x else (a, x)
            v, fv, w, fw, x, fx = w, fw, x, fx, u, fu
        else:
            a, b = (u, b) if u < x else (a, u)
            if fu <= fw or w == x:
                v, fv, w, fw = w, fw, u, fu
            elif fu <= fv or v in (x, w):
                v, fv = u, fu
    return x


def estimate(piles: DataFrame, most_rows: int = 5_000_000) -> DataFrame:
    """(grid_step, alpha): the likelihood's maximum found from each grid. The pileup of the sampled positions is
    collected, so the number of its rows is checked; sample fewer positions where it is passed."""
    rows = piles.select(F.concat_ws(":", "reference_name", F.col("position").cast("string")).alias("k"), "ref_freq", "base", "quality", "n").limit(most_rows + 1).collect()
    if len(rows) > most_rows:
        raise ValueError(f"the pileup has over {most_rows} rows: lower the sampling fraction")
    f = Likelihood(sorted((tuple(r) for r in rows), key=lambda r: (r[0], r[2] or "", r[3] or 0)))
    out = []
    for step in GRID_STEPS:
        left, best, right = grid_bracket(f, 0.0, 0.5, step)
        out.append((step, brent_maximum(f, left, best, right)))
    return piles.sparkSession.createDataFrame(out, "grid_step double, alpha double")
