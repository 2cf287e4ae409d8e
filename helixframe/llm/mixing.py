"""Mixing to target weights by soft membership.

A classifier fitted on a labelled table gives every document a posterior over domains: a multinomial logistic model of the text's
byte trigrams (square roots of their counts, of unit length). Nonnegative document rates are then fitted by projected-gradient
least squares, so that the expected token totals of the domains (sum of rate * tokens * posterior) match target totals. A step is

    rate <- max(0, rate - posterior . g),   g = inverse(sum(tokens * posterior posterior')) (reached - target)

which is the projected gradient of the residuals whitened by the domains' token Gram matrix, in the metric of the
documents' tokens (its Lipschitz constant is 1). g has one number a domain, so a document's rate is a fold over the steps so far: each
iteration is one aggregate over the posteriors, and nothing of a document reaches the driver. It ends when a step moves no total.

Defined results: null or empty texts have no tokens and the posterior of a text without trigrams; documents of no tokens keep a rate but
move no total; repeated rows are fitted alike and each count, and an id's smallest text is learned from; labels with a null part are
ignored; without any labelled row all domains are equally likely; an empty table gives no rows; targets must be nonnegative, those that no
document can reach are approached as near as the rates allow, with a warning; a fit that has not ended after `iterations` steps is an error.
Columns of docs are kept by `mix`; clashing names are replaced.
"""

from __future__ import annotations

import warnings
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, carried, map_rows, short_batches

_CLEAN, _TOXIC, _POOR = "clean", "toxic", "poor"
_SLOTS = 1 << 16


@dataclass(frozen=True)
class Params:
    sample_rows: int = 6_000  # labelled rows the classifier is fitted on, whole
    epochs: int = 8
    pace: float = 0.5
    iterations: int = 1_000  # a guard only: the descent ends by itself
    fold: int = 16  # steps after which the rates so far are written
    tolerance: float = 1e-7  # of the target total: a step that moves no total by more ends the descent
    notable_miss: float = 0.01  # of the target total, warned of


@dataclass(frozen=True)
class Model:
    domains: list[str]
    bias: np.ndarray
    weights: np.ndarray  # slots x domains


def domain_of(quality: Column, toxic: Column) -> Column:
    return F.when(quality == 0, _POOR).when(toxic == 1, _TOXIC).when((quality == 1) & (toxic == 0), _CLEAN)


def trigrams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Slots of the text's byte trigrams and their weights, the square roots of counts at unit length."""
    b = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), dtype=np.uint8).astype(np.uint64)
    if len(b) < 3:
        return np.zeros(0, dtype=np.int64), np.zeros(0)
    with np.errstate(over="ignore"):
        code = (b[:-2] << np.uint64(16) | b[1:-1] << np.uint64(8) | b[2:]) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(48)
    count = np.bincount(code.astype(np.int64), minlength=_SLOTS)
    slots = np.flatnonzero(count)
    return slots, np.sqrt(count[slots] / (len(b) - 2))


def learn(rows: list[tuple[np.ndarray, np.ndarray]], domain: np.ndarray, k: int, p: Params) -> tuple[np.ndarray, np.ndarray]:
    """Bias and weights of the logistic model: gradient steps, scaled by what each slot has moved, in a fixed random order."""
    weights, moved = np.zeros((_SLOTS, k)), np.full(_SLOTS, 1e-8)
    bias = np.log(np.bincount(domain, minlength=k) + 1.0)
    bias -= bias.mean()
    draw = np.random.default_rng(0)
    for _ in range(p.epochs):
        for i in draw.permutation(len(rows)):
            slots, value = rows[i]
            z = bias + value @ weights[slots]
            miss = np.exp(z - z.max())
            miss /= miss.sum()
            miss[domain[i]] -= 1
            g = np.outer(value, miss)
            moved[slots] += (g * g).sum(axis=1)
            weights[slots] -= p.pace * g / np.sqrt(moved[slots])[:, None]
            bias -= 0.02 * miss
    return bias, weights


def fit(docs: DataFrame, labelled: DataFrame, params: Params = Params()) -> Model:
    """Fit on labelled(doc_id, domain): at most sample_rows rows, the first by hash of id; of each its trigrams reach the driver."""
    p = params
    short_batches(docs.sparkSession)
    ids = labelled.where("doc_id is not null and domain is not null").groupBy("doc_id").agg(F.min("domain").alias("domain"))
    ids = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(p.sample_rows)

    def make():
        def work(batch: pa.RecordBatch):
            got = [trigrams(t) for t in batch.column("text").to_pylist()]
            packed = {"slots": [s.astype(np.uint16).tobytes() for s, _ in got], "value": [v.astype(np.float32).tobytes() for _, v in got]}
            yield {c: batch.column(c) for c in ("doc_id", "domain")} | packed

        return work

    one = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(ids), "doc_id").groupBy("doc_id", "domain").agg(F.min("text").alias("text"))
    got = sorted(map_rows(one, make, "doc_id long, domain string, slots binary, value binary").collect(), key=lambda r: r.doc_id)
    if not got:
        domains = [_CLEAN, _POOR, _TOXIC]
        return Model(domains, np.zeros(3), np.zeros((_SLOTS, 3), dtype=np.float32))
    domains = sorted({r.domain for r in got})
    rows = [(np.frombuffer(r.slots, dtype=np.uint16).astype(np.int64), np.frombuffer(r.value, dtype=np.float32).astype(float)) for r in got]
    bias, weights = learn(rows, np.array([domains.index(r.domain) for r in got]), len(domains), p)
    return Model(domains, bias, weights.astype(np.float32))


def posteriors(docs: DataFrame, model: Model, carry: bool = False) -> DataFrame:
    """(doc_id, n_tokens, posterior array<double> in the order of model.domains) of every row of docs(doc_id, text); whole texts.

    With carry the other columns of docs come along (but for clashing names).
    """
    short_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    docs = docs if carry else docs.select("doc_id", "text")
    keep, kept_schema = carried(docs if carry else docs.select("doc_id"), ("n_tokens", "posterior", "rate", *(f"p_{d}" for d in model.domains)))

    def make():
        m = shared.value

        def one(text: str | None) -> list[float]:
            slots, value = trigrams(text)
            z = m.bias + value @ m.weights[slots]
            z = np.exp(z - z.max())
            return (z / z.sum()).tolist()

        def work(batch: pa.RecordBatch):
            texts = batch.column("text").to_pylist()
            yield {c: batch.column(c) for c in keep} | {"n_tokens": [len((t or "").split()) for t in texts], "posterior": [one(t) for t in texts]}

        return work

    return map_rows(docs, make, f"{kept_schema}, n_tokens long, posterior array<double>")


def _rate(steps: list[np.ndarray], posterior: Column, start: Column | None = None) -> Column:
    """A document's rate after the steps: a fold over them."""
    rate = F.lit(1.0) if start is None else start
    if not steps:
        return rate
    array = F.array(*[F.array(*[F.lit(float(x)) for x in g]) for g in steps])
    dot = lambda g: F.aggregate(F.zip_with(posterior, g, lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)
    return F.aggregate(array, rate, lambda r, g: F.greatest(F.lit(0.0), r - dot(g)))


def fit_rates(soft: DataFrame, target: dict[str, float], domains: list[str], params: Params = Params()) -> tuple[list[np.ndarray], np.ndarray]:
    """The steps whose fold gives every document's rate, and the totals reached. soft: (n_tokens, posterior), saved."""
    p, k = params, len(domains)
    want = np.array([float(target.get(d, 0.0)) for d in domains])
    if (want < 0).any():
        raise ValueError("targets must be nonnegative")
    n, part = F.col("n_tokens"), lambda i: F.col("posterior")[i]
    gram = soft.agg(*[F.sum(n * part(i) * part(j)).alias(f"g{i}_{j}") for i in range(k) for j in range(i, k)]).first()
    a = np.zeros((k, k))
    for i in range(k):
        for j in range(i, k):
            a[i, j] = a[j, i] = gram[f"g{i}_{j}"] or 0.0
    whiten = np.linalg.pinv(a, rcond=1e-9, hermitian=True)
    scratch = Scratch(soft.sparkSession, "rates")
    now = soft.select("n_tokens", "posterior", F.lit(1.0).alias("rate"))
    written: DataFrame | None = None
    steps: list[np.ndarray] = []
    new: list[np.ndarray] = []  # since the rates were last written
    before = None
    while True:
        rate = _rate(new, F.col("posterior"), F.col("rate"))
        row = now.select("n_tokens", "posterior", rate.alias("r")).agg(*[F.sum(n * F.col("r") * part(i)).alias(f"t{i}") for i in range(k)]).first()
        reached = np.array([row[f"t{i}"] or 0.0 for i in range(k)])
        scale = max(want.sum(), 1.0)
        if np.abs(reached - want).max() <= p.tolerance * scale or before is not None and np.abs(reached - before).max() <= p.tolerance * scale:
            break
        if len(steps) == p.iterations:
            raise RuntimeError(f"the rates have not settled after {p.iterations} steps: {dict(zip(domains, reached))}, wanted {dict(zip(domains, want))}")
        if len(new) == p.fold:
            last, written = written, scratch.save(now.select("n_tokens", "posterior", rate.alias("rate")))
            if last is not None:
                scratch.drop(last)
            now, new = written, []
        before = reached
        new.append(whiten @ (reached - want))
        steps.append(new[-1])
    if written is not None:
        scratch.drop(written)
    if np.abs(reached - want).max() > p.notable_miss * scale:
        warnings.warn(f"no rates reach the targets: shares {dict(zip(domains, (reached / scale).round(4).tolist()))}, wanted {dict(zip(domains, (want / scale).round(4).tolist()))}", stacklevel=2)
    return steps, reached


def _fitted(docs: DataFrame, labelled: DataFrame, target_share: dict[str, float], params: Params) -> tuple[Model, DataFrame, list[np.ndarray]]:
    model = fit(docs, labelled, params)
    soft = Scratch(docs.sparkSession, "mix").save(posteriors(docs, model).select("doc_id", "n_tokens", "posterior"))
    tokens = soft.agg(F.sum("n_tokens")).first()[0] or 0
    known = {d: s for d, s in target_share.items() if d in model.domains}
    total = sum(known.values()) or 1.0
    steps, _ = fit_rates(soft, {d: tokens * s / total for d, s in known.items()}, model.domains, params)
    return model, soft, steps


def rates(docs: DataFrame, labelled: DataFrame, target_share: dict[str, float], params: Params = Params()) -> DataFrame:
    """(doc_id, n_tokens, p_<domain>..., rate) of every row of docs(doc_id, text); labelled(doc_id, domain).

    With the rates the domains' expected tokens match the target shares of the tokens there are.
    """
    model, soft, steps = _fitted(docs, labelled, target_share, params)
    return soft.select("doc_id", "n_tokens", *[F.col("posterior")[i].alias(f"p_{d}") for i, d in enumerate(model.domains)], _rate(steps, F.col("posterior")).alias("rate"))


def mix(docs: DataFrame, labelled: DataFrame, target_share: dict[str, float], params: Params = Params()) -> DataFrame:
    """docs with the columns of `rates` added to every row. The posteriors are made again beside the texts, so no text is exchanged."""
    model, soft, steps = _fitted(docs, labelled, target_share, params)
    made = [F.col("posterior")[i].alias(f"p_{d}") for i, d in enumerate(model.domains)]
    kept = [c for c in docs.columns if c not in ("n_tokens", "posterior", "rate", *(f"p_{d}" for d in model.domains))]
    return posteriors(docs, model, carry=True).select(*kept, "n_tokens", *made, _rate(steps, F.col("posterior")).alias("rate"))


def totals(rated: DataFrame, domains: list[str]) -> DataFrame:
    """(domain, tokens, share): the expected tokens of each domain under the rates of rated(n_tokens, p_<domain>..., rate)."""
    sums = rated.agg(*[F.sum(F.col("n_tokens") * F.col("rate") * F.col(f"p_{d}")).alias(d) for d in domains])
    rows = sums.select(F.explode(F.array(*[F.struct(F.lit(d).alias("domain"), F.col(d).alias("tokens")) for d in domains])).alias("x"), sum((F.col(d) for d in domains), F.lit(0.0)).alias("every"))
    return rows.select("x.domain", "x.tokens", (F.col("x.tokens") / F.col("every")).alias("share"))
