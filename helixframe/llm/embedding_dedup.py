"""Embedding near-duplicates on a robust-pruned flat graph.

Vectors of one label (and one length) are compared by cosine in double precision:

1. Equal vectors collapse into classes.
2. A label is a shard. A shard over the cap is cut by centroids, fitted on a bounded sample of it by an executor; every class goes to
   its nearest few, so shards overlap. Shards that are still over the cap are cut again, so that they stay small however many
   vectors a label has.
3. Each shard builds a graph: nearest candidates, robust-pruned. The adjacency lists of a
   class from all its shards are united, with their reverse edges.
4. In each shard, every class searches the united graph greedily from the medoid, and from the best
   found (and its own node) the search expands over everything in range. What it finds is verified at the threshold.
   A pair that several shards hold is counted in the lowest of them only, so counts add up and no pairs are emitted.
5. A shard that cutting does not make smaller (its vectors are all alike) is compared exactly, block by block.

Result: (vec_id, n_links, component_id, kept). Vectors that are null, zero, of length 0, or hold null or non-finite
parts, and rows with a null label, link with nothing; rows with a null id are returned with 0 links and a null component;
repeated ids count as one vector each row (their rows link with one another if equal). Links are never below the threshold;
`audit` measures the recall against brute force.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, components, map_rows, n_partitions


@dataclass(frozen=True)
class Params:
    cosine: float = 0.98
    shard_target: int = 400  # classes a centroid stands for
    fan: int = 256  # parts that a shard is cut into at once, at most
    sample_rows: int = 4_000  # of one shard, to fit its centroids
    overlap: int = 3  # parts that a class goes to when a label is cut
    overlap_below: int = 2  # and when a part is cut again
    shard_cap: int = 2_000  # larger shards are cut
    stuck: float = 0.8  # a part that holds more of its shard is not cut again
    block: int = 1_000
    broadcast_bytes: int = 32_000_000  # centroids that are broadcast; more are dealt out with the vectors
    candidates: int = 48
    degree: int = 24
    alpha: float = 1.2
    beam: int = 24
    at_once: int = 6  # nodes of the beam expanded together
    together: int = 64  # searches of a shard that take their steps side by side
    slack: float = 0.06  # nodes this far under the threshold are still expanded


def unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def scaled(column: str) -> Column:
    """The parts of a vector, divided by the largest, so that no square over- or underflows.

    What a transform takes from outside is computed anew for every part, unless it is a part of a list: the list of one binds the largest once a row.
    """
    both = F.array(F.struct(F.col(column).alias("e"), F.array_max(F.transform(column, F.abs)).alias("largest")))
    return F.transform(both, lambda b: F.transform(b["e"], lambda x: x / b["largest"]))[0]


def fit_centroids(sample: np.ndarray, k: int, rounds: int = 6) -> np.ndarray:
    """Spherical k-means, started at evenly spaced sample rows."""
    c = sample[np.linspace(0, len(sample) - 1, min(k, len(sample))).astype(int)].copy()
    for _ in range(rounds):
        near = np.argmax(sample @ c.T, axis=1)
        total = np.zeros_like(c)
        np.add.at(total, near, sample)
        norm = np.linalg.norm(total, axis=1)
        c[norm > 1e-9] = total[norm > 1e-9] / norm[norm > 1e-9, None]
    return c


def robust_prune(x: np.ndarray, p: Params) -> tuple[np.ndarray, np.ndarray]:
    """Links (from, to) between rows of x, in order of from: a candidate is dropped when a kept one is alpha times nearer to it.

    Rows are pruned side by side, a block of them at a time.
    """
    n = len(x)
    k = min(p.candidates, n - 1)
    out: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64))]
    for lo in range(0, n if k else 0, 128):
        sim = x[lo : lo + 128] @ x.T
        own = np.arange(len(sim))
        sim[own, lo + own] = -2
        top = np.argpartition(-sim, k - 1, axis=1)[:, :k]
        near = np.take_along_axis(sim, top, axis=1)
        order = np.argsort(-near, axis=1, kind="stable")
        top, dist = np.take_along_axis(top, order, axis=1), 1 - np.take_along_axis(near, order, axis=1)
        y = x[top]
        between = p.alpha * (1 - y @ y.transpose(0, 2, 1))
        alive, kept = np.ones(top.shape, dtype=bool), np.zeros(top.shape, dtype=bool)
        for j in range(k):
            at = np.flatnonzero(alive[:, j])
            if j >= p.degree:
                at = at[kept[at].sum(axis=1) < p.degree]
            kept[at, j] = True
            alive[at] &= between[at, j] > dist[at]
        i, j = np.nonzero(kept)
        out.append((lo + i, top[i, j]))
    return np.concatenate([i for i, _ in out]), np.concatenate([j for _, j in out])


def range_search(x: np.ndarray, graph: tuple[np.ndarray, np.ndarray], medoid: int, queries: np.ndarray, p: Params) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (position in queries, row of x) within the threshold, but for the query's own row: greedy beam search from the medoid, then expansion in range.

    graph: where each row's neighbours begin (and the last ones end), and the neighbours. The queries take their steps side by side; a query's
    row is a stretch of the flat arrays.
    """
    begin, flat = graph
    n, m = len(x), len(queries)
    degree = np.diff(begin)
    sim, seen, done = np.full(m * n, -2.0), np.zeros(m * n, dtype=bool), np.zeros(m * n, dtype=bool)
    mark = np.empty(m * n, dtype=np.int32)
    room = np.empty((2, 256, x.shape[1]), dtype=x.dtype)  # the vectors taken out stay in a core's cache

    def meet(at: np.ndarray) -> None:
        seen[at] = True
        q, node = np.divmod(at, n)
        asker = queries[q]
        for i in range(0, len(at), len(room[0])):
            own, other = (np.take(x, r[i : i + len(room[0])], axis=0, out=o[: len(r) - i], mode="clip") for r, o in zip((asker, node), room))
            sim[at[i : i + len(room[0])]] = np.einsum("ij,ij->i", own, other)

    def expand(at: np.ndarray) -> np.ndarray:
        """The neighbours of some (query, row) that the query has not met, which it now meets; in order of `at`."""
        done[at] = True
        node = at % n
        size = degree[node]
        last = np.cumsum(size)
        if not len(last) or not last[-1]:
            return np.zeros(0, dtype=np.int64)
        new = flat[np.arange(last[-1]) + np.repeat(begin[node] - (last - size), size)] + np.repeat(at - node, size)
        new = new[~seen[new]]
        turn = np.arange(len(new), dtype=np.int32)
        mark[new] = turn
        new = new[mark[new] == turn]
        meet(new)
        return new

    first = np.arange(m) * n
    meet(first + medoid)
    active, beam = np.arange(m), np.full((m, p.beam), -1)  # the best met, best first
    beam[:, 0] = first + medoid
    while len(active):
        open_ = (beam >= 0) & ~done[beam]
        new = expand(beam[open_ & (np.cumsum(open_, axis=1) <= p.at_once)])
        row = np.searchsorted(active, new // n)
        count = np.bincount(row, minlength=len(active))
        wide = np.full((len(active), p.beam + int(count.max())), -1)
        wide[:, : p.beam] = beam
        wide[row, p.beam + np.arange(len(new)) - np.repeat(np.cumsum(count) - count, count)] = new
        worth = np.where(wide >= 0, -sim[wide], 3.0)
        best = np.argpartition(worth, p.beam - 1, axis=1)[:, : p.beam]
        order = np.argsort(np.take_along_axis(worth, best, axis=1), axis=1, kind="stable")
        beam = np.take_along_axis(wide, np.take_along_axis(best, order, axis=1), axis=1)
        left = ((beam >= 0) & ~done[beam]).any(axis=1)
        active, beam = active[left], beam[left]
    least = p.cosine - p.slack
    own = first + queries
    meet(own[~seen[own]])
    frontier = np.flatnonzero(seen & ~done & (sim >= least))
    while len(frontier):
        new = expand(frontier)
        frontier = new[sim[new] >= least]
    seen[own] = False
    return np.divmod(np.flatnonzero(seen & (sim >= p.cosine)), n)


def _stars(found: np.ndarray) -> list[tuple[int, int]]:
    """The connected parts of a symmetric matrix of pairs: (lowest row, row) for every other row of a part."""
    out: list[tuple[int, int]] = []
    met = ~found.any(axis=1)
    for i in range(len(found)):
        if not met[i]:
            part = np.zeros(len(found), dtype=bool)
            part[i] = True
            new = np.array([i])
            while len(new):
                new = np.flatnonzero(found[new].any(axis=0) & ~part)
                part[new] = True
            met |= part
            out += [(i, j) for j in np.flatnonzero(part).tolist() if j != i]
    return out


def _forest(n: int, a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    parent = list(range(n))

    def find(v: int) -> int:
        while parent[v] != v:
            parent[v] = parent[parent[v]]
            v = parent[v]
        return v

    out = []
    for i, j in zip(a.tolist(), b.tolist()):
        ri, rj = find(i), find(j)
        if ri != rj:
            parent[max(ri, rj)] = min(ri, rj)
            out.append((i, j))
    return out


def _counted(found: np.ndarray, shards_a: list, shards_b: list, here: str) -> np.ndarray:
    """Of a matrix of pairs, those whose lowest common shard is this one."""
    at_a: dict[str, list[int]] = {}
    at_b: dict[str, list[int]] = {}
    for at, shards in ((at_a, shards_a), (at_b, shards_b)):
        for i, own in enumerate(shards):
            for s in own:
                if s < here:
                    at.setdefault(s, []).append(i)
    out = found.copy()
    for s in at_a.keys() & at_b.keys():
        out[np.ix_(at_a[s], at_b[s])] = False
    return out


def _values(column: pa.Array) -> list:
    """A column's values; those of a list of numbers are arrays."""
    if not pa.types.is_list(column.type) or not (pa.types.is_floating(column.type.value_type) or pa.types.is_integer(column.type.value_type)):
        return column.to_pylist()
    flat, ends = column.flatten().to_numpy(zero_copy_only=False), np.cumsum(pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False))
    return [flat[i:j] if there else None for i, j, there in zip([0, *ends.tolist()], ends.tolist(), column.is_valid().to_pylist())]


def _groups(columns: tuple[str, ...], keys: tuple[str, ...], use):
    """Stream sorted rows and call use(key, rows) for each run of equal keys; a run fits memory by the caps."""

    def make():
        state: dict = {"key": None, "rows": []}

        def flush():
            rows, key = state["rows"], state["key"]
            state["rows"] = []
            return use(key, rows) if rows else ()

        def work(batch: pa.RecordBatch):
            cols = [_values(batch.column(c)) for c in columns]
            for key, *row in zip(zip(*(batch.column(k).to_pylist() for k in keys)), *cols):
                if key != state["key"]:
                    yield from flush()
                    state["key"] = key
                state["rows"].append(row)

        work.end = flush
        return work

    return make


def _nearest(x: np.ndarray, centroids: np.ndarray, k: int) -> np.ndarray:
    sim = unit(x) @ centroids.T
    k = min(k, len(centroids))
    return np.sort(np.argpartition(-sim, k - 1, axis=1)[:, :k], axis=1)


def _parts(shard: str, at: list[int]) -> list[str]:
    return [f"{shard}/{i:03d}" for i in at]


def _cut(placed: DataFrame, big: DataFrame, overlap: int, scratch: Scratch, p: Params) -> DataFrame:
    """placed(rep, m, x, shards) with each shard in big(shard, size) replaced by those of its parts that a class is nearest to."""
    spark, parts = placed.sparkSession, n_partitions(placed.sparkSession)
    big = F.broadcast(big) if big.limit(100_001).count() <= 100_000 else big
    inside = placed.select("rep", "x", F.explode("shards").alias("shard")).join(big, "shard")
    draws = 1 << 20
    sample = inside.where(F.pmod(F.xxhash64("rep"), F.lit(draws)) * F.col("size") < p.sample_rows * draws)

    def fit(key, got):
        c = fit_centroids(unit(np.array([r[1] for r in got])), max(2, min(p.fan, -(-got[0][2] // p.shard_target))))
        yield {"shard": [key[0]], "dim": [c.shape[1]], "centroids": [c.tobytes()]}

    ordered = sample.select("shard", "rep", "x", "size").repartition(parts, "shard").sortWithinPartitions("shard", "rep")
    centroids = scratch.save(map_rows(ordered, _groups(("rep", "x", "size"), ("shard",), fit), "shard string, dim int, centroids binary"))
    unpacked = lambda raw, dim: np.frombuffer(raw, dtype=np.float64).reshape(-1, dim)
    if (centroids.agg(F.sum(F.length("centroids"))).first()[0] or 0) <= p.broadcast_bytes:
        shared = spark.sparkContext.broadcast({r.shard: unpacked(r.centroids, r.dim) for r in centroids.collect()})

        def route():
            known = shared.value

            def work(batch: pa.RecordBatch):
                shards, x = batch.column("shards").to_pylist(), _values(batch.column("x"))
                at: dict[str, list[int]] = {}
                for i, own in enumerate(shards):
                    for s in own:
                        if s in known:
                            at.setdefault(s, []).append(i)
                for s, rows in at.items():
                    for i, near in zip(rows, _nearest(np.array([x[i] for i in rows]), known[s], overlap).tolist()):
                        shards[i] = [t for t in shards[i] if t != s] + _parts(s, near)
                yield {c: batch.column(c) for c in ("rep", "m", "x")} | {"shards": shards}

            return work

        return map_rows(placed, route, "rep long, m long, x array<double>, shards array<string>")

    # the centroids of a shard go ahead of its vectors, in as many tasks as these fill
    salts = F.ceil(F.col("size") / 20_000).cast("int")
    ahead = centroids.join(big, "shard").select("shard", F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt"), F.lit(None).cast("long").alias("rep"), F.lit(None).cast("array<double>").alias("x"), "dim", "centroids")
    rows = inside.select("shard", F.pmod(F.xxhash64("rep"), salts).cast("int").alias("salt"), "rep", "x", F.lit(None).cast("int").alias("dim"), F.lit(None).cast("binary").alias("centroids"))

    def deal():
        state: dict = {}

        def work(batch: pa.RecordBatch):
            out: tuple[list, list, list] = [], [], []
            for shard, rep, x, dim, raw in zip(*(batch.column(c).to_pylist() for c in ("shard", "rep", "x", "dim", "centroids"))):
                if rep is None:
                    state["centroids"] = unpacked(raw, dim)
                else:
                    for o, value in zip(out, (rep, shard, _parts(shard, _nearest(np.array([x]), state["centroids"], overlap)[0].tolist()))):
                        o.append(value)
            yield dict(zip(("rep", "shard", "parts"), out))

        return work

    together = ahead.unionByName(rows).repartition(parts, "shard", "salt").sortWithinPartitions("shard", "salt", F.asc_nulls_first("rep"))
    dealt = map_rows(together, deal, "rep long, shard string, parts array<string>")
    each = placed.select("rep", "m", "x", F.explode("shards").alias("shard")).join(dealt, ["rep", "shard"], "left")
    return each.groupBy("rep").agg(F.first("m").alias("m"), F.first("x").alias("x"), F.flatten(F.collect_list(F.coalesce("parts", F.array("shard")))).alias("shards"))


def _placed(rows: DataFrame, scratch: Scratch, p: Params) -> tuple[DataFrame, DataFrame]:
    """rows(g, rep, m, x) in their shards: (rep, m, x, shards), and (shard, size). Shards over the cap are cut until none is, or it does not help."""
    placed = rows.select("rep", "m", "x", F.array(F.concat_ws(":", F.col("g.dim"), F.hex(F.encode(F.col("g.label").cast("string"), "UTF-8")))).alias("shards"))
    overlap, before = p.overlap, None
    while True:
        sizes = scratch.save(placed.select(F.explode("shards").alias("shard")).groupBy("shard").agg(F.count("*").alias("size")))
        big = sizes.where(F.col("size") > p.shard_cap)
        if before is not None:
            parent = before.select(F.col("shard").alias("parent"), F.col("size").alias("whole"))
            big = big.withColumn("parent", F.regexp_replace("shard", "/[0-9]+$", "")).join(parent, "parent", "left").where("whole is null or size <= %r * whole" % p.stuck).select("shard", "size")
            # a shard that has been found stuck stays so
            big = big.join(before.select("shard"), "shard", "left_anti")
        if not big.limit(1).count():
            return placed, sizes
        placed, last = scratch.save(_cut(placed, big, overlap, scratch, p)), placed if before is not None else None
        if last is not None:
            scratch.drop(last)
        overlap, before = p.overlap_below, sizes if before is None else scratch.save(sizes.unionByName(before.join(sizes, "shard", "left_anti")))


def link(vectors: DataFrame, params: Params = Params()) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of vectors(vec_id, embedding, label)."""
    p, spark = params, vectors.sparkSession
    scratch = Scratch(spark, "embedding")
    parts = n_partitions(spark)
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("e"), F.col("label"))
    good = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("e").isNotNull() & (F.size("e") > 0)
    good &= ~F.exists("e", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists("e", lambda x: x != 0)
    v = v.withColumn("ok", F.coalesce(good, F.lit(False)))
    valid = v.where("ok").select("vec_id", F.struct("label", F.size("e").alias("dim")).alias("g"), scaled("e").alias("x"))
    keyed = valid.withColumn("h1", F.xxhash64("g", "x")).withColumn("h2", F.xxhash64(F.lit(1), "x", "g"))
    rows = scratch.save(keyed.groupBy("g", "h1", "h2").agg(F.min("vec_id").alias("rep"), F.count("*").alias("m"), F.first("x").alias("x")))

    placed, sizes = _placed(rows, scratch, p)
    in_shard = placed.select(F.explode("shards").alias("shard"), "rep", "m", "x", "shards")
    # the shards left over the cap are known by name; their number is checked
    over = sizes.where(F.col("size") > p.shard_cap)
    over = F.broadcast(over) if over.limit(100_001).count() <= 100_000 else over
    in_shard = in_shard.join(over, "shard", "left").withColumn("size", F.coalesce("size", F.lit(0)))
    small, large = in_shard.where(F.col("size") <= p.shard_cap), in_shard.where(F.col("size") > p.shard_cap)

    def build(_, got):
        reps = np.array([r[0] for r in got])
        i, j = robust_prune(unit(np.array([r[1] for r in got])), p)
        n = len(reps)
        both = np.unique(np.concatenate([i * n + j, j * n + i]))
        yield {"rep": reps, "near": np.split(reps[both % n], np.searchsorted(both, np.arange(1, n) * n))}

    ordered = small.repartition(parts, "shard").sortWithinPartitions("shard", "rep")
    lists = map_rows(ordered.select("shard", "rep", "x"), _groups(("rep", "x"), ("shard",), build), "rep long, near array<long>")
    united = lists.groupBy("rep").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))

    schema = "rep long, links long, a long, b long"

    def answer(reps, found, weight_b, counted, other=None):
        other = reps if other is None else other
        links = counted @ weight_b
        if other is reps:
            edges = _stars(found)
        else:
            i, j = np.nonzero(found)
            edges = [(x, y - len(reps)) for x, y in _forest(len(reps) + len(other), i, j + len(reps))]
        yield {"rep": reps, "links": links, "a": [None] * len(reps), "b": [None] * len(reps)}
        yield {"rep": [None] * len(edges), "links": [None] * len(edges), "a": [int(reps[x]) for x, _ in edges], "b": [int(other[y]) for _, y in edges]}

    def search(key, got):
        reps, m, shards = np.array([r[0] for r in got]), np.array([r[1] for r in got]), [r[3] for r in got]
        x = unit(np.array([r[2] for r in got]))
        near = [r[4] if r[4] is not None else reps[:0] for r in got]
        flat, row = np.concatenate(near), np.repeat(np.arange(len(reps)), [len(g) for g in near])
        at = np.minimum(np.searchsorted(reps, flat), len(reps) - 1)  # reps are in order
        here = reps[at] == flat
        graph = (np.concatenate([[0], np.cumsum(np.bincount(row[here], minlength=len(reps)))]), at[here])
        medoid = int(np.argmax(x @ x.mean(axis=0)))
        found = np.zeros((len(reps), len(reps)), dtype=bool)
        for lo in range(0, len(reps), p.together):
            q, hit = range_search(x, graph, medoid, np.arange(lo, min(lo + p.together, len(reps))), p)
            found[lo + q, hit] = True
        found |= found.T
        yield from answer(reps, found, m, _counted(found, shards, shards, key[0]))

    graphs = small.join(united, "rep", "left").repartition(parts, "shard").sortWithinPartitions("shard", "rep")
    results = map_rows(graphs.select("shard", "rep", "m", "x", "shards", "near"), _groups(("rep", "m", "x", "shards", "near"), ("shard",), search), schema)

    # the exact way for shards over the cap: every two blocks of a shard meet in one task
    def exact(key, got):
        i, j = key[1], key[2]
        mine, theirs = [r for r in got if r[4] == i], [r for r in got if r[4] == j]
        if not mine or not theirs:
            return
        x, y = unit(np.array([r[2] for r in mine])), unit(np.array([r[2] for r in theirs]))
        a, b = np.array([r[0] for r in mine]), np.array([r[0] for r in theirs])
        found = x @ y.T >= p.cosine
        if i == j:
            np.fill_diagonal(found, False)
        counted = _counted(found, [r[3] for r in mine], [r[3] for r in theirs], key[0])
        yield from answer(a, found, np.array([r[1] for r in theirs]), counted, None if i == j else b)
        if i != j:
            yield {"rep": b, "links": counted.T @ np.array([r[1] for r in mine]), "a": [None] * len(b), "b": [None] * len(b)}

    blocks = large.withColumn("blocks", F.ceil(F.col("size") / p.block).cast("int")).withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    met = blocks.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = met.select("shard", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "rep", "m", "x", "shards", "block")
    met = met.repartition(parts, "shard", "i", "j").sortWithinPartitions("shard", "i", "j", "rep")
    results = scratch.save(results.unionByName(map_rows(met, _groups(("rep", "m", "x", "shards", "block"), ("shard", "i", "j"), exact), schema)))

    linked = results.where("rep is not null").groupBy("rep").agg(F.sum("links").alias("links"))
    comp = components(results.where("a is not null").select("a", "b"), scratch).select(F.col("node").alias("rep"), F.col("component"))
    classes = rows.select("g", "h1", "h2", "rep", "m").join(linked, "rep", "left").join(comp, "rep", "left")
    classes = classes.select("g", "h1", "h2", F.coalesce("component", "rep").alias("component"), (F.coalesce("links", F.lit(0)) + F.col("m") - 1).alias("links"))
    own = keyed.select("vec_id", "g", "h1", "h2").join(classes, ["g", "h1", "h2"], "left").select("vec_id", F.col("links").alias("n_links"), F.col("component").alias("component_id"))
    rest = v.where("not ok").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return own.unionByName(rest).withColumn("kept", F.col("vec_id") == F.col("component_id"))


def audit(vectors: DataFrame, result: DataFrame, params: Params = Params(), every: int = 50) -> tuple[int, int]:
    """(links found, links there) of the vectors whose id is divisible by `every`, by brute force in blocks.

    The queries are broadcast in blocks of 2,000; each Arrow batch of all vectors is compared with a block.
    """
    spark = vectors.sparkSession
    total = 0
    block: list = []

    def count(block: list) -> int:
        shared = spark.sparkContext.broadcast([(r.vec_id, r.label, r.embedding) for r in block])

        def make():
            by: dict = {}
            for i, label, e in shared.value:
                if label is not None and e and all(x is not None and np.isfinite(x) for x in e) and any(e):
                    by.setdefault((label, len(e)), []).append((i, e))
            by = {k: (np.array([i for i, _ in q]), unit(np.array([e for _, e in q], dtype=float))) for k, q in by.items()}

            def work(batch: pa.RecordBatch):
                n = 0
                for i, label, e in zip(*(batch.column(c).to_pylist() for c in ("vec_id", "label", "embedding"))):
                    if label is None or not e or (label, len(e)) not in by or not all(x is not None and np.isfinite(x) for x in e) or not any(e):
                        continue
                    ids, q = by[label, len(e)]
                    n += int(((q @ unit(np.array([e], dtype=float))[0] >= params.cosine) & (ids != i)).sum())
                yield {"n": [n]}

            return work

        return map_rows(vectors.select("vec_id", "label", "embedding"), make, "n long").agg(F.sum("n")).first()[0] or 0

    for r in vectors.where(F.col("vec_id") % every == 0).select("vec_id", "label", "embedding").toLocalIterator():
        block.append(r)
        if len(block) == 2_000:
            total, block = total + count(block), []
    total += count(block) if block else 0
    found = result.where(F.col("vec_id") % every == 0).agg(F.sum("n_links")).first()[0] or 0
    return found, total
