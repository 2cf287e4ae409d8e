"""Quality classifier by compression.

Two raw-content zstandard dictionaries are built from whole labelled texts, good and bad ones. Every whole text is compressed in
blocks against each; the difference of the compressed sizes, divided by the text's length, is calibrated to a probability by a
logistic fit on other labelled rows (with the length's logarithm, since a short text's difference says less, and the sizes' sum).

Defined results: a null or empty text has difference 0 and scores as the calibration says for that; repeated rows score alike,
and an id's smallest text is learned from; rows with a null id are scored and never used for fitting; without labels of both
classes nothing is compressed and all texts score alike; columns of other names are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import carried, map_rows, short_batches


@dataclass(frozen=True)
class Params:
    """Bounds of the labelled rows that are learned from; their texts are used whole."""

    dictionary_rows: int = 1_000  # labelled rows of each class for the dictionaries: as many of one as of the other
    calibration_rows: int = 5_000  # labelled rows of either class for the calibration
    block_bytes: int = 4_096
    level: int = 3
    threshold: float = 0.3


@dataclass(frozen=True)
class Model:
    good: bytes
    bad: bytes
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    params: Params


def sizer(good: bytes, bad: bytes, p: Params):
    """A function from text to its compressed sizes with the good and with the bad dictionary, and its length, in bytes."""
    import zstandard as z

    def compressor(content: bytes) -> "z.ZstdCompressor":
        if len(content) < 8:
            return z.ZstdCompressor(level=p.level, write_checksum=False, write_content_size=False)
        # tables with a slot or two for each two bytes of the dictionary, so that none of it is forgotten
        bits = min(26, max(17, len(content).bit_length() - 1))
        options = z.ZstdCompressionParameters.from_level(
            p.level, dict_size=len(content), window_log=min(30, max(19, len(content).bit_length() + 1)), hash_log=bits, chain_log=bits, write_checksum=0, write_content_size=0
        )
        d = z.ZstdCompressionDict(content, dict_type=z.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(compression_params=options)
        return z.ZstdCompressor(dict_data=d, compression_params=options)

    both = (compressor(good), compressor(bad))

    def sizes(text: str | None) -> tuple[int, int, int]:
        data = (text or "").encode("utf-8", "surrogatepass")
        blocks = [data[i : i + p.block_bytes] for i in range(0, len(data), p.block_bytes)]
        return (*(sum(len(c.compress(b)) for b in blocks) for c in both), len(data))

    return sizes


def features(sizes: np.ndarray) -> np.ndarray:
    """The normalised size difference, the logarithm of the length, their product, and the normalised sum. sizes: columns good, bad, raw.

    The sum says how little either dictionary covers the text, which tells more where labels are few.
    """
    n = np.maximum(sizes[:, 2], 1.0)
    difference = (sizes[:, 1] - sizes[:, 0]) / n
    return np.stack([difference, np.log(n), difference * np.log(n), (sizes[:, 0] + sizes[:, 1]) / n], axis=1)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    z = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(z.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p) + 1e-6)[:, None]).T @ z + ridge * np.eye(len(w)), z.T @ (y - p) - ridge * w)
        w = w + step
        if np.abs(step).max() < 1e-7:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, allowed: Column, params: Params = Params()) -> Model:
    """Fit on labelled rows where `allowed` (a column over doc_id) holds.

    The rows are the first by a hash of their id. What reaches the driver is bounded by their number: the dictionaries' texts, and
    three numbers of each calibration row.
    """
    spark = docs.sparkSession
    short_batches(spark)
    lab = labels.select("doc_id", F.col("quality").cast("int").alias("y")).where(F.col("y").isin(0, 1) & F.col("doc_id").isNotNull()).where(allowed).groupBy("doc_id").agg(F.max("y").alias("y"))
    lab = lab.withColumn("h", F.xxhash64("doc_id"))
    for_dict = F.pmod("h", F.lit(2)) == 0
    sizes = {r.y: r["count"] for r in lab.where(for_dict).groupBy("y").count().collect()}
    each = min(params.dictionary_rows, sizes.get(0, 0), sizes.get(1, 0))
    first = lambda q, n, use: lab.where(q).orderBy("h", "doc_id").limit(n).withColumn("use", F.lit(use))
    chosen = first(for_dict & (F.col("y") == 1), each, "good").unionByName(first(for_dict & (F.col("y") == 0), each, "bad")).unionByName(first(~for_dict, params.calibration_rows, "fit"))
    # bounded: 2 * dictionary_rows + calibration_rows ids; of an id's rows one is used
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id").groupBy("use", "h", "doc_id", "y").agg(F.min("text").alias("text"))
    texts = sorted((r.use, r.h, r.doc_id, r.text) for r in rows.where("use <> 'fit'").collect())
    good, bad = ("\n".join(t for use, _, _, t in texts if use == k).encode("utf-8", "surrogatepass") for k in ("good", "bad"))
    shared = spark.sparkContext.broadcast((good, bad))

    def make():
        sizes_of = sizer(*shared.value, params)

        def work(batch: pa.RecordBatch):
            got = [sizes_of(t) for t in batch.column("text").to_pylist()]
            yield {c: batch.column(c) for c in ("doc_id", "y")} | {k: [g[i] for g in got] for i, k in enumerate(("good", "bad", "raw"))}

        return work

    sized = map_rows(rows.where("use = 'fit'").select("doc_id", "y", "text"), make, "doc_id long, y int, good long, bad long, raw long")
    got = sorted(sized.collect())
    if not got:
        return Model(good, bad, np.zeros(4), np.ones(4), np.zeros(5), params)
    x, y = features(np.array([r[2:] for r in got], dtype=float)), np.array([r[1] for r in got], dtype=float)
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    return Model(good, bad, mean, scale, logistic((x - mean) / scale, y), params)


def score(docs: DataFrame, model: Model, carry: bool = False) -> DataFrame:
    """(doc_id, score, predicted) of every row of docs(doc_id, text): one map, no shuffle.

    With carry the other columns of docs come along (but for clashing names).
    """
    short_batches(docs.sparkSession)
    m = docs.sparkSession.sparkContext.broadcast(model)
    docs = docs if carry else docs.select("doc_id", "text")
    keep, kept_schema = carried(docs if carry else docs.select("doc_id"), ("score", "predicted"))

    def make():
        own = m.value
        sizes_of = sizer(own.good, own.bad, own.params)

        def work(batch: pa.RecordBatch):
            if not batch.num_rows:
                return
            x = features(np.array([sizes_of(t) for t in batch.column("text").to_pylist()], dtype=float))
            z = np.clip(own.weights[0] + ((x - own.mean) / own.scale) @ own.weights[1:], -30, 30)
            s = 1 / (1 + np.exp(-z))
            yield {c: batch.column(c) for c in keep} | {"score": s, "predicted": (s >= own.params.threshold).astype(np.int32)}

        return work

    return map_rows(docs, make, f"{kept_schema}, score double, predicted int")
