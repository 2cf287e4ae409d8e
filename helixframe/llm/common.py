"""Shared helpers: scratch tables, Arrow streaming, hash splits, connected components."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shipping import ship

#: Rows per Arrow batch sent to Python; texts can be long, so batches are kept short.
ARROW_ROWS = 1000
#: Bytes of a batch that a batch function gets at once, and about as many that it should give: 1,000 texts can have any length.
BATCH_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_bucket(col: Column, n: int) -> Column:
    """crc32 of the id written as text, modulo n."""
    return F.crc32(col.cast("string").cast("binary")) % F.lit(n)


def short_batches(spark: SparkSession, rows: int = ARROW_ROWS) -> None:
    """Bound the rows of an Arrow batch, so a batch of long texts fits a Python worker."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key, "10000")) <= rows:
        spark.conf.set(key, str(rows))


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder of spark.checkpoint.dir; a folder of our own only where it is unset."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return "/tmp/checkpoints"


class Scratch:
    """Tables written to the shared checkpoint folder; they cut lineage and survive lost executors."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.base = f"{checkpoint_root(spark).rstrip('/')}/helixframe-{label}-{uuid.uuid4().hex}"
        self.count = 0

    def save(self, df: DataFrame) -> DataFrame:
        self.count += 1
        path = f"{self.base}/{self.count:03d}"
        df.write.mode("overwrite").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._helixframe_path = path
        return out

    def drop(self, *frames: DataFrame) -> None:
        """Delete saved tables that nothing reads any more."""
        jvm = self.spark.sparkContext._jvm
        for f in frames:
            path = jvm.org.apache.hadoop.fs.Path(f._helixframe_path)
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def pieces(batch: pa.RecordBatch, limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in stretches of at most `limit` bytes; a longer row is a stretch of its own."""
    if batch.nbytes <= limit or batch.num_rows < 2:
        yield batch
        return
    half = batch.num_rows // 2
    yield from pieces(batch.slice(0, half), limit)
    yield from pieces(batch.slice(half), limit)


def release() -> None:
    """Give freed memory back to the system: a worker is kept for later tasks, and idles beside others."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not glibc
        pass


def map_rows(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], Iterable[dict[str, list]]]], schema: str) -> DataFrame:
    """Run a batch function over Arrow batches. make() is called once a task and returns it; it yields columns.

    It gets at most BATCH_BYTES at once, so that its memory does not grow with the length of the texts.
    """
    from pyspark.sql.types import _parse_datatype_string
    from pyspark.sql.pandas.types import to_arrow_schema

    ship(df.sparkSession)
    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for piece in pieces(batch):
                for cols in work(piece):
                    yield pa.RecordBatch.from_arrays([pa.array(cols[f.name], type=f.type) for f in arrow], schema=arrow)
        end = getattr(work, "end", None)
        if end:
            for cols in end():
                yield pa.RecordBatch.from_arrays([pa.array(cols[f.name], type=f.type) for f in arrow], schema=arrow)
        del work, end
        release()

    return df.mapInArrow(run, schema)


def carried(docs: DataFrame, made: tuple[str, ...]) -> tuple[list[str], str]:
    """The columns of docs that can travel along with a result, besides those it makes, and their schema."""
    fields = [f for f in docs.schema if f.name not in made]
    return [f.name for f in fields], ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)


def n_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: Edges that one task takes at once (a union-find of 60 MB at most); more of them are contracted in rounds.
FEW_EDGES = 200_000


def _root(parent: dict[int, int], x: int) -> int:
    root = x
    while (p := parent.setdefault(root, root)) != root:
        root = p
    while parent[x] != root:
        parent[x], x = root, parent[x]
    return root


def spanning_forest(edges: DataFrame) -> DataFrame:
    """Within each partition keep only edges that join two trees: fewer rows, the same components.

    Memory is bounded: the forest is flushed whenever it holds a million nodes.
    """

    def make() -> Any:
        parent: dict[int, int] = {}

        def work(batch: pa.RecordBatch):
            a_out, b_out = [], []
            for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
                ra, rb = _root(parent, a), _root(parent, b)
                if ra != rb:
                    lo, hi = (ra, rb) if ra < rb else (rb, ra)
                    parent[hi] = lo
                    a_out.append(a)
                    b_out.append(b)
            if len(parent) > 1_000_000:
                parent.clear()
            yield {"a": a_out, "b": b_out}

        return work

    return map_rows(edges.select("a", "b"), make, "a long, b long")


def _labelled(edges: DataFrame) -> DataFrame:
    """(node, component) of a few edges (u, v), joined by one task."""

    def make() -> Any:
        parent: dict[int, int] = {}

        def work(batch: pa.RecordBatch):
            for u, v in zip(batch.column("u").to_pylist(), batch.column("v").to_pylist()):
                lo, hi = sorted((_root(parent, u), _root(parent, v)))
                parent[hi] = lo
            return ()

        def end():
            nodes = list(parent)
            yield {"node": nodes, "component": [_root(parent, x) for x in nodes]}

        work.end = end
        return work

    return map_rows(edges.coalesce(1), make, "node long, component long")


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """Connected components of edges (a, b): rows (node, component), component the smallest node.

    The partitions' forests are joined by one task if they hold FEW_EDGES at most. More edges are contracted by
    alternating large and small stars; every round is written to the shared folder. No edge or component is collected; only
    counters reach the driver.
    """
    e = scratch.save(spanning_forest(edges.where("a <> b")).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")))
    if e.count() <= FEW_EDGES:
        return _labelled(e)
    last = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # small star: every node's smaller neighbours and itself move to the smallest of them
        low2 = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low2, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low2.select("u", F.col("m").alias("v")))
        new = scratch.save(small.where("u <> v").distinct())
        row = new.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        scratch.drop(e)
        e = new
        if (row["n"], row["h"]) == last:
            break
        last = (row["n"], row["h"])
    nodes = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
