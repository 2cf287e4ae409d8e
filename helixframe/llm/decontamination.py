"""Benchmark decontamination by n-gram windows.

The benchmark's windows (10 consecutive normalised words; a shorter item is one window)
form a hash set that is broadcast in blocks of bounded size. Every document's token
windows are scanned against it, hash hits are verified word by word, and the hit
words are reported as spans, which can be cut out or cause the document to be dropped.

Defined results: null, empty or word-free texts have no words, hits or items; repeated
documents are reported once a row; repeated items count once by id; items with a null
id or text are ignored; an empty benchmark hits nothing. Whole texts are scanned.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, carried, map_rows, short_batches

#: Bytes of words: digits, letters and everything beyond ASCII; A-Z become a-z, all else a blank.
_NORMAL = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_BASE = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Params:
    window: int = 10
    block_chars: int = 4_000_000  # of benchmark text in one broadcast block


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_NORMAL).split()


class Windows:
    """The windows of a block of items: word ids, and by window length the sorted hashes."""

    def __init__(self, items: list[tuple[int, str]], window: int):
        self.vocabulary: dict[bytes, int] = {}
        found: dict[tuple[int, ...], set[int]] = {}
        for item, text in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words(text)]
            if ids:
                n = min(window, len(ids))
                for i in range(len(ids) - n + 1):
                    found.setdefault(tuple(ids[i : i + n]), set()).add(item)
        self.items = {k: sorted(v) for k, v in found.items()}
        by: dict[int, list[tuple[int, ...]]] = {}
        for k in found:
            by.setdefault(len(k), []).append(k)
        self.hashes = {n: np.unique(self._hash(np.array(ks, dtype=np.uint64).ravel(), n)[::n]) for n, ks in by.items()}

    @staticmethod
    def _hash(ids: np.ndarray, n: int) -> np.ndarray:
        h = np.zeros(len(ids) - n + 1, dtype=np.uint64)
        with np.errstate(over="ignore"):
            for k in range(n):
                h = (h ^ ids[k : k + len(h)]) * _BASE
                h ^= h >> np.uint64(29)
        return h

    def scan(self, text: str | None) -> tuple[int, list[int], list[int], list[int]]:
        """Word count, span starts, span ends (word positions, disjoint), item ids found."""
        tokens = words(text)
        if not tokens or not self.hashes:
            return len(tokens), [], [], []
        get = self.vocabulary.get
        ids = np.fromiter((get(t, 0) for t in tokens), dtype=np.uint64, count=len(tokens))
        known = np.concatenate([[0], np.cumsum(ids > 0)])
        spans, items = [], set()
        for n, wanted in self.hashes.items():
            if len(ids) < n:
                continue
            at = np.flatnonzero(known[n:] - known[:-n] == n)
            if not len(at):
                continue
            h = self._hash(ids, n)[at]
            pos = np.minimum(np.searchsorted(wanted, h), len(wanted) - 1)
            for i in at[wanted[pos] == h].tolist():
                own = self.items.get(tuple(ids[i : i + n].tolist()))  # the verification
                if own:
                    spans.append((i, i + n))
                    items.update(own)
        starts, ends = merged(spans)
        return len(tokens), starts, ends, sorted(items)


def merged(spans: list[tuple[int, int]]) -> tuple[list[int], list[int]]:
    starts: list[int] = []
    ends: list[int] = []
    for a, b in sorted(spans):
        if ends and a <= ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a)
            ends.append(b)
    return starts, ends


def _blocks(benchmark: DataFrame, chars: int) -> Iterator[list[tuple[int, str]]]:
    """Items in blocks of bounded text; the driver holds one block and one partition of the benchmark at a time."""
    rows = benchmark.where(F.col("item_id").isNotNull() & F.col("text").isNotNull()).select("item_id", "text")
    block: list[tuple[int, str]] = []
    size = 0
    for r in rows.toLocalIterator():
        if block and size + len(r.text) > chars:
            yield block
            block, size = [], 0
        block.append((r.item_id, r.text))
        size += len(r.text)
    yield block


_MADE = ("n_words", "n_hit", "span_starts", "span_ends", "item_ids")


def scan(docs: DataFrame, benchmark: DataFrame, params: Params = Params(), carry: bool = False) -> DataFrame:
    """(doc_id, text, n_words, n_hit, span_starts, span_ends, item_ids) of every row of docs(doc_id, text).

    One map a block of the benchmark; no shuffle. With several blocks a row carries its spans and items from each scan to the next,
    so nothing is joined back; each scan but the last is written, so that workers hold one block's windows at a time.
    """
    spark = docs.sparkSession
    short_batches(spark)
    out = docs if carry else docs.select("doc_id", "text")
    keep, kept_schema = carried(out, _MADE)
    out = out.select(*keep)
    schema = f"{kept_schema}, n_words long, span_starts array<int>, span_ends array<int>, item_ids array<long>"
    scratch, written, last = Scratch(spark, "windows"), None, None
    for k, block in enumerate(_blocks(benchmark, params.block_chars)):
        if k:
            written, before = scratch.save(out), written
            last.unpersist()
            if before is not None:
                scratch.drop(before)
            out = written
        last = shared = spark.sparkContext.broadcast((block, params.window))

        def make(shared=shared):
            find = Windows(*shared.value)

            def work(batch: pa.RecordBatch):
                texts = batch.column("text").to_pylist()
                got = [find.scan(t) for t in texts]
                if "item_ids" in batch.schema.names:
                    before = [batch.column(c).to_pylist() for c in ("span_starts", "span_ends", "item_ids")]
                    got = [
                        (g[0], *merged([*zip(s, e), *zip(g[1], g[2])]), sorted({*i, *g[3]}))
                        for g, s, e, i in zip(got, *before)
                    ]
                yield {c: batch.column(c) for c in keep} | {
                    k: [g[i] for g in got] for i, k in enumerate(("n_words", "span_starts", "span_ends", "item_ids"))
                }

            return work

        out = map_rows(out, make, schema)
    hit = F.aggregate(F.arrays_zip("span_starts", "span_ends"), F.lit(0).cast("long"), lambda a, s: a + (s.span_ends - s.span_starts))
    return out.select(*keep, "n_words", hit.alias("n_hit"), "span_starts", "span_ends", "item_ids")


def decontaminate(docs: DataFrame, benchmark: DataFrame, mode: str = "drop", max_hit_share: float = 0.0, params: Params = Params()) -> DataFrame:
    """Drop documents whose share of hit words is over max_hit_share, or cut the hit spans out of texts.

    mode "drop" keeps the rows of docs that pass; mode "cut" keeps every row, its hit words removed. Columns
    of docs are kept, but for names that clash with the scan's. One map, no shuffle.
    """
    found = scan(docs, benchmark, params, carry=True)
    keep = [c for c in docs.columns if c not in _MADE]
    if mode == "drop":
        return found.where((F.col("n_hit") == 0) | (F.col("n_hit") <= max_hit_share * F.col("n_words"))).select(*keep)
    if mode != "cut":
        raise ValueError(f"mode is drop or cut, not {mode}")
    _, schema = carried(found.select(*keep), ())

    def make():
        def cut(text: str | None, starts: list[int], ends: list[int]) -> str | None:
            if not starts:
                return text
            at = [m.span() for m in re.finditer(rb"[^ ]+", text.encode().translate(_NORMAL))]
            raw, out, last = text.encode(), b"", 0
            for a, b in zip(starts, ends):
                out += raw[last : at[a][0]]
                last = at[b - 1][1]
            return (out + raw[last:]).decode()

        def work(batch: pa.RecordBatch):
            cols = [batch.column(c).to_pylist() for c in ("text", "span_starts", "span_ends")]
            yield {c: batch.column(c) for c in keep} | {"text": [cut(*x) for x in zip(*cols)]}

        return work

    return map_rows(found, make, schema)
