"""N-gram Jaccard join with set-relation skipping.

A document's set holds its distinct 5-word shingles. Sets A and B link when
100 * |A n B| >= 80 * |A u B|. The join is exact up to 64-bit shingle hashes:

1. Equal sets collapse into classes by a 128-bit digest; only class representatives go on.
2. Answers from similar sets: classes that share a band of min-hashes meet in bounded chunks, the most central of a chunk
   first; a class highly similar to an earlier one is attached to it and is not compared further there. What remains of
   a large key meets again, as long as that helps. These links (all verified) give most components in linear work.
3. Prefix index lists: every class posts the rarest part of its set, the rarity read from a count sketch of all
   shingles. A list is kept in (size, position) order and read in blocks: a block is skipped when its sizes, or the
   positions left in it, rule out the overlap. Entries of one component collapse to one posting, because their mutual
   answers are known; pairs within a component are never made.
4. One representative pair of each two components that meet is verified; unless that links or settles them, all pairs of
   their sets that share a list are, so that no link between components is lost.

Texts are never shuffled: each step maps over the documents and picks those it needs by a bitmap of hashed ids, whose
size is fixed (an id it lets through in error is removed by an exact join afterwards, or is an exact copy, which changes nothing).

Result: one row a document: doc_id, n_shingles, component_id. Null, empty or word-free texts
have 0 shingles and are their own component; documents with fewer than five words have one
shingle; repeated rows of an id count as one document, the smallest text kept; rows with a null id are left out
of the join and returned with a null component. Texts are read whole; other columns are ignored.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BATCH_BYTES, Scratch, carried, components, map_rows, n_partitions, short_batches

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


@dataclass(frozen=True)
class Params:
    words: int = 5
    percent: int = 80
    #: Similarity, in percent, at which a class is attached to an earlier one in a chunk.
    attach_percent: int = 80
    chunk: int = 128  # classes of a key compared in one chunk
    list_rows: int = 256  # postings of a token that one task meets; a longer list is met block pair by block pair
    id_bits: int = 26  # bits of an id bitmap: 8 MB when broadcast, at any input size
    sketch_bits: int = 21  # counters of the count sketch: 2 MB when broadcast, at any input size


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: list[str | None], n: int = 5) -> list[np.ndarray]:
    """Of each text, the sorted distinct 64-bit hashes of its n-word shingles."""
    from xxhash import xxh3_64_intdigest as digest

    rows = [(t or "").encode().lower().split() for t in texts]  # on bytes: A-Z and ASCII white space only
    sizes = [len(r) for r in rows]
    h = np.fromiter((digest(w) for r in rows for w in r), dtype=np.uint64, count=sum(sizes))
    out: list[np.ndarray] = []

    def mixed(x: np.ndarray, k: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            y = np.full(max(0, len(x) - k + 1), np.uint64(k))
            for i in range(k):
                y = _mix(y * np.uint64(31) + x[i : i + len(y)])
        return y

    every, at = mixed(h, n), 0
    for size in sizes:
        if size >= n:
            out.append(np.unique(every[at : at + size - n + 1]))
        else:
            out.append(mixed(h[at : at + size], size) if size else np.zeros(0, dtype=np.uint64))
        at += size
    return out


def shingles(text: str | None, n: int = 5) -> np.ndarray:
    return shingle_sets([text], n)[0]


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum())


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    small, large = min(len(a), len(b)), max(len(a), len(b))
    if 100 * small < percent * large or not small:
        return False
    both = overlap(a, b)
    return 100 * both >= percent * (len(a) + len(b) - both)


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


_BANDS = 4
_SIGN = "kind int, doc_id long, n long, d1 long, d2 long, bands array<long>, block int, counts binary"


def _bands(s: np.ndarray) -> list[int]:
    """Keys from pairs of min-hashes: the least element of each eighth of the hash space (the next one's where it is empty)."""
    at = np.searchsorted(s, np.arange(2 * _BANDS, dtype=np.uint64) << np.uint64(61))
    least = s[at % len(s)]
    with np.errstate(over="ignore"):
        return _signed(_mix(least[0::2] * np.uint64(31) + _mix(least[1::2]) + np.arange(_BANDS, dtype=np.uint64))).tolist()


def pack(own: np.ndarray) -> bytes:
    """The nonzero counters of a block."""
    at = np.flatnonzero(own).astype(np.uint32)
    return zlib.compress(np.diff(at, prepend=np.uint32(0)).tobytes() + np.minimum(own[at], 2**32 - 1).astype(np.uint32).tobytes(), 1)


def unpack(total: np.ndarray, packed: bytes) -> None:
    raw = np.frombuffer(zlib.decompress(packed), dtype=np.uint32)
    n = len(raw) // 2
    total[np.cumsum(raw[:n], dtype=np.int64)] += raw[n:]


class _Counters:
    """Counters of a task, added to in bulk and given out in packed blocks at its end."""

    def __init__(self, width: int, blocks: int = 16):
        self.width, self.blocks, self.total = width, blocks, None
        self.waiting: list[np.ndarray] = []
        self.size = 0

    def add(self, at: np.ndarray) -> None:
        self.waiting.append(at)
        self.size += len(at)
        if self.size > 2_000_000:
            self._flush()

    def _flush(self) -> None:
        if self.waiting:
            counted = np.bincount(np.concatenate(self.waiting), minlength=self.width).astype(np.uint32)
            self.total = counted if self.total is None else self.total + counted
            self.waiting, self.size = [], 0

    def packed(self):
        self._flush()
        step = self.width // self.blocks
        for b in range(self.blocks if self.total is not None else 0):
            own = self.total[b * step : (b + 1) * step]
            if own.any():
                yield b, pack(own)


def _sign(docs: DataFrame, p: Params) -> DataFrame:
    """kind 0: a row a document (size, digest, bands); kind 1: a task's share of the count sketch."""
    width = 1 << p.sketch_bits

    def make():
        from xxhash import xxh3_128_intdigest as digest

        sketch = _Counters(width)

        def work(batch: pa.RecordBatch):
            rows: list[tuple] = []
            sets = shingle_sets(batch.column("text").to_pylist(), p.words)
            for s in sets:
                if not len(s):
                    rows.append((0, 0, 0, None))
                    continue
                d = digest(s.tobytes())
                rows.append((len(s), *np.array([d & (1 << 64) - 1, d >> 64], dtype=np.uint64).view(np.int64).tolist(), _bands(s)))
            if sets:
                sketch.add((np.concatenate(sets) & np.uint64(width - 1)).astype(np.int64))
            n = len(rows)
            yield {"kind": [0] * n, "doc_id": batch.column("doc_id"), "block": [None] * n, "counts": [None] * n} | {k: [r[i] for r in rows] for i, k in enumerate(("n", "d1", "d2", "bands"))}

        def end():
            for b, packed in sketch.packed():
                yield {"kind": [1], "block": [b], "counts": [packed]} | {k: [None] for k in ("doc_id", "n", "d1", "d2", "bands")}

        work.end = end
        return work

    return map_rows(docs.select("doc_id", "text"), make, _SIGN)


def _summed(shares: DataFrame, width: int, finish) -> np.ndarray:
    """Packed counter blocks (block, counts) summed in two levels, so that no task meets the shares of all tasks; one byte a counter."""
    step = width // 16

    def level(last: bool):
        def make():
            own: dict[int, np.ndarray] = {}

            def work(batch: pa.RecordBatch):
                for b, c in zip(batch.column("block").to_pylist(), batch.column("counts").to_pylist()):
                    unpack(own.setdefault(b, np.zeros(step, dtype=np.uint64)), c)
                return ()

            def end():
                for b, t in own.items():
                    yield {"block": [b], "counts": [zlib.compress(finish(t).tobytes(), 1) if last else pack(t)]}

            work.end = end
            return work

        return make

    parts = n_partitions(shares.sparkSession)
    once = map_rows(shares.repartition(parts, "block", F.pmod(F.xxhash64("counts"), F.lit(max(1, parts // 4)))), level(False), "block int, counts binary")
    out = np.zeros(width, dtype=np.uint8)
    for r in map_rows(once.repartition(16, "block"), level(True), "block int, counts binary").collect():
        out[r.block * step : (r.block + 1) * step] = np.frombuffer(zlib.decompress(r.counts), dtype=np.uint8)
    return out


_BITMAP_BLOCKS = 64
#: Ids whose tasks' shares go to the driver as they are (a few bytes an id); those of more ids are merged on the way.
_FEW_IDS = 250_000


def _marked(ids: DataFrame, columns: tuple[str, ...], bits: int) -> list[np.ndarray]:
    """Of each column the bitmap of hashed ids, eight flags a byte. Tasks hold the slots of their own ids; blocks of the bitmaps meet in two levels."""
    step = (1 << bits) // _BITMAP_BLOCKS

    def out(first: int, slots: np.ndarray):
        cuts = np.searchsorted(slots, np.arange(_BITMAP_BLOCKS + 1) * step)
        for b in range(_BITMAP_BLOCKS):
            own = slots[cuts[b] : cuts[b + 1]]
            if len(own):
                yield {"block": [first + b], "at": [pack_slots(own - b * step)]}

    def pack_slots(own: np.ndarray) -> bytes:
        return zlib.compress(np.diff(own, prepend=0).astype(np.uint32).tobytes(), 1)

    def unpack_slots(raw: bytes) -> np.ndarray:
        return np.cumsum(np.frombuffer(zlib.decompress(raw), dtype=np.uint32), dtype=np.int64)

    def collect():
        waiting: list[list[np.ndarray]] = [[] for _ in columns]

        def work(batch: pa.RecordBatch):
            for own, c in zip(waiting, columns):
                own.append(_slot(batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64), bits))
            if sum(map(len, waiting[0])) > 4_000_000:
                yield from end()

        def end():
            for k, own in enumerate(waiting):
                if own:
                    slots = np.unique(np.concatenate(own))
                    own.clear()
                    yield from out(k * _BITMAP_BLOCKS, slots)

        work.end = end
        return work

    def merge(last: bool):
        def make():
            own: dict[int, np.ndarray] = {}

            def work(batch: pa.RecordBatch):
                for b, raw in zip(batch.column("block").to_pylist(), batch.column("at").to_pylist()):
                    own.setdefault(b, np.zeros(step, dtype=np.uint8))[unpack_slots(raw)] = 1
                return ()

            def end():
                for b, flags in own.items():
                    if last:
                        yield {"block": [b], "at": [zlib.compress(np.packbits(flags).tobytes(), 1)]}
                    else:
                        yield {"block": [b], "at": [pack_slots(np.flatnonzero(flags))]}

            work.end = end
            return work

        return make

    parts, schema = n_partitions(ids.sparkSession), "block int, at binary"
    shares = map_rows(ids.select(*columns), collect, schema)
    flags = np.zeros((len(columns), (1 << bits) // 8), dtype=np.uint8)
    if ids.count() <= _FEW_IDS:
        for r in shares.collect():
            at = unpack_slots(r["at"]) + r.block % _BITMAP_BLOCKS * step
            np.bitwise_or.at(flags[r.block // _BITMAP_BLOCKS], at >> 3, (128 >> (at & 7)).astype(np.uint8))
        return list(flags)
    once = map_rows(shares.repartition(parts, "block", F.pmod(F.xxhash64("at"), F.lit(max(1, parts // 16)))), merge(False), schema)
    for r in map_rows(once.repartition(_BITMAP_BLOCKS, "block"), merge(True), schema).collect():
        b = r.block % _BITMAP_BLOCKS
        flags[r.block // _BITMAP_BLOCKS, b * step // 8 : (b + 1) * step // 8] = np.frombuffer(zlib.decompress(r["at"]), dtype=np.uint8)
    return list(flags)


class IdBitmap:
    """A broadcast bitmap of hashed ids: `picks` tells which of some ids may be among them."""

    def __init__(self, ids: DataFrame, column: str, p: Params, flags: np.ndarray | None = None):
        self.shared = ids.sparkSession.sparkContext.broadcast(_marked(ids, (column,), p.id_bits)[0] if flags is None else flags)
        self.bits = p.id_bits

    @classmethod
    def several(cls, ids: DataFrame, columns: tuple[str, ...], p: Params) -> list["IdBitmap"]:
        """The bitmaps of several columns, from one pass over the ids."""
        return [cls(ids, c, p, own) for c, own in zip(columns, _marked(ids, columns, p.id_bits))]

    def __getstate__(self):
        return {"shared": self.shared, "bits": self.bits}

    def picks(self, ids: pa.Array) -> np.ndarray:
        """A mask; null ids are never picked."""
        known = ~np.asarray(ids.is_null().to_numpy(zero_copy_only=False), dtype=bool)
        at = _slot(ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64), self.bits)
        return known & (self.shared.value[at >> 3] >> (7 - (at & 7)) & 1).astype(bool)


def _slot(ids: np.ndarray, bits: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (_mix(ids.view(np.uint64) + np.uint64(1)) >> np.uint64(64 - bits)).astype(np.int64)


def _sets(docs: DataFrame, ids: DataFrame, p: Params) -> DataFrame:
    """(rep, set) of the documents that may be in ids(rep): the set as bytes of its sorted hashes. No exchange."""
    wanted = IdBitmap(ids, "rep", p)

    def make():
        def work(batch: pa.RecordBatch):
            at = np.flatnonzero(wanted.picks(batch.column("doc_id")))
            if len(at):
                own = batch.take(pa.array(at))
                yield {"rep": own.column("doc_id"), "set": [s.tobytes() for s in shingle_sets(own.column("text").to_pylist(), p.words)]}

        return work

    return map_rows(docs.select("doc_id", "text"), make, "rep long, set binary")


_LEVEL_BITS = 20


def _banded(docs: DataFrame, left: DataFrame, turn: int, p: Params) -> DataFrame:
    """(key, salt, rep, set): each set that left(rep, key, size) names, once for each of its keys that several classes share.

    Reps and keys are told by bitmaps, and how many chunks a large key is cut into by a sketch, all of fixed size, so the sets
    go straight from the texts to their chunks. What a bitmap lets through in error meets others without a result.
    """
    reps, keys = IdBitmap.several(left, ("rep", "key"), p)
    slots = left.where(F.col("size") > p.chunk).groupBy(F.pmod("key", F.lit(1 << _LEVEL_BITS)).alias("slot")).agg(F.max("size").alias("size")).collect()  # at most 2^20
    level = np.zeros(1 << _LEVEL_BITS, dtype=np.uint8)
    for r in slots:
        level[r.slot] = int(-(-r.size // p.chunk) - 1).bit_length()
    levels = docs.sparkSession.sparkContext.broadcast(level)

    def make():
        chunks = levels.value

        def work(batch: pa.RecordBatch):
            own = batch.take(pa.array(np.flatnonzero(reps.picks(batch.column("doc_id")))))
            if not own.num_rows:
                return
            sets = [(i, s) for i, s in zip(own.column("doc_id").to_pylist(), shingle_sets(own.column("text").to_pylist(), p.words)) if len(s)]
            key = np.array([_bands(s) for _, s in sets], dtype=np.int64).ravel()
            at = np.flatnonzero(keys.picks(pa.array(key)))
            rep, key = np.repeat(np.array([i for i, _ in sets], dtype=np.int64), _BANDS)[at], key[at]
            with np.errstate(over="ignore"):
                drawn = _mix(rep.view(np.uint64) * np.uint64(31) + np.uint64(turn) + _mix(key.view(np.uint64)) * np.uint64(turn > 0))
            salt = (drawn & ((np.uint64(1) << chunks[key & (1 << _LEVEL_BITS) - 1].astype(np.uint64)) - np.uint64(1))).astype(np.int64)
            yield {"key": key, "salt": salt, "rep": rep, "set": [sets[i // _BANDS][1].tobytes() for i in at.tolist()]}

        return work

    return map_rows(docs.select("doc_id", "text"), make, "key long, salt long, rep long, set binary")


def _ranks(signed: DataFrame, p: Params) -> bytes:
    """The count sketch of all shingles as one byte of log2 scale a counter; its size is fixed."""
    shares = signed.where("kind = 1").select("block", "counts")
    return _summed(shares, 1 << p.sketch_bits, lambda t: np.minimum(np.log2(t + np.float64(1)) * 4, 255).astype(np.uint8)).tobytes()


def _attach(rows: DataFrame, p: Params) -> DataFrame:
    """Verified links (a, b) inside chunks of rows (key, salt, rep, set); b is the class that stays.

    A chunk's classes come in the order of their similarity to its consensus, the shingles that half of them share.
    """

    def links(got: list[tuple[int, np.ndarray]]):
        values, count = np.unique(np.concatenate([s for _, s in got]), return_counts=True)
        middle = values[count * 2 >= len(got)]
        near = sorted(((-overlap(s, middle) / (len(s) + len(middle) - overlap(s, middle) or 1), rep, s) for rep, s in got), key=lambda x: x[:2])
        kept: list[tuple[int, np.ndarray]] = []
        for _, rep, s in near:
            for other, o in kept:
                if linked(s, o, p.attach_percent):
                    yield rep, other
                    break
            else:
                kept.append((rep, s))

    def make():
        state: dict = {"at": None, "rows": []}

        def flush():
            got, state["rows"] = state["rows"], []
            return list(links(got)) if len(got) > 1 else []

        def out(pairs):
            return {"a": [x[0] for x in pairs], "b": [x[1] for x in pairs]}

        def work(batch: pa.RecordBatch):
            found = []
            for key, salt, rep, raw in zip(*(batch.column(c).to_pylist() for c in ("key", "salt", "rep", "set"))):
                if state["at"] != (key, salt):
                    found += flush()
                    state["at"] = (key, salt)
                state["rows"].append((rep, np.frombuffer(raw, dtype=np.uint64)))
            yield out(found)

        def end():
            yield out(flush())

        work.end = end
        return work

    parts = n_partitions(rows.sparkSession)
    return map_rows(rows.repartition(parts, "key", "salt").sortWithinPartitions("key", "salt", "rep"), make, "a long, b long")


def _postings(docs: DataFrame, reps: DataFrame, ranks: bytes, p: Params) -> DataFrame:
    """(token, rep, n, left): the prefix of every class in rarity order, for tokens of more than one class; left: shingles from there on."""
    shared = docs.sparkSession.sparkContext.broadcast(ranks)
    width = np.uint64((1 << p.sketch_bits) - 1)
    wanted = IdBitmap(reps, "rep", p)

    def make():
        rank = np.frombuffer(shared.value, dtype=np.uint8)

        def work(batch: pa.RecordBatch):
            own = batch.take(pa.array(np.flatnonzero(wanted.picks(batch.column("doc_id")))))
            out: dict[str, list[np.ndarray]] = {k: [] for k in ("token", "rep", "n", "left")}
            for rep, s in zip(own.column("doc_id").to_pylist(), shingle_sets(own.column("text").to_pylist(), p.words)):
                n = len(s)
                if not n:
                    continue
                order = np.argsort(rank[(s & width).astype(np.int64)], kind="stable")
                k = n - (p.percent * n + 99) // 100 + 1
                out["token"].append(_signed(s[order[:k]]))
                out["left"].append((n - np.arange(k)).astype(np.int32))
                out["rep"].append(np.full(k, rep, dtype=np.int64))
                out["n"].append(np.full(k, n, dtype=np.int32))
            if out["token"]:
                yield {k: np.concatenate(v) for k, v in out.items()}

        return work

    def several():
        """Drop the rows whose token no neighbour shares; a batch's last row waits for the next batch."""
        names = ("token", "rep", "n", "left")
        state: dict = {"last": None, "before": None}

        def kept(cols, token, before, after):
            same = np.zeros(len(token), dtype=bool)
            same[1:] |= token[1:] == token[:-1]
            same[:-1] |= token[1:] == token[:-1]
            if before is not None and len(token):
                same[0] |= token[0] == before
            if after is not None and len(token):
                same[-1] |= token[-1] == after
            return {k: v[same] for k, v in cols.items()}

        def work(batch: pa.RecordBatch):
            cols = {k: batch.column(k).to_numpy(zero_copy_only=False) for k in names}
            if state["last"] is not None:
                cols = {k: np.concatenate([state["last"][k], v]) for k, v in cols.items()}
            if len(cols["token"]):
                state["last"] = {k: v[-1:].copy() for k, v in cols.items()}
                head = {k: v[:-1] for k, v in cols.items()}
                before, state["before"] = state["before"], head["token"][-1] if len(head["token"]) else state["before"]
                yield kept(head, head["token"], before, cols["token"][-1])

        def end():
            if state["last"] is not None:
                yield kept(state["last"], state["last"]["token"], state["before"], None)

        work.end = end
        return work

    schema = "token long, rep long, n int, left int"
    rows = map_rows(docs.select("doc_id", "text"), make, schema)
    return map_rows(rows.repartition(n_partitions(docs.sparkSession), "token").sortWithinPartitions("token"), several, schema)


def _meetings(lists: DataFrame, p: Params, one: bool, block: int = 256) -> DataFrame:
    """(ca, cb, a, b): postings of different components on one list that could overlap enough; if `one`, a task gives two components once.

    lists: (token, comp, rep, n_min, n_max, left), dealt out so that a group holds two blocks of a list at most and streamed in
    order of size. Sizes and positions left rule out whole runs of postings before pairs are looked at.
    """

    def make():
        state: dict = {"token": None, "blocks": [], "found": []}

        def pairs(x: dict[str, np.ndarray], y: dict[str, np.ndarray], same: bool) -> tuple[np.ndarray, np.ndarray]:
            """Index pairs of blocks x (earlier, smaller sets) and y that pass the size and position tests."""
            least = lambda a, b: (p.percent * (a + b) + 99 + p.percent) // (100 + p.percent)  # noqa: E731  overlap needed, rounded up
            if 100 * int(x["n_max"].max()) < p.percent * int(y["n_min"].min()) or min(int(x["left"].max()), int(y["left"].max())) < least(int(x["n_min"].min()), int(y["n_min"].min())):
                return np.zeros(0, dtype=int), np.zeros(0, dtype=int)
            ok = (x["comp"][:, None] != y["comp"][None, :]) & (100 * x["n_max"][:, None] >= p.percent * y["n_min"][None, :]) & (100 * y["n_max"][None, :] >= p.percent * x["n_min"][:, None])
            ok &= np.minimum(x["left"][:, None], y["left"][None, :]) >= least(x["n_min"][:, None], y["n_min"][None, :])
            ok &= (x["i"][:, None] == x["j"][:, None]) | (x["block"][:, None] != y["block"][None, :])  # two blocks: each one's own pairs are met elsewhere
            if same:
                ok = np.triu(ok, 1)
            return np.nonzero(ok)

        def work(batch: pa.RecordBatch):
            cols = {c: batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("token", "i", "j", "block", "comp", "rep", "n_min", "n_max", "left")}
            token = cols["token"]
            if not len(token):
                return
            edges = np.concatenate([[0], np.flatnonzero((np.diff(token) != 0) | (np.diff(cols["i"]) != 0) | (np.diff(cols["j"]) != 0)) + 1, [len(token)]])
            got: list[tuple] = []
            for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist()):
                group = (token[lo], cols["i"][lo], cols["j"][lo])
                if state["token"] != group:
                    state["token"], state["blocks"] = group, []
                elif hi - lo and state["blocks"] and 100 * state["blocks"][0]["n_max"].max() < p.percent * cols["n_min"][lo]:
                    state["blocks"] = [b for b in state["blocks"] if 100 * b["n_max"].max() >= p.percent * cols["n_min"][lo]]
                if hi - lo == 1 and not state["blocks"]:
                    if hi == len(token):
                        state["blocks"].append({k: v[lo:hi].copy() for k, v in cols.items()})
                    continue
                for at in range(lo, hi, block):
                    y = {k: v[at : min(at + block, hi)] for k, v in cols.items()}
                    for x in [*state["blocks"], y]:
                        i, j = pairs(x, y, x is y)
                        if len(i):
                            got.append((x["comp"][i], y["comp"][j], x["rep"][i], y["rep"][j]))
                    state["blocks"].append({k: v.copy() for k, v in y.items()} if hi == len(token) else y)
            if got:
                ca, cb, a, b = (np.concatenate(c) for c in zip(*got))
                swap = ca > cb
                state["found"].append(np.stack([np.where(swap, cb, ca), np.where(swap, ca, cb), np.where(swap, b, a), np.where(swap, a, b)]))
                if sum(f.shape[1] for f in state["found"]) > 500_000:
                    state["found"] = [fewer()]
                    if state["found"][0].shape[1] > 250_000:
                        yield from flush()

        def fewer() -> np.ndarray:
            u = np.unique(np.concatenate(state["found"], axis=1), axis=1)
            if one:
                u = u[:, np.concatenate([[True], (u[:2, 1:] != u[:2, :-1]).any(axis=0)])]
            return u

        def flush():
            if state["found"]:
                yield dict(zip(("ca", "cb", "a", "b"), fewer()))
                state["found"] = []

        work.end = flush
        return work

    spark = lists.sparkSession
    return map_rows(_dealt(lists, p).repartition(n_partitions(spark), "token", "i", "j").sortWithinPartitions("token", "i", "j", "n_min", "rep"), make, "ca long, cb long, a long, b long")


def _verify(pairs: DataFrame, docs: DataFrame, p: Params) -> DataFrame:
    """Pairs (a, b) that link. Sets go to their pairs in two exchanges: each set once, by its id, to the places that ask
    for it, then to the pairs; there each a meets its b's in chunks."""
    sets = _sets(docs, pairs.select(F.col("a").alias("rep")).unionByName(pairs.select(F.col("b").alias("rep"))), p)
    count = pairs.groupBy("a").agg(F.ceil(F.count("*") / 128).alias("chunks"))
    salted = pairs.join(count, "a").select("a", "b", F.pmod(F.xxhash64("b"), "chunks").alias("salt"))
    none = lambda kind: F.lit(None).cast(kind)
    places = salted.select(F.col("b").alias("rep"), "a", "salt", "b", none("binary").alias("set"))
    places = places.unionByName(salted.select("a", "salt").distinct().select(F.col("a").alias("rep"), "a", "salt", none("long").alias("b"), none("binary").alias("set")))
    asked = sets.select("rep", none("long").alias("a"), none("long").alias("salt"), none("long").alias("b"), "set").unionByName(places)
    parts = n_partitions(pairs.sparkSession)

    def give():
        state: dict = {"rep": None, "set": None}

        def work(batch: pa.RecordBatch):
            out: tuple[list, ...] = ([], [], [], [])
            size = 0
            for rep, raw, *place in zip(*(batch.column(c).to_pylist() for c in ("rep", "set", "a", "salt", "b"))):
                if raw is not None:
                    state["rep"], state["set"] = rep, raw
                elif state["rep"] == rep:
                    for o, x in zip(out, (*place, state["set"])):
                        o.append(x)
                    size += len(state["set"])
                    if size > BATCH_BYTES:  # a long set may be asked for by every row of a batch
                        yield dict(zip(("a", "salt", "b", "set"), out))
                        out, size = ([], [], [], []), 0
            yield dict(zip(("a", "salt", "b", "set"), out))

        return work

    given = map_rows(asked.repartition(parts, "rep").sortWithinPartitions("rep", F.col("set").isNull()), give, "a long, salt long, b long, set binary")

    def make():
        state: dict = {"a": None, "set": None}

        def work(batch: pa.RecordBatch):
            out: list[tuple[int, int]] = []
            for a, b, raw in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "set"))):
                s = np.frombuffer(raw, dtype=np.uint64)
                if b is None:
                    state["a"], state["set"] = a, s
                elif state["a"] == a and linked(state["set"], s, p.percent):
                    out.append((a, b))
            yield {"a": [x[0] for x in out], "b": [x[1] for x in out]}

        return work

    return map_rows(given.repartition(parts, "a", "salt").sortWithinPartitions("a", "salt", F.asc_nulls_first("b")), make, "a long, b long")


def _attached(docs: DataFrame, classes: DataFrame, scratch: Scratch, p: Params) -> DataFrame:
    """Verified links (a, b) that attach classes to highly similar ones, found in chunks of the min-hash bands.

    All bands are read in one exchange of the sets; after it only classes go on whose key did not fit a chunk and
    that are not attached yet, as long as their number falls.
    """
    banded = classes.select("rep", F.explode("bands").alias("key"))

    def shared(rows: DataFrame) -> DataFrame:
        count = rows.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
        return scratch.save(rows.join(count, "key").select("rep", "key", "size"))

    left = shared(banded)
    edges = scratch.save(_attach(_banded(docs, left, 0, p), p).distinct())
    before, turn = None, 0
    while True:
        left = shared(left.where(F.col("size") > p.chunk).select("rep", "key").join(edges.select(F.col("a").alias("rep")).distinct(), "rep", "left_anti"))
        size = left.count()
        if not size or before is not None and size > 0.9 * before:
            return edges
        before, turn = size, turn + 1
        edges = scratch.save(edges.unionByName(_attach(_banded(docs, left, turn, p), p)).distinct())


#: Hot tokens up to this number are broadcast (16 bytes each); there are at most postings / list_rows of them.
_HOT_TOKENS = 200_000


def _dealt(lists: DataFrame, p: Params) -> DataFrame:
    """lists with (i, j, block): a token of many postings has them in blocks, and every two blocks meet in a group of their own."""
    count = lists.groupBy("token").agg(F.count("*").alias("m")).where(F.col("m") > p.list_rows)
    hot = count.limit(_HOT_TOKENS + 1).count()
    if not hot:
        return lists.withColumns({"i": F.lit(0), "j": F.lit(0), "block": F.lit(0)})
    dealt = lists.join(F.broadcast(count) if hot <= _HOT_TOKENS else count, "token", "left").withColumn("blocks", F.coalesce(F.ceil(F.col("m") / p.list_rows).cast("int"), F.lit(1)))
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return dealt.withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")}).drop("m", "blocks", "other")


def distinct_ids(docs: DataFrame, scratch: Scratch, p: Params = Params()) -> DataFrame:
    """docs with one row an id: of rows that repeat one, that with the smallest text (a null text last). Rows without an id stay.

    Only rows whose id may be a repeated one are exchanged; they are told by a bitmap.
    """
    short_batches(docs.sparkSession)
    repeated = scratch.save(docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id"))
    if not repeated.limit(1).count():
        return docs
    wanted = IdBitmap(repeated, "doc_id", p)
    names, schema = carried(docs, ("_maybe",))

    def make():
        def work(batch: pa.RecordBatch):
            yield {c: batch.column(c) for c in names} | {"_maybe": wanted.picks(batch.column("doc_id"))}

        return work

    flagged = map_rows(docs.select(*names), make, f"{schema}, _maybe boolean")
    plain = [f.name for f in docs.schema if f.name in names and f.dataType.typeName() not in ("map", "variant")]
    order = F.struct(F.col("text").isNull(), "text", F.xxhash64(*plain))
    one = flagged.where("_maybe").groupBy("doc_id").agg(F.min_by(F.struct(*names), order).alias("row")).select("row.*")
    return flagged.where("not _maybe").select(*names).unionByName(scratch.save(one))


def join(docs: DataFrame, params: Params = Params()) -> DataFrame:
    """(doc_id, n_shingles, component_id, class_id) of docs(doc_id, text)."""
    scratch = Scratch(docs.sparkSession, "jaccard")
    return _join(distinct_ids(docs.select("doc_id", "text"), scratch, params), scratch, params)


def _join(docs: DataFrame, scratch: Scratch, p: Params) -> DataFrame:
    """join() of docs(doc_id, text) in which no id is repeated."""
    every = scratch.save(_sign(docs, p))
    signed = every.where("kind = 0 and doc_id is not null").select("doc_id", "n", "d1", "d2", "bands")
    ranks = _ranks(every, p)
    classes = scratch.save(signed.where("n > 0").groupBy("d1", "d2", "n").agg(F.min("doc_id").alias("rep"), F.first("bands").alias("bands")))

    edges = _attached(docs, classes, scratch, p)
    comp = scratch.save(components(edges, scratch).select(F.col("node").alias("rep"), F.col("component").alias("comp")))

    # lists of components: one posting a component and token, with the widest bounds of its sets
    listed = scratch.save(_postings(docs, classes, ranks, p))
    posts = listed.join(comp, "rep", "left").withColumn("comp", F.coalesce("comp", "rep"))
    grouped = scratch.save(posts.groupBy("token", "comp").agg(F.min("rep").alias("rep"), F.min("n").alias("n_min"), F.max("n").alias("n_max"), F.max("left").alias("left")))
    met = _meetings(grouped, p, one=True).groupBy("ca", "cb").agg(F.min(F.struct("a", "b")).alias("p"))
    met = scratch.save(met.select("ca", "cb", "p.a", "p.b"))
    scratch.drop(grouped)
    first = scratch.save(_verify(met.select("a", "b"), docs, p))
    edges2 = edges.unionByName(first)

    # components of more than one set whose chosen pair doesn't link: all their pairs on shared lists
    sizes = comp.groupBy("comp").agg(F.count("*").alias("members"))
    open_pairs = met.join(first, ["a", "b"], "left_anti").select("ca", "cb")
    merged = scratch.save(components(edges2, scratch).select(F.col("node"), F.col("component")))
    for c in ("ca", "cb"):
        open_pairs = open_pairs.join(merged.select(F.col("node").alias(c), F.col("component").alias(f"{c}_now")), c, "left")
        open_pairs = open_pairs.join(sizes.select(F.col("comp").alias(c), F.col("members").alias(f"{c}_n")), c, "left")
    now = {c: F.coalesce(f"{c}_now", c) for c in ("ca", "cb")}
    open_pairs = open_pairs.where((now["ca"] != now["cb"]) & F.expr("coalesce(ca_n, 1) > 1 or coalesce(cb_n, 1) > 1"))
    open_pairs = scratch.save(open_pairs.select(F.least(now["ca"], now["cb"]).alias("ca"), F.greatest(now["ca"], now["cb"]).alias("cb")).distinct())
    if open_pairs.limit(1).count():
        # by the components as they are now: what has been linked meanwhile is not met again
        flagged = open_pairs.select(F.col("ca").alias("comp")).unionByName(open_pairs.select(F.col("cb").alias("comp"))).distinct()
        rows = posts.drop("comp").join(merged.select(F.col("node").alias("rep"), F.col("component").alias("comp")), "rep", "left").withColumn("comp", F.coalesce("comp", "rep"))
        rows = scratch.save(rows.join(flagged, "comp", "left_semi").select("token", "comp", "rep", F.col("n").alias("n_min"), F.col("n").alias("n_max"), "left"))
        # a list matters here if two of the flagged components are on it
        shared = rows.groupBy("token").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1")).where("c0 < c1").select("token")
        more = _meetings(rows.join(shared, "token", "left_semi"), p, one=False).join(open_pairs, ["ca", "cb"], "left_semi").select("a", "b").distinct()
        edges2 = edges2.unionByName(_verify(scratch.save(more), docs, p))
        merged = scratch.save(components(edges2, scratch).select(F.col("node"), F.col("component")))
    scratch.drop(listed)

    # classes keep their smallest document; a document follows its class
    final = classes.join(merged.withColumnRenamed("node", "rep"), "rep", "left").select("d1", "d2", "n", F.col("rep").alias("class_id"), F.coalesce("component", "rep").alias("component_id"))
    out = every.where("kind = 0").select("doc_id", "n", "d1", "d2").join(final, ["d1", "d2", "n"], "left")
    known = lambda c: F.when(F.col("doc_id").isNotNull(), F.coalesce(c, "doc_id")).alias(c)
    return out.select("doc_id", F.col("n").alias("n_shingles"), known("component_id"), known("class_id"))


def deduplicate(docs: DataFrame, params: Params = Params()) -> DataFrame:
    """One document of each component stays: the one with the smallest id. Columns of docs are kept.

    Rows without an id stay, as nothing names their group; of rows that repeat an id, the one that `join` compares stays.
    """
    scratch = Scratch(docs.sparkSession, "duplicates")
    docs = distinct_ids(docs, scratch, params)
    found = _join(docs.select("doc_id", "text"), scratch, params).select("doc_id", "component_id")
    removed = scratch.save(found.where("doc_id <> component_id").select("doc_id"))
    # only rows whose id may be among the removed ones meet them in a join; the other texts are not exchanged
    wanted = IdBitmap(removed, "doc_id", params)
    names, schema = carried(docs, ("_maybe",))

    def make():
        def work(batch: pa.RecordBatch):
            yield {c: batch.column(c) for c in names} | {"_maybe": wanted.picks(batch.column("doc_id"))}

        return work

    flagged = map_rows(docs.select(*names), make, f"{schema}, _maybe boolean")
    return flagged.where("not _maybe").unionByName(flagged.where("_maybe").join(removed, "doc_id", "left_anti").select(*flagged.columns)).select(*names)
