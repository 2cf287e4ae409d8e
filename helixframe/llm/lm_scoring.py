"""Language-model scores by online logistic mixing of hashed-context bit predictors.

A text is lower-cased (A-Z), cut into words, and written as its words' bytes with a blank between and an
end mark. Each byte is coded bit by bit along a Huffman tree chosen by the byte before, so a byte takes about
three binary decisions. Several predictors look each decision up by a hash of its node and a context (the last
3 and 5 bytes; the word so far, or the word before), and one by the node alone. Their log-odds are mixed by weights that a
gate picks from the predictors' confidence and that are refined online within the text, by a gradient step every 64 decisions,
carried from a text's first decision to its last. The score is the log10 probability of the text; `bits_per_byte` follows from it.

Counts come from every training text: word counts (for the unigram base), byte pairs (for the trees) and
context counts, each summed over tasks before they meet. Contexts are counted by 32-bit hash; a predictor's table has
two slots or more for each context met, so it grows with the input, and is read from a mapped file. A part of the training texts, one
in `mixer_fold`, is counted apart: all its texts, whole, fit the gates' weights over tables without them, by Newton steps whose sums
are taken over the tasks. The tables that score hold the counts of both parts.

The loops over all texts (words, context counts, sums of a fit, scores) are LmKernels.java, run inside the executors. events, coded_bytes,
decisions_of, Mixer.sums and Mixer.log2_probability say the same in NumPy, for a few texts on the driver; tests compare the two.

Defined results: a null or empty text is the end mark alone (one token); repeated rows score alike; rows with a null id
are scored and never learned from; with nothing to learn from, all predictions are even. Other columns are ignored.
"""

from __future__ import annotations

import heapq
import os
import tempfile
import uuid
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_rows, n_partitions, short_batches
from .kernels import map_java

BLOCK = 64  # decisions between gradient steps
_ODD = 0x9E3779B97F4A7C15
_INV = pow(_ODD, -1, 1 << 64)


@dataclass(frozen=True)
class Params:
    slot_bits: int = 20  # slots of each predictor's table, at least; it has two for each context met, or more
    mixer_fold: int = 40  # one of so many training texts fits the mixing weights, over the counts of the others
    newton_steps: int = 5  # at most, of either fit; a step under newton_least ends it
    newton_least: float = 0.02
    rate: float = 0.06
    top_words: int = 150_000  # words looked up from a broadcast table; rarer ones are joined
    chunk_bytes: int = 40_000  # of text counted at once: its arrays stay in a core's cache
    score_bytes: int = 400_000  # of text scored at once: texts of like length take their gradient steps together


CONTEXTS = 3
INPUTS = CONTEXTS + 1
_GATES = 4**CONTEXTS


def tokens(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()


def stream(words: list[bytes]) -> bytes:
    """The bytes that are coded: words, blanks between them, and one end mark."""
    return b" ".join(words) + b"\n"


# --- trees ---------------------------------------------------------------------------------------


class Trees:
    """A Huffman tree for each byte before: paths of (node, bit) laid end to end, and each node's log-odds."""

    def __init__(self, pairs: np.ndarray):
        self.offset = np.zeros(65536, dtype=np.int32)
        self.length = np.zeros(65536, dtype=np.uint8)
        node_of: list[int] = []
        bit_of: list[int] = []
        prior = np.zeros(65536, dtype=np.float32)
        prior_of: list[np.ndarray] = []
        flat = pairs.sum(axis=0).astype(float)
        flat = (flat + 0.01) / (flat.sum() + 2.56)
        plain: dict[bytes, tuple] = {}
        for before in range(256):
            count = pairs[before].astype(float) + 0.5 * flat
            key = b"" if not pairs[before].any() else None
            if key is not None and key in plain:  # bytes never seen before another share a tree
                base = plain[key]
                self.offset[before * 256 : before * 256 + 256], self.length[before * 256 : before * 256 + 256] = base[0], base[1]
                continue
            heap = [(c, s) for s, c in enumerate(count.tolist())]
            heapq.heapify(heap)
            kids: list[tuple[int, int]] = []
            weight = dict(enumerate(count.tolist()))
            while len(heap) > 1:
                a, x = heapq.heappop(heap)
                b, y = heapq.heappop(heap)
                kids.append((x, y))
                weight[255 + len(kids)] = a + b
                heapq.heappush(heap, (a + b, 255 + len(kids)))
            paths: dict[int, list[tuple[int, int]]] = {255 + len(kids): []}
            for n in range(len(kids), 0, -1):
                zero, one = kids[n - 1]
                own = paths.pop(255 + n)
                paths[zero], paths[one] = [*own, (n - 1, 0)], [*own, (n - 1, 1)]
                prior[before * 256 + n - 1] = np.log(weight[one] / weight[zero])
            first = len(node_of)
            for s in range(256):
                self.offset[before * 256 + s] = len(node_of)
                self.length[before * 256 + s] = len(paths[s])
                node_of += [n for n, _ in paths[s]]
                bit_of += [b for _, b in paths[s]]
            prior_of.append(prior[before * 256 + np.array(node_of[first:], dtype=np.int64)])
            if key is not None:
                at = slice(before * 256, before * 256 + 256)
                plain[key] = (self.offset[at].copy(), self.length[at].copy())
        # by path entry: the bit, also as +1 or -1, the node's log-odds, and a hash of the node
        self.bit = np.array(bit_of, dtype=np.uint8)
        self.sign = self.bit.astype(np.float32) * 2 - 1
        self.prior = np.concatenate(prior_of).astype(np.float32)
        self.salt = (np.array(node_of, dtype=np.uint64) * np.uint64(0x2545F491) & np.uint64(0xFFFFFFFF)).astype(np.uint32)

    def arrays(self) -> dict[str, np.ndarray]:
        """What the kernels read."""
        return {"offset": self.offset, "length": self.length, "bit": self.bit, "prior": self.prior, "salt": self.salt}


# --- events --------------------------------------------------------------------------------------


_powers = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]  # of _ODD and its inverse


def _contexts(data: np.ndarray, begin: np.ndarray) -> list[np.ndarray]:
    """A 32-bit hash of each predictor's context before every byte. begin: where texts begin."""
    n = len(data)
    back = [np.zeros(n, dtype=np.uint32) for _ in range(5)]
    for k in range(1, 6):
        back[k - 1][k:] = data[:-k] if k < n else 0
        for j in range(k):
            at = begin + j
            back[k - 1][at[at < n]] = 0
    with np.errstate(over="ignore"):
        b3 = back[0] | back[1] << np.uint32(8)
        b3 |= back[2] << np.uint32(16)
        o3 = b3 * np.uint32(0x85EBCA6B)
        o5 = (b3 | back[3] << np.uint32(24)) * np.uint32(0xC2B2AE35)
        o5 += back[4] * np.uint32(0x27D4EB2F)
        o5 ^= o5 >> np.uint32(15)
        o5 *= np.uint32(0x9E3779B1)
        # the hash of a word's bytes so far, from sums of byte * odd**position
        if len(_powers[0]) <= n:
            for i, odd in enumerate((_ODD, _INV)):
                factors = np.full(2 * n + 1, odd, dtype=np.uint64)
                factors[0] = 1
                _powers[i] = np.cumprod(factors, dtype=np.uint64)
        power, inverse = _powers
        total = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum((data + np.uint64(1)) * power[:n], out=total[1:])
        first = np.concatenate([[0], np.flatnonzero((data[:-1] == 32) | (data[:-1] == 10)) + 1])
        size = np.diff(first, append=n)
        word = total[:n] - np.repeat(total[first], size)
        word *= np.repeat(inverse[first], size)
        # at a word's first byte: the word before, in the same text
        prior = np.concatenate([[0], first[:-1]])
        word[first] = (total[first] - total[prior]) * inverse[prior] + np.uint64(99)
        word[begin] = 0
        word ^= word >> np.uint64(29)
        word *= np.uint64(0xBF58476D1CE4E5B9)
        w = (word >> np.uint64(32)).astype(np.uint32) ^ back[0]
    return [o3, o5, w]


def events(texts: list[bytes], trees: Trees, bits: list[int], segment: int = 1) -> tuple[np.ndarray, np.ndarray, list[np.ndarray], np.ndarray | None]:
    """All decisions of some streams: decisions a text, path entries, slots by predictor, and which are real.

    With a segment over 1 each text's decisions are padded to whole segments (by repeats of some decision, not real).
    """
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    size = np.array([len(t) for t in texts])
    begin = np.concatenate([[0], np.cumsum(size)[:-1]])
    hashes = _contexts(data, begin)
    before = np.concatenate([[0], data[:-1]]).astype(np.int32)
    before[begin] = 0
    code = before * 256 + data
    length = trees.length[code].astype(np.int64)
    count = np.add.reduceat(length, begin)
    # a text's last byte takes up the padding: its decisions beyond the code's length are not real
    padded = length
    if segment > 1:
        padded = length.copy()
        padded[begin + size - 1] += -count % segment
    last = np.cumsum(padded)
    # the byte of each decision: every byte has one at least
    pos = np.zeros(last[-1], dtype=np.intp)
    pos[last[:-1]] = 1
    np.cumsum(pos, out=pos)
    at = np.take(trees.offset[code] - (last - padded), pos, mode="clip")
    at += np.arange(last[-1])
    real = None
    if segment > 1:
        real = np.ones(len(at), dtype=np.float32)
        ends = last[begin + size - 1]
        for end, pad in zip(ends.tolist(), (-count % segment).tolist()):
            real[end - pad : end] = 0
            at[end - pad : end] = 0
    slots = []
    with np.errstate(over="ignore"):
        salt = np.take(trees.salt, at, mode="clip")
        for h, b in zip(hashes, bits):
            x = np.take(h, pos, mode="clip")
            x += salt
            x >>= np.uint32(32 - b)
            slots.append(x)
    return count, at, slots, real


def coded_bytes(texts: list[bytes]) -> list[np.ndarray]:
    """For each predictor a key of every byte of some streams: its context's hash, then the byte before and the byte itself."""
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    begin = np.concatenate([[0], np.cumsum([len(t) for t in texts])[:-1]]).astype(np.int64)
    hashes = _contexts(data, begin)
    code = np.empty(len(data), dtype=np.uint64)
    code[0] = 0
    code[1:] = data[:-1]
    code[begin] = 0
    code <<= np.uint64(8)
    code |= data
    return [h.astype(np.uint64) << np.uint64(16) | code for h in hashes]


def decisions_of(keys: np.ndarray, counts: np.ndarray, trees: Trees) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The decisions of distinct keys of coded_bytes: each one's 32-bit key, its count and its bit."""
    code = (keys & np.uint64(0xFFFF)).astype(np.int64)
    length = trees.length[code].astype(np.int64)
    last = np.cumsum(length)
    at = np.arange(last[-1] if len(last) else 0)
    at += np.repeat(trees.offset[code] - (last - length), length)
    with np.errstate(over="ignore"):
        slots = np.repeat((keys >> np.uint64(16)).astype(np.uint32), length) + trees.salt[at]
    return slots, np.repeat(counts, length), trees.bit[at].view(bool)


def chunks(texts: list[bytes], limit: int) -> list[list[bytes]]:
    """Lists of whole streams of about `limit` bytes; a longer stream is a list of its own."""
    out: list[list[bytes]] = []
    size = limit
    for t in texts:
        if size + len(t) > limit:
            out.append([])
            size = 0
        out[-1].append(t)
        size += len(t)
    return out


# --- counting ------------------------------------------------------------------------------------


def _pack(own: np.ndarray) -> bytes | None:
    at = np.flatnonzero(own).astype(np.uint32)
    if not len(at):
        return None
    return zlib.compress(np.diff(at, prepend=np.uint32(0)).tobytes() + np.minimum(own[at], 2**32 - 1).astype(np.uint32).tobytes(), 1)


def _unpack(total: np.ndarray, packed: bytes) -> None:
    raw = np.frombuffer(zlib.decompress(packed), dtype=np.uint32)
    n = len(raw) // 2
    total[np.cumsum(raw[:n], dtype=np.int64)] += raw[n:]


def _summed(shares: DataFrame, size: int, finish, schema: str) -> DataFrame:
    """Sum packed count blocks in two levels, so that no task meets the shares of all tasks; finish(total) packs."""

    def level(last: bool):
        def make():
            own: dict[int, np.ndarray] = {}

            def work(batch: pa.RecordBatch):
                for b, c in zip(batch.column("block").to_pylist(), batch.column("counts").to_pylist()):
                    _unpack(own.setdefault(b, np.zeros(size, dtype=np.int64)), c)
                return ()

            def end():
                for b, t in own.items():
                    yield {"block": [b], "counts": [finish(t) if last else _pack(t)]}

            work.end = end
            return work

        return make

    fan = max(1, n_partitions(shares.sparkSession) // 2)
    mixed = shares.repartition(fan * 4, "block", F.pmod(F.xxhash64("counts"), F.lit(fan)))
    once = map_rows(mixed, level(False), schema)
    return map_rows(once.repartition(64, "block"), level(True), schema)


@dataclass(frozen=True)
class Words:
    """Unigram counts: all training tokens N, distinct V, counts of the most frequent words; rarer words' counts as rows."""

    total: int
    distinct: int
    top: dict[bytes, int]
    rare: DataFrame


def _first_pass(train: DataFrame) -> DataFrame:
    """Word counts (word, n) and byte-pair counts of the training texts, each task's share summed inside it."""
    return map_java(train.select(F.col("text").cast("binary")), "words", {}, "word binary, n long, block int, counts binary")


def _count_words(rows: DataFrame, scratch, p: Params) -> Words:
    words = scratch.save(rows.where("word is not null").groupBy("word").agg(F.sum("n").alias("n")))
    scale = words.groupBy(F.floor(F.log2("n") * 8).cast("int").alias("level")).agg(F.count("*").alias("words"), F.sum("n").alias("n")).collect()
    room, level = p.top_words, 1 << 30
    for r in sorted(scale, key=lambda r: -r.level):
        if (room := room - r.words) < 0:
            break
        level = r.level
    frequent = F.floor(F.log2("n") * 8) >= level
    top = {bytes(r.word): r.n for r in words.where(frequent).collect()}  # at most top_words rows
    return Words(sum(r.n for r in scale), sum(r.words for r in scale), top, words.where(~frequent))


class Tally:
    """Counts by key, as sorted runs; a run is merged into the one before while it is at least half as long."""

    def __init__(self, dtype=np.uint32):
        self.dtype = dtype
        self.runs: list[tuple[np.ndarray, np.ndarray]] = []

    def __len__(self) -> int:
        return sum(len(k) for k, _ in self.runs)

    def add(self, keys: np.ndarray, counts: np.ndarray | None = None) -> None:
        if counts is None:
            keys = np.sort(keys)
            first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, dtype=np.int64)
            keys, counts = keys[first], np.diff(first, append=len(keys))
        if not len(keys):
            return
        self.runs.append((keys, counts.astype(np.uint32)))
        while len(self.runs) > 1 and 2 * len(self.runs[-1][0]) >= len(self.runs[-2][0]):
            self._merge()

    def _merge(self) -> None:
        (a, m), (b, n) = self.runs[-2:]
        if self.dtype == np.uint32:
            both = np.concatenate([_both(a, m), _both(b, n)])
            both.sort(kind="stable")  # two sorted runs: one merge
            self.runs[-2:] = [_sums_of(both)]
            return
        keys = np.concatenate([a, b])
        order = np.argsort(keys, kind="stable")  # two sorted runs: one merge
        keys = keys[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        self.runs[-2:] = [(keys[first], _totals(np.concatenate([m, n])[order], first))]

    def take(self) -> tuple[np.ndarray, np.ndarray]:
        while len(self.runs) > 1:
            self._merge()
        return self.runs.pop() if self.runs else (np.zeros(0, dtype=self.dtype), np.zeros(0, dtype=np.uint32))


def _totals(counts: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The sum of each stretch of counts that begins at `first`, in 32 bits."""
    ends = np.append(first[1:], len(counts)) - 1
    total = np.diff(np.cumsum(counts, dtype=np.uint64)[ends], prepend=np.uint64(0))
    return np.minimum(total, 2**32 - 1).astype(np.uint32)


def _both(keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """32-bit keys and their 32-bit counts as one number each, which sort as the keys do."""
    both = keys.astype(np.uint64)
    both <<= np.uint64(32)
    both |= counts
    return both


def _sums_of(both: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of sorted numbers of _both, and the sum of each one's counts."""
    keys = (both >> np.uint64(32)).astype(np.uint32)
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    both &= np.uint64(0xFFFFFFFF)
    return keys[first], _totals(both, first)


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sum of each one's counts."""
    if not len(keys):
        return keys, counts
    both = _both(keys, counts)
    both.sort()
    return _sums_of(both)


def _planes(*columns: np.ndarray) -> bytes:
    """Columns of 32-bit numbers, byte by byte: most of the higher bytes are zeros."""
    out = np.empty((len(columns), 4, len(columns[0])), dtype=np.uint8)
    for own, c in zip(out, columns):
        for i in range(4):
            own[i] = c >> c.dtype.type(8 * i)
    return zlib.compress(out, 1)


def _columns(packed: bytes, n: int) -> list[np.ndarray]:
    raw = np.frombuffer(zlib.decompress(packed), dtype=np.uint8).reshape(n, 4, -1)
    return [np.ascontiguousarray(c.T).view("<u4").ravel() for c in raw]


#: Keys (their steps) and counts of a block: a predictor's keys with the same upper bits. kind: the bit, and 2 more where texts of the mixer's part met it.
_SHARE = "block int, kind int, n long, packed binary"
_KINDS = 4
_MET = "block int, n long, packed array<binary>"  # all kinds of a block in one row, which no reader splits


def _share(train: DataFrame, trees: Trees, block_bits: int) -> DataFrame:
    """Every task's context counts by 32-bit key, nothing shared or left out. train: (text, aside).

    A task counts whole bytes in their contexts (as coded_bytes) and takes only the distinct ones apart (as decisions_of).
    """
    rows = train.select(F.col("text").cast("binary"), F.col("aside").cast("int"))
    return map_java(rows, "share", trees.arrays() | {"numbers": np.array([block_bits], dtype=np.int32)}, _SHARE)


def _meet(shares: DataFrame, block_bits: int) -> DataFrame:
    """The shares of each block summed: its contexts' keys, kinds apart. A task holds one block at a time."""

    def make():
        now: dict = {"block": None}
        tally = [Tally() for _ in range(_KINDS)]

        def finish():
            taken = [t.take() for t in tally]
            if any(len(keys) for keys, _ in taken):
                packed = [_planes(np.diff(keys, prepend=np.uint32(0)), counts) if len(keys) else None for keys, counts in taken]
                yield {"block": [now["block"]], "n": [sum(len(keys) for keys, _ in taken)], "packed": [packed]}

        def work(batch: pa.RecordBatch):
            for block, kind, packed in zip(*(batch.column(c).to_pylist() for c in ("block", "kind", "packed"))):
                if block != now["block"]:
                    yield from finish()
                    now["block"] = block
                steps, counts = _columns(packed, 2)
                tally[kind].add(np.cumsum(steps, dtype=np.uint32), counts)

        work.end = finish
        return work

    parts = max(n_partitions(shares.sparkSession), (CONTEXTS << block_bits) // 8)
    return map_rows(shares.repartition(parts, "block").sortWithinPartitions("block"), make, _MET)


@dataclass
class Table:
    """A predictor's slots as int16 in a file: log-odds * 100, shifted up by two bits that hold the confidence.

    The file lies in the shared checkpoint folder, or, where that is no mounted folder, is handed out by Spark. It is mapped, not
    loaded, so it may outgrow memory, and the workers of a node share its pages.
    """

    name: str
    shared: bool
    bits: int

    def open(self) -> np.ndarray:
        from pyspark import SparkFiles

        return np.asarray(np.memmap(self.name if self.shared else SparkFiles.get(self.name), dtype=np.int16, mode="r"))

    def drop(self) -> None:
        if self.shared:
            os.remove(self.name)


def _tables(met: DataFrame, block_bits: int, kinds: int, p: Params) -> list[Table]:
    """Files of all predictors' slots, two or more for each of its contexts (at most 2^32); filled a block at a time, with the first `kinds`.

    A block is a stretch of its file: tasks write theirs into a shared file (a task that runs again writes the same). Without a
    shared folder the blocks come to the driver one by one.
    """
    from .common import checkpoint_root

    spark = met.sparkSession
    most = {r.k: r.n for r in met.groupBy(F.shiftright("block", block_bits).alias("k")).agg(F.sum("n").alias("n")).collect()}  # of all kinds: at least the contexts
    bits = [min(32, max(p.slot_bits, block_bits, int(2 * most.get(k, 1) - 1).bit_length())) for k in range(CONTEXTS)]

    root = checkpoint_root(spark)
    shared = root.startswith(("/", "file:"))
    folder = "/" + root.removeprefix("file:").lstrip("/") if shared else tempfile.gettempdir()
    os.makedirs(folder, exist_ok=True)
    names = [os.path.join(folder, f"helixframe-lm-{uuid.uuid4().hex}.slots") for _ in range(CONTEXTS)]
    for name, b in zip(names, bits):
        with open(name, "wb") as f:
            f.truncate(2 << b)

    def make():
        def fill(block: int, packed: list[bytes | None]):
            k, b = block >> block_bits, block & (1 << block_bits) - 1
            shift, found = np.uint32(32 - bits[k]), []
            for kind, own in enumerate(packed[:kinds]):
                if own is not None:
                    steps, counts = _columns(own, 2)
                    found.append((np.cumsum(steps, dtype=np.uint32) >> shift, counts, kind & 1))
            if not found:
                return
            slots = np.unique(np.concatenate([at for at, _, _ in found]))
            total = np.zeros((2, len(slots)))
            for at, counts, bit in found:
                total[bit] += np.bincount(np.searchsorted(slots, at), weights=counts, minlength=len(slots))
            odds = np.clip(np.round(100 * np.log((total[1] + 0.2) / (total[0] + 0.2))), -1200, 1200).astype(np.int16)
            n = total.sum(axis=0)
            value = odds * np.int16(4) + (n > 0).astype(np.int16) + (n > 3) + (n > 30)
            if shared:
                size = 1 << bits[k] - block_bits
                stretch = np.memmap(names[k], dtype=np.int16, mode="r+", offset=2 * b * size, shape=(size,))
                stretch[slots.astype(np.int64) - b * size] = value
                stretch.flush()
            else:
                yield {"block": [block], "packed": [_planes(np.diff(slots, prepend=np.uint32(0)), value.view(np.uint16))]}

        def work(batch: pa.RecordBatch):
            for block, packed in zip(batch.column("block").to_pylist(), batch.column("packed").to_pylist()):
                yield from fill(block, packed)

        return work

    filled = map_rows(met, make, "block int, packed binary")
    if shared:
        filled.count()  # the tasks write
    else:
        files = [np.memmap(name, dtype=np.int16, mode="r+") for name in names]
        for r in filled.toLocalIterator():
            steps, value = _columns(r.packed, 2)
            files[r.block >> block_bits][np.cumsum(steps, dtype=np.uint32)] = value.astype(np.uint16).view(np.int16)
        for f in files:
            f.flush()
        for name in names:
            spark.sparkContext.addFile(name)
    return [Table(name if shared else os.path.basename(name), shared, b) for name, b in zip(names, bits)]


# --- mixing --------------------------------------------------------------------------------------


@dataclass
class Mixer:
    trees: Trees
    tables: list[Table]
    weights: np.ndarray  # gates x INPUTS
    params: Params

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "opened"}

    def arrays(self) -> dict[str, np.ndarray | bytes]:
        """What the kernels read."""
        numbers = {"bits": np.array([t.bits for t in self.tables], dtype=np.int32), "shared": np.array([t.shared for t in self.tables], dtype=np.int32)}
        return self.trees.arrays() | numbers | {"weights": self.weights.astype(np.float32)} | {f"table{k}": t.name.encode() for k, t in enumerate(self.tables)}

    def inputs(self, texts: list[bytes], segment: int = 1) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray | None]:
        """Decisions a text, signs (+1 for bit 1), log-odds INPUTS x decisions, gates, which decisions are real."""
        count, entry, slots, real = events(texts, self.trees, [t.bits for t in self.tables], segment)
        opened = self.__dict__.get("opened")
        if opened is None:
            opened = self.opened = [t.open() for t in self.tables]
        s = np.empty((INPUTS, len(entry)), dtype=np.float32)
        np.take(self.trees.prior, entry, out=s[0], mode="clip")
        gate = np.zeros(len(entry), dtype=np.int16)
        for k in range(CONTEXTS):
            v = np.take(opened[k], slots[k], mode="clip")
            s[k + 1] = v
            s[k + 1] *= np.float32(0.0025)  # the two bits of confidence change this by under 0.01
            gate <<= 2
            v &= 3
            gate |= v
        return count, np.take(self.trees.sign, entry, mode="clip"), s, gate, real

    def sums(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """By gate, over the texts' decisions with the weights as they are: how many, the gradient of their log probability, its curvature."""
        number, gradient, curvature = np.zeros(_GATES), np.zeros((_GATES, INPUTS)), np.zeros((_GATES, INPUTS, INPUTS))
        for part in chunks(texts, self.params.chunk_bytes):
            _, sign, s, gate, _ = self.inputs(part)
            order = np.argsort(gate, kind="stable")
            gates, first, size = np.unique(np.take(gate, order), return_index=True, return_counts=True)
            x = np.empty((INPUTS, len(order)))
            for i in range(INPUTS):
                s[i] *= sign  # signed: the gradient and the curvature are those of the unsigned inputs
                x[i] = np.take(s[i], order)
            number[gates] += size
            for g, i, j in zip(gates.tolist(), first.tolist(), (first + size).tolist()):
                own = x[:, i:j]
                e = 1 / (1 + np.exp(np.clip(self.weights[g].astype(float) @ own, -30, 30)))
                gradient[g] += own @ e
                curvature[g] += (own * (e * (1 - e) + 1e-4)) @ own.T
        return number, gradient, curvature

    def log2_probability(self, texts: list[bytes]) -> np.ndarray:
        """Of each stream: the sum over its decisions, weights refined online from its first decision to its last."""
        size = np.array([len(t) for t in texts])
        out = np.zeros(len(texts))
        order = np.argsort(-size, kind="stable")
        at = 0
        for part in chunks([texts[i] for i in order], self.params.score_bytes):
            out[order[at : at + len(part)]] = self._refined(part)
            at += len(part)
        return out

    def _refined(self, texts: list[bytes]) -> np.ndarray:
        counts, inputs, odds = [], [], []
        weights = np.ascontiguousarray(self.weights.T)
        for part in chunks(texts, self.params.chunk_bytes):  # these arrays stay in a core's cache
            count, sign, s, gate, real = self.inputs(part, BLOCK)
            at = gate.astype(np.intp)
            sign *= -real  # inputs towards the other bit; padding has even odds and no gradient
            mixed = np.zeros(len(sign), dtype=np.float32)
            for k in range(INPUTS):
                s[k] *= sign
                w = np.take(weights[k], at, mode="clip")
                w *= s[k]
                mixed += w
            counts.append(count)
            inputs.append(s.reshape(INPUTS, -1, BLOCK))
            odds.append(mixed.reshape(-1, BLOCK))
        count, z0 = np.concatenate(counts), np.concatenate(odds)
        x = np.empty((INPUTS, *z0.shape), dtype=np.float32)
        at = len(z0)
        while inputs:
            s = inputs.pop()
            x[:, at - s.shape[1] : at] = s
            at -= s.shape[1]
        blocks = -(-count // BLOCK)
        begin = np.concatenate([[0], np.cumsum(blocks)[:-1]])
        order = np.argsort(-blocks, kind="stable")  # the texts that have a step left come first
        first, left = begin[order], blocks[order]
        delta = np.zeros((INPUTS, len(texts)), dtype=np.float32)
        rate, clip = np.float32(self.params.rate / 8), np.float32(15)
        m = len(texts)
        for t in range(int(left[0])):
            while left[m - 1] <= t:
                m -= 1
            rows = first[:m] + t
            own = np.take(x, rows, axis=1, mode="clip")
            z = np.take(z0, rows, axis=0, mode="clip")
            if t:
                z += np.einsum("ki,kij->ij", delta[:, :m], own)
            np.minimum(z, clip, out=z)
            np.maximum(z, -clip, out=z)
            np.exp(z, out=z)
            whole = 1 + z
            z0[rows] = whole
            z /= whole
            delta[:, :m] -= rate * np.einsum("ij,kij->ki", z, own)
        # a logarithm for every four decisions: their product is at most e^60
        four = z0.reshape(len(z0), 4, -1)
        whole = four[:, 0] * four[:, 1]
        whole *= four[:, 2]
        whole *= four[:, 3]
        total = -np.add.reduceat(np.log(whole).sum(axis=1, dtype=np.float64), begin)
        return total / np.log(2) + (blocks * BLOCK - count)


def _sums(texts: DataFrame, mixer: Mixer) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Mixer.sums over all texts: a row a gate from each task, summed by gate."""
    curved = [(i, j) for i in range(INPUTS) for j in range(INPUTS)]
    names = ["n", *(f"g{i}" for i in range(INPUTS)), *(f"c{i}_{j}" for i, j in curved)]
    arrays = mixer.arrays() | {"weights": mixer.weights.astype(np.float64)}
    rows = map_java(texts.select(F.col("text").cast("binary")), "sums", arrays, ", ".join(["gate int", *(f"{k} double" for k in names)]))
    number, gradient, curvature = np.zeros(_GATES), np.zeros((_GATES, INPUTS)), np.zeros((_GATES, INPUTS, INPUTS))
    for r in rows.groupBy("gate").agg(*[F.sum(k).alias(k) for k in names]).collect():
        number[r.gate], gradient[r.gate], curvature[r.gate] = r.n, [r[f"g{i}"] for i in range(INPUTS)], np.reshape([r[f"c{i}_{j}"] for i, j in curved], (INPUTS, INPUTS))
    return number, gradient, curvature


def fit_weights(texts: DataFrame, mixer: Mixer, p: Params) -> np.ndarray:
    """The gates' weights on all of texts(text): Newton steps of ridge logistic regression, first of one fit for all gates, then of each
    gate's own, pulled towards it."""
    start = np.full(INPUTS, 0.3)
    common, own = start.copy(), None
    for _ in range(p.newton_steps):
        _, g, c = _sums(texts, Mixer(mixer.trees, mixer.tables, np.tile(common, (_GATES, 1)), p))
        step = np.linalg.solve(c.sum(axis=0) + np.eye(INPUTS), g.sum(axis=0) - (common - start))
        common += step
        if np.abs(step).max() < p.newton_least:
            break
    own = np.tile(common, (_GATES, 1))
    for _ in range(p.newton_steps):
        _, g, c = _sums(texts, Mixer(mixer.trees, mixer.tables, own, p))
        step = np.linalg.solve(c + 20.0 * np.eye(INPUTS), (g - 20.0 * (own - common))[..., None])[..., 0]
        own = own + step
        if np.abs(step).max() < p.newton_least:
            break
    return own.astype(np.float32)


# --- the operator --------------------------------------------------------------------------------


@dataclass
class Model:
    words: Words
    mixer: Mixer
    scratch: object


def fit(docs: DataFrame, allowed: Column, params: Params = Params()) -> Model:
    """Learn from docs(doc_id, text) where `allowed` holds."""
    from .common import Scratch

    p, spark = params, docs.sparkSession
    short_batches(spark)
    scratch = Scratch(spark, "lm")
    train = docs.where(allowed & F.col("doc_id").isNotNull()).select("doc_id", "text")
    first = scratch.save(_first_pass(train))
    words = _count_words(first, scratch, p)
    pairs = np.zeros(65536, dtype=np.int64)
    for r in _summed(first.where("block is not null").select("block", "counts"), 65536, _pack, "block int, counts binary").collect():
        _unpack(pairs, r.counts)
    scratch.drop(first)
    trees = Trees(pairs.reshape(256, 256))
    length = trees.length.reshape(256, 256).astype(np.int64)
    block_bits = min(16, max(4, int((pairs.reshape(256, 256) * length).sum() >> 26).bit_length()))  # so that a block has some 2^26 decisions
    train = train.withColumn("aside", F.pmod(F.xxhash64("doc_id"), F.lit(p.mixer_fold)) == 0)
    met = scratch.save(_meet(_share(train, trees, block_bits), block_bits))
    # the weights are fitted over the counts of the other texts
    apart = scratch.save(train.where("aside").select("text"))
    mixer = Mixer(trees, _tables(met, block_bits, 2, p), np.zeros((_GATES, INPUTS), dtype=np.float32), p)
    weights = fit_weights(apart, mixer, p)
    for t in mixer.tables:
        t.drop()
    mixer = Mixer(trees, _tables(met, block_bits, _KINDS, p), weights, p)
    scratch.drop(met, apart)
    return Model(words, mixer, scratch)


def score(docs: DataFrame, model: Model, ids: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte) of every row of docs(doc_id, text).

    One map gives the mixed score and the base score of the frequent words; rarer words are
    joined to their counts by word, summed once for each distinct text, and joined back by the text's digest,
    so that neither repeated nor null ids matter.
    """
    words, total, distinct = model.words, model.words.total, model.words.distinct
    top = {
        "words": b"".join(words.top), "sizes": np.array([len(w) for w in words.top], dtype=np.int32),
        "values": np.log10(np.array(list(words.top.values()), dtype=np.float64) + 0.5),
    }
    digest = F.substring(F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256)), 1, 16).alias("digest")
    text = F.col("text").cast("binary")
    below = float(np.log10(total + 0.5 * (distinct + 1)))
    keyed = docs.select(F.col("doc_id").cast("long"), digest, text)
    scored = map_java(
        keyed, "score", model.mixer.arrays() | top | {"rate": np.array([model.mixer.params.rate / 8], dtype=np.float32)},
        "doc_id long, digest binary, n_tokens long, top_known long, top_base double, score double, size long",
    )
    asked = map_java(docs.select(digest, text), "rare", {k: top[k] for k in ("words", "sizes")}, "word binary, digest binary, tf int")
    once = asked.join(words.rare, "word").groupBy("word", "digest").agg(F.max("tf").alias("tf"), F.max("n").alias("n"))  # repeats of a text ask alike
    met = once.groupBy("digest").agg(F.sum("tf").alias("rare_known"), F.sum(F.col("tf") * F.log10(F.col("n") + 0.5)).alias("rare_base"))
    out = scored.join(met, "digest", "left")
    hit = F.coalesce("rare_known", F.lit(0)) + F.col("top_known")
    unknown = (F.col("n_tokens") - hit) * float(np.log10(0.5))
    return out.select(
        "doc_id", "n_tokens", hit.alias("n_known"), F.lit(total).cast("long").alias("train_tokens"),
        (F.col("top_base") + F.coalesce("rare_base", F.lit(0.0)) + unknown - F.col("n_tokens") * below).alias("base_score"),
        "score", (F.col("score") / float(-np.log10(2)) / F.col("size")).alias("bits_per_byte"),
    )
