"""BAM files: a Python data source planned from the index, and a sorted, sharded writer with index.

Reading: `spark.dataSource.register(BamSource)`, then `spark.read.format("bam").load(path)` (a file, folder, glob, prefix or
text file that lists such, or a comma-separated list of them) gives the rows of `sam_rows`; `sam.reads_of` turns them into reads. A
file with an index is cut into shards of about `maxShardBytes`, or of `maxShardLoci`; one without is a shard. Options: regions
(`ref:start:end,...`, 1-based, both ends in), maxShardBytes, maxShardLoci, includeUnmapped, and mode: FAILFAST (a record that cannot be
read fails the job), DROPMALFORMED (it is left out) or MALFORMED (only such records are given, by place, to be counted or looked into).

Writing: `write_bam` sorts by place, writes a shard a partition with the index entries of its records, and joins the
shards on the driver by copying bytes.
"""

from __future__ import annotations

import glob
import os
import shutil
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import islice

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions.regions import parse_regions
from ..shipping import ship
from . import sam

#: Fixed values of the format: the empty last block, letters of operations and of packed bases, the index's metadata bin and windows.
EOF = bytes.fromhex("1f8b08040000000000ff0600424302001b0003000000000000000000")
OPERATIONS = "MIDNSHP=X"
BASES = "=ACMGRSVTWYHKDBN"
METADATA_BIN, WINDOW, FIRST_LEAF, LEAVES = 37450, 1 << 14, 4681, 37449
SCHEMA = "qname string, flag int, rname string, pos int, mapq int, cigar string, rnext string, pnext int, tlen int, seq string, qual string, tags array<string>"


class BlockReader:
    """Sequential bytes of a block-compressed file from a virtual offset; `tell` gives the virtual offset of the next byte."""

    def __init__(self, path: str, virtual: int = 0):
        self.file = open(path, "rb")
        self.next = virtual >> 16
        self.data, self.at, self.block = b"", 0, self.next
        self._load()
        self.at = virtual & 0xFFFF

    def _load(self) -> bool:
        self.block = self.next
        self.file.seek(self.next)
        head = self.file.read(12)
        self.data, self.at = b"", 0
        if len(head) < 12:
            return False
        extra = self.file.read(struct.unpack("<H", head[10:12])[0])
        i, size = 0, 0
        while i + 4 <= len(extra):
            kind, n = extra[i : i + 2], struct.unpack("<H", extra[i + 2 : i + 4])[0]
            if kind == b"BC":
                size = struct.unpack("<H", extra[i + 4 : i + 6])[0] + 1
            i += 4 + n
        if not size:
            raise ValueError("not a block-compressed file")
        self.data = zlib.decompress(self.file.read(size - 12 - len(extra))[:-8], -15)
        self.next += size
        return True

    def tell(self) -> int:
        while self.at >= len(self.data):
            if not self._load():
                return self.block << 16
        return self.block << 16 | self.at

    def read(self, n: int) -> bytes:
        out = b""
        while len(out) < n:
            if self.at >= len(self.data) and not self._load():
                break
            take = self.data[self.at : self.at + n - len(out)]
            self.at += len(take)
            out += take
        return out


def header_of(reader: BlockReader) -> tuple[str, list[tuple[str, int]]]:
    """Header text and (name, length) of the sequences; the reader is left at the first record."""
    if reader.read(4) != b"BAM\1":
        raise ValueError("not a BAM file")
    text = reader.read(struct.unpack("<i", reader.read(4))[0]).rstrip(b"\0").decode()
    refs = []
    for _ in range(struct.unpack("<i", reader.read(4))[0]):
        name = reader.read(struct.unpack("<i", reader.read(4))[0])[:-1].decode()
        refs.append((name, struct.unpack("<i", reader.read(4))[0]))
    return text, refs


_TAG = {"A": "<c", "c": "<b", "C": "<B", "s": "<h", "S": "<H", "i": "<i", "I": "<I", "f": "<f"}


def decode(raw: bytes, refs: list[tuple[str, int]]) -> tuple:
    """A record's bytes (without its length) as the columns of SCHEMA."""
    ref, pos, n_name, mapq, _, n_cigar, flag, n_seq, mate, mate_pos, tlen = struct.unpack_from("<iiBBHHHiiii", raw)
    at = 32
    qname = raw[at : at + n_name - 1].decode()
    at += n_name
    cigar = "".join(f"{x >> 4}{OPERATIONS[x & 15]}" for x in struct.unpack_from(f"<{n_cigar}I", raw, at)) or "*"
    at += 4 * n_cigar
    packed = raw[at : at + (n_seq + 1) // 2]
    seq = "".join(BASES[b >> 4] + BASES[b & 15] for b in packed)[:n_seq] or "*"
    at += (n_seq + 1) // 2
    quals = raw[at : at + n_seq]
    qual = "*" if not n_seq or quals[0] == 255 else bytes(q + 33 for q in quals).decode()
    at += n_seq
    tags = []
    while at < len(raw):
        tag, kind = raw[at : at + 2].decode(), chr(raw[at + 2])
        at += 3
        if kind in "ZH":
            end = raw.index(0, at)
            tags.append(f"{tag}:{kind}:{raw[at:end].decode()}")
            at = end + 1
        elif kind == "B":
            sub, n = chr(raw[at]), struct.unpack_from("<i", raw, at + 1)[0]
            values = struct.unpack_from(f"<{n}{_TAG[sub][1]}", raw, at + 5)
            tags.append(f"{tag}:B:{','.join([sub, *map(str, values)])}")
            at += 5 + n * struct.calcsize(_TAG[sub])
        else:
            value = struct.unpack_from(_TAG[kind], raw, at)[0]
            tags.append(f"{tag}:{'A' if kind == 'A' else 'f' if kind == 'f' else 'i'}:{value.decode() if kind == 'A' else value}")
            at += struct.calcsize(_TAG[kind])
    name = lambda i: refs[i][0] if i >= 0 else "*"
    return qname, flag, name(ref), pos + 1, mapq, cigar, "=" if mate >= 0 and mate == ref else name(mate), mate_pos + 1, tlen, seq, qual, tags


def encode(row, index: dict[str, int]) -> tuple[bytes, int, int, int]:
    """A row of SCHEMA as a record (with its length), and its sequence index, start and end."""
    ref = index.get(row.rname, -1)
    mate = ref if row.rnext == "=" else index.get(row.rnext, -1)
    ops, n, length = [], "", 0
    for c in "" if row.cigar == "*" else row.cigar:
        if c.isdigit():
            n += c
        else:
            ops.append(int(n) << 4 | OPERATIONS.index(c))
            length += int(n) if c in "MDN=X" else 0
            n = ""
    start = row.pos - 1
    end = start + max(1, length)
    seq = "" if row.seq == "*" else row.seq
    codes = [max(0, BASES.find(b)) for b in seq.upper()] + [0]
    packed = bytes(codes[i] << 4 | codes[i + 1] for i in range(0, len(seq), 2))
    qual = b"\xff" * len(seq) if row.qual == "*" else bytes(ord(q) - 33 for q in row.qual)
    tags = b""
    for t in row.tags or ():
        tag, kind, value = t.split(":", 2)
        head = tag.encode()
        if kind == "i":
            tags += head + b"i" + struct.pack("<i", int(value))
        elif kind == "f":
            tags += head + b"f" + struct.pack("<f", float(value))
        elif kind == "A":
            tags += head + b"A" + value.encode()[:1]
        elif kind == "B":
            sub, *values = value.split(",")
            tags += head + b"B" + sub.encode() + struct.pack("<i", len(values)) + struct.pack(f"<{len(values)}{_TAG[sub][1]}", *[float(v) if sub == "f" else int(v) for v in values])
        else:
            tags += head + kind.encode() + value.encode() + b"\0"
    name = row.qname.encode() + b"\0"
    body = struct.pack("<iiBBHHHiiii", ref, start, len(name), row.mapq, bin_of(max(start, 0), max(end, 1)), len(ops), row.flag, len(seq), mate, row.pnext - 1, row.tlen)
    body += name + struct.pack(f"<{len(ops)}I", *ops) + packed + qual + tags
    return struct.pack("<i", len(body)) + body, ref, start, end


def bin_of(start: int, end: int) -> int:
    """The smallest bin that holds [start, end)."""
    end -= 1
    for shift, first in ((14, 4681), (17, 585), (20, 73), (23, 9), (26, 1)):
        if start >> shift == end >> shift:
            return first + (start >> shift)
    return 0


def bins_over(start: int, end: int) -> list[int]:
    out = [0]
    for shift, first in ((26, 1), (23, 9), (20, 73), (17, 585), (14, 4681)):
        out += range(first + (start >> shift), first + (end - 1 >> shift) + 1)
    return out


def read_index(path: str) -> list[dict]:
    """By sequence: {"bins": {bin: [(begin, end)]}, "linear": [offset]}, the metadata bin left out."""
    raw = open(path, "rb").read()
    if raw[:4] != b"BAI\1":
        raise ValueError("not a BAM index")
    at, out = 8, []
    for _ in range(struct.unpack_from("<i", raw, 4)[0]):
        n = struct.unpack_from("<i", raw, at)[0]
        at, bins = at + 4, {}
        for _ in range(n):
            b, k = struct.unpack_from("<Ii", raw, at)
            v = struct.unpack_from(f"<{2 * k}Q", raw, at + 8)
            at += 8 + 16 * k
            if b != METADATA_BIN:
                bins[b] = list(zip(v[::2], v[1::2]))
        n = struct.unpack_from("<i", raw, at)[0]
        out.append({"bins": bins, "linear": list(struct.unpack_from(f"<{n}Q", raw, at + 4))})
        at += 4 + 8 * n
    return out


def chunk_bytes(chunks: list[tuple[int, int]]) -> int:
    """About how many uncompressed bytes chunks hold, by the usual compression of 0.39."""
    return sum(round(((e >> 16) - (b >> 16)) / 0.39) + (e & 0xFFFF) - (b & 0xFFFF) for b, e in chunks)


@dataclass
class Shard(InputPartition):
    """Records of a file that start in [start, end) of a sequence (None: any, `*`: unmapped without place), in its chunks."""

    path: str
    reference: str | None
    start: int
    end: int
    chunks: list

    def __init__(self, path, reference, start, end, chunks):
        self.path, self.reference, self.start, self.end, self.chunks = path, reference, start, end, chunks


#: Whether a shard is full, from its loci and the bytes of its chunks so far.
Full = Callable[[int, int], bool]


def plan(path: str, regions: list[tuple[str, int, int]], most: int, unmapped: bool, loci: int | None = None, full: Full | None = None) -> list[Shard]:
    """Shards of a file: leaf bins are taken in order until the shard is full; each shard then gets the chunks of every bin over
    its range. It is full over `most` bytes, over `loci` loci where that is given, or as a rule of one's own says. Regions are
    1-based and hold both ends: a record belongs if its position is at least the start and at most the end. Without an index the
    file is one shard a region."""
    full = full or (lambda width, size: size > most or loci is not None and width > loci)
    regions = [(name, max(0, start - 1), end) for name, start, end in regions]
    index_path = next((p for p in (f"{path}.bai", path.removesuffix(".bam") + ".bai") if os.path.exists(p)), None)
    _, refs = header_of(reader := BlockReader(path))
    first, size = reader.tell(), os.path.getsize(path) << 16
    spans = regions or [(name, 0, 1 << 29) for name, _ in refs]
    if index_path is None:
        out = [Shard(path, r, s, e, [(first, size)]) for r, s, e in regions] or [Shard(path, None, 0, 1 << 29, [(first, size)])]
        return out + [Shard(path, "*", 0, 0, [(first, size)])] * (unmapped and bool(regions))
    index, names, out, last = read_index(index_path), [n for n, _ in refs], [], first
    for i in index:
        last = max([last, *(e for c in i["bins"].values() for _, e in c)])
    for name, start, end in spans:
        if name not in names or names.index(name) >= len(index):
            continue
        own = index[names.index(name)]
        stops, grown = [start], []
        for b in sorted(b for b in own["bins"] if FIRST_LEAF <= b < LEAVES):
            locus = (b - FIRST_LEAF) * WINDOW
            if start <= locus + WINDOW and locus < end:
                grown += own["bins"][b]
                if full(locus + WINDOW - stops[-1], chunk_bytes(grown)) and stops[-1] < locus + WINDOW < end:
                    stops.append(locus + WINDOW)
                    grown = []
        for s, e in zip(stops, [*stops[1:], end]):
            least = own["linear"][min(s // WINDOW, len(own["linear"]) - 1)] if own["linear"] else 0
            wanted = set(bins_over(s, min(e, 1 << 29)))
            chunks = sorted((max(a, least), z) for b, c in own["bins"].items() if b in wanted for a, z in c if z > least)
            merged: list[tuple[int, int]] = []
            for a, z in chunks:
                if merged and a <= merged[-1][1]:
                    merged[-1] = (merged[-1][0], max(z, merged[-1][1]))
                else:
                    merged.append((a, z))
            if merged:
                out.append(Shard(path, name, s, e, merged))
    if unmapped or not regions:
        out.append(Shard(path, "*", 0, 0, [(last, size)]))
    return out


#: What is done about a record that cannot be read: the job fails, the record is dropped, or only such records are given (by place).
MODES = ("FAILFAST", "DROPMALFORMED", "MALFORMED")


def records(shard: Shard, unmapped: bool, mode: str = "FAILFAST") -> Iterator[tuple]:
    _, refs = header_of(BlockReader(shard.path))
    for begin, end in shard.chunks:
        reader = BlockReader(shard.path, begin)
        while reader.tell() < end:
            at = reader.tell()
            head = reader.read(4)
            if len(head) < 4:
                break
            raw = reader.read(struct.unpack("<i", head)[0])
            try:
                row = decode(raw, refs)
            except (struct.error, IndexError, KeyError, ValueError) as e:
                if mode == "FAILFAST":
                    raise ValueError(f"{shard.path}: the record at {at >> 16}:{at & 0xFFFF} cannot be read: {e}") from e
                if mode == "MALFORMED":
                    yield (f"{shard.path}:{at >> 16}:{at & 0xFFFF}", *(None,) * (len(SCHEMA.split(",")) - 1))
                continue
            if mode == "MALFORMED":
                continue
            placed = row[2] != "*"
            if shard.reference == "*":
                if not placed:
                    yield row
            elif placed and (shard.reference is None or row[2] == shard.reference and shard.start <= row[3] - 1 < shard.end) and (unmapped or not row[1] & sam.UNMAPPED):
                yield row
            elif shard.reference is None and not placed and unmapped:
                yield row


BATCH_ROWS = 5_000


def input_files(part: str) -> list[str]:
    """The files of one input path: a .bam file, a folder or pattern or prefix of such, or a text file that lists paths, one a line."""
    if os.path.isfile(part) and not part.endswith(".bam"):
        with open(part, encoding="utf-8") as f:
            listed = [line.strip() for line in f if line.strip()]
        return [p for x in listed for p in input_files(x if os.path.isabs(x) else os.path.join(os.path.dirname(part), x))]
    found = [part] if os.path.isfile(part) else glob.glob(f"{part}/*.bam") if os.path.isdir(part) else glob.glob(part) or glob.glob(f"{part}*")
    if not (files := sorted(p for p in found if p.endswith(".bam"))):
        raise FileNotFoundError(f"no .bam file at {part}")
    return files


class BamReader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = options

    def partitions(self) -> list[Shard]:
        o = self.options
        paths = [p for part in o["path"].split(",") for p in input_files(part)]
        mode = o.get("mode", "FAILFAST").upper()
        if mode not in MODES:
            raise ValueError(f"mode is one of {', '.join(MODES)}, not {mode}")
        loci = o.get("maxshardloci", o.get("maxShardLoci"))
        flag = str(o.get("includeunmapped", o.get("includeUnmapped", "true"))).lower() == "true"
        most = int(o.get("maxshardbytes", o.get("maxShardBytes", 100 << 20)))
        return [s for p in paths for s in plan(p, parse_regions(o.get("regions", "")), most, flag, int(loci) if loci else None)]

    def read(self, partition: Shard) -> Iterator["pa.RecordBatch"]:
        import pyarrow as pa

        kinds = {"string": pa.string(), "int": pa.int32(), "array<string>": pa.list_(pa.string())}
        schema = pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in SCHEMA.split(", "))])
        unmapped = str(self.options.get("includeunmapped", self.options.get("includeUnmapped", "true"))).lower() == "true"
        rows = records(partition, unmapped, self.options.get("mode", "FAILFAST").upper())
        while some := list(islice(rows, BATCH_ROWS)):
            yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*some), schema)], schema=schema)


class BamSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "bam"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> BamReader:
        return BamReader(dict(self.options))


def read_bam(spark: SparkSession, path: str, **options: str) -> DataFrame:
    ship(spark)
    spark.dataSource.register(BamSource)
    return spark.read.format("bam").options(**options).load(path)


def read_bam_header(path: str) -> dict:
    return sam.parse_header(header_of(BlockReader(path))[0].splitlines())


def _block(data: bytes) -> bytes:
    deflate = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = deflate.compress(data) + deflate.flush()
    return b"\x1f\x8b\x08\x04\0\0\0\0\0\xff\x06\0BC\x02\0" + struct.pack("<H", len(body) + 25) + body + struct.pack("<II", zlib.crc32(data), len(data))


class BlockWriter:
    def __init__(self, file):
        self.file, self.pending, self.done = file, b"", 0

    def tell(self) -> int:
        return self.done << 16 | len(self.pending)

    def write(self, data: bytes) -> None:
        if self.pending and len(self.pending) + len(data) > 60_000:
            self.flush()
        self.pending += data
        while len(self.pending) > 60_000:
            self._out(self.pending[:60_000])
            self.pending = self.pending[60_000:]

    def _out(self, data: bytes) -> None:
        block = _block(data)
        self.file.write(block)
        self.done += len(block)

    def flush(self) -> None:
        if self.pending:
            self._out(self.pending)
            self.pending = b""


def shared_folder(spark: SparkSession) -> str:
    """A new folder under spark.checkpoint.dir, as a path that files can be opened at; a local session without that setting uses /tmp."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = "/tmp/checkpoints"
    if not root.startswith(("/", "file:")):
        raise ValueError(f"alignment files need a mounted folder, not {root}")
    folder = os.path.join("/" + root.removeprefix("file:").lstrip("/"), f"helixframe-bam-{uuid.uuid4().hex}")
    os.makedirs(folder)
    return folder


def write_bam(rows: DataFrame, header: dict, path: str, partitions: int | None = None) -> None:
    """Write rows of SCHEMA as one sorted BAM file and its index. `path` is in a folder that all executors share.

    A range exchange by (sequence, position) replaces any shard key: shards are even where reads are dense. A task writes its shard
    under a name of its own attempt and returns that name, so that a lost or repeated task leaves no part in the result.
    """
    spark = rows.sparkSession
    ship(spark)
    names = [s["SN"] for s in header.get("SQ", [])]
    index = {n: i for i, n in enumerate(names)}
    parts = f"{path}.parts-{uuid.uuid4().hex}"
    os.makedirs(parts)
    place = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for n, i in index.items() for x in (n, i)]), F.col("rname")), F.lit(1 << 30)) if index else F.lit(1 << 30)
    keyed = rows.withColumn("_ref", place)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = keyed.repartitionByRange(n, "_ref", "pos", "qname", "flag").sortWithinPartitions("_ref", "pos", "qname", "flag")

    def write(batches):
        import pickle
        from types import SimpleNamespace

        import pyarrow as pa

        name, file, out, entries, loose = "", None, None, [], 0
        first = None
        for batch in batches:
            for row in batch.to_pylist():
                if file is None:
                    name = f"{parts}/{uuid.uuid4().hex}"
                    file = open(name, "wb")
                    out, first = BlockWriter(file), (row["_ref"], row["pos"], row["qname"], row["flag"])
                raw, ref, start, end = encode(SimpleNamespace(**row), index)
                begin = out.tell()
                out.write(raw)
                if ref >= 0 and start >= 0:
                    entries.append((ref, start, end, begin, out.tell(), bool(row["flag"] & sam.UNMAPPED)))
                else:
                    loose += 1
        if file is not None:
            out.flush()
            file.close()
            yield pa.RecordBatch.from_pydict({"name": [name], "first": [pickle.dumps(first)], "loose": [loose], "entries": [pickle.dumps(_compact(entries))]})

    import pickle

    done = sorted(ordered.mapInArrow(write, "name string, first binary, loose long, entries binary").collect(), key=lambda r: pickle.loads(r.first))
    bins: list[dict] = [{} for _ in names]
    linear: list[dict] = [{} for _ in names]
    meta: list[list] = [[None, 0, 0, 0] for _ in names]
    with open(f"{path}.tmp", "wb") as whole:
        out = BlockWriter(whole)
        text = sam.header_text(header).encode()
        head = b"BAM\1" + struct.pack("<i", len(text)) + text + struct.pack("<i", len(names))
        for s in header.get("SQ", []):
            head += struct.pack("<i", len(s["SN"]) + 1) + s["SN"].encode() + b"\0" + struct.pack("<i", int(s.get("LN", 0)))
        out.write(head)
        out.flush()
        for r in done:
            shift = whole.tell() << 16
            by_bin, windows, totals = pickle.loads(r.entries)
            for (ref, b), chunks in by_bin.items():
                bins[ref].setdefault(b, []).extend((a + shift, z + shift) for a, z in chunks)
            for (ref, w), at in windows.items():
                linear[ref][w] = min(linear[ref].get(w, at + shift), at + shift)
            for ref, (a, z, mapped, un) in totals.items():
                m = meta[ref]
                meta[ref] = [a + shift if m[0] is None else m[0], z + shift, m[2] + mapped, m[3] + un]
            with open(r.name, "rb") as part:
                shutil.copyfileobj(part, whole, 1 << 20)
        whole.write(EOF)
    with open(f"{path}.bai", "wb") as f:
        f.write(b"BAI\1" + struct.pack("<i", len(names)))
        for ref in range(len(names)):
            f.write(struct.pack("<i", len(bins[ref]) + (meta[ref][0] is not None)))
            for b, chunks in sorted(bins[ref].items()):
                f.write(struct.pack("<Ii", b, len(chunks)) + b"".join(struct.pack("<QQ", *c) for c in chunks))
            if meta[ref][0] is not None:
                f.write(struct.pack("<Ii", METADATA_BIN, 2) + struct.pack("<QQQQ", *meta[ref]))
            n_windows = max(linear[ref], default=-1) + 1
            offsets, last = [], 0
            for w in range(n_windows):
                last = linear[ref].get(w, last)
                offsets.append(last)
            f.write(struct.pack("<i", n_windows) + struct.pack(f"<{n_windows}Q", *offsets))
        f.write(struct.pack("<Q", sum(r.loose for r in done)))
    os.replace(f"{path}.tmp", path)
    shutil.rmtree(parts)


def _compact(entries: list[tuple]) -> tuple[dict, dict, dict]:
    """A shard's index: chunks by (sequence, bin), first offsets by (sequence, window), and (first, last, mapped, unmapped) by sequence."""
    by_bin: dict = {}
    windows: dict = {}
    totals: dict = {}
    for ref, start, end, a, z, unmapped in entries:
        chunks = by_bin.setdefault((ref, bin_of(start, end)), [])
        if chunks and a >> 16 == chunks[-1][1] >> 16:
            chunks[-1] = (chunks[-1][0], z)
        else:
            chunks.append((a, z))
        for w in range(start // WINDOW, (end - 1) // WINDOW + 1):
            windows.setdefault((ref, w), a)
        t = totals.get(ref, (a, z, 0, 0))
        totals[ref] = (t[0], z, t[2] + (not unmapped), t[3] + unmapped)
    return by_bin, windows, totals
