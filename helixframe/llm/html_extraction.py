"""HTML main text by markup and nearest-URL page differencing.

Pages are cut into text lines (one a block element). Pages are then sorted by host and URL path, each is
paired with the neighbour of its host that shares the longer leading path (the nearest page on either side
whose lines differ: a copy tells nothing), the lines of both are aligned by longest common subsequence, and aligned (shared) lines are deleted.

Differencing alone errs where menus change from page to page and where articles quote the same passage, so the
markup decides first: scripts, styles, forms, menus, headers, footers, asides, adverts, notices and reader
comments never count; prose (paragraphs, headings, items, quotes, cells) inside an article (or main) element is kept even if
shared, and where a page has such an element nothing outside it counts. Shared lines are deleted where no prose element holds
them: all of a page without an article, and an article's bare lines.

Defined results: null, empty or text-free html gives an empty text; a null or malformed url has an empty host and
is paired within that; repeated pages are one row each; broken or cut-off markup is closed at the end of the page; a page
whose host has no page with other lines loses no line. Results do not depend on partitions. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import html as _html
import re
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, map_rows, n_partitions, short_batches

BOILERPLATE, ARTICLE, OPEN, BARE = 0, 1, 2, 3

_TOKEN = re.compile(r"<!--|<[!?][^>]*+>?|</?([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|</?([a-zA-Z][a-zA-Z0-9:-]*)([^>]*+)>?")
_RAW = {"script", "style", "noscript", "template", "textarea", "iframe", "object", "title", "svg", "math"}
_RAW_END = {t: re.compile(rf"</{t}\s*+[^>]*+>", re.I) for t in _RAW}
_DROPPED = {"head", "nav", "footer", "aside", "form", "button", "select", "menu", "dialog", "label", "fieldset"}
_INLINE = {"a", "abbr", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
_PROSE = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "dd", "dt", "blockquote", "pre", "td", "th", "caption", "figcaption"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_WORDS = re.compile(r"[a-z]+")
_ATTRIBUTE = re.compile(r"\b(class|id|role|style)\s*=\s*(\"[^\"]*+\"|'[^']*+'|[^\s>]+)", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?=\s|=|/|$)|display\s*:\s*none", re.I)
#: Words of class, id or role names that mark an element as no part of the article.
_MARKS = {"ad", "ads", "advert", "adverts", "advertisement", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "complementary", "consent", "contentinfo", "cookie", "cookies", "disqus", "footer", "login", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "popup", "promo", "related", "search", "share", "sharing", "sidebar", "social", "sponsor", "sponsored", "subscribe", "widget"}


def lines(page: str | None) -> tuple[list[str], list[int]]:
    """Text lines of a page in order, each with its standing: boilerplate, article's prose, open, or bare in an article."""
    out: list[str] = []
    kinds: list[int] = []
    if not page:
        return out, kinds
    stack: list[tuple[str, int, int]] = []  # open elements: name, drops so far, articles so far
    drops = articles = 0
    piece: list[str] = []

    def flush() -> None:
        if piece:
            text = "".join(piece)
            piece.clear()
            text = " ".join(text.split())
            if text:
                out.append(text)
                kinds.append(BOILERPLATE if drops else OPEN if not articles else ARTICLE if any(e[0] in _PROSE for e in stack) else BARE)

    at, end = 0, len(page)
    search = _TOKEN.search
    while at < end:
        m = search(page, at)
        if m is None:
            raw = page[at:]
            piece.append(_html.unescape(raw) if "&" in raw else raw)
            break
        start = m.start()
        if start > at:
            raw = page[at:start]
            piece.append(_html.unescape(raw) if "&" in raw else raw)
        at = m.end()
        token = m.group()
        if token == "<!--":
            close = page.find("-->", at)
            at = end if close < 0 else close + 3
            continue
        name = (m.group(1) or m.group(3) or "").lower()
        if not name:
            continue
        if token[1] == "/":
            if name in _INLINE and not any(s[0] == name for s in stack[-1:]):
                continue
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    if name not in _INLINE or drops != stack[k][1]:
                        flush()
                    drops, articles = stack[k][1], stack[k][2]
                    del stack[k:]
                    break
            else:
                if name not in _INLINE:
                    flush()
            continue
        if name in _RAW:
            if name not in ("svg", "math"):
                flush()
            close = _RAW_END[name].search(page, at)
            at = end if close is None else close.end()
            continue
        attributes = m.group(2) or m.group(4) or ""
        if name not in _INLINE:
            flush()
            if name in ("p", "li", "tr", "td", "th", "dt", "dd", "option") and stack and stack[-1][0] == name:
                _, drops, articles = stack.pop()
        if name in _VOID or attributes.endswith("/"):
            continue
        dropped = name in _DROPPED or name == "header" and not articles
        article = name in ("article", "main")
        if attributes:
            if _HIDDEN.search(attributes):
                dropped = True
            for key, value in _ATTRIBUTE.findall(attributes):
                marks = set(_WORDS.findall(value.lower()))
                key = key.lower()
                if key == "role" and "main" in marks:
                    article = True
                elif key != "style" and name not in ("html", "body", "article", "main") and not _MARKS.isdisjoint(marks):
                    dropped = True
        if name == "article" and any(s[0] == "article" for s in stack) and drops:
            dropped = True
        if dropped and name in _INLINE:
            flush()
        if name not in _INLINE or dropped:
            stack.append((name, drops, articles))
            drops += dropped
            articles += article and not drops
        if name == "body":
            drops = 0
    flush()
    return out, kinds


def line_hash(line: bytes) -> bytes:
    """Lines are compared by 64-bit hashes."""
    return hashlib.blake2b(line, digest_size=8).digest()


def shared_lines(a: list, b: list) -> set[int]:
    """Positions of a that a longest common subsequence of a and b aligns (bit-parallel rows, halved if large)."""
    lo = 0
    while lo < len(a) and lo < len(b) and a[lo] == b[lo]:
        lo += 1
    ea, eb = len(a), len(b)
    while ea > lo and eb > lo and a[ea - 1] == b[eb - 1]:
        ea, eb = ea - 1, eb - 1
    out = set(range(lo)) | set(range(ea, len(a)))
    common = set(a[lo:ea]) & set(b[lo:eb])
    x = [i for i in range(lo, ea) if a[i] in common]
    y = [b[j] for j in range(lo, eb) if b[j] in common]
    return out | {x[i] for i in _lcs([a[i] for i in x], y)}


def _rows(a: list[str], b: list[str], keep: bool) -> list[int]:
    where: dict[str, int] = {}
    for j, w in enumerate(b):
        where[w] = where.get(w, 0) | 1 << j
    full = (1 << len(b)) - 1
    v, rows = full, []
    for w in a:
        u = v & where.get(w, 0)
        v = ((v + u) | (v - u)) & full
        if keep:
            rows.append(v)
    return rows if keep else [v]


def _lcs(a: list[str], b: list[str]) -> list[int]:
    if not a or not b:
        return []
    if len(a) > 1 and len(a) * len(b) > 1 << 27:  # Hirschberg: the kept rows would take over 16 MB
        half = len(a) // 2
        left, right = _rows(a[:half], b, False)[0], _rows(a[half:][::-1], b[::-1], False)[0]
        head, tail = [0], [0]
        for j in range(len(b)):
            head.append(head[-1] + (not left >> j & 1))
            tail.append(tail[-1] + (not right >> j & 1))
        cut = max(range(len(b) + 1), key=lambda j: head[j] + tail[len(b) - j])
        return _lcs(a[:half], b[:cut]) + [half + i for i in _lcs(a[half:], b[cut:])]
    rows, out, j = _rows(a, b, True), [], len(b)
    for i in range(len(a) - 1, -1, -1):
        mask = (1 << j) - 1
        zeros = (~rows[i]) & mask
        before = (~rows[i - 1]) & mask if i else 0
        if zeros.bit_count() > before.bit_count():
            out.append(i)
            j = zeros.bit_length() - 1
            # the match of line i lies at or before the last column that counts it
            while b[j] != a[i]:
                j -= 1
    return out[::-1]


def _beyond(met: DataFrame, parts: DataFrame) -> DataFrame:
    """(part, host, before1, before2, after1, after2) of each range partition: the nearest page outside it of the host at its edge,
    and the nearest there whose lines differ from that page's. One row a partition is folded on the driver."""
    edges = {r.part: r for r in parts.collect()}
    order = sorted(edges)
    rows: dict[int, dict[str, tuple | None]] = {p: {} for p in order}
    for name, way, own, other in (("before", order, "last", "first"), ("after", order[::-1], "first", "last")):
        known: tuple | None = None  # host, nearest, nearest that differs from it
        for at, p in enumerate(way):
            if known is not None:
                rows[p][name] = known
            end, start = edges[p][own], edges[p][other]
            nearest, differs = end.side, end[name]
            if differs is None and known is not None and known[0] == end.host and start.host == end.host:
                differs = known[1] if known[1].digest[:16] != nearest.digest[:16] else known[2]
            known = (end.host, nearest, differs)
    side = "struct<digest: binary, path: string>"
    out = [(p, *(rows[p].get("before") or (None,) * 3), *(rows[p].get("after") or (None,) * 3)) for p in order]
    return met.sparkSession.createDataFrame(out, f"part int, before_host string, before1 {side}, before2 {side}, after_host string, after1 {side}, after2 {side}")


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_lines, n_shared) of every row of pages(page_id, url, html).

    Neighbours are found on paths and digests of lines alone, sorted by host and path over range partitions, so that a large host
    is shared among tasks; what lies beyond a partition's edges is handed to it. Then each distinct list of lines is joined in by
    digest: a page's own as text, compressed and without its boilerplate, its neighbour's as hashes. Memory: a page at a time.
    """
    spark = pages.sparkSession
    short_batches(spark, 200)
    url = F.coalesce("url", F.lit(""))
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1))
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)", 1)

    def cut(pack: bool):
        def work(batch: pa.RecordBatch):
            packed, digests, hashes = [], [], []
            for page in batch.column("html").to_pylist():
                texts, kinds = lines(page)
                raw = [t.encode("utf-8", "surrogatepass") for t in texts]
                # whether lines differ is told by `of_lines`; the pages of one `digest` have the same standings too
                of_lines = hashlib.sha256(b"\n".join(raw)).digest()[:16]
                digests.append(of_lines + hashlib.sha256(bytes(kinds)).digest()[:8])
                hashes.append(b"".join(line_hash(r) for r in raw))
                body = b"\n".join(r for r, k in zip(raw, kinds) if k != BOILERPLATE)
                packed.append(zlib.compress("".join(map(str, kinds)).encode() + b"\n" + body, 6) if pack else None)
            yield {c: batch.column(c) for c in ("page_id", "url", "host", "path")} | {"digest": digests, "hashes": hashes, "packed": packed}

        return lambda: work

    # pages are cut once for the digests of their lines and once for the lines: keeping the lines in between would take more disk
    scratch = Scratch(spark, "html")
    placed = pages.select("page_id", "url", host.alias("host"), path.alias("path"), "html")
    schema = "page_id long, url string, host string, path string, digest binary, hashes binary, packed binary"
    packed_lines = map_rows(placed, cut(True), schema)
    found = scratch.save(map_rows(placed, cut(False), schema).drop("packed"))
    order = ("path", "page_id", "digest", "url")
    ranged = scratch.save(found.drop("hashes").repartitionByRange(n_partitions(spark), "host", *order).withColumn("part", F.spark_partition_id()))
    side, met = F.struct("digest", "path"), ranged

    def of_lines(c):
        return F.substring(c, 1, 16)

    for name, by in (("before", order), ("after", tuple(F.col(c).desc() for c in order))):
        w = Window.partitionBy("part", "host").orderBy(*by)
        changed = F.when(F.lag(of_lines("digest")).over(w) != of_lines("digest"), F.lag(side).over(w))
        met = met.withColumn("step", changed).withColumn(name, F.last("step", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))).drop("step")
    met = scratch.save(met)
    scratch.drop(ranged)
    place, row = F.struct("host", *order), F.struct("host", side.alias("side"), "before", "after")
    beyond = _beyond(met, met.groupBy("part").agg(F.min_by(row, place).alias("first"), F.max_by(row, place).alias("last")))
    met = met.join(F.broadcast(beyond), "part")  # a row a partition
    for name in ("before", "after"):
        outside = F.when(of_lines(F.col(f"{name}1").digest) != of_lines("digest"), F.col(f"{name}1")).otherwise(F.col(f"{name}2"))
        met = met.withColumn(name, F.coalesce(name, F.when(F.col(f"{name}_host") == F.col("host"), outside)))

    def common(x: str):
        same = F.zip_with(F.split("path", "/"), F.split(F.col(x).path, "/"), lambda a, b: a.eqNullSafe(b))
        at = F.array_position(same, False)
        return F.when(F.col(x).isNull(), F.lit(-1)).when(at > 0, at - 1).otherwise(F.size(same))

    near = F.when(common("after") > common("before"), F.col("after").digest).otherwise(F.col("before").digest)
    contents = packed_lines.groupBy("digest").agg(F.first("packed").alias("packed"), F.first("hashes").alias("hashes"))
    hashes = found.groupBy(F.col("digest").alias("near")).agg(F.first("hashes").alias("other"))
    asked = met.select("page_id", "url", "digest", near.alias("near")).join(hashes, "near", "left")
    both = asked.join(contents, "digest").select("page_id", "url", "packed", "hashes", "other")

    def pair():
        def work(batch: pa.RecordBatch):
            texts, n_lines, n_shared = [], [], []
            for packed, own, other in zip(*(batch.column(c).to_pylist() for c in ("packed", "hashes", "other"))):
                kinds, _, body = zlib.decompress(packed).partition(b"\n")
                kinds = [k - 48 for k in kinds]
                left = iter(body.decode("utf-8", "surrogatepass").split("\n"))
                now = [None if k == BOILERPLATE else next(left) for k in kinds]
                shared = shared_lines(*([h[i : i + 8] for i in range(0, len(h), 8)] for h in (own, other))) if other is not None else set()
                counted = BARE if ARTICLE in kinds or BARE in kinds else OPEN
                texts.append(" ".join(t for i, (t, k) in enumerate(zip(now, kinds)) if k == ARTICLE or k == counted and i not in shared))
                n_lines.append(len(kinds))
                n_shared.append(len(shared))
            yield {"page_id": batch.column("page_id"), "url": batch.column("url"), "text": texts, "n_lines": n_lines, "n_shared": n_shared}

        return work

    return map_rows(both, pair, "page_id long, url string, text string, n_lines int, n_shared int")
