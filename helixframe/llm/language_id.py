"""Language identification by cross-parsing against suffix automata.

For every language a suffix automaton is built over running labelled text. A text's letters (lower case, a blank between
words) are cut into longest matches with that automaton, from word to word; the phrases needed are divided by those that
other labelled text of the language needs, and the language with the fewest normalised phrases wins. The parse begins
anew at each stretch of 4,096 bytes, so that the stretches of many texts are parsed side by side; a text is read whole.

The automata of all languages are one table of states: a mask of the bytes that leave a state, and the states they lead to.

Defined results: null texts and texts with no letter are `und` with score 0, as is everything when nothing was learned; ties go
to the first language name; repeated rows get equal results, and count once in learning; rows with a null text or lang are not
learned from; other columns are ignored. Whole texts are parsed, of any length.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import carried, map_rows, release, short_batches

UNDETERMINED = "und"
_LETTERS = re.compile(r"[^\W\d_]+")
_DRAWS = 1 << 30
#: A table of at most so many languages' sizes is broadcast.
_LANGUAGES = 10_000


@dataclass(frozen=True)
class Params:
    rows_per_language: int = 60  # labelled rows whose whole texts a language's automaton holds
    rate_rows: int = 60  # further labelled rows that tell how many phrases text of the language needs
    stretch: int = 4096
    sharpness: float = 4.0  # of the score
    batch_bytes: int = 8_000_000  # parsed at once: bounds a worker's memory


def letters(text: str | None) -> bytes:
    """The words of letters, in lower case, with a blank around each; empty if there is no letter."""
    words = _LETTERS.findall(text.lower()) if text else []
    if not words or not any(map(str.isalpha, words)) and not any(map(str.isalpha, "".join(words))):
        return b""
    return f" {' '.join(words)} ".encode("utf-8", "surrogatepass")


def suffix_automaton(text: bytes) -> list[dict[int, int]]:
    """The transitions of each state of the suffix automaton of text; state 0 is the start."""
    edges: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in text:
        new, at = len(edges), last
        edges.append({})
        length.append(length[last] + 1)
        link.append(0)
        while at >= 0 and c not in edges[at]:
            edges[at][c] = new
            at = link[at]
        if at >= 0:
            to = edges[at][c]
            if length[to] == length[at] + 1:
                link[new] = to
            else:
                copy = len(edges)
                edges.append(dict(edges[to]))
                length.append(length[at] + 1)
                link.append(link[to])
                while at >= 0 and edges[at].get(c) == to:
                    edges[at][c] = copy
                    at = link[at]
                link[to] = link[new] = copy
        last = new
    return edges


class Automata:
    """The suffix automata of several references, as arrays: 12 to 40 bytes a state."""

    def __init__(self, references: list[bytes]):
        seen = np.zeros(256, dtype=bool)
        for r in references:
            seen[np.frombuffer(r, dtype=np.uint8)] = True
        k = int(seen.sum())
        self.classes = np.full(256, k, dtype=np.uint8)  # of bytes; k: in no reference
        self.classes[seen] = np.arange(k)
        self.words = k // 64 + 1  # of 64 bits in a state's mask
        masks, targets, starts = [], [], []
        self.root = np.zeros((len(references), k + 1), dtype=np.int32)
        # from the start states, by class: where to, and whether no match begins with it
        self.alone = np.ones((len(references), k + 1), dtype=np.int32)
        n = 0
        for i, r in enumerate(references):
            # a language at a time: its automaton in Python's objects is let go before the next one's is built
            state, own, target = self._flat(suffix_automaton(self.classes[np.frombuffer(r, dtype=np.uint8)].tobytes()))
            size = int(state[-1]) + 1 if len(state) else 1
            size = max(size, int(target.max()) + 1 if len(target) else 1)  # the last state may have no way out
            mask = np.zeros(size * self.words, dtype=np.uint64)
            np.bitwise_or.at(mask, state * np.int32(self.words) + (own >> 6), np.uint64(1) << (own & 63).astype(np.uint64))
            self.root[i] = n
            leaves = int(np.searchsorted(state, 1))
            self.root[i, own[:leaves]] = target[:leaves] + n
            self.alone[i, own[:leaves]] = 0
            masks.append(mask)
            targets.append(target + np.int32(n))
            starts.append(n)
            n += size
        self.starts = np.array(starts, dtype=np.int32)
        self.masks = np.concatenate(masks)
        self.base = (np.cumsum(np.bitwise_count(self.masks), dtype=np.int32) - np.bitwise_count(self.masks)).astype(np.int32)
        self.targets = np.concatenate([*targets, np.zeros(1, dtype=np.int32)])

    @staticmethod
    def _flat(edges: list[dict[int, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """States, classes and targets of all transitions, in the order of states and classes."""
        degree = np.fromiter(map(len, edges), dtype=np.int32, count=len(edges))
        total = int(degree.sum())
        own = np.fromiter((c for out in edges for c in out), dtype=np.uint8, count=total)
        target = np.fromiter((t for out in edges for t in out.values()), dtype=np.int32, count=total)
        edges.clear()
        state = np.repeat(np.arange(len(degree), dtype=np.int32), degree)
        order = np.lexsort((own, state))
        return state[order], own[order], target[order]

    def phrases(self, texts: list[bytes], stretch: int) -> np.ndarray:
        """texts x references: longest matches needed to cover each text; a byte without a match is a phrase."""
        n, k = len(texts), len(self.starts)
        size = np.array([len(t) for t in texts], dtype=np.int64)
        if not size.sum():
            return np.zeros((n, k), dtype=np.int64)
        data = self.classes[np.frombuffer(b"".join(texts), dtype=np.uint8)]
        pieces = -(-size // stretch)
        own = np.repeat(np.arange(n), pieces)
        skipped = (np.arange(len(own)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * stretch
        begin = np.repeat(np.cumsum(size) - size, pieces) + skipped
        length = np.minimum(stretch, size[own] - skipped)
        order = np.argsort(-length, kind="stable")  # the stretches that are not at their end come first
        own, begin, length = own[order], begin[order], length[order]
        left = np.searchsorted(-length, -np.arange(int(length[0])), side="left")
        state = np.repeat(self.starts[:, None], len(own), axis=1)
        count = np.zeros((k, len(own)), dtype=np.int64)
        one = np.uint64(1)
        below = (one << np.arange(64, dtype=np.uint64)) - one
        for t, m in enumerate(left.tolist()):
            c = data[begin[:m] + t]
            now = state[:, :m]
            at = now * self.words + (c >> 6)
            bit = c & 63
            mask = np.take(self.masks, at)
            to = np.take(self.targets, np.take(self.base, at) + np.bitwise_count(mask & below[bit]))
            miss = np.flatnonzero(((mask >> bit.astype(np.uint64)) & one).ravel() == 0)
            if len(miss):
                i, j = np.divmod(miss, m)
                count[i, j] += (now[i, j] != self.starts[i]) + self.alone[i, c[j]]
                to[i, j] = self.root[i, c[j]]
            state[:, :m] = to
        count += state != self.starts[:, None]
        return np.stack([np.bincount(own, weights=x, minlength=n) for x in count], axis=1).astype(np.int64)


@dataclass(frozen=True)
class Model:
    languages: list[str]
    automata: Automata | None
    rates: np.ndarray  # phrases a byte of each language's own text
    params: Params

    def ratios(self, texts: list[bytes]) -> np.ndarray:
        """texts x languages: phrases needed, over those that a text of the language of that size needs."""
        size = np.array([max(1, len(t)) for t in texts], dtype=float)
        return self.automata.phrases(texts, self.params.stretch) / (size[:, None] * self.rates)


def fit(docs: DataFrame, allowed: Column, params: Params = Params()) -> Model:
    """Learn from docs(doc_id, text, lang) where `allowed` holds.

    Of each language the first rows by a hash of id and text are drawn, rows_per_language for its automaton and rate_rows for its
    rate by turns; these numbers of rows bound what is collected. Their texts are used whole.
    """
    short_batches(docs.sparkSession)
    wanted = params.rows_per_language + params.rate_rows
    rows = docs.where(allowed & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text", F.pmod(F.xxhash64("doc_id", "text"), F.lit(_DRAWS)).alias("h"))
    # the first rows lie below this hash (four times as many as wanted do): no language's rows meet in one task
    sizes = rows.groupBy("lang").agg(F.approx_count_distinct("h").alias("rows"))
    few = sizes.limit(_LANGUAGES + 1).count() <= _LANGUAGES
    drawn = rows.join(F.broadcast(sizes) if few else sizes, "lang").where(F.col("h") * F.col("rows") < 4 * wanted * _DRAWS).groupBy("lang", "h").agg(F.min("text").alias("text"))
    first = drawn.withColumn("at", F.row_number().over(Window.partitionBy("lang").orderBy("h"))).where(F.col("at") <= wanted)
    texts: dict[str, list[bytes]] = {}
    for r in sorted(first.select("lang", "at", "text").collect(), key=lambda r: (r.lang, r["at"])):
        if own := letters(r.text):
            texts.setdefault(r.lang, []).append(own)
    languages = sorted(texts)
    if not languages:
        return Model([], None, np.zeros(0), params)
    references = [b"".join(texts[k][::2]) for k in languages]
    automata = Automata(references)
    release()  # the driver keeps running: what the automata took as Python's objects is given back
    rates = np.full(len(languages), np.nan)
    for i, k in enumerate(languages):
        if others := texts[k][1::2]:
            rates[i] = automata.phrases(others, params.stretch)[:, i].sum() / sum(map(len, others))
    usual = np.nanmedian(rates) if np.isfinite(rates).any() else 0.125
    return Model(languages, automata, np.where(np.isfinite(rates), rates, usual), params)


def predict(docs: DataFrame, model: Model, carry: bool = False) -> DataFrame:
    """(doc_id, lang_pred, score, ratio, expected) of every row of docs(doc_id, text): one map, no shuffle.

    expected: phrases that a text of the language needs at this length; ratio: phrases needed here, over those (both null for `und`). score: the weight
    exp(-sharpness * ratio) of the language among all of them. With carry the other columns of docs come along (but for clashing names).
    """
    short_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    docs = docs if carry else docs.select("doc_id", "text")
    keep, kept_schema = carried(docs if carry else docs.select("doc_id"), ("lang_pred", "score", "ratio", "expected"))

    def make():
        own = shared.value
        names = np.array(own.languages, dtype=object)

        def work(batch: pa.RecordBatch):
            texts = [letters(t) for t in batch.column("text").to_pylist()]
            known = [i for i, t in enumerate(texts) if t] if len(names) else []
            pred, score = np.full(len(texts), UNDETERMINED, dtype=object), np.zeros(len(texts))
            ratio, expected = np.full(len(texts), np.nan), np.full(len(texts), np.nan)
            lo = 0
            while lo < len(known):
                hi, size = lo, 0
                while hi < len(known) and (hi == lo or size + len(texts[known[hi]]) <= own.params.batch_bytes):
                    size += len(texts[known[hi]])
                    hi += 1
                at, lo = known[lo:hi], hi
                r = own.ratios([texts[i] for i in at])
                best = r.argmin(axis=1)
                least = r[np.arange(len(at)), best]
                pred[at], ratio[at], expected[at] = names[best], least, own.rates[best] * [len(texts[i]) for i in at]
                score[at] = 1 / np.exp(own.params.sharpness * (least[:, None] - r)).sum(axis=1)
            yield {c: batch.column(c) for c in keep} | {"lang_pred": pred.tolist(), "score": score, "ratio": pa.array(ratio, from_pandas=True), "expected": pa.array(expected, from_pandas=True)}

        return work

    return map_rows(docs, make, f"{kept_schema}, lang_pred string, score double, ratio double, expected double")
