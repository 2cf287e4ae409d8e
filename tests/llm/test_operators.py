"""Each llm operator on small tables: against brute force, round trips, and the edge cases that its docstring defines."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from helixframe.llm import chat_formatting, decontamination, embedding_dedup, html_extraction, language_id, lm_scoring, mixing, ngram_jaccard, quality_classifier, url_filters
from helixframe.llm.common import BATCH_BYTES, Scratch, components, map_rows

DOC = "doc_id long, text string, score double, rep long"  # with columns whose names clash
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def docs(spark, rows):
    return spark.createDataFrame([(i, t, 0.5, 7) for i, t in rows], DOC)


def edge_rows():
    return [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "ONE"), (6, "x " * 3000), (None, "one"), (7, "!!! ### ...")]


def test_components(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(160)] + [(1000, 1000 + i) for i in range(1, 400)] + [(2000 + i, 2001 + i) for i in range(60)] + [(5, 5)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            ra, rb = find(a), find(b)
            parent[max(ra, rb)] = min(ra, rb)
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long"), Scratch(spark, "test")).collect()}
    assert got == {x: find(x) for x in parent}
    assert components(spark.createDataFrame([], "a long, b long"), Scratch(spark, "test")).count() == 0


def brute_jaccard(rows):
    sets = {}
    for i, t in rows:
        w = re.findall("[^\x20\x09-\x0D]+", (t or "").translate(LOWER))
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both, union = len(sets[a] & sets[b]), len(sets[a] | sets[b])
            if union and both and 100 * both >= 80 * union:
                ra, rb = find(a), find(b)
                parent[max(ra, rb)] = min(ra, rb)
    return {i: (len(sets[i]), find(i)) for i in ids}


def test_jaccard_join_is_exact(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefg") for _ in range(3))
    rows, n = [], 0
    passage = [word() for _ in range(60)]
    for _ in range(6):
        base = [word() for _ in range(rng.choice([6, 12, 40, 90]))]
        for _ in range(rng.randrange(2, 30)):
            own = list(base)
            for _ in range(rng.randrange(0, 4)):
                own[rng.randrange(len(own))] = word()
            rows.append((n, " ".join(own).upper() if n % 3 else " ".join(own)))
            n += 1
    for _ in range(30):  # a shared passage that makes no links by itself, and boundary cases around 80 %
        rows.append((n, " ".join(passage[: rng.randrange(20, 60)] + [word() for _ in range(rng.randrange(0, 30))])))
        n += 1
    rows += [(n + i, t) for i, t in enumerate([None, "", "one", "ONE", "one two", "a b c d e", "A\tb c\nd e", "a b c d e"])]
    want = brute_jaccard(rows)
    for p in (ngram_jaccard.Params(), ngram_jaccard.Params(chunk=3, sketch_bits=10, id_bits=10)):
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_jaccard.join(docs(spark, rows), p).collect()}
        assert got == want
    kept = {r.doc_id for r in ngram_jaccard.deduplicate(docs(spark, rows)).collect()}
    assert kept == {i for i, (_, c) in want.items() if i == c}


def test_jaccard_edges(spark):
    rows = [*edge_rows(), (4, "one"), (8, "one")]
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in ngram_jaccard.join(docs(spark, rows)).collect()]
    assert sorted(got, key=str) == sorted([(1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (5, 1, 4), (6, 1, 6), (7, 1, 7), (8, 1, 4), (None, 1, None)], key=str)
    assert ngram_jaccard.join(docs(spark, [])).count() == 0
    assert ngram_jaccard.deduplicate(docs(spark, rows)).columns == ["doc_id", "text", "score", "rep"]


def test_html(spark):
    menu = "<div>Home About Contact</div>"
    plain = lambda body: f"<html><body>{menu}<p>{body}</p><div>All rights reserved</div></body></html>"
    article = "<body><header>Top</header><nav>Menu</nav><div class='sidebar'>x</div><article><header><h1>T &amp; <b>b</b>c&nbsp;</h1></header><p>one<br>two\n three<div class='comments'><p>no</p></div><form>f<input></form><script>var a='</p>';</script><p>caf&eacute; &lt;3</article><footer>q"
    rows = [(1, "http://h/a/1", plain("first")), (2, "http://h/a/2", plain("second")), (3, "http://h/b", article), (4, None, None), (5, "nonsense", ""), (6, "http://z/", "a < b & c <"), (3, "http://h/b", article)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    got = [(r.page_id, r.text) for r in html_extraction.extract(pages).collect()]
    assert sorted(got) == [(1, "first"), (2, "second"), (3, "T & bc one two three café <3"), (3, "T & bc one two three café <3"), (4, ""), (5, ""), (6, "a < b & c <")]
    assert html_extraction.extract(pages.limit(0)).count() == 0


def test_longest_common_subsequence():
    rng = random.Random(3)
    for _ in range(400):
        a, b = ([rng.choice("abcd") for _ in range(rng.randint(0, 14))] for _ in range(2))
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
        own = [a[i] for i in sorted(html_extraction.shared_lines(a, b))]
        rest = iter(b)
        assert all(x in rest for x in own) and len(own) == t[-1][-1]
    a, b = [str(i % 7000) for i in range(12000)], [str(i % 6500) for i in range(12000)]
    own = [a[i] for i in sorted(html_extraction.shared_lines(a, b))]
    rest = iter(b)
    assert all(x in rest for x in own) and len(own) > 6000


def test_decontamination(spark):
    rng = random.Random(1)
    word = lambda: rng.choice(["alpha", "Beta", "gamma7", "déjà", "x"])
    items = [(i, " ".join(word() for _ in range(rng.choice([3, 9, 10, 14])))) for i in range(12)] + [(3, "short item"), (20, None), (21, "  "), (None, "alpha")]
    rows = edge_rows() + [(i, "-".join(word() for _ in range(rng.randrange(0, 60))) + ", " + (items[i % 12][1] if i % 3 else "")) for i in range(30, 70)]
    tokens = lambda t: re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (t or "").translate(LOWER))
    windows = {}
    for i, t in items:
        w = tokens(t)
        if w and i is not None:
            n = min(10, len(w))
            for k in range(len(w) - n + 1):
                windows.setdefault(tuple(w[k : k + n]), set()).add(i)
    want = []
    for i, t in rows:
        w, hit, found = tokens(t), set(), set()
        for k in range(len(w)):
            for n in range(1, 11):
                if own := windows.get(tuple(w[k : k + n]) if k + n <= len(w) else ()):
                    hit |= set(range(k, k + n))
                    found |= own
        want.append((i, len(w), len(hit), sorted(found)))
    bench = spark.createDataFrame(items, "item_id long, text string")
    for p in (decontamination.Params(), decontamination.Params(block_chars=60)):
        got = [(r.doc_id, r.n_words, r.n_hit, r.item_ids) for r in decontamination.scan(docs(spark, rows), bench, p).collect()]
        assert sorted(got, key=str) == sorted(want, key=str)
    kept = decontamination.decontaminate(docs(spark, rows), bench)
    assert kept.columns == ["doc_id", "text", "score", "rep"] and sorted((r.doc_id for r in kept.collect()), key=str) == sorted((w[0] for w in want if not w[2]), key=str)
    cut = decontamination.decontaminate(docs(spark, rows), bench, "cut")
    assert cut.count() == len(rows)
    assert decontamination.scan(cut.where("doc_id = 31"), bench).first().n_words == next(w[1] - w[2] for w in want if w[0] == 31)
    assert decontamination.scan(docs(spark, rows), bench.limit(0)).where("n_hit > 0").count() == 0


@pytest.mark.parametrize("cap", [2000, 12])
def test_embeddings_against_brute_force(spark, cap):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(60, 16))
    x = np.concatenate([base, base[:20] + 0.03 * rng.normal(size=(20, 16)), np.repeat(base[:1], 5, axis=0), base[1] + 0.06 * rng.normal(size=(40, 16))])
    rows = [(i, v.tolist(), i % 2 if i < 60 else (i - 60) % 2 if i < 80 else 0) for i, v in enumerate(x)]
    for i in range(80, len(x)):
        rows[i] = (i, x[i].tolist(), 0 if i < 85 else 1)
    special = [(500, None, 0), (501, [0.0] * 16, 0), (502, [float("nan")] * 16, 0), (503, [None] + [1.0] * 15, 0), (504, [1.0] * 16, None), (505, [], 0), (506, [float("inf")] + [1.0] * 15, 0), (507, [1.0] * 3, 0), (None, [1.0] * 16, 0)]
    df = spark.createDataFrame(rows + special, "vec_id long, embedding array<double>, label int").withColumn("rep", F.lit(1))
    p = embedding_dedup.Params(shard_cap=cap, block=5, shard_target=40)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embedding_dedup.link(df, p).collect()}
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    label = np.array([r[2] for r in rows])
    near = (u @ u.T >= 0.98) & (label[:, None] == label[None, :])
    np.fill_diagonal(near, False)
    component = np.arange(len(x))
    for _ in range(len(x)):
        component = np.minimum(component, np.where(near, component[None, :], 10**6).min(axis=1))
    assert {i: got[i][0] for i in range(len(x))} == dict(enumerate(near.sum(axis=1).tolist()))
    assert {i: got[i][1] for i in range(len(x))} == dict(enumerate(component.tolist()))
    assert all(got[i] == (0, i, True) for i in range(500, 508)) and got[None][:2] == (0, None)
    assert embedding_dedup.audit(df, embedding_dedup.link(df, p), p, every=1) == (near.sum(), near.sum())
    assert embedding_dedup.link(df.limit(0), p).count() == 0


def test_embedding_shards_are_cut_until_small(spark):
    rng = np.random.default_rng(6)
    base = rng.normal(size=(500, 12))
    x = np.concatenate([base, base[:150] + 0.03 * rng.normal(size=(150, 12)), base[0] + 0.02 * rng.normal(size=(80, 12))])
    rows = [(i, v.tolist(), "a/1" if i % 3 else "a") for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    label = np.array([r[2] for r in rows])
    near = (u @ u.T >= 0.98) & (label[:, None] == label[None, :])
    np.fill_diagonal(near, False)
    seen = []
    for budget in (1 << 20, 0):
        p = embedding_dedup.Params(shard_cap=40, shard_target=8, fan=8, block=10, broadcast_bytes=budget)
        scratch = Scratch(spark, "test")
        v = df.select(F.struct("label", F.size("embedding").alias("dim")).alias("g"), F.col("vec_id").alias("rep"), F.lit(1).cast("long").alias("m"), F.col("embedding").alias("x"))
        placed, sizes = embedding_dedup._placed(v, scratch, p)
        size = {r.shard: r["size"] for r in sizes.collect()}
        # cut more than once; what is left over the cap is a cluster that no cut makes smaller
        assert max(s.count("/") for s in size) >= 2
        assert placed.count() == len(x) and sum(len(r.shards) for r in placed.collect()) == sum(size.values())
        got = {r.vec_id: r for r in embedding_dedup.link(df, p).collect()}
        found, there = sum(r.n_links for r in got.values()), int(near.sum())
        assert 0.95 * there <= found <= there
        assert all(got[i].n_links <= near[i].sum() for i in range(len(x)))
        seen.append({i: (r.n_links, r.component_id) for i, r in got.items()})
    assert seen[0] == seen[1]


def test_embedding_searches_side_by_side(spark):
    """Searches of a shard take their steps together and find what each finds alone; a vector is scaled in one pass over its parts."""
    rng = np.random.default_rng(8)
    base = rng.normal(size=(150, 16))
    x = embedding_dedup.unit(np.concatenate([base, base[:60] + 0.04 * rng.normal(size=(60, 16)), base[0] + 0.05 * rng.normal(size=(70, 16))]))
    p, n = embedding_dedup.Params(), len(x)
    i, j = embedding_dedup.robust_prune(x, p)
    links = set(zip(i.tolist(), j.tolist()))
    for a in range(n):  # row by row
        row = np.argsort(-np.delete(x @ x[a], a), kind="stable")[: p.candidates]
        row = row + (row >= a)
        alive, kept = np.ones(len(row), dtype=bool), []
        for c in range(len(row)):
            if alive[c] and len(kept) < p.degree:
                kept.append(int(row[c]))
                alive &= p.alpha * (1 - x[row] @ x[row[c]]) > 1 - x[row] @ x[a]
        assert {b for f, b in links if f == a} == set(kept)
    both = np.unique(np.concatenate([i * n + j, j * n + i]))
    graph = (np.searchsorted(both, np.arange(n + 1) * n), both % n)
    pairs = lambda queries: {(int(queries[q]), int(h)) for q, h in zip(*embedding_dedup.range_search(x, graph, 3, queries, p))}
    together = pairs(np.arange(n))
    assert together == set().union(*(pairs(np.array([q])) for q in range(n)))
    near = x @ x.T >= p.cosine
    np.fill_diagonal(near, False)
    assert together == set(zip(*(a.tolist() for a in np.nonzero(near))))
    assert embedding_dedup.robust_prune(x[:1], p)[0].size == 0
    alone = (np.zeros(2, dtype=np.int64), np.zeros(0, dtype=np.int64))
    assert embedding_dedup.range_search(x[:1], alone, 0, np.arange(1), p)[0].size == 0
    forest = embedding_dedup._stars(near)
    assert {tuple(sorted(e)) for e in forest} <= {(a, b) for a in range(n) for b in range(a, n)} and len({b for _, b in forest}) == len(forest)
    df = spark.createDataFrame([([3.0, -4.0, 0.0],), ([1e-300, 1e-300, 0.0],)], "e array<double>").select(embedding_dedup.scaled("e").alias("x"))
    assert [r.x for r in df.collect()] == [[0.75, -1.0, 0.0], [1.0, 1.0, 0.0]]
    plan = embedding_dedup.link(spark.createDataFrame([(1, [3.0, 4.0], 0), (2, [3.0, 4.1], 0)], "vec_id long, embedding array<double>, label int"))._jdf.queryExecution().optimizedPlan().toString()
    assert "array_max" in plan and "/ array_max" not in plan  # not once more for every part


def test_url_filters(spark):
    day = lambda n: F.expr(f"timestamp'2024-01-01' + make_interval(0, 0, 0, {n})")
    entries = spark.createDataFrame([("a", "host", "bad.org", "add", 10), ("a", "host", "bad.org", "remove", 20), ("a", "host", "bad.org", "add", 30), ("b", "prefix", "ok.com/x/y", "add", 0), ("b", "host", None, "add", 0), ("c", "host", "bad.org", "add", 40), ("c", "host", "bad.org", "remove", 40), ("d", "host", "q.net", "purge", 0)], "list string, kind string, key string, action string, d int")
    entries = entries.withColumn("since", F.expr("timestamp'2024-01-01' + make_interval(0, 0, 0, d)"))
    rows = [("http://bad.org/", 9), ("http://bad.org/", 10), ("https://u@www.BAD.org:80/p?q", 19), ("http://bad.org", 20), ("http://bad.org", 45), ("http://notbad.org", 45), ("http://ok.com/x/y/z", 5), ("http://ok.com/x/yz", 5), (None, 5), ("bad.org", 45), ("http://bad.org/", None), ("http://q.net", 3), ("http://bad.org/", 10)]
    captures = spark.createDataFrame(rows, "url string, d int").withColumn("fetched_at", F.expr("timestamp'2024-01-01' + make_interval(0, 0, 0, d)")).withColumn("lists", F.lit("old"))
    got = sorted((str(r.url), str(r.d), r.lists, r.n_entries, r.blocked) for r in url_filters.evaluate(captures, entries).collect())
    hit = {("http://bad.org/", "10"): "a", ("https://u@www.BAD.org:80/p?q", "19"): "a", ("http://bad.org", "45"): "a", ("http://ok.com/x/y/z", "5"): "b"}
    want = sorted((str(u), str(d), hit.get((str(u), str(d)), ""), int((str(u), str(d)) in hit), (str(u), str(d)) in hit) for u, d in rows)
    assert got == want
    assert url_filters.evaluate(captures, entries.limit(0)).where("blocked").count() == 0
    del day


def test_url_filter_keys_are_brought_to_one_form(spark):
    events = [("a", "host", "Bad.org", "add", 1), ("a", "host", "bad.org.", "remove", 5), ("p", "prefix", "OK.com./X//y/", "add", 1), ("p", "prefix", "ok.com/X/y", "remove", 9), ("q", "prefix", "ok.com/x", "add", 1), ("r", "prefix", "solo.net", "add", 1)]
    frame = spark.createDataFrame(events, "list string, kind string, key string, action string, d int").withColumn("since", F.timestamp_seconds(F.col("d") * 86400))
    rows = [("http://www.BAD.org./", 2, "a"), ("http://bad.org", 6, ""), ("http://ok.com/X/y/z", 3, "p"), ("http://ok.com/x/y", 3, "q"), ("http://ok.com/X//y?a=/x", 3, "p"), ("http://ok.com/X/y", 9, ""), ("http://ok.com/" + "x/" * 500, 2, "q")]
    captures = spark.createDataFrame(rows, "url string, d int, want string").withColumn("fetched_at", F.timestamp_seconds(F.col("d") * 86400))
    assert [(r.url, r.lists) for r in url_filters.evaluate(captures, frame).where("lists <> want").collect()] == []
    # whole operator against loops
    rng, day = random.Random(3), 86400
    events = [(rng.choice("ab"), "host", rng.choice(["x.org", "Y.x.org", "z.net"]), rng.choice(["add", "remove"]), rng.randrange(20)) for _ in range(60)]
    rows = [(i, f"http://{rng.choice(['', 'y.', 'Q.y.'])}{rng.choice(['x.org', 'z.net'])}/p", rng.randrange(20)) for i in range(80)]
    frame = spark.createDataFrame(events, "list string, kind string, key string, action string, d int").withColumn("since", F.timestamp_seconds(F.col("d") * day))
    captures = spark.createDataFrame(rows, "page_id int, url string, d int").withColumn("fetched_at", F.timestamp_seconds(F.col("d") * day))
    got = {r.page_id: r.lists for r in url_filters.evaluate(captures, frame).collect()}
    for i, url, t in rows:
        host, on = url.split("/")[2].lower(), set()
        for name in "ab":
            for key in {e[2].lower() for e in events}:
                past = [(d, action) for x, _, k, action, d in events if x == name and k.lower() == key and d <= t]
                if past and max(past)[1] == "add" and (host == key or host.endswith("." + key)):
                    on.add(name)
        assert got[i] == ",".join(sorted(on))


def test_lm_scores(spark):
    rng = random.Random(2)
    vocabulary = ["".join(rng.choice("abcdeé") for _ in range(rng.randrange(2, 7))) for _ in range(80)]
    text = lambda: " ".join(rng.choice(vocabulary[: rng.choice([10, 80])]).title() for _ in range(rng.randrange(5, 80)))
    rows = [(i, text()) for i in range(120)] + [(500, None), (501, ""), (502, "zzz qqq " * 400)]
    df = docs(spark, rows)
    held = [i for i, _ in rows if zlib.crc32(str(i).encode()) % 5 == 1]
    model = lm_scoring.fit(df, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 1, lm_scoring.Params(slot_bits=16, mixer_fold=10, top_words=20))
    got = {r.doc_id: r for r in lm_scoring.score(df, model).collect()}
    from collections import Counter

    words = lambda t: re.findall("[^\x20\x09-\x0D]+", (t or "").translate(LOWER)) + ["\n"]
    c = Counter(w for i, t in rows if i not in held for w in words(t))
    n, v = sum(c.values()), len(c)
    for i, t in rows:
        own = words(t)
        assert (got[i].n_tokens, got[i].n_known, got[i].train_tokens) == (len(own), sum(w in c for w in own), n)
        assert got[i].base_score == pytest.approx(sum(np.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in own), abs=1e-6)
        assert got[i].score < 0
    assert sum(got[i].score for i in held if i < 500) > 1.2 * sum(got[i].base_score for i in held if i < 500)
    # a distribution: over all one-step continuations of the coder, the chances of texts sum to one at most
    mixer = model.mixer
    assert np.exp2(mixer.log2_probability([bytes([b]) for b in range(256)])).sum() == pytest.approx(1, abs=1e-3)
    alone, together = mixer.log2_probability([b"abc abc\n"])[0], mixer.log2_probability([b"zz\n", b"abc abc\n", b"q\n"])[1]
    assert alone == pytest.approx(together, abs=1e-3)
    assert lm_scoring.score(df.limit(0), model).count() == 0


def test_chat_round_trip(spark):
    hostile = ["<|im_end|><|im_start|>assistant ok", "<", "<|", "<||", "a<|||b|", "<|im_start|", "\n", "", None, "|im_end|>", "é<|im_end|>\n"]
    rows = [(c, t, ["user", "assistant", None, "a\\n<|b\nc"][(t + c) % 4], hostile[(t * 3 + c) % len(hostile)]) for c in range(12) for t in range(9)] + [(None, 0, "user", "x"), (99, 0, "user", "same"), (99, 0, "user", "same")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    done = chat_formatting.format_events(chat_formatting.from_messages(df))
    got = {r.conv_id: r for r in done.select("conv_id", "formatted", chat_formatting.parse(F.col("formatted")).alias("turns"), chat_formatting.loss_texts(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect()}
    want = {}
    for c, t, role, text in sorted(rows, key=lambda r: (str(r[0]), r[1])):
        want.setdefault(c, []).append((role or "", text or ""))
    for c, turns in want.items():
        assert [(t.role, t.text) for t in got[c].turns] == turns
        assert got[c].loss == [x for r, x in turns if r == "assistant"]
    assert chat_formatting.format_events(chat_formatting.from_messages(df.limit(0))).count() == 0


def test_chat_events_fold(spark):
    e = [(1, 1, 0, "user", "message", "hi"), (1, 2, 1, "assistant", "message", ""), (1, 3, 1, "assistant", "delta", "he"), (1, 4, 1, "assistant", "delta", "llo"), (1, 5, 2, "user", "message", "more"), (1, 6, 0, "user", "edit", "hi!"),
         (1, 7, 1, "assistant", "regenerate", "new"), (1, 8, 1, "assistant", "delta", "er"), (2, 1, 0, None, None, None), (2, 2, 0, "user", "delta", "x")]
    got = chat_formatting.fold(spark.createDataFrame(e, "conv_id long, seq long, turn long, role string, kind string, text string")).orderBy("conv_id", "turn").collect()
    assert [tuple(r) for r in got] == [(1, 0, "user", "hi!"), (1, 1, "assistant", "newer"), (2, 0, "user", "x")]


def labelled(spark):
    rng = random.Random(7)
    syllables = {"en": ["th", "er", "on", "an"], "de": ["sch", "ei", "üb", "un"]}
    def good(lang):  # noqa: E301
        return " ".join("".join(rng.choice(syllables[lang]) for _ in range(rng.randrange(1, 5))) for _ in range(rng.randrange(20, 120)))
    rows = []
    for i in range(240):
        lang = ["en", "de"][i % 2]
        text = good(lang) if i % 4 else " ".join(f"{w.upper()}!!" for w in good(lang).split())
        rows.append((i, text, lang, 0 if i % 4 == 0 else 1))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, quality int")


def crc(name, n):
    return F.crc32(F.col(name).cast("string").cast("binary")) % n


def greedy(text, ref):
    """Longest matches that cover the text, by search alone."""
    n = i = 0
    while i < len(text):
        k = i
        while k < len(text) and text[i : k + 1] in ref:
            k += 1
        i, n = max(k, i + 1), n + 1
    return n


def test_language_id(spark):
    df = labelled(spark)
    allowed = crc("doc_id", 4) != 2
    p = language_id.Params(rows_per_language=20, rate_rows=20, stretch=200)
    model = language_id.fit(df, allowed, p)
    got = df.join(language_id.predict(df, model), "doc_id")
    assert got.where("lang = lang_pred and score between 0.5 and 1").count() / got.count() > 0.98
    # the whole operator against a search in the references it draws: the first rows by hash, by turns
    rows = df.where(allowed).select("lang", "text", F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)).alias("h")).collect()
    refs, rates = {}, {}
    for lang in ("de", "en"):
        texts = [language_id.letters(r.text) for r in sorted((r for r in rows if r.lang == lang), key=lambda r: r.h)][:40]
        refs[lang] = b"".join(texts[::2])
        rates[lang] = sum(greedy(t[i : i + 200], refs[lang]) for t in texts[1::2] for i in range(0, len(t), 200)) / sum(map(len, texts[1::2]))
    for r in got.where("doc_id < 24").collect():
        own = language_id.letters(r.text)
        ratio = {k: sum(greedy(own[i : i + 200], refs[k]) for i in range(0, len(own), 200)) / len(own) / rates[k] for k in refs}
        best = min(ratio, key=lambda k: (ratio[k], k))
        assert r.lang_pred == best and r.ratio == pytest.approx(ratio[best])
        assert r.score == pytest.approx(1 / sum(np.exp(4 * (ratio[best] - x)) for x in ratio.values()))
    edge = {r.doc_id: (r.lang_pred, r.score) for r in language_id.predict(docs(spark, edge_rows() + [(8, "²³"), (9, "日本"), (10, "ther" * 9000)]), model).collect()}
    assert all(edge[i] == ("und", 0.0) for i in (1, 2, 3, 7, 8)) and edge[9][0] in ("de", "en") and edge[10][0] == "en"
    # repeated rows and clashing names; a row that fills the table counts once in learning
    clash = df.withColumns({"score": F.lit("old"), "expected": F.lit("old")})
    again = language_id.predict(clash.unionByName(clash), model, carry=True)
    assert again.columns == ["doc_id", "text", "lang", "quality", "lang_pred", "score", "ratio", "expected"]
    assert again.distinct().count() == 240 and again.count() == 480
    many = df.unionByName(df.where("doc_id = 0").crossJoin(spark.range(500).select()))
    assert language_id.fit(many, allowed, p).languages == ["de", "en"] and np.allclose(language_id.fit(many, allowed, p).rates, model.rates)
    # ties go to the first name
    twins = df.where("lang = 'en'").select("doc_id", "text", F.explode(F.array(F.lit("x"), F.lit("w"))).alias("lang"))
    assert {r.lang_pred for r in language_id.predict(df, language_id.fit(twins, allowed, p)).collect()} == {"w"}
    empty = language_id.fit(df.limit(0), allowed)
    assert {(r.lang_pred, r.ratio) for r in language_id.predict(df, empty).collect()} == {("und", None)}
    one = language_id.fit(df.where("doc_id = 1"), F.lit(True))
    assert {r.lang_pred for r in language_id.predict(df, one).collect()} == {"de"}


def test_suffix_automaton_phrases():
    rng = random.Random(1)
    letters = bytes(range(60, 200))
    refs = [b"abcabd ca", bytes(rng.choice(letters) for _ in range(3000)), bytes(rng.choice(b"ab") for _ in range(300))]
    automata = language_id.Automata(refs)
    texts = [bytes(rng.choice(rng.choice([b"abcdx ", letters, b"ab\xff"])) for _ in range(rng.randrange(0, 40))) for _ in range(200)]
    texts += [refs[1][i : i + 90] for i in range(0, 900, 90)]
    for stretch in (7, 4096):
        got = automata.phrases(texts, stretch)
        for t, row in zip(texts, got.tolist()):
            assert row == [sum(greedy(t[i : i + stretch], r) for i in range(0, len(t), stretch)) for r in refs]
    assert automata.phrases([b"", b""], 5).tolist() == [[0] * 3] * 2


def test_quality_classifier(spark):
    df = labelled(spark)
    allowed = crc("doc_id", 5) != 0
    p = quality_classifier.Params(dictionary_rows=20, block_bytes=300)
    model = quality_classifier.fit(df.select("doc_id", "text"), df.select("doc_id", "quality"), allowed, p)
    got = df.join(quality_classifier.score(df.select("doc_id", "text"), model), "doc_id")
    assert got.where(~allowed).where("quality = predicted").count() / got.where(~allowed).count() > 0.95
    # the whole operator again, from plain lists
    import zstandard as z

    rows = {r.doc_id: r for r in df.where(allowed).select("*", F.xxhash64("doc_id").alias("h")).collect()}
    half = sorted((r for r in rows.values() if r.h % 2 == 0), key=lambda r: r.h)
    of = [[r for r in half if r.quality == y] for y in (1, 0)]
    n = min(20, *map(len, of))
    content = ["\n".join(r.text for r in sorted(x[:n], key=lambda r: r.h)).encode() for x in of]
    assert (model.good, model.bad) == tuple(content)
    packers = []
    for c in content:
        bits = max(17, len(c).bit_length() - 1)
        o = z.ZstdCompressionParameters.from_level(3, dict_size=len(c), window_log=max(19, len(c).bit_length() + 1), hash_log=bits, chain_log=bits, write_checksum=0, write_content_size=0)
        packers.append(z.ZstdCompressor(dict_data=z.ZstdCompressionDict(c, dict_type=z.DICT_TYPE_RAWCONTENT), compression_params=o))
    def row(t):  # noqa: E301
        raw = t.encode()
        good, bad = (sum(len(k.compress(raw[i : i + 300])) for i in range(0, len(raw), 300)) for k in packers)
        m = max(1, len(raw))
        return [(bad - good) / m, np.log(m), (bad - good) / m * np.log(m), (bad + good) / m]
    fit = [r for r in rows.values() if r.h % 2]
    x, y = np.array([row(r.text) for r in fit]), np.array([r.quality for r in fit], dtype=float)
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    w = np.zeros(5)
    d = np.column_stack([np.ones(len(x)), (x - mean) / scale])
    for _ in range(20_000):  # plain gradient ascent on the same ridge objective
        w += 0.02 * (d.T @ (y - 1 / (1 + np.exp(-d @ w))) - w)
    for r in got.where("doc_id < 40").collect():
        assert r.score == pytest.approx(1 / (1 + np.exp(-(w[0] + ((np.array(row(r.text)) - mean) / scale) @ w[1:]))), abs=2e-3)
    edge = quality_classifier.score(docs(spark, edge_rows() + [(8, "word " * 200_000)]), model).collect()
    assert len(edge) == 9 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in edge)
    assert len({r.score for r in edge if r.doc_id in (1, 2)}) == 1
    carried = quality_classifier.score(docs(spark, edge_rows()), model, carry=True)
    assert carried.columns == ["doc_id", "text", "rep", "score", "predicted"]
    # repeated ids, in documents and labels, are learned from once
    twice = quality_classifier.fit(df.select("doc_id", "text").unionByName(df.select("doc_id", "text")), df.select("doc_id", "quality").unionByName(df.select("doc_id", "quality")), allowed, p)
    assert twice.good == model.good and np.allclose(twice.weights, model.weights)
    nothing = quality_classifier.fit(df.limit(0), df.select("doc_id", "quality").limit(0), allowed)
    assert {r.score for r in quality_classifier.score(df, nothing).collect()} == {0.5}


def test_mixing_meets_targets(spark):
    df = labelled(spark)
    domains = df.select("doc_id", F.when(F.col("quality") == 0, "poor").otherwise("clean").alias("domain"))
    got = mixing.rates(df.select("doc_id", "text"), domains, {"clean": 0.9, "poor": 0.1})
    share = {r.domain: r.share for r in mixing.totals(got, ["clean", "poor"]).collect()}
    assert share == {"clean": pytest.approx(0.9, rel=1e-5), "poor": pytest.approx(0.1, rel=1e-5)}
    assert got.where("rate < 0").count() == 0
    told = got.join(domains, "doc_id").toPandas()
    assert ((told.p_poor > 0.5) == (told.domain == "poor")).mean() > 0.98
    # brute force: the same descent in NumPy, with clipping at work, and rates written between steps
    n, p = np.array([10.0, 20, 30, 40]), np.array([[0.9, 0.1], [0.5, 0.5], [0.1, 0.9], [0.3, 0.7]])
    frame = spark.createDataFrame([(int(a), b) for a, b in zip(n, p.tolist())], "n_tokens long, posterior array<double>")
    inverse = np.linalg.inv((p * n[:, None]).T @ p)
    for fold in (2, 16):
        steps, reached = mixing.fit_rates(frame, {"a": 90.0, "b": 15.0}, ["a", "b"], mixing.Params(fold=fold))
        r = np.ones(4)
        for _ in steps:
            r = np.maximum(0, r - p @ (inverse @ ((n * r) @ p - [90, 15])))
        assert np.allclose(reached, (n * r) @ p, atol=1e-6) and (r == 0).any()
        for _ in range(2000):
            r = np.maximum(0, r - p @ (inverse @ ((n * r) @ p - [90, 15])))
        assert np.allclose(reached, (n * r) @ p, rtol=1e-4)
    with pytest.warns(UserWarning, match="no rates reach"):
        mixing.fit_rates(frame, {"a": 100.0}, ["a", "b"])
    with pytest.raises(RuntimeError):
        mixing.fit_rates(frame, {"a": 90.0, "b": 15.0}, ["a", "b"], mixing.Params(iterations=1))
    mixed = mixing.mix(docs(spark, edge_rows() + [(4, "one"), (8, "long " * 200_000)]), domains.limit(0), {"clean": 1.0})
    assert mixed.count() == 10 and {"doc_id", "text", "score", "rep", "n_tokens", "rate"} <= set(mixed.columns)
    assert len({r.rate for r in mixed.where("doc_id = 4").collect()}) == 1 and mixed.where("rate is null").count() == 0
    assert mixing.rates(df.limit(0), domains, {"clean": 1.0}).count() == 0
    with pytest.raises(ValueError):
        mixing.fit_rates(frame, {"a": -1.0}, ["a", "b"])


def test_trigrams():
    slots, value = mixing.trigrams("abcabcabd")
    assert len(slots) == 4 and (value**2).sum() == pytest.approx(1) and sorted((value**2 * 7).round().tolist()) == [1, 2, 2, 2]
    assert len(mixing.trigrams("ab")[0]) == len(mixing.trigrams(None)[0]) == 0


def test_digest_of_no_items():
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0c442")


def test_lm_tables_grow_with_the_contexts(spark):
    rng = random.Random(9)
    rows = [(i, " ".join("".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(60))) for i in range(120)]
    p = lm_scoring.Params(slot_bits=8, mixer_fold=10)
    sizes = []
    for n in (30, 120):
        model = lm_scoring.fit(docs(spark, rows[:n]), F.lit(True), p)
        kept = [lm_scoring.stream(lm_scoring.tokens(t)) for _, t in rows[:n]]
        _, _, keys, _ = lm_scoring.events(kept, model.mixer.trees, [32] * lm_scoring.CONTEXTS)
        sizes.append([2 ** t.bits for t in model.mixer.tables])
        assert all(s >= len(np.unique(k)) for s, k in zip(sizes[-1], keys))
    assert all(a < b for a, b in list(zip(*sizes))[1:])  # three bytes before are few contexts here


def test_lm_learns_from_every_text(spark, monkeypatch):
    rows = [(i, f"word{i % 7} other{i % 5} " * 6) for i in range(40)] + [(1000 + i, f"qxz{i}jvk " * 5000) for i in range(12)]
    fitted = []
    real = lm_scoring.fit_weights
    monkeypatch.setattr(lm_scoring, "fit_weights", lambda texts, mixer, p: (fitted.append((sorted(r.text for r in texts.collect()), [t.open().copy() for t in mixer.tables], mixer)), real(texts, mixer, p))[1])
    p = lm_scoring.Params(slot_bits=16, mixer_fold=3)
    model = lm_scoring.fit(docs(spark, rows), F.lit(True), p)
    # the mixer's part: all of its texts, whole; its tables lack them
    (apart, without, first), = fitted
    part = {r.doc_id for r in docs(spark, rows).where(F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0).collect()}
    assert apart == sorted(t for i, t in rows if i in part) and 5 < len(apart) < 47 and max(map(len, apart)) > 20_000
    missing = 0
    for i, t in rows:
        _, _, slots, _ = lm_scoring.events([lm_scoring.stream(lm_scoring.tokens(t))], model.mixer.trees, [x.bits for x in model.mixer.tables])
        assert all((x.open()[s] & 3 > 0).all() for x, s in zip(model.mixer.tables, slots))  # whole tables: every text's contexts
        _, _, slots, _ = lm_scoring.events([lm_scoring.stream(lm_scoring.tokens(t))], model.mixer.trees, [x.bits for x in first.tables])
        seen = all((x[s] & 3 > 0).all() for x, s in zip(without, slots))
        missing += not seen
        assert seen or i in part
    assert missing


def test_lm_work_stays_in_small_arrays(spark, monkeypatch):
    """Decisions are looked up a chunk of text at a time, whatever is scored together; the sums of a fit are those of plain loops; counts meet as whole numbers."""
    rng = random.Random(11)
    rows = [(i, " ".join(rng.choice(["tide", "harbour", "le", "phare", "salt", "éclat"]) for _ in range(rng.choice([0, 3, 40, 300])))) for i in range(60)]
    p = lm_scoring.Params(slot_bits=12, mixer_fold=5, chunk_bytes=700)
    mixer = lm_scoring.fit(docs(spark, rows), F.lit(True), p).mixer
    texts = [lm_scoring.stream(lm_scoring.tokens(t)) for _, t in rows]
    alone = [float(mixer.log2_probability([t])[0]) for t in texts]
    met, real = [], lm_scoring.Mixer.inputs
    monkeypatch.setattr(lm_scoring.Mixer, "inputs", lambda self, part, segment=1: (met.append(part), real(self, part, segment))[1])
    assert np.allclose(mixer.log2_probability(texts), alone, rtol=1e-6)
    assert sorted(t for part in met for t in part) == sorted(texts) and all(len(part) == 1 or sum(map(len, part)) <= p.chunk_bytes for part in met)
    number, gradient, curvature = mixer.sums(texts)
    _, sign, x, gate, _ = real(mixer, texts)
    for g in range(lm_scoring._GATES):
        at = gate == g
        y, own = sign[at].astype(float), x[:, at].astype(float)
        e = 1 / (1 + np.exp(np.clip(y * (mixer.weights[g].astype(float) @ own), -30, 30)))
        assert number[g] == at.sum() and np.allclose(gradient[g], own @ (y * e)) and np.allclose(curvature[g], (own * (e * (1 - e) + 1e-4)) @ own.T)
    most = 2**32 - 1
    keys, counts = np.array([7, most, 0, 7, most], dtype=np.uint32), np.array([most, 1, 2, 1, 5], dtype=np.uint32)
    got = lm_scoring._sums_of(np.sort(lm_scoring._both(keys, counts)))
    assert [a.tolist() for a in got] == [[0, 7, most], [2, most, 6]] and [a.tolist() for a in lm_scoring.summed(keys, counts)] == [a.tolist() for a in got]
    assert all((a == b).all() for a, b in zip((keys, counts), lm_scoring._columns(lm_scoring._planes(keys, counts), 2)))


def test_lm_weights_are_a_fit_over_all_texts(spark, monkeypatch):
    rng = random.Random(12)
    rows = [(i, " ".join(rng.choice(["alpha", "beta", "gamma", "delta", "omega"])[: rng.randrange(2, 6)] for _ in range(40))) for i in range(80)]
    p = lm_scoring.Params(slot_bits=16, mixer_fold=4, newton_steps=30, newton_least=1e-9)
    seen = []
    real = lm_scoring.fit_weights
    def spy(texts, mixer, p):  # noqa: E301
        mixer.weights = np.zeros((64, 4), dtype=np.float32)
        got = [mixer.inputs([lm_scoring.stream(lm_scoring.tokens(r.text))])[1:4] for r in texts.collect()]
        seen.append([np.concatenate(x, axis=-1) for x in zip(*got)])
        return real(texts, mixer, p)
    monkeypatch.setattr(lm_scoring, "fit_weights", spy)
    weights = lm_scoring.fit(docs(spark, rows), F.lit(True), p).mixer.weights
    (sign, x, gate), = seen
    def plain(x, y, start, pull):  # noqa: E301
        w = start.copy()
        for _ in range(60):
            e = 1 / (1 + np.exp(y * (w @ x)))
            w += np.linalg.solve((x * (e * (1 - e) + 1e-4)) @ x.T + pull * np.eye(4), x @ (y * e) - pull * (w - start))
        return w
    x, sign = x.astype(float), sign.astype(float)
    common = plain(x, sign, np.full(4, 0.3), 1.0)
    for g in range(64):
        own = gate == g
        assert np.allclose(weights[g], plain(x[:, own], sign[own], common, 20.0) if own.any() else common, atol=1e-3)


def test_lm_weights_are_carried_through_a_text(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice(["alpha", "beta", "gamma", "delta"]) for _ in range(60))) for i in range(60)]
    mixer = lm_scoring.fit(docs(spark, rows), F.lit(True), lm_scoring.Params(slot_bits=16, mixer_fold=10)).mixer
    texts = [lm_scoring.stream([bytes(rng.choice(b"qwxyz") for _ in range(4)) for _ in range(n)]) for n in (2, 3000, 40, 41, 0)]
    got = mixer.log2_probability(texts)
    for text, bits in zip(texts, got):
        _, sign, s, gate, _ = mixer.inputs([text])
        delta, want = np.zeros(lm_scoring.INPUTS), 0.0
        for i in range(0, len(sign), 64):  # step by step, with no restart
            x = s[:, i : i + 64].astype(float) * sign[i : i + 64]
            z = np.clip(((mixer.weights[gate[i : i + 64]].T + delta[:, None]) * x).sum(axis=0), -15, 15)
            want -= np.log2(1 + np.exp(-z)).sum()
            delta += mixer.params.rate / 8 * (x / (1 + np.exp(z))).sum(axis=1)
        assert bits == pytest.approx(want, rel=1e-3, abs=1e-2)


def test_lm_rare_words_of_repeated_and_null_ids(spark):
    rows = [(i, f"common rare{i} rare{i + 1}") for i in range(30)]
    odd = [(3, "rare5 common rare6"), (3, "rare7 rare7"), (3, "rare7 rare7"), (None, "rare9 common unseen"), (None, None), (200, "rare7 rare7")]
    model = lm_scoring.fit(docs(spark, rows), F.lit(True), lm_scoring.Params(slot_bits=12, top_words=3))
    counts = {"common": 30, "\n": 30, "rare0": 1, "rare30": 1} | {f"rare{i}": 2 for i in range(1, 30)}
    n, v = sum(counts.values()), len(counts)
    got = sorted((str(r.doc_id), r.n_tokens, r.n_known, round(r.base_score, 6)) for r in lm_scoring.score(docs(spark, rows + odd), model).collect())
    own = [(i, [*(t or "").split(), "\n"]) for i, t in rows + odd]
    want = sorted((str(i), len(w), sum(x in counts for x in w), round(sum(np.log10((counts.get(x, 0) + 0.5) / (n + 0.5 * (v + 1))) for x in w), 6)) for i, w in own)
    assert [g[:3] for g in got] == [w[:3] for w in want] and [g[3] for g in got] == pytest.approx([w[3] for w in want], abs=1e-5)


def test_html_copies_and_partitions(spark):
    page = lambda body: f"<body><div>Home About</div><p>{body}</p><div>Rights</div></body>"
    rows = [(i, f"http://h/a/{i:02d}", page(f"body {i // 3}")) for i in range(12)] + [(50, "http://two/1", page("x")), (51, "http://two/2", page("y")), (60, "http://same/1", page("z")), (61, "http://same/1", page("z"))]
    want = sorted([(i, f"body {i // 3}") for i in range(12)] + [(50, "x"), (51, "y"), (60, "Home About z Rights"), (61, "Home About z Rights")])
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in (1, 3, 16):
            spark.conf.set("spark.sql.shuffle.partitions", str(n))
            got = html_extraction.extract(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(n)).collect()
            assert sorted((r.page_id, r.text) for r in got) == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def plain_extract(rows):
    """The operator by plain lists: a host's pages in order, the nearest page on either side whose lines differ, a textbook LCS."""
    place = lambda u: re.match(r"[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)([^?#]*)", u or "")
    cut = {}
    for k, (i, u, h) in enumerate(rows):
        m = place(u)
        texts, kinds = html_extraction.lines(h)
        raw = "\n".join(texts).encode()
        digest = hashlib.sha256(raw).digest()[:16] + hashlib.sha256(bytes(kinds)).digest()[:8]
        cut[k] = (m[1].lower() if m else "", (m[2] if m else "", -1 if i is None else i, digest, u or ""), texts, kinds)
    out = []
    for k, (host, at, texts, kinds) in cut.items():
        common = lambda o: next((n for n, (a, b) in enumerate(zip(at[0].split("/"), o[1][0].split("/"))) if a != b), max(len(at[0].split("/")), len(o[1][0].split("/"))) if o[1][0] == at[0] else min(len(at[0].split("/")), len(o[1][0].split("/"))))
        others = [o for j, o in cut.items() if o[0] == host and o[2] != texts]
        before = max((o for o in others if o[1] < at), key=lambda o: o[1], default=None)
        after = min((o for o in others if o[1] > at), key=lambda o: o[1], default=None)
        near = after if before is None or after is not None and common(after) > common(before) else before
        shared = set()
        if near:
            a, b = texts, near[2]
            size = np.zeros((len(a) + 1, len(b) + 1), dtype=int)
            for i in range(len(a)):
                for j in range(len(b)):
                    size[i + 1, j + 1] = size[i, j] + 1 if a[i] == b[j] else max(size[i, j + 1], size[i + 1, j])
            i, j = len(a), len(b)
            while i and j:
                if a[i - 1] == b[j - 1]:
                    i, j = i - 1, j - 1
                    shared.add(i)
                elif size[i - 1, j] >= size[i, j - 1]:
                    i -= 1
                else:
                    j -= 1
        open_ = 3 if {1, 3} & set(kinds) else 2
        out.append((str(rows[k][0]), " ".join(t for i, (t, c) in enumerate(zip(texts, kinds)) if c == 1 or c == open_ and i not in shared)))
    return sorted(out)


def test_html_against_plain_lists(spark):
    rng = random.Random(8)
    rows = []
    for i in range(90):
        menu = ["Home", "News", f"Part {i % 3}"]
        body = [f"<div>{rng.choice(['alpha', 'beta', 'gamma'])} {j} {rng.choice([0, i])}</div>" for j in range(rng.randrange(0, 4))]
        kind = i % 3
        if kind == 0:
            page = "".join(f"<div>{m}</div>" for m in menu) + "".join(body)
        elif kind == 1:
            page = f"<nav>x</nav><div>{menu[0]}</div><article><div>Share this</div><p>quoted by all</p>{''.join(body)}</article>"
        else:
            page = "<div>same</div><div>lines</div>"
        host = rng.choice(["hot.org", "hot.org", "hot.org", "B.com", "c.net"])
        rows.append((i if i % 17 else None, rng.choice([f"http://{host}/a/{rng.randrange(6)}/{i % 4}", f"https://{host}/b?x={i}"]) if i % 13 else None, f"<body>{page}</body>"))
    rows += [(200, "http://big/1", "<p>" + "word " * 100_000 + "</p>"), (201, "http://big/2", None), (202, "not a url", "")]
    want = plain_extract(rows)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in (1, 4, 40):
            spark.conf.set("spark.sql.shuffle.partitions", str(n))
            frame = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"text": F.lit("old"), "host": F.lit("old"), "part": F.lit(1)}).repartition(n)
            got = html_extraction.extract(frame).collect()
            assert sorted((str(r.page_id), r.text) for r in got) == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert html_extraction.extract(frame.limit(0)).count() == 0


def test_lm_bytes_counted_whole_give_the_same_decisions():
    texts = [lm_scoring.stream(lm_scoring.tokens(t)) for t in ("", "a", "the cat sat on the mat the cat sat", "çà et là " * 30, "a", "x" * 700)]
    pairs = np.zeros(65536, dtype=np.int64)
    for t in texts:
        data = np.frombuffer(b"\0" + t, dtype=np.uint8).astype(np.int64)
        np.add.at(pairs, data[:-1] * 256 + data[1:], 1)
    trees = lm_scoring.Trees(pairs.reshape(256, 256))
    _, at, slots, _ = lm_scoring.events(texts, trees, [32] * lm_scoring.CONTEXTS)
    for k, coded in enumerate(lm_scoring.coded_bytes(texts)):
        tally = lm_scoring.Tally(np.uint64)
        tally.add(coded)
        got, n, one = lm_scoring.decisions_of(*tally.take(), trees)
        for bit in (0, 1):
            expected = np.unique(slots[k][trees.bit[at] == bit], return_counts=True)
            for a, b in zip(lm_scoring.summed(got[one == bit], n[one == bit]), expected):
                assert a.tolist() == b.tolist()
    none = lm_scoring.decisions_of(*lm_scoring.Tally(np.uint64).take(), trees)
    assert [len(x) for x in none] == [0, 0, 0] and len(lm_scoring.summed(none[0], none[1])[0]) == 0


def test_batches_are_bounded_by_bytes(spark):
    def make():
        def work(batch):
            size = sum(len(x.as_py()) for x in batch.column("text"))
            yield {"n": [batch.num_rows], "size": [size], "first": batch.column("id")[:1]}

        return work

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    docs = spark.range(300, numPartitions=1).select("id", F.repeat(F.lit("word "), F.when(F.col("id") == 7, 2_500_000).otherwise(20_000).cast("int")).alias("text"))
    got = map_rows(docs, make, "n int, size long, first long").orderBy("first").collect()
    assert sum(r.n for r in got) == 300 and sum(r.size for r in got) == 299 * 100_000 + 12_500_000
    assert all(r.size <= BATCH_BYTES or r.n == 1 for r in got) and max(r.size for r in got) == 12_500_000


def test_sets_asked_for_often_are_given_in_bounded_batches(spark, monkeypatch):
    monkeypatch.setattr(ngram_jaccard, "BATCH_BYTES", 1000)
    text = " ".join(f"w{i}" for i in range(300))
    docs = spark.createDataFrame([(i, text + f" x{i}") for i in range(40)] + [(40, "a b c d e f")], "doc_id long, text string")
    pairs = spark.createDataFrame([(a, b) for a in range(40) for b in range(a + 1, 41)], "a long, b long")
    found = {(r.a, r.b) for r in ngram_jaccard._verify(pairs, docs, ngram_jaccard.Params()).collect()}
    assert found == {(a, b) for a in range(40) for b in range(a + 1, 40)}


def test_few_edges_take_no_rounds(spark, monkeypatch):
    from helixframe.llm import common

    edges = [(i, i + 1) for i in range(200)] + [(500, 400), (500, 450), (450, 450)]
    frame = spark.createDataFrame(edges, "a long, b long").repartition(4)
    want = {i: 0 for i in range(201)} | {400: 400, 450: 400, 500: 400}
    context = spark.sparkContext
    for few in (200_000, 10):  # in one task, and in rounds
        monkeypatch.setattr(common, "FEW_EDGES", few)
        context.setJobGroup(f"components {few}", "")
        got = components(frame, Scratch(spark, "test")).collect()
        assert {r.node: r.component for r in got} == want and len(got) == len(want)
    jobs = [len(context.statusTracker().getJobIdsForGroup(f"components {few}")) for few in (200_000, 10)]
    context.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[0] <= 5 < jobs[1]


def test_bitmaps_of_few_and_many_ids_are_equal(spark, monkeypatch):
    rng = random.Random(8)
    rows = [(rng.randrange(-(1 << 40), 1 << 40), rng.randrange(1000)) for _ in range(3000)]
    frame = spark.createDataFrame(rows, "rep long, key long").repartition(5)
    few = ngram_jaccard._marked(frame, ("rep", "key"), 16)
    monkeypatch.setattr(ngram_jaccard, "_FEW_IDS", 10)
    many = ngram_jaccard._marked(frame, ("rep", "key"), 16)
    for k in range(2):
        want = np.zeros(1 << 16, dtype=np.uint8)
        want[ngram_jaccard._slot(np.array([r[k] for r in rows], dtype=np.int64), 16)] = 1
        assert (few[k] == np.packbits(want)).all() and (many[k] == few[k]).all()
    empty = ngram_jaccard._marked(frame.where("key < 0"), ("rep", "key"), 16)
    assert not empty[0].any() and not empty[1].any()


def test_language_fit_gives_the_drivers_memory_back(spark, monkeypatch):
    built, given = [], []
    monkeypatch.setattr(language_id, "Automata", lambda refs, make=language_id.Automata: built.append(len(refs)) or make(refs))
    monkeypatch.setattr(language_id, "release", lambda: given.append(len(built)))
    rows = [(i, "the cat sat on the mat" if i % 2 else "die katze auf der matte", "en" if i % 2 else "de") for i in range(8)]
    model = language_id.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), F.lit(True))
    assert model.languages == ["de", "en"] and built == [2] and given == [1]


def test_lm_kernels_are_the_numpy_forms(spark):
    """Words, pairs, context counts, sums of a fit and scores of the kernels, on odd texts; no text of them goes through Python."""
    from collections import Counter

    rng = random.Random(21)
    word = lambda: "".join(rng.choice("abCDeéÉ\0ß\x1c") for _ in range(rng.randrange(1, 7)))
    texts = [None, "", " \t\r\n\x0b\x0c ", "A", "é", "\0", "  The THE the\x0bend ", "x" * 9000, "日本語 " * 50] + [" ".join(word() for _ in range(n)) for n in (1, 2, 9, 400, 6000)]
    df = docs(spark, list(enumerate(texts))).repartition(3)
    kept = [lm_scoring.stream(lm_scoring.tokens(t)) for t in texts]
    met = lm_scoring._first_pass(df).collect()
    found, pairs = Counter(), np.zeros(65536, dtype=np.int64)
    for r in met:
        if r.word is not None:
            found[bytes(r.word)] += r.n
        else:
            lm_scoring._unpack(pairs, r.counts)
    assert found == Counter(w for t in texts for w in [*lm_scoring.tokens(t), b"\n"]) and len(found) > 2000
    want = np.zeros((256, 256), dtype=np.int64)
    for s in kept:
        for before, byte in zip(b"\0" + s, s):
            want[before, byte] += byte > 0
    assert (pairs.reshape(256, 256) == want).all()
    trees = lm_scoring.Trees(want)
    for aside in (0, 1):
        own = [s for i, s in enumerate(kept) if i % 2 == aside]
        counted = [{}, {}, {}]
        for r in lm_scoring._share(df.withColumn("aside", F.col("doc_id") % 2 == 1), trees, 4).where(f"int(kind / 2) = {aside}").collect():
            steps, counts = lm_scoring._columns(r.packed, 2)
            assert r.n == len(steps) == len(counts)
            for key, n in zip(np.cumsum(steps, dtype=np.uint32).tolist(), counts.tolist()):
                assert key >> 28 == r.block & 15
                counted[r.block >> 4][key, r.kind & 1] = counted[r.block >> 4].get((key, r.kind & 1), 0) + n
        for got, keys in zip(counted, lm_scoring.coded_bytes(own)):
            slots, n, one = lm_scoring.decisions_of(*np.unique(keys, return_counts=True), trees)
            want = Counter()
            for key, count, bit in zip(slots.tolist(), n.tolist(), one.tolist()):
                want[key, int(bit)] += count
            assert got == want
    model = lm_scoring.fit(df, F.col("doc_id") % 4 != 1, lm_scoring.Params(slot_bits=10, mixer_fold=3))
    for a, b in zip(lm_scoring._sums(df, model.mixer), model.mixer.sums(kept)):
        assert np.allclose(a, b, rtol=1e-5, atol=1e-5)
    scored = lm_scoring.score(df, model)
    got = {r.doc_id: r.score for r in scored.collect()}
    assert np.allclose([got[i] for i in range(len(texts))], model.mixer.log2_probability(kept) * np.log10(2), rtol=1e-5, atol=1e-5)
    assert "MapInArrow" not in scored._jdf.queryExecution().toString()
