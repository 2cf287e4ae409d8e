"""The pipeline's stages on a small corpus, each against a brute-force version on its own input; and the queries without SQL on the same tables."""

import random
import re
import zlib

import numpy as np
import pytest

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(11)
    syllables = {"en": ["th", "er", "on", "an", "st"], "de": ["sch", "ei", "üb", "un", "zu"]}
    word = lambda lang: "".join(rng.choice(syllables[lang]) for _ in range(rng.randrange(1, 5)))
    prose = lambda lang, n: " ".join(word(lang) for _ in range(n))
    items = [(i, prose("en", 20)) for i in range(4)]
    docs, labels = [], []
    for i in range(200):
        lang = ["en", "de"][i % 2]
        text = prose(lang, rng.randrange(30, 120))
        if i % 5 == 4:
            text = " ".join(f"{w.upper()}!!" for w in text.split())
        elif i % 20 == 6:
            text = docs[i - 6][1].replace(" ", "  ", 3)
        elif i % 25 == 8:
            text += " " + items[i % 4][1]
        if i % 7 == 0:
            text = f"idiot {text} clown"
        docs.append((i, text, lang, f"s{i % 3}", len(text)))
        if i % 3:
            labels.append((i, int(i % 5 != 4), int(i % 7 == 0)))
    docs += [(200, None, None, None, None), (201, "", "en", "s0", 0), (202, "12 34 56", "en", "s0", 8), (203, docs[0][1], "en", "s1", 1)]
    d = str(tmp_path_factory.mktemp("corpus"))
    for name, rows, schema in (
        ("documents", docs, "doc_id long, text string, lang string, source string, n_chars long"), ("labels", labels, "doc_id long, quality int, toxic int"),
        ("benchmark", items, "item_id long, text string"),
    ):
        spark.createDataFrame(rows, schema).write.parquet(f"{d}/{name}.parquet")
    return d, {r[0]: r for r in docs}, {r[0]: r for r in labels}, items


def test_stages(spark, corpus):
    import corpus_pipeline as cp
    from tests.llm.test_operators import brute_jaccard

    d, texts, labels, items = corpus
    assert [n for n, _ in cp.STAGES] == ["quality classifier", "language ID", "n-gram Jaccard join", "benchmark decontamination", "mixing sources to target weights"]
    now = spark.read.parquet(f"{d}/documents.parquet")
    kept = {}
    scratch = cp.Scratch(spark, "test")
    for name, stage in cp.STAGES:
        before = {r.doc_id for r in now.collect()}
        now = scratch.save(stage(spark, now, d))
        kept[name] = after = {r.doc_id for r in now.collect()}
        if name != cp.STAGES[-1][0]:
            assert now.columns == cp.COLUMNS
        assert after <= before
        if name == "quality classifier":
            good = {i for i in before if i < 200 and i % 5 != 4}
            assert len(good - after) <= 2 and len(after & {i for i in before if i < 200 and i % 5 == 4}) <= 2
        elif name == "language ID":
            from helixframe.llm import language_id

            # the same learned rows, every text parsed by search
            model = language_id.fit(spark.createDataFrame([texts[i][:3] for i in sorted(before)], "doc_id long, text string, lang string"), cp.crc_bucket(cp.F.col("doc_id"), 4) != 2)
            own = {i: t for i in before if (t := language_id.letters(texts[i][1]))}
            ratio = {i: model.ratios([t])[0] for i, t in own.items()}
            expected = {i: model.rates[r.argmin()] * len(own[i]) for i, r in ratio.items()}
            assert after == {i for i, r in ratio.items() if 1 / np.exp(4 * (r.min() - r)).sum() >= 0.5 and r.min() <= 1.5 + 3 / expected[i] ** 0.5}
            # no learned language explains these, whatever the stage before thinks of them
            rng = random.Random(3)
            odd = [(300 + i, " ".join("".join(rng.choice("αβγδεζηθ") for _ in range(5)) for _ in range(200)), "en", "s0", 9) for i in range(4)]
            with_odd = spark.read.parquet(f"{d}/documents.parquet").unionByName(spark.createDataFrame(odd, "doc_id long, text string, lang string, source string, n_chars long"))
            stayed = {r.doc_id for r in cp.language(spark, with_odd, d).collect()}
            assert {i for i in range(200) if i % 25 != 8} <= stayed and not stayed & {200, 201, 202, 300, 301, 302, 303}
        elif name == "n-gram Jaccard join":
            want = brute_jaccard([(i, texts[i][1]) for i in sorted(before)])
            assert after == {i for i, (_, c) in want.items() if c == i} and after < before
        elif name == "benchmark decontamination":
            tokens = lambda t: re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", t.translate(LOWER))
            windows = {tuple(w[k : k + 10]) for _, t in items for w in [tokens(t)] for k in range(len(w) - 9)}
            hit = {i for i in before for w in [tokens(texts[i][1])] if any(tuple(w[k : k + 10]) in windows for k in range(len(w) - 9))}
            assert after == before - hit and hit
    out = now.toPandas()
    # the same posteriors, fitted by plain NumPy: the totals agree, whether the targets can be reached or not
    domains = sorted(k.removeprefix("p_") for k in out.columns if k.startswith("p_"))
    p, n = out[[f"p_{k}" for k in domains]].to_numpy(), out.n_tokens.to_numpy(float)
    share = np.array([cp.TARGET_SHARES[k] for k in domains])
    want, inverse, r = n.sum() * share / share.sum(), np.linalg.pinv((p * n[:, None]).T @ p, rcond=1e-9), np.ones(len(n))
    for _ in range(3000):
        r = np.maximum(0, r - p @ (inverse @ ((n * r) @ p - want)))
    assert (n * out.rate.to_numpy()) @ p == pytest.approx((n * r) @ p, rel=1e-3) and (out.rate >= 0).all()
    assert kept["mixing sources to target weights"] == kept["benchmark decontamination"]
    assert {r.doc_id for r in cp.run(spark, d).collect()} == set(out.doc_id)


def test_stages_on_odd_rows(spark, corpus, tmp_path):
    import corpus_pipeline as cp

    d, texts, _, items = corpus
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    # rows without an id, rows that repeat one, a very long text, columns whose names clash with the stages' own
    good = [t for i, t, *_ in texts.values() if i < 200 and i % 5 != 4 and i % 7 and i % 25 != 8]
    odd = [(None, good[0], "en", "s", 1), (None, None, None, None, None), (500, good[1], "de", "s", 1), (500, good[1], "de", "s", 1), (501, " ".join(good) * 5, "en", None, 1)]
    clash = spark.read.parquet(f"{d}/documents.parquet").unionByName(spark.createDataFrame(odd, schema))
    for c in ("score", "rate", "lang_pred", "component_id", "n_hit", "posterior"):
        clash = clash.withColumn(c, cp.F.lit("old"))
    at = str(tmp_path / "odd")
    clash.write.parquet(f"{at}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{d}/{name}.parquet").write.parquet(f"{at}/{name}.parquet")
    now = cp.table(spark, at, "documents")
    kept = [r.doc_id for r in cp.near_duplicates(spark, now, at).collect()]
    assert kept.count(None) == 2 and kept.count(500) == 0 and 501 in kept  # 500 repeats, and copies an earlier text
    assert [r.doc_id for r in cp.decontaminate(spark, now, at).collect()].count(None) == 2
    rated = cp.mixture(spark, now, at)
    assert rated.count() == now.count() and rated.where("rate IS NULL").count() == 0
    out = cp.run(spark, at)
    assert {f.name for f in out.schema} >= {*cp.COLUMNS, "n_tokens", "rate"} and "lang_pred" not in out.columns
    assert out.where("doc_id IS NULL").count() == 1
    # an empty corpus, and one without labels or benchmark
    none = str(tmp_path / "none")
    spark.createDataFrame([], schema).write.parquet(f"{none}/documents.parquet")
    bare = str(tmp_path / "bare")
    spark.createDataFrame([t for t in texts.values() if t[0] is not None and t[0] < 40], schema).write.parquet(f"{bare}/documents.parquet")
    for at in (none, bare):
        spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
        spark.createDataFrame([], "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    assert cp.run(spark, none).count() == 0
    assert cp.run(spark, bare).count() > 20


def test_queries_without_sql(spark, corpus):
    import __spark_entry__

    d, texts, labels, _ = corpus
    q = __spark_entry__.queries()
    crc = lambda i, n: zlib.crc32(str(i).encode()) % n
    rows = q["op9_language_id"](spark, d).collect()
    assert {r.doc_id for r in rows} == set(texts) and all(r.held_out == (crc(r.doc_id, 4) == 2) for r in rows)
    right = [r.lang_pred == texts[r.doc_id][2] for r in rows if r.held_out and r.doc_id < 200]
    assert sum(right) / len(right) > 0.95
    rows = q["op10_quality_classifier"](spark, d).collect()
    right = [r.predicted == int(r.doc_id % 5 != 4) for r in rows if r.held_out and r.doc_id < 200]
    assert len(rows) == len(texts) and sum(right) / len(right) > 0.9
    rows = q["op7_lm_scoring"](spark, d).collect()
    assert len(rows) == len(texts) and all(r.held_out == (crc(r.doc_id, 5) == 1) and r.score < 0 for r in rows)
    assert q["op3_mixing"](spark, d).count() == len(texts)


def test_entry_without_llm(monkeypatch):
    import __spark_entry__ as entry

    real = entry.importlib.import_module

    def gone(name):
        if name.startswith("helixframe.llm") or name == "corpus_pipeline":
            raise ModuleNotFoundError(name=name)
        return real(name)

    monkeypatch.setattr(entry.importlib, "import_module", gone)
    assert "pipeline" not in entry.queries() and not any(k.startswith("op") for k in entry.queries()) and "coverage_means" in entry.oracle_sql()
    monkeypatch.setattr(entry.importlib, "import_module", lambda name: (_ for _ in ()).throw(ModuleNotFoundError(name="some_other_module")))
    with pytest.raises(ModuleNotFoundError):
        entry.queries()


