import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from adlake.llm import langid_em, quality_llr, toxicity_ftrl
from adlake.llm.textgrams import chunks

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ODD = [None, "", " \n\t ", "one", "a b", "é x y", "\x0b\x0c", "x\n\nx\nx \nx", "word " * 40, "a b c d e f g h " * 3, "#*$ %&|<>", "\n", "q" * 300_000 + " r", "a b c d e f g h i a b c d e f g h"]


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    marked = {i + j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(8)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(marked)


def test_word_ranges_equal_regex(sample):
    texts = ODD + [r.text for r in sample("documents").limit(50).collect()]
    for size in (1, 100, 1 << 20):
        got = []
        for a, b, t in chunks(pa.array(texts, pa.string()), size=size):
            starts, ends, first = t.words()
            raw = bytes(t.data)
            got += [[raw[s:e].decode() for s, e in zip(starts[i:j], ends[i:j])] for i, j in zip(first[:-1], first[1:])]
        assert got == [WORD.findall(t or "") for t in texts]


def test_base_columns_equal_brute_force(spark, make_docs, sample):
    docs = make_docs(ODD).unionByName(sample("documents").withColumn("doc_id", F.col("doc_id") + 1000), allowMissingColumns=True)
    labels = spark.createDataFrame([(8, 1), (9, 1), (None, 1)], "doc_id long, quality int")
    got = {r.doc_id: r for r in quality_llr.quality(docs, labels).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert len(got) == len(texts)
    for i, text in texts.items():
        r, want = got[i], brute(text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want, i
        assert r.base_failed == (want[0] < 20 or 100 * want[4] > 30 * want[0])


def test_ratio_equals_direct_multinomials(spark, make_docs):
    texts = ["good good fine", "bad junk bad", "fine junk", None]
    docs, labels = make_docs(texts), spark.createDataFrame([(0, 1), (1, 0)], "doc_id long, quality int")
    got = {r.doc_id: r.score for r in quality_llr.quality(docs, labels).collect()}
    grams = lambda t: [(w,) for w in (t or "").split()] + list(zip((t or "").split(), (t or "").split()[1:]))
    raw, target, s = Counter(g for t in texts for g in grams(t)), Counter(grams(texts[0])), quality_llr.SMOOTHING
    part = sum(target.values()) / sum(raw.values())
    for i, t in enumerate(texts):
        want = np.mean([np.log((target[g] + s) / (raw[g] * part + s)) for g in grams(t)]) if grams(t) else 0
        assert got[i] == pytest.approx(want, abs=1e-5)
    assert quality_llr.quality(docs.limit(0), labels).count() == 0
    assert {r.score for r in quality_llr.quality(docs, labels.limit(0)).collect()} == {0.0}


def test_quality_keeps_clean_documents(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{n}.parquet") for n in ("documents", "labels"))
    got = quality_llr.quality(docs, labels).join(labels, "doc_id").collect()
    clean = [r for r in got if r.quality == 1 and not r.base_failed]
    junk = [r for r in got if r.quality == 0]
    assert np.mean([r.kept for r in clean]) > 0.98 and np.mean([r.kept for r in junk]) < 0.2


def test_language_accuracy_and_und(spark, sample, make_docs):
    docs = sample("documents").unionByName(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").withColumn("doc_id", F.col("doc_id") + 10_000))
    names, model = langid_em.language_model(langid_em.trigram_counts(docs, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 1))
    held = docs.filter(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1)
    got = langid_em.predict(held, names, model).join(held.select("doc_id", "lang"), "doc_id")
    assert got.filter("lang = lang_pred").count() / got.count() > 0.97
    odd = {r.doc_id: r for r in langid_em.predict(make_docs([None, "", "123 456 -- 789", "… — ©", "the thing", "x"]), names, model).collect()}
    assert [odd[k].lang_pred for k in range(4)] == ["und"] * 4 and [odd[k].score for k in range(4)] == [0.0] * 4
    assert all(0 <= r.score <= 1 for r in odd.values())
    assert {r.lang_pred for r in langid_em.predict(held.limit(3), [], np.zeros((0, langid_em.BUCKETS))).collect()} == {"und"}
    en, fr = (held.filter(f"lang = '{x}' AND n_chars > 1500").first().text[:1500] for x in ("en", "fr"))
    (mixed,) = langid_em.predict(make_docs([en + " " + fr]), names, model).collect()
    assert set(mixed.mixture) == {"en", "fr"} and sum(mixed.mixture.values()) == pytest.approx(1)


def test_all_languages_of_a_text_and_short_texts(sample, make_docs):
    docs = sample("documents").filter("n_chars > 0")
    names, model = langid_em.language_model(langid_em.trigram_counts(docs, F.lit(True)))
    parts = {n: docs.filter(F.col("lang") == n).agg(F.array_join(F.sort_array(F.collect_list("text")), " ")).first()[0] for n in names}
    assert len(names) == 4
    few = names[-1]  # a clear passage of 1.5 per cent of the text
    texts = ["A.", "x", "é", "Z", " ".join(parts[n][:2000] for n in names), parts[names[0]][:40_000] + " " + parts[few][:600]]
    got = sorted(langid_em.predict(make_docs(texts), names, model).collect(), key=lambda r: r.doc_id)
    assert all(r.lang_pred != "und" and r.score > 0 for r in got)
    assert set(got[4].mixture) == set(names)
    assert few in got[5].mixture


def test_bound_leaves_out_no_winning_set():
    """Sets chosen with the bound equal those chosen by fitting every size for every document."""
    rng = np.random.default_rng(3)
    model = rng.dirichlet(np.ones(60), 5)
    for k in range(60):
        counts = rng.multinomial(rng.integers(3, 600), rng.dirichlet(np.full(5, 0.3)) @ model)
        at = np.flatnonzero(counts)
        n, args = counts.sum(), (model.T[at], counts[at].astype(float), np.array([0]), np.zeros(len(at), int), np.array([counts.sum()]))
        full, _ = langid_em._em(np.full((1, 5), 0.2), *args)
        single = counts @ np.log(model.T)
        best, cost = np.eye(5)[np.argmax(single)], -2 * single.max()
        for size in range(2, 6):
            start = np.zeros((1, 5))
            start[0, np.argsort(-full[0], kind="stable")[:size]] = full[0, np.argsort(-full[0], kind="stable")[:size]]
            pi, fit = langid_em._em(start / start.sum(), *args)
            now = -2 * fit[0] + langid_em.PENALTY * (size - 1) * np.log(n + 1)
            if now < cost:
                best, cost = pi[0], now
        assert np.allclose(langid_em.mixtures(np.zeros(n, int), np.repeat(np.arange(60), counts), model, 1)[0], best)


def test_em_equals_plain_em():
    """Each document of a batch gets what EM by itself gives, whenever the others end; the end is near the maximum."""
    rng = np.random.default_rng(1)
    model = rng.dirichlet(np.ones(50), 3)
    weights = np.array([[0.7, 0, 0.3], [1, 0, 0], [0.2, 0.3, 0.5], [0, 0.98, 0.02], [0.4, 0.4, 0.2]])
    counts = np.array([rng.multinomial(n, w @ model) for n, w in zip((400, 3000, 80, 5000, 2), weights)])

    def plain(n, tolerance):
        pi, steps = np.full(3, 1 / 3), 0
        while True:
            share = pi[:, None] * model
            now = (share / share.sum(0) * n).sum(1) / n.sum()
            moved, pi, steps = np.abs(now - pi).max(), now, steps + 1
            if moved <= tolerance:
                return pi, steps

    owner, at = np.nonzero(counts)
    first = np.searchsorted(owner, np.arange(5))
    got, fit = langid_em._em(np.full((5, 3), 1 / 3), model.T[at], counts[owner, at].astype(float), first, owner, counts.sum(1))
    expected, steps = zip(*(plain(n, langid_em.TOLERANCE) for n in counts))
    assert np.allclose(got, expected) and len(set(steps)) > 1 and max(steps) < langid_em.ROUNDS
    best = np.array([plain(n, 1e-9)[0] for n in counts])
    assert np.allclose(fit, (counts * np.log(best @ model)).sum(1), atol=0.1)


def test_ftrl_equals_scalar_updates():
    texts, labels = [np.array([1, 3]), np.array([2]), np.array([1])], np.array([1.0, 0.0, 1.0])
    got = toxicity_ftrl.train_ftrl(texts, labels, buckets=8, l1=0.1, epochs=2)
    z, n = np.zeros(9), np.zeros(9)
    a, b, l2 = toxicity_ftrl.ALPHA, toxicity_ftrl.BETA, toxicity_ftrl.L2

    def weight(i):
        l1 = 0 if i == 8 else 0.1
        return 0.0 if abs(z[i]) <= l1 else -(z[i] - np.sign(z[i]) * l1) / ((b + n[i] ** 0.5) / a + l2)

    order = np.random.default_rng(7)
    for _ in range(2):
        for k in order.permutation(3):
            at = [*texts[k], 8]
            w = {i: weight(i) for i in at}
            g = 1 / (1 + np.exp(-sum(w.values()))) - labels[k]
            for i in at:
                s = ((n[i] + g * g) ** 0.5 - n[i] ** 0.5) / a
                z[i] += g - s * w[i]
                n[i] += g * g
    want = {i if i < 8 else -1: weight(i) for i in range(9) if weight(i)}
    assert got == pytest.approx(want)


def test_toxicity(spark, make_docs):
    texts = [f"calm words number {k}" for k in range(60)] + [f"you idiot number {k} IDIOT" for k in range(60)]
    docs = make_docs(texts)
    labels = spark.createDataFrame([(k, int(k >= 60), 1) for k in range(0, 120, 2)] + [(None, 1, 1), (3, None, 1)], "doc_id long, toxic int, text int")
    model = toxicity_ftrl.fit(docs.repartition(7), labels)
    assert model == toxicity_ftrl.fit(docs, labels)
    got = {r.doc_id: r.s for r in toxicity_ftrl.score(docs, model, name="s").collect()}
    assert all((got[k] >= 0.5) == (k >= 60) for k in got)
    odd = [r.s for r in toxicity_ftrl.score(make_docs([None, "", "z" * 500_000]), model, name="s").collect()]
    assert odd[0] == odd[1] and all(0 <= s <= 1 for s in odd)
    assert {r.s for r in toxicity_ftrl.score(docs, toxicity_ftrl.fit(docs, labels.limit(0)), name="s").collect()} == {0.0}
    assert toxicity_ftrl.score(docs.limit(0), model, name="s").count() == 0


def test_quality_of_null_and_repeated_ids_and_bloom_filter(spark, make_docs):
    docs = make_docs([(None, "good fine"), (1, "good fine"), (1, "good other"), (2, "bad junk")])
    labels = spark.createDataFrame([(1, 1), (1, 1), (None, 1), (2, 0)], "doc_id long, quality int")
    assert sorted(r.text for r in quality_llr.trusted(docs, labels).collect()) == ["good fine", "good other"]
    assert len(quality_llr.quality(docs, labels).collect()) == 4
    assert {r.text for r in quality_llr.trusted(docs, labels, broadcast_rows=0).collect()} == {"good fine", "good other"}


def test_repeated_rows_have_one_language(sample, make_docs):
    docs = sample("documents")
    names, model = langid_em.language_model(langid_em.trigram_counts(docs, F.lit(True)))
    got = langid_em.predict(make_docs([(3, "the thing is here"), (3, "the thing is here"), (None, "a"), (4, "ab")]), names, model).collect()
    assert len(got) == 4 and len({(r.lang_pred, r.score) for r in got if r.doc_id == 3}) == 1 and all(r.lang_pred != "und" for r in got)


def test_largest_of_several_labels_counts(spark, make_docs):
    docs = make_docs([f"calm words number {k}" for k in range(40)] + [f"you idiot number {k}" for k in range(40)])
    one = spark.createDataFrame([(k, int(k >= 40)) for k in range(80)], "doc_id long, toxic int")
    more = one.union(spark.createDataFrame([(k, 0) for k in range(80)], one.schema))
    assert toxicity_ftrl.fit(docs, more) == toxicity_ftrl.fit(docs, one)
