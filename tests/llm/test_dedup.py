import random
import re

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from adlake.llm import common
from adlake.llm import superminhash as M
from adlake.llm.components import connected_components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, width):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(low)
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set()


def groups(links, nodes):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def brute(texts, width):
    sets = {i: shingles(t, width) for i, t in texts}
    ids = sorted(sets)
    links = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    return {i: (len(sets[i]), c) for i, c in groups(links, ids).items()}


def corpus(seed=3, n=150):
    r = random.Random(seed)
    words = [f"w{k}" for k in range(400)]
    shared = [r.choice(words) for _ in range(60)]
    out = [None, "", "  \n ", "a", "A", "b a", "a b", "É x", "é x", "x " * 5000]
    base = [r.choice(words) for _ in range(80)]
    for k in range(n):
        kind = k % 5
        if kind == 0:
            base = [r.choice(words) for _ in range(r.choice((3, 20, 80, 300)))]
            t = base
        elif kind == 4:
            t = shared + [r.choice(words) for _ in range(r.choice((5, 15, 60)))]
        else:
            t = list(base)
            for _ in range(r.choice((0, 1, 2, 4, 8))):
                t[r.randrange(len(t))] = r.choice(words)
        out.append((" ", "\n")[k % 2].join(t))
    return list(enumerate(out))


def test_sql_equals_all_pairs():
    con = duckdb.connect()
    for texts in (corpus(), corpus(seed=8, n=300), [(0, None), (1, " ")], duckdb.sql("SELECT doc_id, text FROM '/root/testdata/sf0.001/documents.parquet'").fetchall()):
        con.register("documents", pd.DataFrame(texts, columns=["doc_id", "text"]).astype({"text": "string"}))
        got = con.sql(f"SELECT doc_id, n_shingles, component_id, kept FROM ({M.ORACLE_SQL})").fetchall()
        assert sorted(got) == sorted((i, n, c, i == c) for i, (n, c) in brute(texts, 2).items())


def test_sql_of_repeated_and_null_ids():
    con = duckdb.connect()
    con.sql("CREATE TABLE documents AS SELECT * FROM (VALUES (5, 'a b c'), (3, 'A B c'), (5, 'x y z'), (9, 'x y z'), (NULL, 'x y z'), (7, ''), (3, NULL), (9, 'q')) _(doc_id, text)")
    got = con.sql(f"SELECT doc_id, n_shingles, component_id, kept FROM ({M.ORACLE_SQL})").fetchall()
    want = [(5, 2, 3, False), (3, 2, 3, True), (5, 2, 3, False), (9, 2, 3, False), (None, 2, None, None), (7, 0, 7, True), (3, 0, 3, True), (9, 1, 3, False)]
    assert sorted(got, key=str) == sorted(want, key=str)


@pytest.mark.parametrize("width", [2, 5])
def test_components_equal_brute_force(make_docs, width):
    texts = corpus()
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in M.near_duplicates(make_docs(texts), width).collect()}
    assert got == brute(texts, width)


def test_large_bucket_of_a_chain_loses_no_link(spark, make_docs):
    """Each text shares enough with the next one only, and all share bands: the star alone does not link them."""
    words = [f"v{k}" for k in range(1200)]
    texts = [(k, " ".join(words[3 * k : 3 * k + 60])) for k in range(300)]
    got = {r.doc_id: r.component_id for r in M.near_duplicates(make_docs(texts), 2).collect()}
    assert set(got.values()) == {0}
    # the step behind the stars alone, with blocks smaller than the bucket: every text is a group of its own at first
    docs = make_docs(texts)
    sets = M.documents_to_signatures(docs, 2, M.BANDS, M.ROWS).selectExpr("doc_id AS id", "sketch", "keys", "n_shingles")
    bucket = M.explode_keys(sets).selectExpr("key", "id", "id AS `group`")
    links = {(p.a, p.b) for p in M.across_groups(docs, bucket, sets, 2, 80, small=2, block=4).collect()}
    near = {(i, j) for i in range(300) for j in range(i + 1, min(300, i + 4)) if 100 * (59 - 3 * (j - i)) >= 80 * (59 + 3 * (j - i))}
    assert links <= near and len(set(groups(links, range(300)).values())) == 1


@pytest.mark.parametrize("small, block", [(1, 3), (4, 16)])
def test_blocks_change_nothing(make_docs, small, block):
    texts = corpus(9, 120)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in M.near_duplicates(make_docs(texts), 2, small=small, block=block).collect()}
    assert got == brute(texts, 2)


def test_keep_one_and_odd_rows(spark, make_docs):
    text = " ".join(f"t{k}" for k in range(50))
    docs = make_docs([(5, text), (3, text + " end"), (3, text + " end"), (None, text), (7, "other"), (8, None)])
    kept = M.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == [(False, 3), (False, 3), (False, 7), (False, 8), (True, 0)]
    assert M.near_duplicates(docs.limit(0), 2).count() == 0 and M.keep_one(docs.limit(0)).count() == 0


def test_signature_is_superminhash():
    """Against the sequential definition: ranks of one element are a permutation, the least value stays."""
    m, r = 24, random.Random(1)
    sets = [np.array(sorted(r.getrandbits(64) for _ in range(n)), np.uint64) for n in (1, 2, 5, 40, 400)] + [np.zeros(0, np.uint64)]
    got = M.signatures(sets, m)
    for s, row in zip(sets, got):
        want = np.full(m, np.inf, np.float32)
        for e in s:
            place = list(range(m))
            for j in range(m):
                x = int(M.mix(np.array([(int(e) + M._GOLDEN * (j + 1)) % (1 << 64)], np.uint64))[0])
                k = j + ((x & 0xFFFFFFFF) * (m - j) >> 32)
                place[j], place[k] = place[k], place[j]
                want[place[j]] = min(want[place[j]], np.float32(x >> 40) / np.float32(1 << 24) + np.float32(j))
            assert sorted(place) == list(range(m))
        assert np.array_equal(row, want)


def test_signature_estimates_similarity():
    r = np.random.default_rng(2)
    a = r.integers(0, 1 << 63, 1000).astype(np.uint64)
    b = np.concatenate([a[:800], r.integers(0, 1 << 63, 200).astype(np.uint64)])
    s = M.signatures([a, b], 160)
    assert abs((s[0] == s[1]).mean() - 800 / 1200) < 0.12


def test_connected_components(spark):
    r = random.Random(4)
    edges = [(k, k + 1) for k in range(100, 160)] + [(500, k) for k in range(501, 560)] + [(r.randrange(1000, 1300), r.randrange(1000, 1300)) for _ in range(120)] + [(7, 7)]
    got = {x.node: x.component for x in connected_components(spark.createDataFrame(edges, "a long, b long").repartition(6)).collect()}
    want = groups(edges, {n for e in edges for n in e})
    assert got == {n: c for n, c in want.items() if n != 7}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_hot_keys_are_dealt_and_join_alike(spark, monkeypatch):
    monkeypatch.setattr(common, "HOT_ROWS", 10)
    rows = spark.range(400).selectExpr("id", "IF(id < 300, 1, id) AS key")
    sides = rows.groupBy("key").count().withColumnRenamed("count", "n").filter("key % 2 = 1").withColumn("side", F.col("key") * 2)
    got = common.spread_join(rows, sides, "key")
    assert sorted(map(tuple, got.select("id", "key", "n", "side").collect())) == sorted(map(tuple, rows.join(sides, "key").select("id", "key", "n", "side").collect()))
    assert common.spread_join(rows.limit(0), sides, "key").count() == 0 and common.spread_join(rows, sides.limit(0), "key").count() == 0


def test_many_copies_and_a_doc_id_with_several_texts(make_docs, monkeypatch):
    monkeypatch.setattr(common, "HOT_ROWS", 8)
    a, b = (" ".join(f"{x}{k}" for k in range(40)) for x in "ab")
    docs = [(k, a) for k in range(60)] + [(70, b), (71, b + " c"), (71, a), (72, None), (71, "")]
    got = {(r.doc_id, r.component_id) for r in M.near_duplicates(make_docs(docs), 2).collect()}
    assert got == {(k, 0) for k in [*range(60), 70, 71]} | {(72, 72)}


def test_ids_beyond_the_broadcast_bound(spark, make_docs, monkeypatch):
    """A bitmap of the ids lets few other rows through, and the results are the same."""
    texts = corpus(n=60)
    want = {i: c for i, (_, c) in brute(texts, 5).items()}
    kept = sorted(i for i, c in want.items() if i == c)
    monkeypatch.setattr(M, "BROADCAST_IDS", 3)
    docs = make_docs(texts + [(None, "a row without an id")]).selectExpr("*", "5 AS _gone", "6 AS id_", "7 AS set_id")
    assert {r.doc_id: r.component_id for r in M.near_duplicates(docs).collect() if r.doc_id is not None} == want
    out = M.keep_one(docs)
    assert sorted(r.doc_id for r in out.collect() if r.doc_id is not None) == kept and out.filter("doc_id IS NULL").count() == 1 and out.columns == docs.columns
    ids = spark.range(0, 40_000, 7).toDF("k")
    rows = spark.range(400_000).toDF("k")
    test = common.id_bitmap(ids, "k", 1 << 20)
    passed = rows.filter(test(F.col("k")))
    assert ids.join(passed, "k", "left_anti").isEmpty() and passed.count() < ids.count() + 4000
    assert common.semi_join(rows, ids, "k", 5).count() == ids.count() and common.anti_join(rows, ids, "k", 5).count() == 400_000 - ids.count()


INTERNAL = "_toxicity _gone _s _l _t _w _topic _tokens _probability _kept _source _lang _cell_source cell id fp n key keys a b component component_id n_shingles set_id members label bucket ids decoded spans mark place part score rank weight features _n _salt _parts _hot"


def test_clashing_columns_are_carried(make_docs):
    import corpus_pipeline
    from adlake.llm import overlap_dsir, segment_popcount

    texts = [" ".join(f"w{(k * 7 + j) % 50}" for j in range(30)) for k in range(12)]
    docs = make_docs(texts, lang="x").selectExpr("doc_id", "text", "lang", "source", "n_chars", *[f"'{n}' AS `{n}`" for n in INTERNAL.split()])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(docs.sparkSession, docs, "/root/testdata/sf0.001")
        assert out.columns == docs.columns, name
        assert all(r[n] == n for r in out.collect() for n in INTERNAL.split())
    assert corpus_pipeline.STAGES[-1][1](docs.sparkSession, docs, "").count() == 12
    assert segment_popcount.near_duplicates(docs).count() == 12
    assert overlap_dsir.resample(docs, docs.select("text")).count() == 12
