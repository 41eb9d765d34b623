import hashlib
import heapq
import itertools
import math
import random
import re
from zlib import crc32

import duckdb
import numpy as np
import pandas as pd
import pytest
import xxhash
from pyspark.sql import functions as F

from adlake.llm import overlap_dsir as D
from adlake.llm import prefix_repair as R
from adlake.llm import segment_popcount as S

from test_dedup import corpus, groups


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


# ---- segment popcounts


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    grams = [" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))] if words else []
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_groups(prints):
    values = sorted(set(prints))
    of = groups([(a, b) for k, a in enumerate(values) for b in values[k + 1 :] if (a ^ b).bit_count() <= 2], values)
    return [of[p] for p in prints]


def test_fingerprints_are_those_of_spark_and_of_plain_python(spark):
    texts = [t for _, t in corpus(n=40)] + ["É Ünï " * 3, "\x1c a\x1fb \x0b c"]
    assert [S.fingerprint(t) for t in texts] == [plain_fingerprint(t) for t in texts]
    assert spark.sql("SELECT xxhash64('a b c')").first()[0] & (1 << 64) - 1 == xxhash.xxh64_intdigest(b"a b c", 42)


def near_prints(seed, n):
    """Random fingerprints, crowds around some of them, and zero."""
    r = random.Random(seed)
    out = [0, 0, 1, 3, 7]
    for _ in range(n):
        base = r.getrandbits(64)
        out.append(base)
        for _ in range(r.choice((0, 0, 1, 3, 40))):
            p = base
            for _ in range(r.choice((0, 1, 2, 3, 4))):
                p ^= 1 << r.randrange(64)
            out.append(p)
    return out


@pytest.mark.parametrize(("segment", "small"), [(4, 32), (4, 1), (4, 3), (2, 32), (1, 32)])
def test_links_join_what_lies_within_two_bits(spark, segment, small):
    prints = near_prints(segment + small, 60)
    values = sorted(set(prints))
    points = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in values], "fp long")
    links = [tuple(x & (1 << 64) - 1 for x in row) for row in S.links_within(points, segment=segment, small=small).collect()]
    assert all((a ^ b).bit_count() <= 2 for a, b in links)
    of = groups(links, values)
    assert [of[p] for p in prints] == plain_groups(prints)


def test_the_manhattan_distance_is_a_lower_bound():
    r = random.Random(5)
    for _ in range(300):
        a = r.getrandbits(64)
        b = a
        for _ in range(r.randrange(9)):
            b ^= 1 << r.randrange(64)
        for segment in (1, 2, 4):
            x, y = (int(v) for v in S.embedding(np.array([a, b], np.uint64), segment))
            mask = (1 << segment) - 1
            assert [x >> k & mask for k in range(0, 64, segment)] == [(a >> k & mask).bit_count() for k in range(0, 64, segment)]
            assert sum(abs((x >> k & mask) - (y >> k & mask)) for k in range(0, 64, segment)) <= (a ^ b).bit_count()


def check_simhash(rows, texts):
    prints = {i: plain_fingerprint(t) for i, t in texts}
    of = plain_groups([prints[i] for i, _ in texts])
    least = {}
    for (i, _), g in zip(texts, of):
        least[g] = min(i, least.get(g, i))
    want = sorted((i, f"{prints[i]:016x}", least[g]) for (i, _), g in zip(texts, of))
    assert sorted((r.doc_id, r.fingerprint, r.component_id) for r in rows) == want


def test_near_duplicates_are_those_of_all_pairs(spark, make_docs, sample):
    texts = corpus()
    check_simhash(S.near_duplicates(make_docs(texts)).collect(), texts)
    whole = [(r.doc_id, r.text) for r in sample("documents").collect()]
    check_simhash(S.query(spark, "/root/testdata/sf0.001").collect(), whole)


def test_simhash_odd_rows(spark, make_docs):
    assert S.near_duplicates(make_docs([]).limit(0)).count() == 0
    long = "word " * 70_000 + "other"
    rows = make_docs([(7, "same text here"), (5, "same text here"), (5, None), (None, "same  TEXT here"), (None, "alone on its own"), (9, long), (8, long)])
    got = sorted(((r.doc_id, r.component_id) for r in S.near_duplicates(rows).collect()), key=str)
    assert got == sorted([(7, 5), (5, 5), (5, 5), (None, 5), (None, None), (9, 8), (8, 8)], key=str)


def test_a_hot_text_and_a_crowd_are_whole(spark, make_docs, monkeypatch):
    monkeypatch.setattr("adlake.llm.common.HOT_ROWS", 20)
    texts = list(enumerate(["copy of all"] * 300 + [f"crowd {'x ' * 200} {k}" for k in range(300)]))
    check_simhash(S.near_duplicates(make_docs(texts), small=4).collect(), texts)


# ---- conversations

PATTERN = re.compile(r"(s?(ua)+)?")
MOVES = {"": "su", "s": "u", "u": "a", "a": "u"}


def plain_repair(rows):
    """rows: (role, text) in order -> (cost, audit, repaired), by best-first search over whole edit strings."""
    seen, faults = set(), []
    for role, text in rows:
        solid = re.sub(r"[\x20\x09-\x0D]", "", text)
        faults.append("blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else "")
        seen.add((role, text))
    best: dict = {}
    heap = [(0, "", 0, "", ())]
    while heap:
        cost, audit, at, last, out = heapq.heappop(heap)
        if best.setdefault((at, last), (cost, audit)) < (cost, audit):
            continue
        if at == len(rows) and last in ("", "a"):
            return cost, audit, out, faults
        for symbol, role in (("u", "user"), ("a", "assistant")):
            if symbol in MOVES[last]:
                heapq.heappush(heap, (cost + 2, audit + "I", at, symbol, (*out, f"{role}:")))
        if at == len(rows):
            continue
        role, text = rows[at]
        heapq.heappush(heap, (cost + 3, audit + "D", at + 1, last, out))
        if faults[at] in ("blank", "duplicate"):
            continue
        more = cost + (faults[at] == "truncated")
        if role[:1] and role[:1] in MOVES[last]:
            heapq.heappush(heap, (more, audit + "K", at + 1, role[:1], (*out, f"{role}:{text}")))
        for symbol, new in (("u", "user"), ("a", "assistant")):
            if symbol in MOVES[last]:
                heapq.heappush(heap, (more + 2, audit + "R", at + 1, symbol, (*out, f"{new}:{text}")))
    raise AssertionError


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        kind = crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind:
            row = (conv, turn, "user" if kind == 4 else role, "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text)
            out += [row] * (2 if kind == 3 else 1)
    return out


def plain_rows(original, damaged):
    """The contract's rows from the rows after damage."""
    for conv in {r[0] for r in original}:
        rows = [r for r in damaged if r[0] == conv]
        rows.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.md5(f"{len(r[2])}:{r[2]}{r[3]}".encode()).digest()))
        cost, audit, out, faults = plain_repair([(r[2], r[3]) for r in rows])
        turns = {r[1] for r in rows if r[1] is not None}
        initials = [r[2][:1] for r in rows]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        yield conv, gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest()


COLUMNS = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def rows_of(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=str)


def test_repair_of_the_table_equals_the_search(spark, sample):
    original = [tuple(r) for r in sample("conversations").select("conv_id", "turn", "role", "text").collect()]
    assert rows_of(R.query(spark, "/root/testdata/sf0.001")) == sorted(plain_rows(original, plain_damage(original)), key=str)


ROLES = ("user", "assistant", "system", "tool", "", "u", "system")


def as_conversations(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "'x' AS audit", "1 AS place", "2 AS part", "'m' AS mark", "3 AS cost")


def repaired_rows(df):
    audits = R.audit(df)
    hashes = {r.conv_id: r.repaired_sha256 for r in R.digests(R.repaired(df, audits)).collect()}
    empty = hashlib.sha256(b"").hexdigest()
    return sorted(((*(r[c] for c in COLUMNS[:-1]), hashes.get(r.conv_id, empty)) for r in audits.collect()), key=str)


def test_random_conversations_equal_the_search(spark):
    r = random.Random(2)
    texts = ("Yes.", "No!", "cut", "", " \t", "Why? ", "end.\n", "x.y")
    rows = [(c, t, r.choice(ROLES[: r.choice((2, 3, 7))]), r.choice(texts)) for c in range(250) for t in range(r.choice((0, 1, 2, 3, 5, 9, 14)))]
    rows += [(None, None, "user", "a."), (None, None, "user", "a."), (None, 4, None, None), (900, None, None, "b."), (900, 3, "assistant", None), (901, 5, "x", "x"), (902, 1, "user", "y."), (902, 1, "assistant", "y.")]
    null = lambda x: " " if x is None else x
    assert repaired_rows(as_conversations(spark, rows)) == sorted(plain_rows(rows, [(c, t, null(a), null(b)) for c, t, a, b in rows]), key=str)


def test_every_short_sequence_of_roles(spark):
    rows = [(k, t, role, f"{t}.") for k, roles in enumerate(itertools.chain(*(itertools.product(("user", "assistant", "system"), repeat=n) for n in range(1, 6)))) for t, role in enumerate(roles)]
    assert repaired_rows(as_conversations(spark, rows)) == sorted(plain_rows(rows, rows), key=str)
    kept = R.repaired(as_conversations(spark, rows), R.audit(as_conversations(spark, rows)))
    told = kept.groupBy("conv_id").agg(F.concat_ws("", F.transform(F.array_sort(F.collect_list(F.struct("place", "role"))), lambda x: F.substring(x["role"], 1, 1))).alias("s")).collect()
    assert all(PATTERN.fullmatch(x.s) for x in told)


def test_dropped_and_empty_conversations(spark):
    gone = [(c, t) for c in range(200) for t in (0,) if crc32(f"{c}:{t}".encode()) % 20 == 0]
    rows = as_conversations(spark, [(c, t, "user", "x.") for c, t in gone])
    got = rows_of(R.audit(R.damage(rows)).withColumn("repaired_sha256", F.lit("")))
    assert got == sorted(((c, 0, 0, 0, 0, 0, 0, "", "") for c, _ in gone), key=str) and gone
    assert R.audit(R.damage(rows.limit(0))).count() == 0 and R.repaired(rows.limit(0), R.audit(rows.limit(0))).count() == 0


def test_a_long_conversation_among_short_ones(spark, monkeypatch):
    monkeypatch.setattr(R, "RANK_ROWS", 50)
    r = random.Random(4)
    rows = [(1, t, r.choice(("user", "assistant")), f"{t} {'w' * 50}" + r.choice((".", ""))) for t in range(3000)] + [(c, 0, "user", "hi.") for c in range(2, 300)]
    assert repaired_rows(as_conversations(spark, rows)) == sorted(plain_rows(rows, rows), key=str)


# ---- importance resampling


def plain_features(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))
    return words, [" ".join(words[k : k + n]) for n in (1, 2) for k in range(len(words) - n + 1)]


def plain_resample(docs, target):
    bucket = lambda f: crc32(f.encode()) % 10_000
    counts = []
    for texts in ([t for _, t in docs], target):
        c = [0] * 10_000
        for t in texts:
            for f in plain_features(t)[1]:
                c[bucket(f)] += 1
        counts.append(c)
    s, t = counts
    gain = [math.floor(1000 * math.log((t[b] + 1) * (sum(s) + 10_000) / ((s[b] + 1) * (sum(t) + 10_000)))) for b in range(10_000)]
    rows = []
    for i, text in docs:
        words, found = plain_features(text)
        weight = sum(gain[bucket(f)] for f in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append((i, len(words), len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    order = sorted((r for r in rows if r[1] >= 20), key=lambda r: (-r[4], r[0] is not None, r[0] or 0))
    rank = {id(r): k + 1 for k, r in enumerate(order[: 25 * len(order) // 100])}
    return sorted(((r[0], *r[2:], rank.get(id(r))) for r in rows), key=str)


def drawn(df):
    return sorted((tuple(r[c] for c in ("doc_id", "n_features", "weight", "score", "rank")) for r in df.collect()), key=str)


def test_resampling_equals_the_plain_version(spark, sample, make_docs):
    docs = [(r.doc_id, r.text) for r in sample("documents").collect()]
    target = [r.text for r in sample("benchmark").collect()]
    assert drawn(D.query(spark, "/root/testdata/sf0.001")) == plain_resample(docs, target)
    odd = corpus(n=60) + [(500, "Ünï-Cödé 12_3 ÉA"), (None, "w " * 30), (501, "-- // --"), (502, "y" * 100_000), (503, "a b " * 40_000)]
    assert drawn(D.resample(make_docs(odd), spark.createDataFrame([(t,) for t in ("a b c", None, "w7 w9")], "text string"))) == plain_resample(odd, ["a b c", None, "w7 w9"])


def test_sql_of_resampling_equals_the_plain_version():
    def sql(docs, target):
        con = duckdb.connect()
        con.register("documents", pd.DataFrame(docs, columns=["doc_id", "text"]).astype({"doc_id": "Int64", "text": "string"}))
        con.register("benchmark", pd.DataFrame({"text": pd.array(target, "string")}))
        return sorted(con.sql(f"SELECT doc_id, n_features, weight, score, rank FROM ({D.ORACLE_SQL})").fetchall(), key=str)

    docs, target = (duckdb.sql(f"SELECT {c} FROM '/root/testdata/sf0.001/{n}.parquet'").fetchall() for c, n in (("doc_id, text", "documents"), ("text", "benchmark")))
    assert sql(docs, [t for t, in target]) == plain_resample(docs, [t for t, in target])
    odd = [*corpus(n=60), (500, "Ünï-Cödé 12_3 ÉA"), (None, "w " * 30), (501, "-- // --"), (502, "y" * 10_000), (503, None), (504, "")]
    for wanted in (["a b c", None, "w7 w9"], []):
        assert sql(odd, wanted) == plain_resample(odd, wanted)


def test_resampling_of_equal_scores_and_empty_tables(spark, make_docs):
    rows = spark.createDataFrame([(i, 30, s) for i, s in [(4, 5), (3, 5), (2, 5), (1, 9), (0, 1), (9, 1), (8, 1), (7, 1)]] + [(10, 3, 99), (11, None, 99)], "doc_id long, n_words long, score long")
    assert {r.doc_id: r["rank"] for r in D.draw(rows, percent=30).collect() if r["rank"]} == {1: 1, 2: 2}
    assert {r.doc_id: r["rank"] for r in D.draw(rows, percent=50).collect() if r["rank"]} == {1: 1, 2: 2, 3: 3, 4: 4}
    assert D.draw(rows, percent=100).filter("rank IS NULL").count() == 2
    none = spark.createDataFrame([], "text string")
    assert D.resample(make_docs([]).limit(0), none).count() == 0
    texts = corpus(n=20)
    assert drawn(D.resample(make_docs(texts), none)) == plain_resample(texts, [])


def test_chosen_documents_keep_their_columns(spark, make_docs):
    texts = corpus(n=80) + [(None, "w " * 30), (900, None), (901, "")]
    docs = make_docs(texts).withColumn("rank", F.lit("own")).withColumn("_drawn", F.col("doc_id")).withColumn("n_words", F.lit(None).cast("int"))
    target = spark.createDataFrame([("a b w1 w2",)], "text string")
    ranked = D.resample(docs, target, percent=40)
    got = D.chosen(docs, ranked)
    want = {}
    for i, *_, rank in drawn(ranked):
        if rank:
            want[i] = min(rank, want.get(i, rank))
    assert got.columns == [*docs.columns, "rank_"] and want
    assert sorted(((r.doc_id, r.text, r["rank_"]) for r in got.collect()), key=str) == sorted(((i, t, want[i]) for i, t in texts if i in want), key=str)
    assert D.chosen(docs.limit(0), ranked).count() == 0 and D.chosen(docs, ranked.filter("rank IS NULL")).count() == 0
    assert D.chosen(docs, D.resample(docs, target, percent=100)).filter("doc_id IS NULL").count() == 1


def test_features_of_longer_runs():
    words, found = D.features("A b  c-d", D.ngram_patterns(3))
    assert words == 4 and list(found) == [crc32(x) % 10_000 for x in (b"a", b"b", b"c", b"d", b"a b", b"b c", b"c d", b"a b c", b"b c d")]
