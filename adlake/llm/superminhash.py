"""MinHash near-dedup by SuperMinHash: signatures, banding, verification, union-find groups.

SuperMinHash gives every shingle a random permutation of the m registers and the
value r_j + j at the j-th place of it (r_j uniform in [0, 1)); a register keeps
the least value over all shingles.  Ranks of one shingle are a permutation, not
independent draws, so the estimate's variance is lower than MinHash's; and once
every register holds less than j + 1, no later rank can matter, so a document
stops early (a long one after two or three ranks).  Here rank j of all
unfinished documents of a chunk is done at once in numpy.

Steps on Spark:

1. one scan makes each document's shingle set (64-bit hashes), and from that a
   set id and the signature; only these are kept.  Documents with the same set id
   (two 64-bit sums over the set; the sets themselves are not compared) are collapsed
   to one representative (min doc_id) by an aggregation;
2. `bands` hashes of `rows` registers each are shuffled as (band key, id);
3. every bucket links its members to its smallest member (a star, not pairs);
   the pairs are verified on the full sets and grouped;
4. buckets whose members then lie in one group are done.  In the others every
   pair of different groups is compared by signature, in the first band that it shares,
   and then on the full sets.  Buckets above `small` members are dealt to pairs of
   blocks: a first pass over signatures alone finds the members that have a candidate at
   all, a second one over their sets gives out only links that join groups, never all pairs.
   Nothing is capped;
5. groups of representatives come from alternating large-star and small-star steps after a
   union-find inside each Arrow batch; documents meet their representative's group last.

Hot keys - a band key, or a set with a third of all documents as copies - are
dealt to many tasks by `spread_join`.

A pair at the similarity 0.8 meets in no band with probability
(1 - 0.8^rows)^bands, 3e-6 at the defaults, and then falls below the signature
test with less than 2e-9 (Chernoff's bound); all links are verified exactly.

Defined results: null text is empty; an empty set links with nothing; rows with
a null doc_id link with nothing and keep a null component; repeated doc_ids
count as one document with the union of its links; an empty table gives an empty
result; other columns are carried or ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from string import ascii_lowercase, ascii_uppercase

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlake.llm.common import anti_join, drop_stored, in_batches, read_table, semi_join, small_batches, spread_join, stored
from adlake.llm.components import connected_components
from adlake.llm.textgrams import Texts, chunks, join_hashes, mix

QUERY_NAME = "op7_superminhash"

BANDS, ROWS = 32, 5
#: Buckets of up to SMALL members give out candidate pairs; larger ones are dealt to blocks of BLOCK members, or fewer with BLOCK_SHINGLES in all.
SMALL, BLOCK, BLOCK_SHINGLES = 64, 1024, 1 << 19
#: Bytes of text whose sets are made at once.
SIGN_BYTES = 1 << 18
#: Standard deviations by which a signature may fall short of the similarity before the sets are left out.
SLACK = 7
#: Ids that are broadcast to fetch texts or drop rows (16 MB); of more a bitmap goes to the tasks, and only rows that it lets pass are shuffled.
BROADCAST_IDS = 1_000_000
_GOLDEN = 0x9E3779B97F4A7C15


def shingle_sets(texts: Texts, width: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of each document's *width*-word shingles; a shorter text is one shingle, an empty one none."""
    starts, ends, first = texts.words()
    h = texts.range_hash(starts, ends)
    grams = join_hashes(*[h[k : len(h) - width + 1 + k] for k in range(width)]) if len(h) >= width else h[:0]
    sets = []
    for a, b in zip(first[:-1], first[1:]):
        if b - a >= width:
            sets.append(np.unique(grams[a : b - width + 1]))
        elif b > a:
            sets.append(mix(join_hashes(*[h[k : k + 1] for k in range(a, b)]) + np.uint64(b - a)))
        else:
            sets.append(h[:0])
    return sets


def signatures(sets: list[np.ndarray], m: int) -> np.ndarray:
    """SuperMinHash signatures (sets x m, float32); an empty set has infinities."""
    n_sets = len(sets)
    out = np.full(n_sets * m, np.inf, np.float32)
    owner = np.repeat(np.arange(n_sets), [len(s) for s in sets])
    seeds = np.concatenate(sets) if n_sets else np.zeros(0, np.uint64)
    places: list[np.ndarray] = []  # the place that each former rank swapped with
    for j in range(m):
        if not len(owner):
            break
        draw = mix(seeds + np.uint64(_GOLDEN * (j + 1) % (1 << 64)))
        value = (draw >> np.uint64(40)).astype(np.float32) / np.float32(1 << 24) + np.float32(j)
        place = j + (((draw & np.uint64(0xFFFFFFFF)) * np.uint64(m - j)) >> np.uint64(32)).astype(np.int32)
        register = place.copy()
        for t in range(j - 1, -1, -1):  # undo the swaps: which register stands at this place
            np.copyto(register, t, where=register == places[t])
        np.minimum.at(out, owner * m + register, value)
        places.append(place)
        if j < 2 or j % 4 == 3:
            open_docs = out.reshape(n_sets, m).max(axis=1) >= j + 1
            go_on = open_docs[owner]
            if not go_on.all():
                owner, seeds = owner[go_on], seeds[go_on]
                places = [p[go_on] for p in places]
    return out.reshape(n_sets, m)


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """64-bit key of each band (documents x bands)."""
    words = np.ascontiguousarray(sig).view(np.uint32).astype(np.uint64).reshape(len(sig), bands, rows)
    return join_hashes(np.broadcast_to(np.arange(bands, dtype=np.uint64), words.shape[:2]), *[words[:, :, k] for k in range(rows)])


def _set_ids(sets: list[np.ndarray]) -> pa.Array:
    """Two 64-bit sums over each set as hex; null for an empty set."""
    return pa.array([f"{int(s.sum(dtype=np.uint64)):016x}{int(mix(s).sum(dtype=np.uint64)):016x}" if len(s) else None for s in sets], pa.string())


def documents_to_signatures(docs: DataFrame, width: int, bands: int, rows: int) -> DataFrame:
    """doc_id, n_shingles, set_id, and for documents with words the band keys and a sketch (a byte of each register)."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, texts in chunks(batch.column(1), lower=True, size=SIGN_BYTES):
                sets = shingle_sets(texts, width)
                sig = signatures(sets, bands * rows)
                keys = band_keys(sig, bands, rows).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a),
                        pa.array([len(s) for s in sets], pa.int64()),
                        _set_ids(sets),
                        pa.array([k.tobytes() for k in keys], pa.binary()),
                        pa.array([(mix(s.view(np.uint32).astype(np.uint64)) & np.uint64(255)).astype(np.uint8).tobytes() for s in sig], pa.binary()),
                    ],
                    ["doc_id", "n_shingles", "set_id", "keys", "sketch"],
                )

    schema = "doc_id long, n_shingles long, set_id string, keys binary, sketch binary"
    return in_batches(docs.select(F.col("doc_id").cast("long"), "text"), sign, schema)


def full_sets(docs: DataFrame, ids: DataFrame, width: int) -> DataFrame:
    """(id, members): the shingle sets of the documents with these ids, made from their texts again.

    Sets are larger than texts, so they are kept only of documents that have a candidate.
    """

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, texts in chunks(batch.column(1), lower=True, size=SIGN_BYTES):
                sets = shingle_sets(texts, width)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), _set_ids(sets), pa.array([s.tobytes() for s in sets], pa.binary())], ["id", "set_id", "members"])

    texts = semi_join(docs.select(F.col("doc_id").cast("long").alias("id"), "text"), ids, "id", BROADCAST_IDS)
    return in_batches(texts, make, "id long, set_id string, members binary")


def explode_keys(sets: DataFrame) -> DataFrame:
    """(key, id) for each band."""

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                keys = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.int64)
                ids = np.repeat(batch.column(0).to_numpy(), len(keys) // len(batch))
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(ids)], ["key", "id"])

    return in_batches(sets.select("id", "keys"), explode, "key long, id long")


def verify(pairs: DataFrame, docs: DataFrame, width: int, similarity: int) -> DataFrame:
    """The pairs (a, b) with 100 * intersection >= similarity * union on the full sets."""
    pairs = stored(pairs, "pairs")
    ids = stored(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "ids")
    # repeated rows have one set
    half = stored(full_sets(docs, ids, width).dropDuplicates(["id", "set_id"]).drop("set_id"), "members")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = np.zeros(len(batch), bool)
            for k, (x, y) in enumerate(zip(batch.column(2), batch.column(3))):
                good[k] = _similar(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64), similarity)
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(good)) for c in batch.columns[:2]], ["a", "b"])

    both = pairs.join(half.withColumnsRenamed({"id": "b", "members": "set_b"}), "b").join(half.withColumnsRenamed({"id": "a", "members": "set_a"}), "a")
    links = stored(in_batches(both.select("a", "b", "set_a", "set_b"), check, "a long, b long"), "links")
    drop_stored(pairs, ids, half)
    return links


def _candidates(k: int, right: np.ndarray, key: int, group: np.ndarray, size: np.ndarray, sketch: np.ndarray, keys: np.ndarray, similarity: int) -> np.ndarray:
    """The members of *right* in another group than *k* that may be similar, if this is the first band that the two share."""
    at = right[(group[right] != group[k]) & (100 * np.minimum(size[right], size[k]) >= similarity * np.maximum(size[right], size[k]))]
    floor = similarity / 100
    at = at[(sketch[at] == sketch[k]).mean(axis=1) >= floor - SLACK * np.sqrt(floor * (1 - floor) / sketch.shape[1])]
    first = np.argmax(keys[at] == keys[k], axis=1)
    return at[keys[k][first] == key]


def _similar(x: np.ndarray, y: np.ndarray, similarity: int) -> bool:
    """100 * intersection >= similarity * union of two sorted sets."""
    if 100 * min(len(x), len(y)) < similarity * max(len(x), len(y)):
        return False
    both = np.concatenate([x, y])
    both.sort(kind="stable")
    shared = int((both[1:] == both[:-1]).sum())
    return 100 * shared >= similarity * (len(both) - shared)


def _looks(t: pa.Table) -> tuple[np.ndarray, ...]:
    """ids, group, size, sketch and band keys of a bucket's members."""
    ids, group, size = (t[c].to_numpy() for c in ("id", "group", "n_shingles"))
    sketch = np.frombuffer(b"".join(t["sketch"].to_pylist()), np.uint8).reshape(len(ids), -1)
    keys = np.frombuffer(b"".join(t["keys"].to_pylist()), np.int64).reshape(len(ids), -1)
    return ids, group, size, sketch, keys


def pairs_in_small_buckets(members: DataFrame, similarity: int) -> DataFrame:
    """Candidate pairs (a, b) of different groups in each bucket; at most a block's members share one, so pairs grow with members."""

    def compare(t: pa.Table) -> pa.Table:
        ids, group, size, sketch, keys = _looks(t)
        a, b = [], []
        for k in range(len(ids)):
            meet = _candidates(k, np.arange(k + 1, len(ids)), t["key"][0].as_py(), group, size, sketch, keys, similarity)
            a += [ids[k]] * len(meet)
            b += list(ids[meet])
        a, b = np.array(a, np.int64), np.array(b, np.int64)
        return pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    return members.groupBy("key").applyInArrow(compare, "a long, b long")


def _dealt(members: DataFrame) -> DataFrame:
    """Members of large buckets on (key, i, j): each pair of the bucket's *cells* is a task of its own."""
    return (
        members.withColumn("cell", F.pmod(F.xxhash64("id"), F.col("cells")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cells") - 1)))
        .withColumns({"i": F.least("cell", "other"), "j": F.greatest("cell", "other")})
    )


def _sides(t: pa.Table) -> Iterator[tuple[int, np.ndarray]]:
    """(row, rows to compare it with) for a pair of cells, or for a cell with itself."""
    cell, i, j = t["cell"].to_numpy(), t["i"][0].as_py(), t["j"][0].as_py()
    across = np.flatnonzero(cell == j)
    for k in np.flatnonzero(cell == i):
        yield k, across[across > k] if i == j else across


def candidates_in_large_buckets(members: DataFrame, similarity: int) -> DataFrame:
    """(key, id) of the members that have a candidate in another group, by signatures alone."""

    def find(t: pa.Table) -> pa.Table:
        ids, group, size, sketch, keys = _looks(t)
        key, held = t["key"][0].as_py(), np.zeros(t.num_rows, bool)
        for k, right in _sides(t):
            meet = _candidates(k, right, key, group, size, sketch, keys, similarity)
            held[meet] = True
            held[k] |= len(meet) > 0
        return pa.table({"key": pa.array(np.full(held.sum(), key)), "id": ids[held]})

    return _dealt(members).groupBy("key", "i", "j").applyInArrow(find, "key long, id long").distinct()


def links_in_large_buckets(members: DataFrame, similarity: int) -> DataFrame:
    """Links (a, b) that join the groups of each bucket, verified on the full sets.

    A task looks at all its pairs of different groups but gives out only links that join two groups that it has not joined yet.
    """

    def join_groups(t: pa.Table) -> pa.Table:
        ids, group, size, sketch, keys = _looks(t)
        sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in t["members"]]
        group, key = group.copy(), t["key"][0].as_py()
        a, b = [], []
        for k, right in _sides(t):
            for other in _candidates(k, right, key, group, size, sketch, keys, similarity):
                if group[other] != group[k] and _similar(sets[k], sets[other], similarity):
                    a.append(min(ids[k], ids[other]))
                    b.append(max(ids[k], ids[other]))
                    group[group == group[other]] = group[k]
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return _dealt(members).groupBy("key", "i", "j").applyInArrow(join_groups, "a long, b long")


def across_groups(docs: DataFrame, buckets: DataFrame, sets: DataFrame, width: int, similarity: int, small: int = SMALL, block: int = BLOCK) -> DataFrame:
    """Links between different groups in a bucket: every pair that shares a band is looked at.

    *buckets*: key, id, group of the members of buckets with two groups or more, and n, their number, if it is known.
    """
    small_batches(docs.sparkSession)
    looks = sets.select("id", "sketch", "keys", "n_shingles")
    if "n" not in buckets.columns:
        buckets = spread_join(buckets, buckets.groupBy("key").agg(F.count("*").alias("n")), "key")
    members = stored(buckets.join(looks, "id"), "bucketed")
    links = verify(pairs_in_small_buckets(members.filter(F.col("n") <= small), similarity), docs, width, similarity)
    large = members.filter(F.col("n") > small)
    if not large.isEmpty():
        cells = F.ceil(F.col("n") / F.lit(block)).cast("int")
        found = stored(candidates_in_large_buckets(large.withColumn("cells", cells), similarity), "found")
        rest = large.drop("n").join(found, ["key", "id"])
        room = F.greatest(F.count("*") / F.lit(block), F.sum("n_shingles") / F.lit(BLOCK_SHINGLES))
        sized = stored(rest.groupBy("key").agg(F.count("*").alias("n"), F.ceil(room).cast("int").alias("cells")), "cells")
        ids = stored(rest.select("id").distinct(), "ids")
        texts = stored(full_sets(docs, ids, width).dropDuplicates(["id", "set_id"]).drop("set_id"), "large")
        joining = links_in_large_buckets(spread_join(rest, sized, "key").join(texts, "id"), similarity)
        small_links, links = links, stored(links.union(joining), "links")
        drop_stored(found, sized, ids, texts, small_links)
    drop_stored(members)
    return links


def near_duplicates(docs: DataFrame, width: int = 5, similarity: int = 80, bands: int = BANDS, rows: int = ROWS, small: int = SMALL, block: int = BLOCK) -> DataFrame:
    """doc_id, n_shingles, component_id of each row of *docs*."""
    signed = stored(documents_to_signatures(docs, width, bands, rows), "signatures")
    whole = signed.filter("doc_id IS NOT NULL AND set_id IS NOT NULL")
    # one representative for equal sets, which have equal keys and sketches
    carried = [F.first(c).alias(c) for c in ("keys", "sketch", "n_shingles")]
    sets = stored(whole.groupBy("set_id").agg(F.min("doc_id").alias("id"), F.count("*").alias("n"), *carried), "representatives")
    banded = explode_keys(sets)
    hubs = stored(banded.groupBy("key").agg(F.min("id").alias("a"), F.count("*").alias("n")).filter("n > 1"), "hubs")
    buckets = stored(spread_join(banded, hubs, "key"), "buckets")
    links = verify(buckets.filter("id <> a").select("a", F.col("id").alias("b")).distinct(), docs, width, similarity)
    groups = stored(connected_components(links.union(_same_id(whole, sets))), "groups")
    member = stored(buckets.join(groups.withColumnRenamed("node", "id"), "id", "left").select("key", "id", F.coalesce("component", "id").alias("group")), "grouped")
    mixed = stored(member.groupBy("key").agg(F.min("group").alias("lo"), F.max("group").alias("hi"), F.count("*").alias("n")).filter("lo < hi").select("key", "n"), "mixed")
    more = across_groups(docs, spread_join(member, mixed, "key"), sets, width, similarity, small, block)
    component = stored(connected_components(groups.union(more)), "components")
    # the copies of a set, a third of all documents perhaps, meet its group on dealt keys
    of_set = stored(sets.select("set_id", "id", "n").join(component.withColumnRenamed("node", "id"), "id", "left").select("set_id", "n", F.coalesce("component", "id").alias("component")), "sets")
    drop_stored(hubs, buckets, links, groups, member, mixed, more, sets, component)
    placed = spread_join(whole.select("doc_id", "set_id", "n_shingles"), of_set, "set_id", by="doc_id")
    placed = placed.select("doc_id", "n_shingles", F.col("component").alias("component_id"))
    # a row without words belongs to the rows of its doc_id that have some
    empty = signed.filter("doc_id IS NULL OR set_id IS NULL").select("doc_id", "n_shingles")
    named = placed.join(empty.select("doc_id").distinct(), "doc_id", "left_semi").groupBy("doc_id").agg(F.min("component_id").alias("component_id"))
    return placed.union(empty.join(named, "doc_id", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id")))


def _same_id(whole: DataFrame, sets: DataFrame) -> DataFrame:
    """Links between the sets of a doc_id that comes with several texts, so that it is one document."""
    twice = whole.groupBy("doc_id").agg(F.min("set_id").alias("first"), F.max("set_id").alias("last")).filter("first < last").select("doc_id", "first")
    named = sets.select("set_id", "id")
    return (
        whole.select("doc_id", "set_id")
        .join(twice, "doc_id")
        .filter("set_id <> first")
        .join(named.withColumnsRenamed({"id": "b"}), "set_id")
        .drop("set_id")
        .join(named.withColumnsRenamed({"id": "a", "set_id": "first"}), "first")
        .select("a", "b")
        .distinct()
    )


def keep_one(docs: DataFrame, width: int = 5, similarity: int = 80) -> DataFrame:
    """The rows of *docs* whose doc_id is the smallest of its group; rows without a doc_id stay."""
    groups = near_duplicates(docs, width, similarity)
    gone = stored(groups.filter("doc_id <> component_id").select("doc_id").distinct(), "gone")
    return anti_join(docs, gone, "doc_id", BROADCAST_IDS)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_duplicates(read_table(spark, sf_dir, "documents"), width=2)
    return out.withColumn("kept", F.col("doc_id") == F.col("component_id"))


#: The query in DuckDB's SQL, by exact sets: texts of a similarity of 0.8 share a shingle among the rarest fifth, and one more, of each.
ORACLE_SQL = rf"""
WITH RECURSIVE words AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), '{ascii_uppercase}', '{ascii_lowercase}'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
shingled AS (
  SELECT r, doc_id, list_sort(list_distinct(CASE WHEN len(w) = 1 THEN w ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END)) AS shingles
  FROM words),
sets AS (SELECT min(doc_id) AS id, shingles, len(shingles) AS n FROM shingled WHERE doc_id IS NOT NULL AND len(shingles) > 0 GROUP BY shingles),
held AS (SELECT DISTINCT hash(shingles) AS s, id, n, unnest(shingles) AS shingle FROM sets),
rare AS (
  SELECT s, id, n, shingle, row_number() OVER (PARTITION BY s, id ORDER BY f, shingle) AS place
  FROM held JOIN (SELECT shingle, count(*) AS f FROM held GROUP BY shingle) USING (shingle)),
firsts AS (SELECT * FROM rare WHERE place <= n - (4 * n + 4) // 5 + 1),
candidates AS (
  SELECT DISTINCT a.s AS s, a.id AS id, b.s AS s2, b.id AS id2
  FROM firsts a JOIN firsts b ON a.shingle = b.shingle AND (a.s < b.s OR (a.s = b.s AND a.id < b.id)) AND 5 * least(a.n, b.n) >= 4 * greatest(a.n, b.n)),
links AS (
  SELECT c.id AS a, c.id2 AS b
  FROM candidates c JOIN held x ON x.s = c.s AND x.id = c.id JOIN held y ON y.s = c.s2 AND y.id = c.id2 AND y.shingle = x.shingle
  GROUP BY c.s, c.id, c.s2, c.id2, x.n, y.n
  HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))),
edges AS (
  SELECT a, b FROM links UNION SELECT b, a FROM links
  UNION SELECT doc_id, id FROM shingled JOIN sets USING (shingles) WHERE doc_id IS NOT NULL
  UNION SELECT id, doc_id FROM shingled JOIN sets USING (shingles) WHERE doc_id IS NOT NULL),
reach AS (
  SELECT DISTINCT doc_id AS node, doc_id AS seen FROM shingled WHERE doc_id IS NOT NULL
  UNION SELECT node, b FROM reach JOIN edges ON seen = a),
components AS (SELECT node AS doc_id, min(seen) AS component_id FROM reach GROUP BY node)
SELECT doc_id, len(shingles)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept FROM shingled LEFT JOIN components USING (doc_id)"""
