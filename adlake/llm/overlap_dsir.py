"""Target-distribution importance resampling with n-grams found by an overlapped regex scan.

A text is brought to words parted by single spaces.  For each length n a pattern of
n words between boundary lookarounds, run with overlapped=True, matches at every
word, so its spans are the n-grams; a feature's bucket is the CRC-32 of its span.

Steps on Spark: one scan of the texts writes each row's buckets (two bytes a
feature, so texts are not read again); counts by bucket are made in every task and
summed, for the corpus and for the target; the log gains - one number a bucket,
a fixed size - go to the tasks with the function; a row's weight is the floored
mean gain of its features.  Adding Gumbel noise from a hash of the doc_id and
taking the highest scores draws without replacement in proportion to the weights.

Scores are whole numbers in a fixed range (a gain is below 60,000 in size, the noise between
-3,200 and 45,000), so the rows of each score are counted, the counts summed from the top
on the driver, and ranks are given within each score: no sort of all rows in one task.

Defined results: null and empty texts have no features, the weight 0 and no rank;
a null doc_id has the noise of an empty id and comes first among ties; repeated
rows count each, and tie in any order where they are equal; an empty table gives
an empty result, an empty target gives gains from the smoothing alone; other
columns are ignored by `resample`; `chosen` gives the drawn documents with all of theirs.
"""

from __future__ import annotations

from collections.abc import Iterator
from string import ascii_lowercase, ascii_uppercase
from zlib import crc32

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from adlake.llm.common import drop_stored, id_bitmap, in_batches, read_table, stored, unused

QUERY_NAME = "op13_overlap_dsir"

ORDER, BUCKETS, SEED = 2, 10_000, 7
LEAST_WORDS, DRAW_PERCENT = 20, 25

#: Every byte as it stands in a scanned text: letters A-Z small, separators as spaces.
_PLAIN = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def ngram_patterns(order: int = ORDER) -> list[regex.Pattern]:
    """For each length up to *order* a pattern that spans so many whole words."""
    return [regex.compile(rb"(?<![^ ])" + rb" ".join([rb"[^ ]++"] * n) + rb"(?![^ ])") for n in range(1, order + 1)]


def features(text: str | None, patterns: list[regex.Pattern], buckets: int = BUCKETS) -> tuple[int, np.ndarray]:
    """Number of words, and the bucket of every run of words that one of *patterns* spans."""
    plain = b" ".join((text or "").encode().translate(_PLAIN).split())
    found = [[crc32(m[0]) for m in p.finditer(plain, overlapped=True)] for p in patterns]
    return len(found[0]), (np.array(sum(found, []), np.uint32) % buckets).astype(np.uint16)


def scan(docs: DataFrame, order: int = ORDER, buckets: int = BUCKETS) -> DataFrame:
    """doc_id, n_words, and features: the buckets of a row as two bytes each."""
    if buckets > 1 << 16:
        raise ValueError("a bucket is kept in two bytes")

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patterns = ngram_patterns(order)
        for batch in batches:
            found = [features(t.as_py(), patterns, buckets) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([n for n, _ in found], pa.int64()), pa.array([x.astype("<u2").tobytes() for _, x in found], pa.binary())], ["doc_id", "n_words", "features"]
            )

    return in_batches(docs.select("doc_id", "text"), find, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_words long, features binary")


def bucket_counts(scanned: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features by bucket over all rows: one vector of *buckets* sums leaves each task and is added up on executors."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for x in batch.column(0):
                total += np.bincount(np.frombuffer(x.as_buffer(), "<u2"), minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array(total[held])], ["bucket", "n"])

    sums = in_batches(scanned.select("features"), count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for row in sums.collect():  # at most *buckets* rows
        out[row["bucket"]] = row["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of each bucket's smoothed share of the target over that of the corpus."""
    n = float(len(corpus))
    s, t = corpus.astype(float), target.astype(float)
    return np.floor(1000 * np.log((t + 1) * (s.sum() + n) / ((s + 1) * (t.sum() + n)))).astype(np.int64)


def weigh(scanned: DataFrame, gain: np.ndarray) -> DataFrame:
    """doc_id, n_words, n_features, weight."""

    def mean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = [np.frombuffer(x.as_buffer(), "<u2") for x in batch.column(2)]
            weights = [int(gain[x].sum()) // len(x) if len(x) else 0 for x in held]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([len(x) for x in held], pa.int64()), pa.array(weights, pa.int64())], ["doc_id", "n_words", "n_features", "weight"])

    return in_batches(scanned, mean, f"doc_id {scanned.schema['doc_id'].dataType.simpleString()}, n_words long, n_features long, weight long")


def gumbel(doc_id: Column, seed: int = SEED) -> Column:
    """floor(1000 x) of a Gumbel number x from the hash of seed and doc_id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def draw(scored: DataFrame, least_words: int = LEAST_WORDS, percent: int = DRAW_PERCENT) -> DataFrame:
    """Adds rank to rows with n_words and score: 1, 2, ... for the drawn share of the rows with enough words, else null."""
    enough = F.coalesce(F.col("n_words") >= least_words, F.lit(False))
    # scores are whole numbers in a fixed range, so this is bounded whatever the rows
    counts = sorted(((r["score"], r["n"]) for r in scored.filter(enough).groupBy("score").agg(F.count("*").alias("n")).collect()), reverse=True)
    wanted = percent * sum(n for _, n in counts) // 100
    above, seen = [], 0
    for score, n in counts:
        if seen >= wanted:
            break
        above.append((score, seen))
        seen += n
    offsets = F.broadcast(scored.sparkSession.createDataFrame(above, "_score long, _above long"))
    lowest = above[-1][0] if above else None
    high = enough & (F.col("score") >= F.lit(lowest)) if above else F.lit(False)
    within = F.row_number().over(Window.partitionBy("score").orderBy("doc_id"))
    drawn = scored.filter(high).withColumn("_row", within).join(offsets, F.col("score") == F.col("_score"))
    rank = F.col("_above") + F.col("_row")
    drawn = drawn.withColumn("rank", F.when(rank <= wanted, rank)).drop("_row", "_score", "_above")
    return drawn.unionByName(scored.filter(~high).withColumn("rank", F.lit(None).cast("long")))


def resample(docs: DataFrame, target: DataFrame, order: int = ORDER, buckets: int = BUCKETS, seed: int = SEED, least_words: int = LEAST_WORDS, percent: int = DRAW_PERCENT) -> DataFrame:
    """doc_id, n_words, n_features, weight, score and rank of each row of *docs* for the texts of *target*."""
    scanned = stored(scan(docs, order, buckets), "features")
    wanted = scan(target.select(F.lit(None).cast("long").alias("doc_id"), "text"), order, buckets)
    gain = gains(bucket_counts(scanned, buckets), bucket_counts(wanted, buckets))
    scored = stored(weigh(scanned, gain).withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed)), "scored")
    drop_stored(scanned)
    return draw(scored, least_words, percent)


def chosen(docs: DataFrame, ranked: DataFrame) -> DataFrame:
    """The documents that `resample` or `draw` drew, with all their columns and their rank (`rank_`, if they have a rank of their own).

    All rows of a drawn doc_id, with its first rank.  Only rows that a bitmap of the drawn ids lets pass are shuffled.
    """
    rank, key = unused("rank", docs), unused("_drawn", docs)
    first = stored(ranked.filter("rank IS NOT NULL").groupBy(F.col("doc_id").alias(key)).agg(F.min("rank").alias(rank)), "drawn")
    may = id_bitmap(first.select(F.xxhash64(key).alias("h")), "h")(F.xxhash64("doc_id"))
    return docs.filter(may).join(first, F.col("doc_id").eqNullSafe(F.col(key))).drop(key)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return resample(docs, read_table(spark, sf_dir, "benchmark")).select("doc_id", "n_features", "weight", "score", "rank")


def _oracle() -> str:
    """The query in DuckDB's SQL: CRC-32 by its table of 256 remainders, folded over each different feature's bytes."""
    words = f"regexp_extract_all(translate(coalesce(text, ''), '{ascii_uppercase}', '{ascii_lowercase}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    runs = "unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f"
    remainder = "list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, i)"
    digit = "instr('123456789ABCDEF', substr(x, {}, 1))"
    nibble = digit.replace("x,", "hex(f),")
    byte = f"16 * {nibble.format('2 * i + 1')} + {nibble.format('2 * i + 2')}"
    h = " + ".join(f"{16 ** (8 - k)} * {digit.format(k)}" for k in range(1, 9))
    return f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {words} AS w FROM documents),
wanted AS (SELECT {words} AS w FROM benchmark),
corpus_runs AS (SELECT r, f, count(*) AS n FROM (SELECT r, {runs} FROM docs) GROUP BY r, f),
target_runs AS (SELECT f, count(*) AS n FROM (SELECT {runs} FROM wanted) GROUP BY f),
remainders AS (SELECT list({remainder} ORDER BY i) AS t FROM range(256) _(i)),
named AS (SELECT f FROM corpus_runs UNION SELECT f FROM target_runs),
bytes AS (SELECT f, list_transform(range(octet_length(encode(f))), lambda i: {byte}) AS b FROM named),
buckets AS (
  SELECT f, xor(list_reduce(b, lambda c, x: xor(c >> 8, t[1 + (xor(c, x) & 255)]), 4294967295), 4294967295) % {BUCKETS} AS bucket
  FROM bytes, remainders),
corpus AS (SELECT bucket, sum(n)::DOUBLE AS s FROM corpus_runs JOIN buckets USING (f) GROUP BY bucket),
target AS (SELECT bucket, sum(n)::DOUBLE AS t FROM target_runs JOIN buckets USING (f) GROUP BY bucket),
totals AS (SELECT coalesce((SELECT sum(s) FROM corpus), 0) AS ss, coalesce((SELECT sum(t) FROM target), 0) AS tt),
gains AS (
  SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1) * (ss + {BUCKETS}) / ((s + 1) * (tt + {BUCKETS}))))::BIGINT AS gain
  FROM corpus LEFT JOIN target USING (bucket), totals),
sums AS (SELECT r, sum(n) AS n_features, sum(n * gain) AS total FROM corpus_runs JOIN buckets USING (f) JOIN gains USING (bucket) GROUP BY r),
noise AS (SELECT r, doc_id, len(w) AS n_words, substr(upper(sha256('{SEED}:' || coalesce(doc_id::VARCHAR, ''))), 1, 8) AS x FROM docs),
scored AS (
  SELECT doc_id, n_words, coalesce(n_features, 0)::BIGINT AS n_features, coalesce(floor(total::DOUBLE / n_features), 0)::BIGINT AS weight,
    floor(-1000 * ln(-ln(({h} + 0.5::DOUBLE) / 4294967296)))::BIGINT AS noise
  FROM noise LEFT JOIN sums USING (r)),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY n_words >= {LEAST_WORDS} ORDER BY weight + noise DESC, doc_id NULLS FIRST) AS place,
    {DRAW_PERCENT} * count(*) OVER (PARTITION BY n_words >= {LEAST_WORDS}) // 100 AS wanted
  FROM scored)
SELECT doc_id, n_features, weight, weight + noise AS score, CASE WHEN n_words >= {LEAST_WORDS} AND place <= wanted THEN place END AS rank FROM placed"""


ORACLE_SQL = _oracle()
