"""Quality rules: hashed n-gram log-likelihood ratio of trusted target against raw corpus.

Words and adjacent word pairs of every document fall into ``buckets`` hash
buckets.  Two multinomials over the buckets are counted: one over all documents
(raw), one over the documents that the labels call good (target), with a prior of
SMOOTHING counts a bucket that follows the raw counts.  A document's
score is the mean over its n-grams of log p_target - log p_raw, so it does not
depend on length; a document is kept if its score reaches ``threshold``.  No
sampling takes part: equal texts get equal verdicts.

The threshold is a parameter of `quality`: on another corpus, take a low quantile
of the scores of documents that are labelled good, as THRESHOLD is for the tables
at hand (over 98 per cent of theirs lie above it).

Plan: three scans.  Two sum a fixed number of buckets per task and shuffle only
those sums - of all texts without a join, and of the texts that a semi-join with
the labels leaves; the third scores in place.  Only the bucket tables (a fixed
size) go through the driver.  Labels beyond the broadcast bound are shuffled, and
with them the labelled texts: for large scans Spark puts a Bloom filter of the
labels before that shuffle.

Defined results: null text counts as empty; a text without words has score 0 and
fails the base rules; a corpus without a trusted document scores 0 everywhere;
repeated rows are counted and scored each, also those of a null doc_id, which is
never trusted; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlake.llm.common import bounded_broadcast, in_batches, read_table
from adlake.llm.textgrams import Texts, chunks, join_hashes, per_document

QUERY_NAME = "op1_quality_llr"

BUCKETS = 1 << 18
SMOOTHING = 10.0
THRESHOLD = -0.08
#: Ids of trusted documents are broadcast up to this many rows (some 4 MB), shuffled beyond.
BROADCAST_ROWS = 200_000

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True

RESULT = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, score double"


def gram_buckets(hashes: np.ndarray, first: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all words, and of all pairs with -1 where a pair would cross documents (the last word of each)."""
    one = (hashes % np.uint64(buckets)).astype(np.int64)
    two = np.full(len(hashes), -1, np.int64)
    if len(hashes) > 1:
        two[:-1] = (join_hashes(hashes[:-1], hashes[1:]) % np.uint64(buckets)).astype(np.int64)
        two[first[1:][np.diff(first) > 0] - 1] = -1
    return one, two


def repeated_words(hashes: np.ndarray, first: np.ndarray, n_docs: int, width: int = 8) -> np.ndarray:
    """Per document: words inside *width*-word windows that the document holds twice or more."""
    n = len(hashes)
    if n < width:
        return np.zeros(n_docs, np.int64)
    owner = np.repeat(np.arange(n_docs), np.diff(first))
    window = hashes[: n - width + 1]
    window = join_hashes(*[hashes[k : n - width + 1 + k] for k in range(width)], owner[: n - width + 1].astype(np.uint64))
    at = np.flatnonzero(owner[: n - width + 1] == owner[width - 1 :])
    order = np.argsort(window[at], kind="stable")
    sorted_windows = window[at][order]
    same = np.zeros(len(at) + 1, bool)
    same[1:-1] = sorted_windows[1:] == sorted_windows[:-1]
    hit = at[order[same[1:] | same[:-1]]]
    depth = np.zeros(n + 1, np.int64)
    np.add.at(depth, hit, 1)
    np.add.at(depth, hit + width, -1)
    return per_document((np.cumsum(depth)[:-1] > 0).astype(np.int64), first)


def duplicate_lines(texts: Texts) -> np.ndarray:
    """Per document: lines with a word that equal an earlier line."""
    breaks = np.flatnonzero(texts.data == 10)
    starts = np.union1d(breaks + 1, texts.offsets[:-1])
    starts = starts[starts < len(texts.data)]
    if not len(starts):
        return np.zeros(texts.n, np.int64)
    # a document's start opens a line, also after another document's last \n; empty documents share their start with the next
    owner = np.searchsorted(texts.offsets, starts, "right") - 1
    ends = np.minimum(np.append(starts[1:], len(texts.data)), texts.offsets[owner + 1])
    ends = ends - ((ends > starts) & (texts.data[np.maximum(ends, 1) - 1] == 10))
    word_starts, _, _ = texts.words()
    held = np.searchsorted(word_starts, ends) > np.searchsorted(word_starts, starts)
    starts, ends, owner = starts[held], ends[held], owner[held]
    h = join_hashes(texts.range_hash(starts, ends), owner.astype(np.uint64))
    order = np.argsort(h, kind="stable")
    again = np.zeros(len(h), bool)
    again[order[1:]] = h[order[1:]] == h[order[:-1]]
    return np.bincount(owner[again], minlength=texts.n).astype(np.int64)


def gram_counts(docs: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): n-gram counts of all texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, texts in chunks(batch.column(0)):
                starts, ends, first = texts.words()
                for grams in gram_buckets(texts.range_hash(starts, ends), first, buckets):
                    sums += np.bincount(grams[grams >= 0], minlength=buckets)
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(sums[at])], ["bucket", "n"])

    return in_batches(docs.select("text"), count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def trusted(docs: DataFrame, labels: DataFrame, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """The documents that *labels* give quality 1."""
    good = labels.filter((F.col("quality") == 1) & F.col("doc_id").isNotNull()).select(F.col("doc_id").alias("_good"))
    return docs.select("doc_id", "text").join(bounded_broadcast(good, broadcast_rows), F.col("doc_id") == F.col("_good"), "left_semi")


def log_ratios(raw_counts: DataFrame, target_counts: DataFrame, buckets: int = BUCKETS, smoothing: float = SMOOTHING) -> np.ndarray:
    """log p_target - log p_raw of each bucket; zeros if nothing is trusted."""
    raw, target = np.zeros(buckets), np.zeros(buckets)
    for sums, counts in ((raw, raw_counts), (target, target_counts)):
        table = counts.toArrow()
        sums[table["bucket"].to_numpy()] = table["n"].to_numpy()
    if not target.sum():
        return np.zeros(buckets, np.float32)
    # the prior follows the raw counts, so a bucket with little evidence has a ratio near 1
    expected = raw * (target.sum() / raw.sum())
    return np.log((target + smoothing) / (expected + smoothing)).astype(np.float32)


def score_documents(docs: DataFrame, ratios: np.ndarray) -> DataFrame:
    """Base counts and the length-normalised score of each document (columns of RESULT)."""
    held = docs.sparkSession.sparkContext.broadcast(ratios)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = held.value
        for batch in batches:
            for a, b, texts in chunks(batch.column(1)):
                starts, ends, first = texts.words()
                hashes = texts.range_hash(starts, ends)
                one, two = gram_buckets(hashes, first, len(table))
                gain = table[one].astype(np.float64) + np.where(two >= 0, table[two], 0)
                n = np.diff(first)
                grams = n + np.maximum(n - 1, 0)
                lead = np.zeros(len(texts.data) + 1, np.int64)  # code points before each byte
                np.cumsum((texts.data & 0xC0) != 0x80, out=lead[1:])
                symbols = np.zeros(len(texts.data) + 1, np.int64)
                np.cumsum(_SYMBOL[texts.data], out=symbols[1:])
                columns = [
                    n.astype(np.int64),
                    per_document(lead[ends] - lead[starts], first),
                    symbols[texts.offsets[1:]] - symbols[texts.offsets[:-1]],
                    duplicate_lines(texts),
                    repeated_words(hashes, first, texts.n),
                    per_document(gain, first) / np.maximum(grams, 1),
                ]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), *map(pa.array, columns)], ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "score"])

    return in_batches(docs.select(F.col("doc_id").cast("long"), "text"), score, RESULT)


def quality(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS, threshold: float = THRESHOLD) -> DataFrame:
    """Scores and verdicts of all documents; the target is the documents that *labels* give quality 1."""
    ratios = log_ratios(gram_counts(docs, buckets), gram_counts(trusted(docs, labels), buckets), buckets)
    scored = score_documents(docs, ratios)
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return scored.withColumn("base_failed", failed).withColumn("kept", ~failed & (F.col("score") >= F.lit(threshold)))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score")
