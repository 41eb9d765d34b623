"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text are the distinct hash buckets of its lower-cased words (outer
punctuation removed), adjacent pairs, pairs with one word between, and stems (the
first 4 to 7 bytes of longer words, as inflected words share them).  The
learner keeps a rate per coordinate and an L1 term that leaves most weights at
zero, so the model is a short list of (bucket, weight).  That list is broadcast;
each task marks its buckets in a table of bits before it reads the texts.

Training uses at most ``max_rows`` labelled rows (those with the smallest hash
of doc_id), so that the learner, which is sequential, runs in one bounded task.
The ids are chosen on the narrow label table; texts are fetched by a broadcast
join of that bounded list.  Scoring covers every document in one scan without a
shuffle.

Defined results: null or empty texts get the score of the intercept alone;
without labelled rows there is no evidence for label 1 and every score is 0;
equal texts score alike; an empty table gives an empty result; other columns are
ignored; a label row with a null is not used; where a doc_id has several labels
the largest counts.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlake.llm.common import crc_mod, in_batches, read_table
from adlake.llm.textgrams import Texts, chunks, join_hashes

QUERY_NAME = "op8_toxicity_ftrl"

BUCKETS = 1 << 20
#: Bound on the labelled rows that the learner reads.
MAX_TRAIN_ROWS = 20_000
ALPHA, BETA, L1, L2, EPOCHS = 1.0, 1.0, 4.0, 0.1, 5
STEMS = (4, 5, 6, 7)

_LETTER = np.zeros(256, bool)
_LETTER[ord("a") : ord("z") + 1] = True
_LETTER[0x80:] = True


def features(texts: Texts, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """(document, bucket) of each n-gram of the texts, with repeats, by document within each kind.

    A word is cut to the range from its first to its last letter; words without a letter drop out.
    """
    starts, ends, first = texts.words()
    at = np.flatnonzero(_LETTER[texts.data])
    if not len(at):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    owner = texts.owner(first)
    i, j = np.searchsorted(at, starts), np.searchsorted(at, ends)
    held = j > i
    starts, ends, owner = at[i[held]], at[j[held] - 1] + 1, owner[held]
    h = texts.range_hash(starts, ends)
    docs, grams = [owner], [h]
    for gap in (1, 2):
        if len(h) > gap:
            same = owner[gap:] == owner[:-gap]
            docs.append(owner[gap:][same])
            grams.append(join_hashes(h[:-gap][same], h[gap:][same]) + np.uint64(gap))
    for n in STEMS:
        longer = ends - starts > n
        docs.append(owner[longer])
        grams.append(texts.range_hash(starts[longer], starts[longer] + n) * np.uint64(3))
    return np.concatenate(docs), (np.concatenate(grams) % np.uint64(buckets)).astype(np.int64)


class Rows:
    """Texts as slices of one block of buckets, in a given order."""

    def __init__(self, block: np.ndarray, ends: np.ndarray, order: np.ndarray) -> None:
        self.block, self.ends, self.order = block, ends, order

    def __len__(self) -> int:
        return len(self.order)

    def __getitem__(self, k: int) -> np.ndarray:
        at = self.order[k]
        return self.block[self.ends[at] : self.ends[at + 1]]


def train_ftrl(texts: Sequence[np.ndarray] | Rows, labels: np.ndarray, buckets: int = BUCKETS, alpha: float = ALPHA, beta: float = BETA, l1: float = L1, l2: float = L2, epochs: int = EPOCHS) -> dict[int, float]:
    """Weights of the nonzero buckets, the intercept at -1; *texts* are arrays of distinct buckets."""
    z, n = np.zeros(buckets + 1), np.zeros(buckets + 1)

    def weights(at: np.ndarray) -> np.ndarray:
        shrunk = np.sign(z[at]) * np.maximum(np.abs(z[at]) - np.where(at == buckets, 0.0, l1), 0)
        return -shrunk / ((beta + np.sqrt(n[at])) / alpha + l2)

    order = np.random.default_rng(7)
    for _ in range(epochs):
        for k in order.permutation(len(texts)):
            at = np.append(texts[k], buckets)
            w = weights(at)
            g = 1 / (1 + np.exp(-np.clip(w.sum(), -30, 30))) - labels[k]
            root = np.sqrt(n[at])
            n[at] += g * g
            z[at] += g - (np.sqrt(n[at]) - root) / alpha * w
    at = np.flatnonzero(z)
    w = weights(at)
    return {int(b) if b < buckets else -1: float(x) for b, x in zip(at, w) if x}


def fit(docs: DataFrame, labels: DataFrame, usable: Column | None = None, max_rows: int = MAX_TRAIN_ROWS, buckets: int = BUCKETS) -> dict[int, float]:
    """Train on at most *max_rows* labelled documents; *usable* is a condition on doc_id."""
    rows = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
    if usable is not None:
        rows = rows.filter(usable)
    chosen = (
        rows.groupBy(F.col("doc_id").alias("_id"))
        .agg(F.max("toxic").cast("double").alias("_label"))
        .orderBy(F.xxhash64("_id"), "_id")
        .limit(max_rows)
    )
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("_id")).select("_id", "text", "_label")

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # one growing block of 32-bit buckets: some 2,000 a text
        grams, ends, ids, labels = array("i"), [0], [], []
        for batch in batches:
            for a, b, texts in chunks(batch.column(1), lower=True):
                doc, bucket = features(texts, buckets)
                keys = np.unique(doc * buckets + bucket)
                grams.frombytes((keys % buckets).astype(np.int32).tobytes())
                ends += (ends[-1] + np.searchsorted(keys, np.arange(1, texts.n + 1) * buckets)).tolist()
                ids.append(batch.column(0).slice(a, b - a).to_numpy())
                labels.append(batch.column(2).slice(a, b - a).to_numpy())
        model: dict[int, float] = {}
        if ids:
            order = np.argsort(np.concatenate(ids), kind="stable")  # the same order however Spark dealt the rows
            model = train_ftrl(Rows(np.frombuffer(grams, np.int32), np.array(ends), order), np.concatenate(labels)[order], buckets)
        yield pa.RecordBatch.from_arrays([pa.array(list(model), pa.int64()), pa.array(list(model.values()), pa.float64())], ["bucket", "weight"])

    model = in_batches(sample.repartition(1), learn, "bucket long, weight double").toArrow()
    return dict(zip(model["bucket"].to_pylist(), model["weight"].to_pylist()))


def score(docs: DataFrame, model: dict[int, float], buckets: int = BUCKETS, name: str = "score") -> DataFrame:
    """*docs* with the column *name*, which must be new."""
    used = np.array(sorted(b for b in model if b >= 0), np.int64)
    weights = np.array([model[b] for b in used.tolist()])
    held, intercept = docs.sparkSession.sparkContext.broadcast((used, weights)), model.get(-1, 0.0) if model else -np.inf
    names = docs.columns
    at_text = names.index("text")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        used, weights = held.value
        active = np.zeros(buckets, bool)
        active[used] = True
        for batch in batches:
            for a, b, texts in chunks(batch.column(at_text), lower=True):
                doc, bucket = features(texts, buckets)
                use = active[bucket]
                keys = np.unique(doc[use] * buckets + bucket[use])
                found = weights[np.searchsorted(used, keys % buckets)] if len(keys) else np.zeros(0)
                total = np.bincount(keys // buckets, found, minlength=texts.n) + intercept
                p = np.where(np.isfinite(total), 1 / (1 + np.exp(-np.clip(total, -30, 30))), 0.0)
                yield pa.RecordBatch.from_arrays([*(c.slice(a, b - a) for c in batch.columns), pa.array(p)], [*names, name])

    return in_batches(docs, apply, T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())]))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long"), "text")
    model = fit(docs, read_table(spark, sf_dir, "labels"), crc_mod(F.col("doc_id"), 5) != 0)
    held_out = docs.select("doc_id", "text", (crc_mod(F.col("doc_id"), 5) == 0).alias("held_out"))
    out = score(held_out, model).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
    return out.select("doc_id", "held_out", "score", "predicted")
