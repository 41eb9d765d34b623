"""Language ID: multilingual mixture inference by expectation-maximisation.

Each language is a multinomial over hashed byte trigrams of lower-cased letters.
A document is a mixture of languages: EM estimates the proportions that make its
trigrams likeliest.  The set of languages is chosen by penalised likelihood: the
nested sets of the 1, 2, ... largest proportions, up to all learned languages, are
fitted again, and the one with the least -2 log L + penalty * size * log(n) stays.
A size is left out only where an upper bound of its likelihood shows that it
cannot win.  EM of a document ends when none of its proportions moves by more
than a tolerance.  The prediction is the largest proportion of that set, its score the
proportion.  A text counts as standing between two spaces, so that every text
with a letter has a trigram.

Plan: two scans.  Counting shuffles at most languages x buckets sums per task;
only that table, of fixed size per language, goes through the driver.  EM runs
per document inside mapInArrow on the document's distinct trigrams.

Defined results: a text that is null or has no letter is `und` with score 0; no
training row gives `und` with score 0 everywhere; repeated rows are predicted
each; ties go to the smaller language name; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adlake.llm.common import crc_mod, in_batches, read_table
from adlake.llm.textgrams import Texts, chunks

QUERY_NAME = "op5_langid_em"

BUCKETS = 1 << 13
SMOOTHING = 0.5
#: EM of a document ends when no proportion moves further than this; ROUNDS only guards against endless work.
TOLERANCE, ROUNDS = 1e-4, 1000
#: Weight of log(n) per further language; adjacent trigrams overlap, so it is above 1.
PENALTY = 3.0

_FOLD = np.full(256, 0x20, np.uint8)
_FOLD[ord("a") : ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
_FOLD[ord("A") : ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)
_FOLD[0x80:] = np.arange(0x80, 0x100)


def trigrams(texts: Texts, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """(document, bucket) of each byte trigram with a letter or a non-ASCII byte inside.

    ASCII letters and the Latin-1 letters behind byte C3 are lower-cased, other ASCII bytes count as spaces.
    """
    owner = np.repeat(np.arange(texts.n), np.diff(texts.offsets) + 2)
    data = np.full(len(owner), 0x20, np.uint8)
    data[np.arange(len(texts.data)) + 2 * np.repeat(np.arange(texts.n), np.diff(texts.offsets)) + 1] = _FOLD[texts.data]
    if len(data) > 1:
        upper = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
        data[1:][upper] += 0x20
    if len(data) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    x = data.astype(np.uint32)
    gram = (x[:-2] << 16) | (x[1:-1] << 8) | x[2:]
    use = (gram != 0x202020) & (owner[:-2] == owner[2:])
    gram = gram[use] * np.uint32(0x9E3779B1)
    return owner[:-2][use], (gram >> np.uint32(32 - buckets.bit_length() + 1)).astype(np.int64)


def trigram_counts(docs: DataFrame, usable: Column, buckets: int = BUCKETS) -> DataFrame:
    """(lang, bucket, n) over the rows that meet the condition and have a language."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            names, of = np.unique(batch.column(1).to_numpy(zero_copy_only=False).astype(str), return_inverse=True)
            for a, b, texts in chunks(batch.column(0)):
                doc, bucket = trigrams(texts, buckets)
                sums = np.bincount(of[a:b][doc] * buckets + bucket, minlength=len(names) * buckets).reshape(len(names), buckets)
                for name, row in zip(names, sums):
                    held[name] = held.get(name, 0) + row
        for name, row in held.items():
            at = np.flatnonzero(row)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at), pa.array(row[at])], ["lang", "bucket", "n"])

    rows = docs.filter(usable & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("text", "lang")
    return in_batches(rows, count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def language_model(counts: DataFrame, buckets: int = BUCKETS, smoothing: float = SMOOTHING) -> tuple[list[str], np.ndarray]:
    """Language names in order and their smoothed bucket probabilities (languages x buckets)."""
    table = counts.toArrow()
    names, of = np.unique(table["lang"].to_numpy().astype(str), return_inverse=True)
    sums = np.zeros((len(names), buckets))
    sums[of, table["bucket"].to_numpy()] = table["n"].to_numpy()
    sums += smoothing
    return list(names), sums / sums.sum(axis=1, keepdims=True)


def _em(pi: np.ndarray, probs: np.ndarray, counts: np.ndarray, first: np.ndarray, owner: np.ndarray, total: np.ndarray, tolerance: float = TOLERANCE, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Proportions (documents x languages) and their log likelihood; probs: features x languages.

    A document leaves when no proportion moves by more than *tolerance*, whatever the others of its batch do.
    """
    pi = pi.copy()
    alive, p, n, of, start = np.arange(len(pi)), probs, counts, owner, first
    for _ in range(rounds):
        share = pi[alive][of] * p
        share *= (n / share.sum(axis=1))[:, None]
        now = np.add.reduceat(share, start, axis=0) / total[alive][:, None]
        moved = np.abs(now - pi[alive]).max(axis=1) > tolerance
        pi[alive] = now
        if not moved.any():
            break
        if not moved.all():
            use = moved[of]
            p, n, of = p[use], n[use], (np.cumsum(moved) - 1)[of[use]]
            start = np.searchsorted(of, np.arange(moved.sum()))
            alive = alive[moved]
    return pi, np.add.reduceat(counts * np.log((pi[owner] * probs).sum(axis=1)), first)


def mixtures(doc: np.ndarray, bucket: np.ndarray, model: np.ndarray, n_docs: int, max_languages: int | None = None, tolerance: float = TOLERANCE, penalty: float = PENALTY) -> np.ndarray:
    """Language proportions of each document after choosing its set of languages; zeros for a document without trigrams."""
    n_langs, buckets = model.shape
    out = np.zeros((n_docs, n_langs))
    if not len(doc):
        return out
    keys, counts = np.unique(doc * buckets + bucket, return_counts=True)
    counts = counts.astype(float)
    docs, owner = np.unique(keys // buckets, return_inverse=True)
    first = np.searchsorted(owner, np.arange(len(docs)))
    probs = np.ascontiguousarray(model.T[keys % buckets])
    total = np.add.reduceat(counts, first)
    full, reached = _em(np.full((len(docs), n_langs), 1 / n_langs), probs, counts, first, owner, total, tolerance)
    # the log likelihood is concave in the proportions: none exceeds this tangent's largest value
    slope = np.add.reduceat(probs * (counts / (full[owner] * probs).sum(axis=1))[:, None], first, axis=0)
    bound = reached + np.maximum(slope.max(axis=1) - total, 0) + 1e-6 * (1 + np.abs(reached))
    order = np.argsort(-full, axis=1, kind="stable")
    # one language: no EM needed
    single = np.add.reduceat(counts[:, None] * np.log(probs), first, axis=0)
    top = np.argmax(single, axis=1)
    best = np.zeros_like(full)
    best[np.arange(len(docs)), top] = 1
    cost = -2 * single[np.arange(len(docs)), top]
    for size in range(2, min(max_languages or n_langs, n_langs) + 1):
        todo = np.flatnonzero(-2 * bound + penalty * (size - 1) * np.log(total + 1) < cost)
        if not len(todo):
            break
        chosen = np.zeros_like(full, bool)
        np.put_along_axis(chosen, order[:, :size], True, 1)
        mark = np.zeros(len(docs), bool)
        mark[todo] = True
        use = mark[owner]
        sub_owner = np.searchsorted(todo, owner[use])
        sub_first = np.searchsorted(sub_owner, np.arange(len(todo)))
        start = np.where(chosen[todo], full[todo], 0)
        pi, fit = _em(start / start.sum(axis=1, keepdims=True), probs[use], counts[use], sub_first, sub_owner, total[todo], tolerance)
        now = -2 * fit + penalty * (size - 1) * np.log(total[todo] + 1)
        win = now < cost[todo]
        best[todo[win]], cost[todo[win]] = pi[win], now[win]
    out[docs] = best
    return out


def predict(docs: DataFrame, names: list[str], model: np.ndarray, max_languages: int | None = None) -> DataFrame:
    """doc_id, lang_pred, score and the chosen mixture (map of language to proportion) of each document."""
    held = docs.sparkSession.sparkContext.broadcast((names, model))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, model = held.value
        for batch in batches:
            for a, b, texts in chunks(batch.column(1)):
                if not names:
                    pi = np.zeros((texts.n, 1))
                else:
                    pi = mixtures(*trigrams(texts, model.shape[1]), model, texts.n, max_languages)
                top = np.argmax(pi, axis=1)
                score = np.clip(pi[np.arange(texts.n), top], 0, 1)
                for k in np.flatnonzero(score):  # texts without ASCII letters may have other letters, or none
                    span = texts.data[texts.offsets[k] : texts.offsets[k + 1]]
                    folded = _FOLD[span]
                    if not ((folded >= ord("a")) & (folded <= ord("z"))).any() and not any(map(str.isalpha, bytes(span).decode())):
                        score[k] = 0
                found = [names[t] if s > 0 else "und" for t, s in zip(top, score)]
                mix = [[(names[j], float(row[j])) for j in np.flatnonzero(row)] if s > 0 else [] for row, s in zip(pi, score)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(found, pa.string()), pa.array(score), pa.array(mix, pa.map_(pa.string(), pa.float64()))], ["doc_id", "lang_pred", "score", "mixture"])

    return in_batches(docs.select(F.col("doc_id").cast("long"), "text"), apply, "doc_id long, lang_pred string, score double, mixture map<string,double>")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    names, model = language_model(trigram_counts(docs, crc_mod(F.col("doc_id"), 3) != 1))
    out = predict(docs, names, model)
    return out.select("doc_id", (crc_mod(F.col("doc_id"), 3) == 1).alias("held_out"), "lang_pred", "score", "mixture")
