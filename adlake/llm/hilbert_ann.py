"""Approximate nearest neighbours by shifted space-filling curves.

Every vector is normalised, turned by ``curves`` random projections to a few
dimensions, made uniform by the sample's quantiles, shifted by a random offset,
and placed on a Hilbert curve.  On each curve the rows fall into ``windows``
ranges of equal share.  A query meets the rows of its own range and of the
neighbouring ranges on both sides - one, or more until they hold `beside` rows or the curve ends - on
every curve; the cosines are computed on the original vectors in double precision, and the best of
all curves are merged.

Projections, quantiles and range bounds come from at most ``sample`` rows (those
with the smallest hash of vec_id); every row is indexed.  A range is dealt to as
many tasks as its rows ask for (``block`` rows each), so a common vector with a
third of all rows is spread as well; only each task's best k of a query are
shuffled.

Recall follows the share of rows that the ranges cover, not their number: the
share is a parameter, so recall is alike at every size.  On vectors without
structure, like independent directions in 64 dimensions, neighbours are hardly
nearer than other rows and the curves must cover most rows to reach a recall of
0.9; `recall()` measures it against brute force.

Defined results: vectors that are null, of another length than the sample's
commonest, zero, or that hold null or non-finite components take no part (cosines
need one length, which the contract does not state); lengths of any magnitude do;
candidates with the query's own vec_id are left out; of repeated vec_ids the
best score counts; ties go to the smaller vec_id; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from adlake.llm.common import in_batches, read_table

QUERY_NAME = "op9_hilbert_ann"

CURVES, DIMENSIONS, BITS, WINDOWS = 16, 8, 6, 32
SAMPLE, BLOCK, SEED = 8192, 16384, 11
#: Rows that a query meets on each side of its range at least, as far as there are any.
BESIDE = 64


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve of integer points (n x d, below 2^bits): the axes are rotated and reflected bit by bit, then Gray-decoded."""
    x = cells.astype(np.int64).copy()
    n, d = x.shape
    level = 1 << (bits - 1)
    while level > 1:
        low = level - 1
        for i in range(d):
            high = (x[:, i] & level) > 0
            swap = np.where(high, 0, (x[:, 0] ^ x[:, i]) & low)
            x[:, 0] ^= np.where(high, low, swap)
            x[:, i] ^= swap
        level >>= 1
    for i in range(1, d):
        x[:, i] ^= x[:, i - 1]
    flip = np.zeros(n, np.int64)
    level = 1 << (bits - 1)
    while level > 1:
        flip[(x[:, d - 1] & level) > 0] ^= level - 1
        level >>= 1
    x ^= flip[:, None]
    key = np.zeros(n, np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(d):
            key = (key << 1) | ((x[:, i] >> b) & 1)
    return key


class Curves:
    """The projections, quantiles, shifts and range bounds of all curves, fitted on a sample (n x dimension)."""

    def __init__(self, sample: np.ndarray, curves: int = CURVES, dimensions: int = DIMENSIONS, bits: int = BITS, windows: int = WINDOWS, seed: int = SEED) -> None:
        rng = np.random.default_rng(seed)
        size = sample.shape[1]
        self.size, self.bits, self.windows = size, bits, windows
        dimensions = min(dimensions, size)
        self.turns = [np.linalg.qr(rng.normal(size=(size, dimensions)))[0] for _ in range(curves)]
        self.shifts = rng.random((curves, dimensions)) / 2
        unit = sample / np.linalg.norm(sample, axis=1, keepdims=True)
        grid = np.linspace(0, 1, 257)[1:-1]
        self.quantiles = [np.quantile(unit @ t, grid, axis=0) for t in self.turns]
        self.bounds = [np.quantile(self.keys(unit, c), np.linspace(0, 1, windows + 1)[1:-1], method="lower").astype(np.int64) for c in range(curves)]

    def keys(self, unit: np.ndarray, curve: int) -> np.ndarray:
        y = unit @ self.turns[curve]
        even = np.stack([np.searchsorted(self.quantiles[curve][:, k], y[:, k]) for k in range(y.shape[1])], axis=1) / 256
        return hilbert_keys(((even / 2 + self.shifts[curve]) * (1 << self.bits)).astype(np.int64), self.bits)

    def ranges(self, vectors: np.ndarray) -> np.ndarray:
        """The range of each vector on each curve (n x curves)."""
        unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
        return np.stack([np.searchsorted(self.bounds[c], self.keys(unit, c), "left") for c in range(len(self.turns))], axis=1)


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and vector (in its own type, so that no wider one is shuffled) of the rows that take part."""
    whole = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("vector"))
    odd = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return whole.filter(F.col("vec_id").isNotNull() & F.col("vector").isNotNull()).filter(~odd & F.exists("vector", lambda x: x != 0))


def scaled(vectors: np.ndarray) -> np.ndarray:
    """Each vector times a power of two that brings its largest component to 0.5 or more and below 1: no length overflows or vanishes, and cosines stay as they are."""
    return np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=1, initial=0))[1][:, None])


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return scaled(column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size))


def best_of(queries: np.ndarray, query_ids: np.ndarray, rows: np.ndarray, row_ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row, cosine) of the k best rows of each query; ties to the smaller id, other rows of the query's own id left out."""
    lengths, query_lengths = np.linalg.norm(rows, axis=1), np.linalg.norm(queries, axis=1)
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for a in range(0, len(queries), 64):
        some = queries[a : a + 64]
        near = (some @ rows.T) / lengths / query_lengths[a : a + 64, None]
        near[query_ids[a : a + 64, None] == row_ids[None, :]] = -np.inf
        least = np.partition(near, max(0, near.shape[1] - k), axis=1)[:, max(0, near.shape[1] - k)]
        for i in range(len(some)):
            # all rows that rounding could put among the best, once more by a sum of fixed order
            at = np.flatnonzero((near[i] >= least[i] - 1e-9) & np.isfinite(near[i]))
            exact = np.sum(rows[at] * some[i], axis=1) / (lengths[at] * query_lengths[a + i])
            order = np.lexsort((row_ids[at], -exact))[:k]
            out.append((np.full(len(order), query_ids[a + i]), row_ids[at[order]], exact[order]))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    return tuple(np.concatenate(x) for x in zip(*out))


def neighbours(rows: np.ndarray, beside: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last range that a query of each range meets (curves x ranges): one more on each side, or more until they hold *beside* rows."""
    curves, windows = rows.shape
    before = np.concatenate([np.zeros((curves, 1), np.int64), np.cumsum(rows, axis=1)], axis=1)
    first, last = np.zeros((curves, windows), np.int64), np.full((curves, windows), windows - 1, np.int64)
    for c in range(curves):
        for r in range(windows):
            low = [x for x in range(r) if before[c, r] - before[c, x] >= beside]
            high = [x for x in range(r + 1, windows) if before[c, x + 1] - before[c, r + 1] >= beside]
            first[c, r], last[c, r] = low[-1] if low else 0, high[0] if high else windows - 1
    return first, last


def nearest(vectors: DataFrame, is_query: Column, k: int = 5, curves: int = CURVES, windows: int = WINDOWS, sample: int = SAMPLE, block: int = BLOCK, beside: int = BESIDE) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each row that meets the condition on vec_id."""
    schema = "query_id long, vec_id long, score double"
    rows = usable(vectors)
    spark = vectors.sparkSession
    fit = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).select("vector").toArrow()["vector"].to_pylist()
    if not fit:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    sizes = np.bincount([len(v) for v in fit])
    size = int(sizes.argmax())
    fit = [v for v in fit if len(v) == size]
    fitted = Curves(scaled(np.array(fit, np.float64)), curves=curves, windows=windows)
    rows = rows.filter(F.size("vector") == size)
    kind = rows.schema["vector"].dataType.simpleString()
    held = spark.sparkContext.broadcast(fitted)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((curves, windows), np.int64)
        for batch in batches:
            got = held.value.ranges(_matrix(batch.column(0), size)) if len(batch) else np.zeros((0, curves), int)
            for c in range(curves):
                sums[c] += np.bincount(got[:, c], minlength=windows)
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(curves), windows)), pa.array(np.tile(np.arange(windows), curves)), pa.array(sums.ravel())], ["curve", "range", "n"])

    # curves x windows sums, whatever the input
    counted = in_batches(rows.select("vector"), count, "curve long, range long, n long").groupBy("curve", "range").agg(F.sum("n").alias("n")).toArrow()
    held_rows = np.zeros((curves, windows), np.int64)
    held_rows[counted["curve"].to_numpy(), counted["range"].to_numpy()] = counted["n"].to_numpy()
    parts = np.maximum(1, -(-held_rows // block))
    first, last = neighbours(held_rows, beside)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, len(batch), 500):
                some = batch.slice(a, 500)
                ids, asks = some.column(0).to_numpy(), some.column(2).to_numpy(zero_copy_only=False)
                got = held.value.ranges(_matrix(some.column(1), size))
                curve, of, cell, part, role = [], [], [], [], []
                for c in range(curves):
                    curve.append(np.full(len(ids), c))
                    of.append(np.arange(len(ids)))
                    cell.append(got[:, c])
                    part.append(ids % parts[c, got[:, c]])
                    role.append(np.zeros(len(ids), bool))
                    for i in np.flatnonzero(asks):  # a query goes to all parts of its own and the neighbouring ranges
                        for r in range(first[c, got[i, c]], last[c, got[i, c]] + 1):
                            n = parts[c, r]
                            curve.append(np.full(n, c))
                            of.append(np.full(n, i))
                            cell.append(np.full(n, r))
                            part.append(np.arange(n))
                            role.append(np.ones(n, bool))
                of = pa.array(np.concatenate(of))
                where = [pa.array(np.concatenate(x).astype(t)) for x, t in ((curve, np.int32), (cell, np.int32), (part, np.int64), (role, bool))]
                yield pa.RecordBatch.from_arrays([*where, some.column(0).take(of), some.column(1).take(of)], ["curve", "range", "part", "asks", "vec_id", "vector"])

    def rerank(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        ids, asks = group["vec_id"].to_numpy(), group["asks"].to_numpy()
        all_vectors = _matrix(group["vector"].combine_chunks(), size) if len(group) else np.zeros((0, size))
        if asks.all() or not asks.any():
            q, v, s = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        else:
            q, v, s = best_of(all_vectors[asks], ids[asks], all_vectors[~asks], ids[~asks], k)
        return pa.table({"query_id": q, "vec_id": v, "score": s})

    dealt = in_batches(rows.select("vec_id", "vector", F.coalesce(is_query, F.lit(False)).alias("asks")), place, f"curve int, range int, part long, asks boolean, vec_id long, vector {kind}")
    found = dealt.groupBy("curve", "range", "part").applyInArrow(rerank, schema)
    merged = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return merged.withColumn("rank", order).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def recall(found: DataFrame, vectors: DataFrame, is_query: Column, k: int = 5) -> float:
    """Share of the true k nearest that *found* holds, by brute force over all rows: for tests and measurements."""
    rows = usable(vectors).toArrow()
    ids, all_vectors = rows["vec_id"].to_numpy(), scaled(np.array(rows["vector"].to_pylist(), np.float64))
    asks = np.isin(ids, usable(vectors).filter(is_query).select("vec_id").toArrow()["vec_id"].to_numpy())
    q, v, _ = best_of(all_vectors[asks], ids[asks], all_vectors, ids, k)
    got = found.select("query_id", "vec_id").toArrow()
    true = set(zip(q.tolist(), v.tolist()))
    return len(true & set(zip(got["query_id"].to_pylist(), got["vec_id"].to_pylist()))) / max(1, len(true))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)
