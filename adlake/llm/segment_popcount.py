"""SimHash near-dedup by segment popcounts: fingerprints, a grid under Manhattan distance, exact verification, groups.

A 64-bit fingerprint is embedded as the bit counts of its segments.  One differing
bit moves one count by one, so the Manhattan distance of two embeddings is a
lower bound of the Hamming distance, and fingerprints at two bits or fewer lie
within distance two.  Of two points at that distance some point of the grid is
within one step of both; so every fingerprint is put in the cell of its own
embedding and in those one step away (33 cells for 16 segments of 4 bits), and
whatever may link meets in a cell.  This is a range join by equal keys.

Steps on Spark:

1. one scan gives (doc_id, fingerprint); equal fingerprints collapse to one row by
   an aggregation, so a group of copies is one point whatever its size;
2. cells with two fingerprints or more keep their members;
3. members of cells of up to `small` are joined on the cell and their Hamming
   distance is tested;
4. members of fuller cells - near copies of one text - go on to a grid of one-bit
   segments.  There the embedding is the fingerprint and Manhattan distance is
   Hamming distance, so two members of a cell are at two bits or fewer for
   certain: each cell (65 members at most) gives a star and no pairs.  Thus work
   grows with the fingerprints however many of them fall into one cell;
5. connected components over the fingerprints, then the least doc_id of each.

With 16 segments random fingerprints meet with a probability of about 5e-7, so
candidates stay below links and rows up to some ten million different
fingerprints; for more, segments of 2 bits (65 cells, 5e-11) are a parameter.

Defined results: null text has no words and the fingerprint zero, which links
like any other; a text with fewer words than a shingle is one shingle; each row
counts for itself, so repeated doc_ids have their own fingerprints and link
nothing by their id; a null doc_id is carried and is never a component_id unless
a group has no other; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlake.llm.common import drop_stored, in_batches, read_table, spread_join, stored
from adlake.llm.components import connected_components

QUERY_NAME = "op11_segment_popcount"

WIDTH, SEED, BITS = 3, 42, 2
#: Bits of a segment of the first grid, and the fingerprints of a cell up to which they are compared with each other.
SEGMENT, SMALL = 4, 32
#: Shingles whose bits are counted at once.
COUNT_AT_ONCE = 1 << 15


def fingerprint(text: str | None, width: int = WIDTH, seed: int = SEED) -> int:
    """SimHash of the *width*-word shingles of a text in lower-case A-Z, repeats included: bits set in over half the XXH64 values."""
    words = (text or "").encode().lower().split()  # both know ASCII only: the words are runs without 0x20 and 0x09-0x0D
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    width = min(width, len(words))
    n, digest = len(words) - width + 1, xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for at in range(0, n, COUNT_AT_ONCE):
        to = min(n, at + COUNT_AT_ONCE)
        spans = zip(starts[at:to].tolist(), ends[at + width - 1 : to + width - 1].tolist())
        h = np.fromiter((digest(line[a:b], seed) for a, b in spans), np.uint64, to - at)
        ones += np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, width: int = WIDTH, seed: int = SEED) -> DataFrame:
    """(doc_id, fp) of each row, the fingerprint as a signed long."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.fromiter((fingerprint(t.as_py(), width, seed) for t in batch.column(1)), np.uint64, len(batch))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values.view(np.int64))], ["doc_id", "fp"])

    return in_batches(docs.select(F.col("doc_id").cast("long"), "text"), sign, "doc_id long, fp long")


def embedding(fp: np.ndarray, segment: int) -> np.ndarray:
    """The bit counts of the segments of *segment* bits (1, 2 or 4), each in the segment's place of a 64-bit word."""
    if segment >= 2:
        fp = (fp & np.uint64(0x5555555555555555)) + ((fp >> np.uint64(1)) & np.uint64(0x5555555555555555))
    if segment >= 4:
        fp = (fp & np.uint64(0x3333333333333333)) + ((fp >> np.uint64(2)) & np.uint64(0x3333333333333333))
    return fp


def cells(points: DataFrame, segment: int) -> DataFrame:
    """(cell, fp): each fingerprint of *points* in the cell of its embedding and in all cells one step away."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column(0).to_numpy().view(np.uint64)
            at = embedding(fp, segment)
            found = [(at, fp)]
            for k in range(0, 64, segment):
                step = np.uint64(1 << k)
                count = (at >> np.uint64(k)) & np.uint64((1 << segment) - 1)
                up, down = count < segment, count > 0
                found += [(at[up] + step, fp[up]), (at[down] - step, fp[down])]
            keys, owners = (np.concatenate(x).view(np.int64) for x in zip(*found))
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(owners)], ["cell", "fp"])

    return in_batches(points.select("fp"), deal, "cell long, fp long")


def links_within(points: DataFrame, bits: int = BITS, segment: int = SEGMENT, small: int = SMALL) -> DataFrame:
    """(a, b): links that join all *points* (different fingerprints) at two differing bits or fewer."""
    if bits > 2:
        raise ValueError("cells one step away meet for at most two bits")
    dealt = cells(points, segment)
    full = stored(dealt.groupBy("cell").agg(F.count("*").alias("n")).filter("n > 1"), "cells")
    members = stored(spread_join(dealt, full, "cell", by="fp"), "members")
    few = members.filter(F.col("n") <= small)
    left, right = few.select("cell", F.col("fp").alias("a")), few.select("cell", F.col("fp").alias("b"))
    near = left.join(right, "cell").filter((F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= bits))
    crowd = stored(members.filter(F.col("n") > small).select("fp").distinct(), "crowd")
    links = stored(near.select("a", "b").union(stars(crowd, bits)).distinct(), "links")
    drop_stored(full, members, crowd)
    return links


def stars(points: DataFrame, bits: int) -> DataFrame:
    """(a, b) from a grid of one-bit segments: the members of a cell all hang on its least."""
    if bits < 2:  # of two points of a cell one must be the cell itself
        raise ValueError("one-bit cells prove a distance of two only")
    of = cells(points, 1).groupBy("cell").agg(F.sort_array(F.collect_set("fp")).alias("fps")).filter("size(fps) > 1")
    return of.select(F.col("fps")[0].alias("a"), F.explode(F.slice("fps", 2, 64)).alias("b"))


def near_duplicates(docs: DataFrame, width: int = WIDTH, seed: int = SEED, bits: int = BITS, segment: int = SEGMENT, small: int = SMALL) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of each row of *docs*."""
    signed = stored(fingerprints(docs, width, seed), "fingerprints")
    # one point for equal fingerprints
    points = stored(signed.groupBy("fp").agg(F.min("doc_id").alias("id"), F.count("*").alias("n")), "points")
    links = links_within(points, bits, segment, small)
    groups = stored(connected_components(links), "groups")
    named = stored(points.join(groups.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp")), "named")
    least = stored(named.groupBy("component").agg(F.min("id").alias("component_id"), F.count("*").alias("m")), "least")
    of_point = stored(spread_join(named.select("fp", "n", "component"), least, "component", n="m", by="fp").select("fp", "n", "component_id"), "of_point")
    drop_stored(links, groups, points, named, least)
    # copies of one text, a third of all rows perhaps, meet their group on dealt keys
    out = spread_join(signed, of_point, "fp", by="doc_id")
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"))
