"""Mixing sources to target weights by iterative proportional fitting.

Documents fall into cells of (source, language, topic).  Raking multiplies the
cells' token weights by target / current for one marginal after the other, until
all marginals are within TOLERANCE of their targets or ROUNDS have passed; what
gap remains is reported (a warning for the tempered targets, an error for targets
that the caller gives).  A document's probability is its cell's weight
per token times a constant that keeps the asked share of tokens, at most 1; the
document is kept if a hash of its doc_id falls below that.

One scan aggregates the cells (pre-aggregated per task); raking runs on the cell
table alone: up to LOCAL_CELLS cells (counted) as one small numpy table, beyond
that as DataFrame rounds written to the shared folder.  A last scan joins the
cells' probabilities back - broadcast up to BROADCAST_CELLS cells.  Nothing is
sampled before the decision.

The topic is a column the caller names; ``form_topic`` gives one from the form
of the text.

Defined results: nulls in source, language or topic are classes of their own;
null or empty texts have no tokens and probability 0 where their cell has none;
repeated rows count each, and share their fate where they share a doc_id; an
empty table gives an empty result; other columns are carried.
"""

from __future__ import annotations

import warnings

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adlake.llm.common import bounded_broadcast, drop_stored, read_table, stored, unused

QUERY_NAME = "op6_mixing_ipf"

ROUNDS, TOLERANCE = 40, 1e-13
#: A gap of a marginal above this counts as a target that was not met.
MET = 1e-6
LOCAL_CELLS, BROADCAST_CELLS = 100_000, 200_000
SEED = "mix-1"
#: Exponent of the tempered targets of the registered query: below 1 it lifts small classes.
TEMPER = {"source": 0.7, "lang": 0.7, "topic": 0.9}
KEEP_SHARE = 0.6
NONE = "(none)"

WORD = r"[^\x20\x09-\x0D]+"


def form_topic(text: Column) -> Column:
    """A class from the form of the text: table, marked, long or prose."""
    text = F.coalesce(text, F.lit(""))
    return F.when(text.contains(" | "), "table").when(text.rlike(r"[#*$%&]{3}"), "marked").when(F.length(text) >= 4000, "long").otherwise("prose")


def uniform(doc_id: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) from the doc_id."""
    digest = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))


def tempered(cells: DataFrame, name: str, exponent: float) -> DataFrame:
    """(name, target): shares proportional to a power of the tokens."""
    sums = cells.groupBy(name).agg(F.pow(F.sum("tokens").cast("double"), F.lit(exponent)).alias("lifted")).filter("lifted > 0")
    return sums.join(F.broadcast(sums.agg(F.sum("lifted").alias("all"))), F.lit(True)).select(name, (F.col("lifted") / F.col("all")).alias("target"))


def rake(cells: DataFrame, targets: dict[str, DataFrame], rounds: int = ROUNDS, tolerance: float = TOLERANCE, local_cells: int = LOCAL_CELLS) -> DataFrame:
    """*cells* (marginal columns, tokens) with w, shares that meet the targets' marginals, and gap, the largest difference that is left.

    targets: marginal column -> (column, target); classes without a target get none, targets are shares that sum to 1.
    """
    cells = cells.select(*targets, "tokens")
    few = cells.limit(local_cells + 1).count() <= local_cells
    return _rake_table(cells, targets, rounds, tolerance) if few else _rake_frames(cells, targets, rounds, tolerance)


def _rake_table(cells: DataFrame, targets: dict[str, DataFrame], rounds: int, tolerance: float) -> DataFrame:
    rows = cells.collect()
    w = np.array([float(r["tokens"] or 0) for r in rows])
    sides = []
    for name, target in targets.items():
        wanted = {r[name]: r["target"] for r in target.collect()}
        classes = sorted({r[name] for r in rows} | set(wanted), key=lambda x: (x is None, x))
        code = {c: k for k, c in enumerate(classes)}
        sides.append((np.array([code[r[name]] for r in rows], np.int64), np.array([wanted.get(c, 0.0) for c in classes])))

    def now(of: np.ndarray, goal: np.ndarray) -> np.ndarray:
        return np.bincount(of, w, minlength=len(goal))

    gap = 0.0
    for _ in range(rounds if rows else 0):
        for of, goal in sides:
            sums = now(of, goal)
            w = w * np.divide(goal, sums, out=np.zeros(len(goal)), where=sums > 0)[of]
        gap = max(np.abs(now(of, goal) - goal).max() for of, goal in sides)
        if gap <= tolerance:
            break
    schema = ", ".join([*(f"`{n}` {cells.schema[n].dataType.simpleString()}" for n in targets), "tokens long, w double, gap double"])
    return cells.sparkSession.createDataFrame([(*(r[n] for n in targets), r["tokens"], float(x), float(gap)) for r, x in zip(rows, w)], schema)


def _rake_frames(cells: DataFrame, targets: dict[str, DataFrame], rounds: int, tolerance: float) -> DataFrame:
    cells, gap = stored(cells.withColumn("w", F.col("tokens").cast("double")), "rake"), 0.0
    for _ in range(rounds):
        last = cells
        for name, target in targets.items():
            now = cells.groupBy(name).agg(F.sum("w").alias("_now"))
            factor = now.join(target, name, "left").select(name, F.coalesce(F.try_divide("target", "_now"), F.lit(0.0)).alias("_factor"))
            cells = cells.join(factor, name).withColumn("w", F.col("w") * F.col("_factor")).drop("_factor")
        cells = stored(cells, "rake")
        drop_stored(last)
        gap = 0.0
        for name, target in targets.items():
            both = cells.groupBy(name).agg(F.sum("w").alias("_now")).join(target, name, "full")
            gap = max(gap, both.agg(F.max(F.abs(F.coalesce("target", F.lit(0.0)) - F.coalesce("_now", F.lit(0.0))))).first()[0] or 0.0)
        if gap <= tolerance:
            break
    return cells.withColumn("gap", F.lit(gap))


def calibrate(cells: DataFrame, keep_share: float = KEEP_SHARE) -> DataFrame:
    """Adds probability: min(1, c * w / tokens), with c such that the expected tokens are *keep_share* of all (as far as 1 allows)."""
    total = cells.agg(F.sum("tokens"), F.sum("w")).first()
    if not total or not total[0] or not total[1]:
        return cells.withColumn("probability", F.lit(0.0))
    budget = keep_share * float(total[0])
    c = budget / total[1]
    while True:  # what full cells can't take goes to the others; each step fills a cell more or is the last
        full = F.col("w") * F.lit(c) >= F.col("tokens")
        row = cells.agg(F.sum(F.when(full, F.col("tokens")).otherwise(0)).alias("full"), F.sum(F.when(full, 0.0).otherwise(F.col("w"))).alias("open")).first()
        if not row["open"]:
            break
        new = (budget - float(row["full"])) / row["open"]
        if abs(new - c) <= 1e-12 * c:
            break
        c = new
    return cells.withColumn("probability", F.coalesce(F.least(F.lit(1.0), F.try_divide(F.col("w") * F.lit(c), F.col("tokens"))), F.lit(0.0)))


def mix(
    docs: DataFrame, topic: Column, temper: dict[str, float] = TEMPER, keep_share: float = KEEP_SHARE, targets: dict[str, DataFrame] | None = None, rounds: int = ROUNDS, seed: str = SEED, prefix: str = "_"
) -> DataFrame:
    """*docs* with topic, tokens, w, probability and kept, each behind *prefix*; ValueError if docs have one of these names."""
    names = {n: prefix + n for n in ("topic", "tokens", "w", "probability", "kept")}
    if clash := {c.lower() for c in docs.columns} & set(names.values()):
        raise ValueError(f"documents have columns {sorted(clash)}: choose another prefix")
    own = {n: unused(f"_{n}", docs) for n in ("source", "lang")} | {n: names[n] for n in ("topic", "tokens")}
    none = lambda c: F.coalesce(c.cast("string"), F.lit(NONE))
    named = docs.withColumns(
        {own["source"]: none(F.col("source")), own["lang"]: none(F.col("lang")), own["topic"]: F.coalesce(topic, F.lit(NONE)), own["tokens"]: F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")}
    )
    cells = stored(named.groupBy(*[F.col(own[n]).alias(n) for n in ("source", "lang", "topic")]).agg(F.sum(own["tokens"]).alias("tokens")), "cells")
    goals = targets or {name: stored(tempered(cells, name, e), f"target-{name}") for name, e in temper.items()}
    raked = rake(cells, goals, rounds)
    gap = raked.agg(F.max("gap")).first()[0] or 0.0
    if gap > MET:
        said = f"the marginals differ from their targets by up to {gap:.3g} after {rounds} rounds: no cells allow these targets together"
        if targets:
            raise ValueError(said)
        warnings.warn(said, stacklevel=2)
    of = {n: unused(f"_cell_{n}", named) for n in ("source", "lang", "topic")}
    fitted = stored(calibrate(raked, keep_share).select(*[F.col(n).alias(of[n]) for n in of], F.col("w").alias(names["w"]), F.col("probability").alias(names["probability"])), "fitted")
    drop_stored(cells, *(goals.values() if not targets else ()))
    same = [F.col(own[n]) == F.col(of[n]) for n in of]
    out = named.join(bounded_broadcast(fitted, BROADCAST_CELLS), same[0] & same[1] & same[2]).drop(own["source"], own["lang"], *of.values())
    return out.withColumn(names["kept"], uniform(F.col("doc_id"), seed) < F.col(names["probability"]))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang", "source")
    out = mix(docs, form_topic(F.col("text")))
    return out.select("doc_id", "source", "lang", F.col("_topic").alias("topic"), F.col("_tokens").alias("n_tokens"), F.round("_probability", 6).alias("probability"), F.col("_kept").alias("kept"))


def _oracle() -> str:
    steps = [
        f"""named AS MATERIALIZED (SELECT doc_id, source, lang, coalesce(source, '{NONE}') AS s, coalesce(lang, '{NONE}') AS l,
  CASE WHEN contains(coalesce(text, ''), ' | ') THEN 'table' WHEN regexp_matches(coalesce(text, ''), '[#*$%&]{{3}}') THEN 'marked'
    WHEN length(coalesce(text, '')) >= 4000 THEN 'long' ELSE 'prose' END AS t,
  len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS n FROM documents)""",
        "cells AS MATERIALIZED (SELECT s, l, t, CAST(sum(n) AS BIGINT) AS tokens FROM named GROUP BY ALL)",
    ]
    for short, name in (("s", "source"), ("l", "lang"), ("t", "topic")):
        steps.append(f"goal_{short} AS MATERIALIZED (SELECT {short}, pow(sum(tokens)::DOUBLE, {TEMPER[name]}) / sum(pow(sum(tokens)::DOUBLE, {TEMPER[name]})) OVER () AS target FROM cells GROUP BY {short} HAVING sum(tokens) > 0)")
    steps.append("w0 AS MATERIALIZED (SELECT *, tokens::DOUBLE AS w FROM cells)")
    k = 0
    for _ in range(ROUNDS):
        for short in "slt":
            steps.append(f"w{k + 1} AS MATERIALIZED (SELECT w{k}.* EXCLUDE (w), coalesce(w * target / nullif(sum(w) OVER (PARTITION BY w{k}.{short}), 0), 0) AS w FROM w{k} LEFT JOIN goal_{short} USING ({short}))")
            k += 1
    last = f"w{k}"
    steps.append(f"c0 AS MATERIALIZED (SELECT {KEEP_SHARE} * sum(tokens) / sum(w) AS c FROM {last})")
    for i in range(12):
        steps.append(
            f"c{i + 1} AS MATERIALIZED (SELECT coalesce(({KEEP_SHARE} * sum(tokens) - sum(CASE WHEN w * c >= tokens THEN tokens ELSE 0 END)) / nullif(sum(CASE WHEN w * c >= tokens THEN 0 ELSE w END), 0), any_value(c)) AS c FROM {last}, c{i})"
        )
    steps.append(f"p AS MATERIALIZED (SELECT s, l, t, coalesce(least(1.0, w * c / nullif(tokens, 0)), 0) AS probability FROM {last}, c12)")
    return "WITH " + ",\n".join(steps) + f"""
SELECT doc_id, source, lang, t AS topic, CAST(n AS BIGINT) AS n_tokens, round(probability, 6) AS probability,
  CAST(('0x' || substr(md5('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8)) AS BIGINT) / 4294967296.0 < probability AS kept
FROM named JOIN p USING (s, l, t)"""


ORACLE_SQL = _oracle()
