"""Secret scans with multipart credential linking, in SQL expressions only.

Strong secrets (assignments, access identifiers, long hex runs) are always
reported.  Weak candidates - user names or short access ids, short assignments,
short hex, 40-character keys, endpoints - mean little alone.  They are reported
only when complementary parts co-occur: a secret within ``scope`` code points of
an identifier or an endpoint, and the reverse.  This is an interval join inside
each document: the scopes of one side are merged into disjoint intervals, so a
part of the other side meets at most one of them and a document costs parts x
(length / scope) at most.  All parts of a credential lie in one text, so the join
needs no shuffle: the plan is one scan with generated code.

Defined results: null text is empty, with no spans; repeated rows are scanned
each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adlake.llm.common import read_table
from adlake.llm.spans import let, once, running, spans

QUERY_NAME = "op3_secret_links"

SCOPE = 200

# fixed values: the base patterns of the contract
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
# hex runs below the base length are looked for from 16 on; a run is taken whole
HEX_RUN = r"[0-9a-f]{16,}"

IDENTIFIER = r"""((?i:client_?id|user_?name|user|login|account))["']?\x20*[:=]\x20*["']?([A-Za-z0-9_.@-]{3,})"""
ENDPOINT = r"""(?:https?|jdbc:[a-z]+|amqps?|mongodb|postgres|redis|ftp)://([A-Za-z0-9._:@/-]+)|(?i:host|endpoint|server)["']?\x20*[:=]\x20*["']?([A-Za-z0-9._:/-]{3,})"""
KEY40 = r"(?<![A-Za-z0-9+/=])(?=[A-Za-z0-9+/]*[A-Z])(?=[A-Za-z0-9+/]*[a-z])(?=[A-Za-z0-9+/]*[0-9])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/])"

#: Kinds in the order in which spans with one start are listed; the first three are the base.
KINDS = ("assign", "access", "hex", "short_assign", "short_access", "short_hex", "key40", "identifier", "endpoint")


def _kind(found: Column, name: str, keep=None) -> Column:
    rows = found if keep is None else F.filter(found, keep)
    return F.transform(rows, lambda x: F.struct(x["start"].alias("start"), F.lit(KINDS.index(name)).alias("rank"), F.lit(name).alias("kind"), x["end"].alias("end")))


def _listed(parts: Column) -> Column:
    ordered = F.array_sort(parts)
    return F.array_join(F.transform(ordered, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def _near(sides: Column, scope: int) -> Column:
    """For each (parts, others) of *sides*: the parts within *scope* of one of the others: one that begins no later must end near enough, or the next one must begin so."""
    none = -(1 << 30)

    def merged(events: Column) -> Column:
        ends = F.transform(events, lambda e: F.when(e["is_part"], none).otherwise(e["part"]["end"]))
        # the least start behind each place, as the running maximum of negative starts from the right
        starts = F.reverse(F.transform(events, lambda e: F.when(e["is_part"], none).otherwise(-e["start"])))
        both = F.transform(F.array(ends, starts), lambda x: running(x, F.greatest))
        rows = let(both, lambda x: F.arrays_zip(events.alias("event"), F.get(x, F.lit(0)).alias("before"), F.reverse(F.get(x, F.lit(1))).alias("behind")))
        held = F.filter(rows, lambda r: r["event"]["is_part"] & ((r["before"] >= r["event"]["start"] - scope) | (-r["behind"] <= r["event"]["part"]["end"] + scope)))
        return F.transform(held, lambda r: r["event"]["part"])

    def event(is_part: bool):
        return lambda p: F.struct(p["start"].alias("start"), F.lit(is_part).alias("is_part"), p.alias("part"))

    def near(x: Column) -> Column:
        events = F.array_sort(F.concat(F.transform(x["parts"], event(True)), F.transform(x["others"], event(False))))
        return F.when((F.size(x["parts"]) > 0) & (F.size(x["others"]) > 0), let(events, merged)).otherwise(F.slice(x["parts"], 1, 0))

    return F.flatten(F.transform(sides, near))


def scan_secrets(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """doc_id and the arrays base (strong spans) and linked (weak spans with their complement), each (start, rank, kind, end)."""
    whole = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    text, weak = F.col("text"), F.col("weak")
    # weak patterns are looked for only where an identifier or an endpoint stands at all
    anchored = text.rlike(IDENTIFIER) | text.rlike(ENDPOINT) | text.contains("AKIA")
    searches = [(text, ASSIGN, 2), (text, ACCESS, 0), (text, HEX_RUN, 0), (weak, KEY40, 0), (weak, IDENTIFIER, 0), (weak, ENDPOINT, 0)]
    found = whole.withColumn("weak", F.when(anchored, text)).select("doc_id", once(spans(searches)).alias("found"))
    assign, access, hexes, key40, identifier, endpoint = (F.get("found", F.lit(k)) for k in range(len(searches)))
    found = found.select(
        "doc_id",
        F.concat(_kind(assign, "assign", lambda x: x["size"] >= 6), _kind(access, "access", lambda x: x["size"] >= 20), _kind(hexes, "hex", lambda x: x["size"] >= 24)).alias("base"),
        F.concat(_kind(assign, "short_assign", lambda x: x["size"] < 6), _kind(hexes, "short_hex", lambda x: x["size"] < 24), _kind(key40, "key40")).alias("weak_secrets"),
        F.concat(_kind(access, "short_access", lambda x: x["size"] < 20), _kind(identifier, "identifier"), _kind(endpoint, "endpoint")).alias("weak_names"),
    )
    names = F.concat("weak_names", F.filter("base", lambda x: x["kind"] == "access"))
    secrets = F.concat("weak_secrets", F.filter("base", lambda x: x["kind"] != "access"))
    sides = F.array(F.struct(F.col("weak_secrets").alias("parts"), names.alias("others")), F.struct(F.col("weak_names").alias("parts"), secrets.alias("others")))
    return found.select("doc_id", "base", once(_near(sides, scope)).alias("linked"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(read_table(spark, sf_dir, "documents"))

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        count("assign"),
        count("access"),
        count("hex"),
        F.sha2(_listed(F.col("base")), 256).alias("base_sha256"),
        _listed(F.concat("base", "linked")).alias("spans"),
    )


def _spelled(pattern: str) -> str:
    """The pattern with (?i:...) spelled out letter by letter, as engines fold letters beyond ASCII differently."""
    return re.sub(r"\(\?i:([^)]*)\)", lambda m: "(?:" + re.sub("[a-z]", lambda c: f"[{c[0].upper()}{c[0]}]", m[1]) + ")", pattern)


def _oracle() -> str:
    kinds = {"assign": ASSIGN, "access": ACCESS, "hex": HEX_RUN, "identifier": IDENTIFIER, "endpoint": ENDPOINT, "run": "[A-Za-z0-9+/]+"}
    quoted = {k: "'" + _spelled(p).replace("'", "''") + "'" for k, p in kinds.items()}
    found = " UNION ALL ".join(
        f"SELECT r, '{k}' AS raw, unnest(m) AS m, unnest(string_split_regex(text, {p})[1:len(m)]) AS gap, unnest(range(len(m))) AS i FROM (SELECT *, regexp_extract_all(text, {p}) AS m FROM docs)" for k, p in quoted.items()
    )
    ranks = " ".join(f"WHEN '{k}' THEN {n}" for n, k in enumerate(KINDS))
    listed = "coalesce(string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, CASE kind {ranks} END, e){where}, '')"
    base = listed.format(ranks=ranks, where=" FILTER (WHERE base)")
    near = lambda complement: f"EXISTS (SELECT 1 FROM parts o WHERE o.r = p.r AND o.{complement} AND o.s <= p.e + {SCOPE} AND o.e >= p.s - {SCOPE})"
    return f"""WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
hits AS ({found}),
placed AS (SELECT *, CAST(sum(length(gap) + length(m)) OVER (PARTITION BY r, raw ORDER BY i) AS BIGINT) AS e FROM hits),
kinds AS (SELECT r, e - length(m) AS s, e, CASE
  WHEN raw = 'assign' THEN CASE WHEN length(regexp_extract(m, {quoted['assign']}, 2)) >= 6 THEN 'assign' ELSE 'short_assign' END
  WHEN raw = 'access' THEN CASE WHEN length(m) >= 20 THEN 'access' ELSE 'short_access' END
  WHEN raw = 'hex' THEN CASE WHEN length(m) >= 24 THEN 'hex' ELSE 'short_hex' END
  WHEN raw <> 'run' THEN raw
  WHEN length(m) = 40 AND regexp_matches(m, '[A-Z]') AND regexp_matches(m, '[a-z]') AND regexp_matches(m, '[0-9]') AND NOT suffix(gap, '=') THEN 'key40' END AS kind FROM placed),
parts AS (SELECT *, kind IN ('assign', 'access', 'hex') AS base, kind IN ('access', 'short_access', 'identifier', 'endpoint') AS is_name,
  kind IN ('assign', 'hex', 'short_assign', 'short_hex', 'key40') AS is_secret FROM kinds WHERE kind IS NOT NULL),
kept AS (SELECT * FROM parts p WHERE base OR (is_name AND {near('is_secret')}) OR (is_secret AND {near('is_name')}))
SELECT doc_id, CAST(count(*) FILTER (WHERE kind = 'assign') AS BIGINT) AS n_assign, CAST(count(*) FILTER (WHERE kind = 'access') AS BIGINT) AS n_access, CAST(count(*) FILTER (WHERE kind = 'hex') AS BIGINT) AS n_hex,
  sha256({base}) AS base_sha256, {listed.format(ranks=ranks, where=" FILTER (WHERE kind IS NOT NULL)")} AS spans
FROM docs LEFT JOIN kept USING (r) GROUP BY r, doc_id"""


ORACLE_SQL = _oracle()
