"""A training-corpus pipeline over `documents` in five stages.

toxicity: documents that the classifier rejects go; near_dedup: one document of
each group of near-copies stays; pii: personal data become pseudonyms; mixing:
documents are sampled to the target weights of source, language and form;
tokens: texts become token ids.  Each stage takes (spark, docs, sf_dir), works on
all rows that its predecessor kept, and returns a DataFrame; all but the last
return the columns of documents.
"""

from __future__ import annotations

import secrets

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlake.llm import bpe_backtrack, mixing_ipf, pii_feistel, superminhash, toxicity_ftrl
from adlake.llm.common import drop_stored, read_table, stored, unused

REJECT_SCORE = 0.5
#: The session setting with the key of the pseudonyms (Spark hides settings with "secret" in its name in logs and UI).
KEY_SETTING = "spark.adlake.pii.secret"


def pii_key(spark: SparkSession) -> str:
    """The session's key; where it names none, a random one for this session, so that nobody can undo its pseudonyms."""
    key = spark.conf.get(KEY_SETTING, None)
    if not key:
        key = secrets.token_hex(32)
        spark.conf.set(KEY_SETTING, key)
    return key


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score below REJECT_SCORE; the model learns from all labels (a bounded sample)."""
    model = toxicity_ftrl.fit(docs, read_table(spark, sf_dir, "labels"))
    name = unused("_toxicity", docs)
    return toxicity_ftrl.score(docs, model, name=name).filter(F.col(name) < REJECT_SCORE).drop(name)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group linked by 0.8 or more of five-word shingles."""
    return superminhash.keep_one(docs, width=5, similarity=80)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with pseudonyms under the session's key; n_chars follows the text."""
    masked = pii_feistel.mask_pii(docs, pii_key(spark))
    return masked.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn by their calibrated probabilities."""
    prefix = "_"
    while any(c.startswith(prefix) for c in docs.columns):
        prefix += "_"
    mixed = mixing_ipf.mix(docs, mixing_ipf.form_topic(F.col("text")), prefix=prefix)
    return mixed.filter(F.col(f"{prefix}kept")).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids and the number of ids."""
    out = bpe_backtrack.encode_documents(docs, bpe_backtrack.load_model(bpe_backtrack.model_path()))
    return out.select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"))


STAGES = [("toxicity", toxicity), ("near_dedup", near_dedup), ("pii", pii), ("mixing", mixing), ("tokens", tokens)]

#: SQL can express neither the classifier nor the encoder; test_pipeline_stages holds each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and read again; a stage's rows go when the next one's are written."""
    docs, former = read_table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
        if former is not None:
            drop_stored(former)
        former = docs
    return STAGES[-1][1](spark, docs, sf_dir)
