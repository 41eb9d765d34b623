"""Queries and SQL of the training-data operators, for the driver's entry module."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline

#: Modules with QUERY_NAME and query(); ORACLE_SQL where SQL can express the query.
MODULES = (
    "quality_llr",
    "html_consensus",
    "secret_links",
    "pii_feistel",
    "langid_em",
    "mixing_ipf",
    "superminhash",
    "toxicity_ftrl",
    "hilbert_ann",
    "bpe_backtrack",
    "segment_popcount",
    "prefix_repair",
    "overlap_dsir",
)


def _modules():
    return [import_module(f"adlake.llm.{name}") for name in MODULES]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {m.QUERY_NAME: m.query for m in _modules()} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    return {m.QUERY_NAME: m.ORACLE_SQL for m in _modules() if getattr(m, "ORACLE_SQL", None)}
