"""The corpus pipeline: documents to tokens in five stages, each over all that the stage before it kept."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from framewright.llm import bpe, decontaminate, exact, shingles, simhash, toxicity
from framewright.llm.common import stored, table

#: No SQL expresses the learned scorer, the link closure and the merges; the tests compare with brute force.
ORACLE_SQL = None


def _toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def _exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact.drop_copies(docs)


def _near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Fingerprints (``op1``) find near copies, exact similarity proves them, and bands of minimum hashes add what three bits miss."""
    return shingles.drop_near_copies(docs, candidates=simhash.near_stars)


def _decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def _encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.digests(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", _toxicity),
    ("exact_dedup", _exact),
    ("near_dedup", _near),
    ("decontamination", _decontaminate),
    ("byte_bpe", _encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage's result is written and reread as the next one's input."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
