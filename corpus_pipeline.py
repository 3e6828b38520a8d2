"""A corpus pipeline: each stage takes what the stage before it kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sluice.llm import decontaminate, mixture, near_dedup, perplexity, shard
from sluice.llm.common import discard, materialize, read, scratch


def of_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity is within the limits of trusted text."""
    return perplexity.keep_good(docs, read(spark, sf_dir, "labels"))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies: the one with the least id."""
    return near_dedup.dedup(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    return decontaminate.clean(docs, read(spark, sf_dir, "benchmark"), nameless=True)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixture.repeat(docs)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, with size, shard and slot."""
    return shard.shard(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", of_quality),
    ("near-dedup", without_near_copies),
    ("decontamination", without_benchmark),
    ("mixing", mixed),
    ("sharding", sharded),
]
#: Model fits and hash signatures have no SQL; tests/llm holds each stage against brute force,
#: given what the stage before it kept.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages. What a stage wrote for itself, and what the next one has read, is deleted; tables
    behind the last stage's result stay."""
    docs = read(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES[:-1]):
        with scratch():
            out = materialize(stage(spark, docs, sf_dir), keep=True)
        if i:
            discard(docs)
        docs = out
    return STAGES[-1][1](spark, docs, sf_dir)
