"""From raw documents to token ids: five stages, each written before the next one reads it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from verdin.llm import decontamination, mixing, repetition, simhash, tokens
from verdin.session import prepare, read_table, scratch_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules on length and repetition."""
    prepare(spark)
    return repetition.kept(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: SimHash links, and all others of similarity 0.8 or more (five-word shingles)."""
    return simhash.without_near_copies(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    return decontamination.clean(docs, read_table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents left out or repeated so that sources meet their weights."""
    return mixing.mixture(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in segment files, reported as read back."""
    return tokens.token_output(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1)


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("near duplicates", near_dedup),
    ("decontamination", decontaminate),
    ("mixing", mix_sources),
    ("token output", write_tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage keeps is written to the shared folder and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        path = scratch_path(spark, f"stage{number}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


#: The stages use models of text and files that SQL does not express; tests hold them against brute force.
ORACLE_SQL = None
QUERIES = {"pipeline": run}
TWINS: dict[str, str] = {}
