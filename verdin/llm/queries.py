"""The registered queries: each operator over its whole table with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from verdin.llm import decontamination, infill, languages, lines, mixing, periods, pseudonyms, repetition, simhash, suffixes, tokens, toxicity, urls
from verdin.llm.registry import QUERIES, TWINS, query
from verdin.session import read_table

__all__ = ["QUERIES", "TWINS"]


@query("op1_simhash")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, folder, "documents"))


@query("op4_mixing")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mixed(read_table(spark, folder, "documents"))


@query("op6_token_output")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    return tokens.token_output(read_table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=1)


@query("op8_quality_rules")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    return repetition.judged(read_table(spark, folder, "documents"))


@query("op3_decontamination")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.report(read_table(spark, folder, "documents"), read_table(spark, folder, "benchmark"))


@query("op5_url_filter")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return urls.judged(read_table(spark, folder, "pages"))


@query("op2_toxicity")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.scored(read_table(spark, folder, "documents"), read_table(spark, folder, "labels"))


@query("op7_suffix_dedup")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return suffixes.deduplicated(read_table(spark, folder, "documents"))


@query("op10_pseudonyms")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    documents = read_table(spark, folder, "documents").select("doc_id", "text")
    return pseudonyms.pseudonymised(documents)


@query("op9_language")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return languages.identified(read_table(spark, folder, "pages"), read_table(spark, folder, "documents"))


@query("op11_periodic_runs")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return periods.digests(periods.periodic_runs(periods.with_planted_runs(read_table(spark, folder, "documents"))))


@query("op12_fill_in_middle", infill.SQL)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return infill.digests(read_table(spark, folder, "documents"))


@query("op13_line_dedup", lines.SQL)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return lines.digests(read_table(spark, folder, "documents"))
