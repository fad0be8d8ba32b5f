"""Per-row classifiers run inside tasks, and a table of answers so that no text is asked twice."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Classifier = Callable[[str], Mapping[str, Any]]

#: Rows answered and handed on at a time; a batch of Spark's may hold ten times as many texts.
ANSWERED_ROWS = 1000


def classify(
    df: DataFrame,
    text: str,
    classifier: Classifier,
    answer: str,
    default: Mapping[str, Any],
    retries: int = 0,
    per_executor: int | None = None,
    pause: float = 0.0,
    longest: float = 60.0,
) -> DataFrame:
    """``df`` plus the answer fields of a classifier called once per row.

    ``answer`` is the DDL schema of the fields. A call that still fails after its
    retries gives the default; before try k it waits ``pause`` times 2 to the k - 1
    seconds, ``longest`` at most. ``per_executor`` calls run at one time on an
    executor, shared out evenly among its task slots (one a slot at least): threads inside
    the task keep the order of rows, and no row is shuffled. Without it a task makes one call
    after another.
    """
    fields = T.StructType.fromDDL(answer)
    schema = T.StructType([*df.schema.fields, *fields.fields])
    names = fields.fieldNames()
    preset = dict(default)
    calls = 1 if per_executor is None else max(1, per_executor // task_slots(df.sparkSession))

    def ask(value: str | None) -> dict:
        for attempt in range(retries + 1):
            if attempt and pause:
                time.sleep(min(longest, pause * 2 ** (attempt - 1)))
            try:
                given = classifier(value or "")
                return {n: given.get(n, preset.get(n)) for n in names}
            except Exception:  # the next try or the default answers
                continue
        return {n: preset.get(n) for n in names}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with ThreadPoolExecutor(calls) as pool:
            for batch in (whole.iloc[k : k + ANSWERED_ROWS] for whole in batches for k in range(0, len(whole), ANSWERED_ROWS)):
                said = pool.map(ask, batch[text]) if calls > 1 else map(ask, batch[text])
                answers = pd.DataFrame(list(said), columns=names, index=batch.index)
                yield pd.concat([batch, answers], axis=1)

    return df.mapInPandas(run, schema)


def task_slots(spark: SparkSession) -> int:
    """Tasks that one executor runs at a time."""
    context = spark.sparkContext
    if context.master.startswith("local") and not context.master.startswith("local-cluster"):
        return context.defaultParallelism
    conf = context.getConf()
    return max(1, int(conf.get("spark.executor.cores", "1")) // int(conf.get("spark.task.cpus", "1")))


def text_key(df: DataFrame, text: str) -> DataFrame:
    return df.withColumn("text_key", F.sha2(F.coalesce(F.col(text), F.lit("")), 256))


def cache_misses(keyed: DataFrame, cache: DataFrame, text: str) -> DataFrame:
    """Each text without an answer once."""
    asked = cache.select("text_key").distinct()
    fresh = keyed.join(asked, "text_key", "left_anti")
    return fresh.groupBy("text_key").agg(F.min(text).alias(text))


def with_answers(keyed: DataFrame, cache: DataFrame, fresh: DataFrame, names: list[str]) -> DataFrame:
    """Rows with the answer of their text, and whether it was known before."""
    known = cache.select("text_key", *names, F.lit(True).alias("from_cache")).dropDuplicates(["text_key"])
    new = fresh.select("text_key", *names, F.lit(False).alias("from_cache"))
    return keyed.join(known.unionByName(new), "text_key", "left")
