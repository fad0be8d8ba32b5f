"""Atomic publishing and bounded calls."""

import os
import threading
import time

import pytest
from pyspark.sql import functions as F

from verdin.operators import classify
from verdin.session import scratch_path
from verdin.sources import published


def keys(spark, path, **options):
    return sorted(r.k for r in published.read_published(spark, path, **options).collect())


def test_versions_replace_and_append(spark):
    path = scratch_path(spark, "published")
    assert published.publish(spark.range(3).select(F.col("id").alias("k"), F.lit("a").alias("v")), path) == 3
    assert published.publish(spark.createDataFrame([(7,)], "k int"), path, append=True) == 1
    assert keys(spark, path) == [0, 1, 2, 7] and keys(spark, path, version=1) == [0, 1, 2]
    assert published.read_published(spark, path).where("v IS NULL").count() == 1
    with pytest.raises(ValueError):
        published.publish(spark.createDataFrame([(7, 1)], "k int, other int"), path, append=True)
    published.publish(spark.range(2).select(F.col("id").alias("k")), path)
    assert keys(spark, path) == [0, 1]
    published.publish(spark.range(0).select(F.col("id").alias("k")), path)
    assert keys(spark, path) == []
    with pytest.raises(ValueError):
        published.read_published(spark, path + "-none")


def test_a_failed_write_or_audit_leaves_the_table(spark):
    path = scratch_path(spark, "published")
    published.publish(spark.range(5).select(F.col("id").alias("k")), path)

    @F.udf("long")
    def breaks(value):
        if value == 77:
            raise RuntimeError("lost")
        return value

    with pytest.raises(Exception, match="lost"):
        published.publish(spark.range(100).repartition(4).select(breaks("id").alias("k")), path)
    with pytest.raises(published.AuditFailed):
        published.publish(spark.range(9).select(F.col("id").alias("k")), path, checks={"small": F.col("k") < 8})

    def refuse(rows):
        assert rows.count() == 9
        raise RuntimeError("refused")

    with pytest.raises(RuntimeError, match="refused"):
        published.publish(spark.range(9).select(F.col("id").alias("k")), path, append=True, audit=refuse)
    assert keys(spark, path) == [0, 1, 2, 3, 4]
    assert published.versions(spark, path).count() == 1


def test_a_reader_sees_whole_versions_while_one_is_written(spark):
    path = scratch_path(spark, "published")
    published.publish(spark.range(4).select(F.col("id").alias("k")), path)
    slow = F.udf(lambda value: (time.sleep(0.05), value)[1], "long")
    sizes = []
    writer = threading.Thread(target=lambda: published.publish(spark.range(40).repartition(4).select(slow("id").alias("k")), path))
    writer.start()
    while writer.is_alive():
        sizes.append(published.read_published(spark, path).count())
    writer.join()
    sizes.append(published.read_published(spark, path).count())
    assert set(sizes) == {4, 40} and sizes == sorted(sizes)


def test_calls_are_bounded_ordered_and_spaced(spark, tmp_path):
    folder = str(tmp_path)
    slots = classify.task_slots(spark)

    def slow(value):
        mine = f"{folder}/{os.getpid()}-{threading.get_ident()}-{time.time_ns()}"
        open(mine, "w").close()
        flying = sum(name.startswith(f"{os.getpid()}-") for name in os.listdir(folder) if not name.startswith("peak"))
        open(f"{folder}/peak-{flying}", "w").close()
        time.sleep(0.05)
        os.remove(mine)
        return {"said": value.upper()}

    df = spark.createDataFrame([(f"text{k}",) for k in range(40)], "t string").coalesce(1)
    got = classify.classify(df, "t", slow, "said string", {"said": ""}, per_executor=4 * slots).collect()
    assert [r.said for r in got] == [f"TEXT{k}" for k in range(40)]
    peaks = [int(name.split("-")[1]) for name in os.listdir(folder) if name.startswith("peak")]
    assert 1 < max(peaks) <= 4
    plan = classify.classify(df, "t", slow, "said string", {"said": ""}, per_executor=4)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan

    def never(value):
        open(f"{folder}/try-{time.time_ns()}", "w").close()
        raise RuntimeError

    one = spark.createDataFrame([("x",)], "t string")
    assert classify.classify(one, "t", never, "said string", {"said": "none"}, retries=3, pause=0.05, longest=0.15).first().said == "none"
    moments = sorted(int(name.split("-")[1]) for name in os.listdir(folder) if name.startswith("try"))
    gaps = [(b - a) / 1e9 for a, b in zip(moments, moments[1:], strict=False)]
    assert len(moments) == 4 and gaps[0] >= 0.05 and gaps[1] >= 0.1 and 0.15 <= gaps[2] < 1


def test_answers_are_handed_on_in_slices_of_a_batch(spark):
    df = spark.range(2500, numPartitions=1).select(F.col("id"), F.col("id").cast("string").alias("t"))
    sizes = []

    class Caught:
        sparkSession, schema = spark, df.schema

        def mapInPandas(self, run, schema):  # noqa: N802
            sizes.extend(len(part) for part in run(iter([df.toPandas()])))

    classify.classify(Caught(), "t", lambda value: {"said": value}, "said string", {"said": ""})
    assert sizes == [1000, 1000, 500]
    got = classify.classify(df, "t", lambda value: {"said": value}, "said string", {"said": ""})
    assert got.where("said = t").count() == 2500
