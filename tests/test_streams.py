"""Streams: keyed state, restart, replay, late rows."""

import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from verdin.operators import trends
from verdin.plans import streams
from verdin.session import scratch_path
from verdin.streaming import live_trends, routing

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(autouse=True)
def few_partitions(spark):
    """Every task of a keyed state starts a Python worker of its own: two tasks are enough here."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_processed_and_skipped_are_all_events(spark):
    out = streams.run_stream(spark, FOLDER)
    total = spark.read.parquet(f"{FOLDER}/events.parquet").count()
    processed, skipped = routing.processed(spark, out), routing.skipped(spark, out)
    assert processed.count() + skipped.count() == total
    once = processed.where("status = 'started'")
    assert once.count() == once.select("key").distinct().count() == processed.select("key").distinct().count()
    assert processed.where("job IS NULL").count() == 0 and skipped.where("reason IS NULL").count() == 0


def test_a_lost_checkpoint_starts_nothing_again(spark):
    out = streams.run_stream(spark, FOLDER)
    before = routing.processed(spark, out).select("key", "status", "run").collect()
    assert len({r.run for r in before}) == 1
    streams.run_stream(spark, FOLDER, out)
    both = routing.processed(spark, out)
    again = both.where(F.col("run") != before[0].run)
    assert again.count() == len(before) and again.where("status = 'started'").count() == 0
    assert both.where("status = 'started'").count() == both.select("key").distinct().count()


@pytest.fixture
def inbox(spark):
    base = scratch_path(spark, "inbox")
    spark.createDataFrame([("ann@example.com",)], "mail string").write.parquet(f"{base}/approved")

    def send(keys, keep_ms=None, checkpoint="checkpoint"):
        frame = spark.createDataFrame([(f"calls/ann@example.com/{key}.wav",) for key in keys], "key string")
        if keys:
            streams.notifications(frame).coalesce(1).write.mode("append").json(f"{base}/inbox")
        query = routing.run_routing(
            routing.read_notifications(spark, f"{base}/inbox"), f"{base}/approved", ["mail"], ["wav"], f"{base}/out", f"{base}/{checkpoint}", "20240301-120000", keep_ms
        )
        query.awaitTermination()
        return query

    send.base = base
    return send


def statuses(spark, base):
    rows = routing.processed(spark, f"{base}/out").collect()
    return Counter((r.key.split("/")[-1].removesuffix(".wav"), r.status) for r in rows)


def test_state_holds_one_value_per_key(spark, inbox):
    for _ in range(3):
        query = inbox(["a", "b", "a", "c"])
    (state,) = query.lastProgress["stateOperators"]
    assert state["numRowsTotal"] == 3
    assert statuses(spark, inbox.base) == {("a", "started"): 1, ("a", "already_exists"): 5, ("b", "started"): 1, ("b", "already_exists"): 2, ("c", "started"): 1, ("c", "already_exists"): 2}


def test_started_keys_are_kept_without_python(spark, inbox):
    hot = ["hot"] * (2 * routing.LAID_OUT + 1)
    query = inbox(["a", *hot])
    assert {state["operatorName"] for state in query.lastProgress["stateOperators"]} == {"dedupe"}
    assert statuses(spark, inbox.base) == {("a", "started"): 1, ("hot", "started"): 1, ("hot", "already_exists"): len(hot) - 1}
    inbox(["a"], checkpoint="other")  # other checkpoints start nothing again, also after their first run
    inbox(["a", "b"], checkpoint="other")
    assert {k: n for k, n in statuses(spark, inbox.base).items() if k[1] == "started"} == {("a", "started"): 1, ("hot", "started"): 1, ("b", "started"): 1}


def test_a_repeated_batch_overwrites_itself(spark, inbox, tmp_path):
    inbox(["a"])
    inbox(["a", "b"])
    before = statuses(spark, inbox.base)
    # the batch was written but its commit is missing: it runs again on the next start
    commits = inbox.base.removeprefix("file:") + "/checkpoint/commits"
    last = max(int(name) for name in os.listdir(commits) if name.isdigit())
    for name in (str(last), f".{last}.crc"):
        os.rename(f"{commits}/{name}", tmp_path / name)
    again = inbox([])
    assert last in [progress["batchId"] for progress in again.recentProgress]
    assert statuses(spark, inbox.base) == before


def test_keys_are_forgotten_after_their_time(spark, inbox):
    inbox(["a"], keep_ms=1)
    inbox(["a"], keep_ms=1)
    assert statuses(spark, inbox.base) == {("a", "started"): 2}


def test_the_list_is_read_again_at_each_run(spark, inbox):
    inbox(["a"])
    spark.createDataFrame([("bob@example.com",)], "mail string").write.mode("overwrite").parquet(f"{inbox.base}/approved")
    inbox(["b"])
    assert [r.reason for r in routing.skipped(spark, f"{inbox.base}/out").collect()] == ["correo_no_aprobado"]


def test_live_trends_with_a_restart_and_late_rows(spark):
    base = scratch_path(spark, "trend-test")
    schema = "origin string, at timestamp, body string, likes int"
    # two weeks with all columns, a Sunday and a Monday, words with equal counts, values with ties, odd rows
    first = [
        ("https://www.a.org/x", "2024-12-30 10:00:00", "coche rojo coche", 3), ("a.org", "2024-12-31 10:00:00", "rojo verde azules", 4),
        ("b.org", "2025-01-01 09:00:00", None, None), (None, "2025-01-02 09:00:00", "nadie", 9), ("b.org", None, "nunca", 9), ("b.org", "2025-01-05 23:59:59", "", 7),
    ]
    second = [("a.org", "2025-01-06 00:00:00", "lunes nuevo", 3), ("a.org", "2025-01-05 12:00:00", "todavía dentro", 8), ("b.org", "2025-01-14 00:00:00", "martes", 1)]
    late = [("a.org", "2025-01-01 00:00:00", "demasiado tarde", 1_000_000)]

    def frame(rows):
        return spark.createDataFrame([(o, None if m is None else m, b, v) for o, m, b, v in rows], "origin string, at string, body string, likes int").selectExpr(
            "origin", "cast(at as timestamp) at", "body", "likes"
        )

    def run(rows):
        frame(rows).coalesce(1).write.mode("append").parquet(f"{base}/feed")
        feed = spark.readStream.schema(schema).parquet(f"{base}/feed")
        query = live_trends.run_trend_feed(feed, "origin", "at", "body", f"{base}/out", f"{base}/checkpoint")
        query.awaitTermination()
        return query

    def tables():
        return sorted(map(tuple, live_trends.closed_trends(spark, f"{base}/out").collect()))

    def batch(rows, weeks=None):
        table = trends.weekly_trends(trends.prepare_posts(frame(rows), "origin", "at", "body"))
        return sorted(tuple(r) for r in table.collect() if weeks is None or r.week in weeks)

    run(first)
    assert not live_trends.closed_trends(spark, f"{base}/out").count()
    run(second)
    closed = ["2024-53", "2025-00", "2025-01"]
    assert tables() == batch(first + second, closed[:2]) + batch(first + second, closed[2:])
    run(late)
    assert tables() == batch(first + second, closed)
    query = run([("", "2030-01-01 00:00:00", None, None)])
    assert tables() == batch(first + second)
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] <= 2  # the closing row alone
