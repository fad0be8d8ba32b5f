"""Registered queries against their SQL twins on the smallest tables.

All of them run with ``VERDIN_ALL=1``; otherwise one query of every family.
"""

import os

import duckdb
import pytest

from tools.check import TABLES, plain
from verdin.plans import QUERIES, TWINS

FOLDER = "/root/testdata/sf0.001"
QUICK = [
    "a7_control_table", "a9_kpi_clamped", "a20_roc_points", "a25_bin_table", "w2_top_m_pending", "j1_latest_per_key",
    "j3_left_join_chain", "j16_w9_best_report", "enrolment_base", "w7_time_folds", "f1_normalise_words", "f6_count_per_phrase",
    "f24_transcript_turns", "evaluate_chats", "evaluate_sales_calls", "a10_a11_weekly_trends", "p20_convert", "n2_summary_shape",
    "e7_sequence_table", "s13_landing_plan", "j13_st1_route_batch", "st5_week_feed_stream",
]


@pytest.fixture(scope="module")
def base():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from '{FOLDER}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(TWINS) if os.environ.get("VERDIN_ALL") else QUICK)
def test_twin(spark, base, name):
    frame = QUERIES[name](spark, FOLDER)
    answer = base.execute(TWINS[name])
    heads = [d[0] for d in answer.description]
    assert sorted(heads) == sorted(frame.columns)
    mine = sorted((tuple(plain(r[c]) for c in sorted(heads)) for r in frame.collect()), key=repr)
    theirs = sorted((tuple(plain(r[heads.index(c)]) for c in sorted(heads)) for r in answer.fetchall()), key=repr)
    assert mine == theirs


def test_every_twin_belongs_to_a_query():
    assert set(TWINS) <= set(QUERIES)
