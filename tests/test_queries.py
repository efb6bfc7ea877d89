"""Every registered query against its SQL on the smallest tables."""

import sys
import time

import duckdb
import pytest

import __spark_entry__ as entry
from logweave import session
from tools.check import TABLES, compare

SF_DIR = "/root/testdata/sf0.001"
LIBRARY = {**entry.BATCH_QUERIES, **entry.STREAM_QUERIES}


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_DIR}/{t}.parquet')")
    return connection


def test_all_queries_have_sql():
    assert set(LIBRARY) == set(entry.ORACLES) | set(entry.STREAM_ORACLES)
    assert set(LIBRARY) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).columns == ["p", "position", "committed_seq", "pending"]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", list(LIBRARY))
def test_query(spark, con, name):
    begin = time.time()
    df = entry.queries()[name](spark, SF_DIR)
    # joins on keys, no row-at-a-time Python, and only protobuf through Arrow
    plan = plan_of(df)
    for operator in ("CartesianProduct", "NestedLoopJoin", "BatchEvalPython"):
        assert operator not in plan
    assert ("ArrowEvalPython" in plan) == (name == "order_event_roundtrip")
    result = compare(con, name, df, begin)
    assert ": ok" in result, result


@pytest.mark.parametrize(
    "name, columns",
    [
        ("seq_gaps", "struct<event_id:bigint>"),
        ("bounded_read", "struct<offset:bigint>"),
        ("cdc_latest", "struct<c_custkey:bigint,c_name:string>"),
        ("carry_positions", "struct<c_custkey:bigint>"),
        ("enum_names", "struct<o_orderkey:bigint,o_orderstatus:string>"),
    ],
)
def test_scans_read_only_what_is_used(spark, name, columns):
    assert f"ReadSchema: {columns}" in plan_of(entry.queries()[name](spark, SF_DIR))


def test_gap_search_shuffles_its_blocks_once(spark):
    df = entry.queries()["seq_gaps"](spark, SF_DIR)
    df.collect()
    assert "ReusedExchange" in plan_of(df)


@pytest.mark.parametrize(
    "name",
    [
        "commit_contiguous", "commit_gap_timeout", "skipped_gaps", "clean_marks", "oldest_pending",
        "pause_holds", "stamp_sequence", "chunked", "route_batch", "upsert_table", "track_commits_gap_stream",
        "idempotent_consume_stream", "first_arrival_stream", "partition_quota", "pause_holds_stream",
        "partition_health_reversed_stream",
    ],
)
def test_query_with_nothing_small(spark, con, monkeypatch, name):
    """The way beyond the size check: no local relations and no broadcasts, and the same results."""
    small = session.small_side
    for module in list(sys.modules.values()):
        if getattr(module, "__name__", "").startswith("logweave") and getattr(module, "small_side", None) is small:
            monkeypatch.setattr(module, "small_side", lambda df, max_rows=0: df)
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(threshold, "-1")
    try:
        begin = time.time()
        result = compare(con, name, entry.queries()[name](spark, SF_DIR), begin)
    finally:
        spark.conf.unset(threshold)
    assert ": ok" in result, result
