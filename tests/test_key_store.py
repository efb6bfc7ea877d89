"""The store of earlier ids, and streams that keep first arrivals with it."""

from datetime import datetime, timedelta, timezone
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import rows
from logweave.session import path_exists, work_dir
from logweave.sinks import batches, key_store
from logweave.streaming import dedup
from logweave.streaming.run import finish

SCHEMA = "k string, arrival long, v string, at timestamp"


def ids_of(spark, numbers):
    return spark.createDataFrame([(f"id-{n}",) for n in numbers], "id string")


def test_lookup_follows_the_batch_and_not_the_history(spark, monkeypatch):
    """Buckets of 16 ids, four runs to a merge: after 24 batches a lookup still opens a few small files."""
    monkeypatch.setattr(key_store, "FANOUT", 4)
    monkeypatch.setattr(key_store, "BUCKET_BITS", 4)
    root, opened = work_dir(spark, "store"), {}
    asked = [5, 17, 10_000, 10_001]
    for batch_id in range(24):
        runs = key_store.read_runs(spark, root, batch_id - 1 if batch_id else None)
        key_store.add_ids(spark, root, batch_id, runs, ids_of(spark, range(32 * batch_id, 32 * batch_id + 32)))
        runs = key_store.read_runs(spark, root, batch_id)
        hashes = [r[0] for r in ids_of(spark, asked).select(F.xxhash64("id")).collect()]
        paths = key_store.buckets_to_open(root, runs, hashes)
        files = [f for p in paths for f in Path(p.removeprefix("file:")).glob("*.parquet")]
        live = [r for r in runs if r["retired"] is None]
        assert len(paths) <= len(asked) * len(live) and len(live) <= 3 * 3
        assert sum(r["rows"] for r in live) == 32 * (batch_id + 1)
        opened[batch_id] = sum(f.stat().st_size for f in files) / len(live)
    assert opened[23] <= 1.5 * opened[3]
    assert {r["generation"] for r in runs if r["retired"] is None} == {1, 2}
    assert rows(key_store.known_ids(spark, root, runs, ids_of(spark, asked))) == [("id-17",), ("id-5",)]
    # beyond the number that is looked up by buckets
    monkeypatch.setattr(key_store, "FEW_IDS", 3)
    assert rows(key_store.known_ids(spark, root, runs, ids_of(spark, asked))) == [("id-17",), ("id-5",)]
    assert key_store.known_ids(spark, root, runs, ids_of(spark, range(2000))).count() == 768
    assert key_store.all_ids(spark, root, runs).distinct().count() == 768


def test_merged_runs_stay_while_a_state_names_them(spark, monkeypatch):
    monkeypatch.setattr(key_store, "FANOUT", 2)
    monkeypatch.setattr(batches, "KEPT_STATES", 2)
    root = work_dir(spark, "store")
    for batch_id in range(5):
        runs = key_store.read_runs(spark, root, batch_id - 1 if batch_id else None)
        for _ in range(2):  # written again, a batch leaves the same ids
            key_store.add_ids(spark, root, batch_id, runs, ids_of(spark, [batch_id]))
        for kept in range(max(0, batch_id - 1), batch_id + 1):
            held = key_store.all_ids(spark, root, key_store.read_runs(spark, root, kept))
            assert held.count() == kept + 1
    assert not path_exists(spark, f"{root}/keys/run=0-0")
    assert not path_exists(spark, f"{root}/runs/batch_id=2")


def start(spark, source, data, root, checkpoint, **options):
    frame = spark.createDataFrame([(k, a, v, datetime.fromtimestamp(a, timezone.utc)) for k, a, v in data], SCHEMA)
    frame.repartition(4).write.mode("append").parquet(source)
    stream = spark.readStream.schema(SCHEMA).parquet(source)
    finish(dedup.first_arrivals(stream, ["k"], ["arrival"], root, checkpoint, event_time="at", **options))


def kept(spark, root):
    return rows(dedup.read_arrivals(spark, root, spark.createDataFrame([], SCHEMA).schema).select("k", "arrival"))


def test_first_arrival_inside_and_across_batches(spark):
    source, root, checkpoint = (work_dir(spark, n) for n in ("in", "root", "cp"))
    start(spark, source, [("a", 5, "x"), ("a", 2, "x"), ("b", 9, "x"), (None, 1, "x")], root, checkpoint)
    start(spark, source, [("a", 1, "y"), ("c", 8, "y"), ("c", 7, "y"), ("b", 3, "y")], root, checkpoint)
    start(spark, source, [("c", 1, "z"), ("d", 1, "z")], root, checkpoint)
    assert kept(spark, root) == [("a", 2), ("b", 9), ("c", 7), ("d", 1)]


def test_first_arrival_of_a_key_with_most_rows(spark):
    source, root, checkpoint = (work_dir(spark, n) for n in ("in", "root", "cp"))
    start(spark, source, [("hot", 5000 - i, "x") for i in range(3000)] + [(f"k{i}", i, "x") for i in range(1500)], root, checkpoint)
    start(spark, source, [("hot", i, "x") for i in range(1000)] + [(f"k{i}", i, "x") for i in range(1000, 3000)], root, checkpoint)
    found = kept(spark, root)
    assert len(found) == 3001 and ("hot", 2001) in found


def test_key_comes_again_beyond_the_horizon(spark):
    source, root, checkpoint = (work_dir(spark, n) for n in ("in", "root", "cp"))
    hour = timedelta(hours=1)
    for data in (
        [("a", 0, "x"), ("a", 600, "x"), ("b", 3000, "x")],
        [("a", 3500, "x"), ("c", 9000, "x")],  # the newest before is 3000: a of 0 still counts
        [("a", 9100, "x"), ("b", 9100, "x"), ("c", 9200, "x")],  # the newest is 9000: a and b do not
        [("a", 9300, "x")],
    ):
        start(spark, source, data, root, checkpoint, horizon=hour)
    assert kept(spark, root) == [("a", 0), ("a", 9100), ("b", 3000), ("b", 9100), ("c", 9000)]
    assert "0-0" not in [r["run"] for r in key_store.read_runs(spark, root, 3) if r["retired"] is None]


def test_batch_that_died_before_its_commit_keeps_the_same(spark, monkeypatch):
    source, root, checkpoint = (work_dir(spark, n) for n in ("in", "root", "cp"))
    start(spark, source, [("a", 1, "x")], root, checkpoint)

    def die(*_):
        raise RuntimeError("lost before the commit")

    with monkeypatch.context() as m:
        m.setattr(dedup, "commit_state", die)
        with pytest.raises(Exception, match="lost before the commit"):
            start(spark, source, [("a", 2, "x"), ("b", 3, "x")], root, checkpoint)
    assert kept(spark, root) == [("a", 1)]
    start(spark, source, [("b", 4, "x"), ("c", 5, "x")], root, checkpoint)
    assert kept(spark, root) == [("a", 1), ("b", 3), ("c", 5)]
