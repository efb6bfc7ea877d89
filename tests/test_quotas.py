"""Quotas of partitions, and pauses over micro-batches."""

import random
from fractions import Fraction
from datetime import datetime, timedelta, timezone

import pytest

from conftest import rows
from logweave import operators as op
from logweave.operators import health as health_module
from logweave.session import work_dir
from logweave.streaming import pauses
from logweave.streaming.run import finish

HEALTH = (
    "topic string, partition int, inflight long, recent_errors long, avg_latency_ms double, last_error_ms long, "
    "unavailable_until_ms long, available boolean"
)


def step_by_step(options, n):
    """Every row to the lowest score, which then rises by one."""
    scores, taken = dict(options), dict.fromkeys(options, 0)
    for _ in range(n):
        p = min(scores, key=lambda x: (scores[x], x))
        scores[p] += 1
        taken[p] += 1
    return taken


def test_quotas_equal_one_row_at_a_time(spark):
    rng = random.Random(2)
    given, counts, expected = [], [], []
    for g in range(60):
        topic, options = f"t{g}" if g else None, {}
        for p in range(4):
            if rng.random() < 0.2:
                options[p] = 0.0  # never tried
                continue
            available = rng.random() < 0.8
            inflight, latency = rng.randrange(0, 12), rng.choice([0.0, 10.0, 33.3, 7.0])
            given.append((topic, p, inflight, 0, latency, None, 0, available))
            if available:
                options[p] = Fraction(round((inflight + latency * 0.05) * 1_000_000), 1_000_000)
        n = rng.choice([0, 1, 2, 5, 17, 60])
        counts.append((topic, n))
        expected += [(topic, p, q) for p, q in step_by_step(options, n if options else 0).items()]
    found = op.partition_quotas(
        spark.createDataFrame(given, HEALTH), spark.createDataFrame(counts, "topic string, n long"), ["topic"], 4, 100
    )
    assert rows(found.select("topic", "partition", "quota")) == sorted(expected, key=repr)


def test_rows_are_dealt_by_quota(spark, monkeypatch):
    monkeypatch.setattr(health_module, "QUOTA_ROWS", 50)
    health = spark.createDataFrame(
        [("a", 0, 100, 0, 0.0, None, 0, True), ("a", 1, 0, 0, 0.0, None, 0, True), ("a", 2, 0, 0, 0.0, None, 0, False),
         ("b", 0, 0, 0, 0.0, None, 0, False), ("b", 1, 0, 0, 0.0, None, 0, False), ("b", 2, 0, 0, 0.0, None, 0, False)], HEALTH
    )
    given = spark.createDataFrame([("a" if i % 4 else "b", i) for i in range(1200)] + [(None, 5000 + i) for i in range(9)], "topic string, k long")
    out = op.assign_by_quota(given, health, ["topic"], "k", 3, 100)
    counts = {(r["topic"], r["partition"]): r["count"] for r in out.groupBy("topic", "partition").count().collect()}
    assert {k: v for k, v in counts.items() if k[0] == "a"} == {("a", 0): 400, ("a", 1): 500}
    assert {k: v for k, v in counts.items() if k[0] is None} == {(None, 0): 3, (None, 1): 3, (None, 2): 3}
    assert sum(v for k, v in counts.items() if k[0] == "b") == 300 and out.select("k").distinct().count() == 1209
    assert rows(out) == rows(op.assign_by_quota(given.repartition(7), health, ["topic"], "k", 3, 100))
    assert op.assign_by_quota(given.limit(0), health, ["topic"], "k", 3, 100).count() == 0


SCHEMA = "partition int, offset long, at timestamp, delay_s int"
START = datetime(2024, 1, 1, tzinfo=timezone.utc)


def feed(spark, source, data, root, checkpoint):
    made = [(p, o, START + timedelta(seconds=t), d) for p, o, t, d in data]
    spark.createDataFrame(made, SCHEMA).repartition(3).write.mode("append").parquet(source)
    stream = spark.readStream.schema(SCHEMA).parquet(source)
    finish(pauses.pause_stream(stream, ["partition"], "at", ["offset"], root, checkpoint))


def seconds(held):
    return held and int((held.replace(tzinfo=timezone.utc) - START).total_seconds())


def test_rows_wait_over_batches_and_leave_in_order(spark):
    source, root, checkpoint = (work_dir(spark, n) for n in ("in", "root", "cp"))
    schema = spark.createDataFrame([], SCHEMA).schema

    def state():
        left = pauses.read_released(spark, root, schema).collect()
        waits = pauses.read_waiting(spark, root, schema).collect()
        return (
            sorted((r["batch_id"], r["partition"], r["offset"], seconds(r["held_until"])) for r in left),
            sorted((r["partition"], r["offset"], seconds(r["held_until"])) for r in waits),
        )

    feed(spark, source, [(0, 0, 0, 0), (0, 1, 10, 30), (0, 2, 20, 0), (1, 0, 5, 0)], root, checkpoint)
    assert state() == ([(0, 0, 0, None), (0, 0, 1, None), (0, 1, 0, None)], [(0, 2, 40)])
    # another failure while paused: one longer pause, also for the row that waits; the other partition goes on
    feed(spark, source, [(0, 3, 35, 60), (0, 4, 36, 0), (1, 1, 50, 0)], root, checkpoint)
    assert state()[1] == [(0, 2, 95), (0, 3, 95), (0, 4, 95)]
    assert state()[0][-1] == (1, 1, 1, None)
    # a row at the end of the pause itself lets nothing go yet
    feed(spark, source, [(0, 5, 95, 0)], root, checkpoint)
    assert state()[1] == [(0, 2, 95), (0, 3, 95), (0, 4, 95)]
    feed(spark, source, [(0, 6, 96, 0)], root, checkpoint)
    left, waits = state()
    assert waits == [] and [r for r in left if r[0] == 3] == [(3, 0, 2, 95), (3, 0, 3, 95), (3, 0, 4, 95), (3, 0, 6, None)]
    assert [r for r in left if r[0] == 2] == [(2, 0, 5, None)]


@pytest.mark.parametrize("cuts", [1, 4])
def test_streamed_pauses_equal_those_of_all_rows(spark, cuts):
    rng = random.Random(cuts)
    data, t = [], 0
    for o in range(150):
        t += rng.choice([0, 1, 1, 5, 20])
        data.append((o % 2, o, t, rng.choice([0, 0, 0, 0, 3, 15])))
    source, root, checkpoint = (work_dir(spark, n) for n in ("in", "root", "cp"))
    # rows of one moment come together
    moments = sorted({d[2] for d in data})
    edges = [moments[len(moments) * i // cuts] for i in range(cuts)] + [t + 1]
    for low, high in zip(edges, edges[1:]):
        feed(spark, source, [d for d in data if low <= d[2] < high], root, checkpoint)
    frame = spark.createDataFrame([(p, o, START + timedelta(seconds=x), d) for p, o, x, d in data], SCHEMA)
    want = op.hold_paused(frame, op.pause_intervals(frame, ["partition"], "at"), ["partition"], "at")
    found = pauses.read_released(spark, root, frame.schema).drop("batch_id").unionByName(pauses.read_waiting(spark, root, frame.schema))
    assert rows(found) == rows(want)
