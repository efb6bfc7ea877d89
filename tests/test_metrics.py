"""Delivery metrics as cells: quantiles within the stated error, in any order of merging."""

import math
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from logweave import operators as op
from logweave.operators import metrics
from logweave.schemas import ATTEMPT_SCHEMA
from logweave.session import path_exists, work_dir
from logweave.streaming import cells as streams
from logweave.streaming.run import finish

HOUR = 3_600_000


def delivered(latencies, at=lambda i: 0, partition=0):
    return [(partition, i, at(i), "delivery", x, None, None) for i, x in enumerate(latencies)]


def exact(values, q):
    ordered = sorted(values)
    return ordered[max(math.ceil(q * len(ordered)), 1) - 1]


@pytest.mark.parametrize("accuracy", [0.001, 0.01, 0.2])
def test_quantiles_within_the_error(spark, accuracy):
    rng = random.Random(3)
    samples = {
        0: [rng.lognormvariate(3, 2) for _ in range(400)],
        1: [rng.uniform(-50, 50) for _ in range(333)] + [0.0] * 7,
        2: [1e-300, 1e300, 5e-324, 7.0],
        3: [12.5],
    }
    data = [row for p, values in samples.items() for row in delivered(values, lambda i: i * 9_000, p)]
    cells = op.metric_cells(spark.createDataFrame(data, ATTEMPT_SCHEMA), accuracy=accuracy)
    quantiles = (0.0, 0.01, 0.5, 0.9, 0.999, 1.0)
    found = op.metrics_from_cells(op.merge_cells(cells, "1 hour"), quantiles=quantiles, accuracy=accuracy).collect()
    assert sorted((r["partition"], r["window_start_ms"]) for r in found) == [(p, 0) for p in samples]
    for r in found:
        for q in quantiles:
            want, got = exact(samples[r["partition"]], q), r[f"produce_latency_p{100 * q:g}_ms".replace(".", "_")]
            # numbers next to zero have too few digits for the stated error
            assert abs(got - want) <= accuracy * abs(want) * (1 + 1e-9) or abs(want) < 1e-307, (r["partition"], q)


def test_minutes_add_up_to_hours(spark):
    """Cells of minutes, merged, are the cells of the hours; counts equal the plain metrics."""
    rng = random.Random(4)
    data = []
    for i in range(2_000):
        kind = rng.choice(["produce", "delivery", "error"])
        code = rng.choice(["LeaderNotAvailable", "Local_QueueFull", "Local_KeySerialization"]) if kind == "error" else None
        latency = rng.choice([None, rng.uniform(0, 90)]) if kind == "delivery" else None
        data.append((rng.choice([0, 1, None]), i, rng.randrange(4 * HOUR), kind, latency, code, False if code else None))
    attempts = spark.createDataFrame(data, ATTEMPT_SCHEMA)
    rolled = op.merge_cells(op.metric_cells(attempts), "1 hour")
    at_once = op.metric_cells(attempts, "1 hour")
    rounded = [c if c != "latency_sum" else F.round(c, 6) for c in at_once.columns]
    assert rows(rolled.select(*rounded)) == rows(at_once.select(*rounded))
    plain = op.delivery_metrics(attempts, "1 hour").drop("produce_latency_p95_ms")
    same = op.metrics_from_cells(rolled).select(*plain.columns)
    digits = [F.round(c, 6).alias(c) if c == "produce_latency_ms" else c for c in plain.columns]
    assert rows(same.select(*digits)) == rows(plain.select(*digits))


def test_values_without_a_cell(spark):
    data = delivered([None, float("nan"), float("inf"), -float("inf")]) + [(1, 9, None, "delivery", 3.0, None, None)]
    found = op.metrics_from_cells(op.metric_cells(spark.createDataFrame(data, ATTEMPT_SCHEMA))).collect()
    assert [(r["partition"], r["produce_latency_ms"], r["produce_latency_p99_ms"]) for r in found] == [(0, None, None)]
    empty = spark.createDataFrame([], ATTEMPT_SCHEMA)
    assert op.metrics_from_cells(op.merge_cells(op.metric_cells(empty), "1 day")).collect() == []
    with pytest.raises(ValueError):
        metrics.latency_cell(F.lit(1.0), 0.0)


def test_parts_hold_every_batch_once():
    for last in range(700):
        covered = []
        for generation, at in streams.parts_until(last):
            covered += range(at - streams.FANOUT**generation + 1, at + 1)
        assert covered == list(range(last + 1))
        assert len(streams.parts_until(last)) <= 7 * 4


def test_stream_merges_late_attempts_in_generations(spark, monkeypatch):
    """Seven micro-batches in random order, merged by twos, equal one pass over all; what was merged goes."""
    monkeypatch.setattr(streams, "FANOUT", 2)
    monkeypatch.setattr(streams.batches, "KEPT_STATES", 2)
    rng = random.Random(6)
    data = delivered([rng.uniform(1, 80) for _ in range(140)], lambda i: i * 100_000)
    rng.shuffle(data)
    source, root, checkpoint = (work_dir(spark, n) for n in ("attempts", "cells", "checkpoint"))
    for i in range(7):
        part = spark.createDataFrame(data[i * 20 : i * 20 + 20], ATTEMPT_SCHEMA)
        part.coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(ATTEMPT_SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)
    finish(streams.cells_stream(stream, root, checkpoint))
    assert streams.parts_until(6) == [(2, 3), (1, 5), (0, 6)]
    whole = op.metric_cells(spark.createDataFrame(data, ATTEMPT_SCHEMA))
    for every in (None, "1 hour"):
        want = op.metrics_from_cells(op.merge_cells(whole, every))
        found = op.metrics_from_cells(streams.read_cells(spark, root, every=every))
        assert rows(found.withColumn("produce_latency_ms", F.round("produce_latency_ms", 6))) == rows(
            want.withColumn("produce_latency_ms", F.round("produce_latency_ms", 6))
        )
    assert not path_exists(spark, f"{root}/cells0/batch_id=0")
    assert path_exists(spark, f"{root}/cells1/batch_id=5")
