import random

import pytest
from pyspark.sql import functions as F

from logweave import operators as op

from conftest import rows
from models import merge, retry


@pytest.fixture
def failing(spark):
    return spark.createDataFrame([(k, k) for k in range(9)], "id int, failures int")


def error(n):
    return F.when(F.col("failures") >= n, F.concat(F.lit("try "), F.lit(n)))


def test_outcomes_follow_the_model(failing):
    out = op.with_retries(failing, error)
    assert rows(out.select("id", "attempts", "delay_s", "outcome")) == [(k, *retry(k)) for k in range(9)]
    assert rows(out.filter("outcome = 'dlq'").select("id", "_error")) == [(k, "try 6") for k in (6, 7, 8)]


def test_frame_form_tries_only_what_failed(failing, spark):
    seen = spark.sparkContext.accumulator(0)

    def process(df, attempt):
        def run(batches):
            for pdf in batches:
                seen.add(len(pdf))
                yield pdf.assign(_error=[f"try {attempt}" if f >= attempt else None for f in pdf.failures])

        return df.mapInPandas(run, "id int, failures int, _error string")

    out = op.with_retries_frame(failing, process)
    assert rows(out.select("id", "attempts", "delay_s", "outcome")) == [(k, *retry(k)) for k in range(9)]
    # every attempt ran once: 9 first tries, then those that had failed so far
    assert seen.value == sum(min(k, 5) + 1 for k in range(9))


def test_fewer_retries(failing):
    out = op.with_retries(failing, error, max_retries=2).select("id", "attempts", "delay_s", "outcome")
    assert rows(out) == [(k, *retry(k, 2)) for k in range(9)]


def test_pauses_merge_and_hold(spark):
    rng = random.Random(4)
    data = [(i, i % 2, rng.randint(0, 4_000_000_000), rng.choice([0, 0, 1, 7, 31])) for i in range(400)]
    df = spark.createDataFrame(data, "id int, p int, us long, delay_s int").withColumn("at", F.timestamp_micros("us"))
    pauses = op.pause_intervals(df, ["p"], "at")
    want = {
        p: merge([(us, us + d * 1_000_000) for _, q, us, d in data if q == p and d]) for p in (0, 1)
    }
    found = pauses.select("p", F.unix_micros("paused_at"), F.unix_micros("resumed_at"))
    assert rows(found) == sorted(((p, s, e) for p, iv in want.items() for s, e in iv), key=repr)
    held = op.hold_paused(df, pauses, ["p"], "at").select("id", F.unix_micros("held_until")).collect()
    for i, until in held:
        _, p, us, _ = data[i]
        assert until == next((e for s, e in want[p] if s < us < e), None)
    assert len(held) == len(data)
