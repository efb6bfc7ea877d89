import random

import pytest
from pyspark.sql import functions as F, types as T

from logweave import functions as fn, operators as op
from logweave.operators import health, scan
from logweave.schemas import ATTEMPT_SCHEMA
from logweave.session import work_dir
from logweave.streaming.health import health_stream, read_health
from logweave.streaming.run import finish

from conftest import rows
from models import clamped, moving_average


def random_attempts(rng, n=300, partitions=2):
    data = []
    for i in range(n):
        p = rng.randrange(partitions)
        data.append((p, i, i * 10, "produce", None, None, None))
        outcome = rng.random()
        if outcome < 0.5:
            data.append((p, i, i * 10, "delivery", rng.uniform(1, 99), None, None))
        elif outcome < 0.95:
            data.append((p, i, i * 10, "error", None, rng.choice(["LeaderNotAvailable", "RequestTimedOut"]), False))
    return data


@pytest.fixture
def small_blocks(monkeypatch):
    original = scan.block_of
    monkeypatch.setattr(health, "block_of", lambda order, bits: original(order, 3))


def expected(data, p, now):
    mine = [a for a in data if a[0] == p]
    settled = [a for a in mine if a[3] != "produce"]
    errors = [a for a in settled if a[3] == "error"]
    cool = [a[2] for a in errors if a[5] == "LeaderNotAvailable"]
    until = max(cool, default=-5000) + 5000
    return (
        p, len(mine) - 2 * len(settled), clamped([1 if a[3] == "error" else -1 for a in settled]),
        round(moving_average([a[4] for a in settled if a[3] == "delivery"]), 9),
        max((a[2] for a in errors), default=None), until, now > until,
    )


def test_health_follows_the_model(spark, small_blocks):
    data = random_attempts(random.Random(2))
    df = spark.createDataFrame(data, ATTEMPT_SCHEMA).repartition(5)
    now = 4_000
    found = op.partition_health(df, now).withColumn("avg_latency_ms", F.round("avg_latency_ms", 9))
    want = [expected(data, p, now) for p in (0, 1)]
    # produce rows count +1 and settled ones -1, so an open attempt is what is left
    assert [(r[0], r[1], *r[2:]) for r in rows(found)] == [
        (p, sum(1 if a[3] == "produce" else -1 for a in data if a[0] == p), *rest)
        for p, _, *rest in want
    ]
    assert rows(op.recent_errors(df)) == [(w[0], w[2]) for w in want]
    means = op.ewma(df.filter("kind = 'delivery'"), ["partition"], "attempt_no", "latency_ms")
    assert rows(means.withColumn("ewma", F.round("ewma", 9))) == [(w[0], w[3]) for w in want]


def test_stream_merges_batches(spark, small_blocks):
    data = random_attempts(random.Random(9))
    source, root, checkpoint = (work_dir(spark, n) for n in ("in", "root", "cp"))
    # the second partition is silent at first, so its state begins later
    cuts = [[a for a in data if a[1] < 100 and a[0] == 0], [a for a in data if 100 <= a[1] < 180], [a for a in data if a[1] >= 180]]
    kept = [a for part in cuts for a in part]
    for part in cuts:
        spark.createDataFrame(part, ATTEMPT_SCHEMA).write.mode("append").parquet(source)
        finish(health_stream(spark.readStream.schema(ATTEMPT_SCHEMA).parquet(source), root, checkpoint))
    rounded = lambda df: rows(df.withColumn("avg_latency_ms", F.round("avg_latency_ms", 9)))
    whole = op.partition_health(spark.createDataFrame(kept, ATTEMPT_SCHEMA), 4_000)
    assert rounded(read_health(spark, root, 4_000)) == rounded(whole)


def test_stream_takes_batches_in_any_order(spark, small_blocks):
    """Two topics, one of them null, with batches in and out of order that share blocks: all agree with one pass."""
    data = random_attempts(random.Random(9))
    schema = T.StructType([T.StructField("topic", T.StringType()), *ATTEMPT_SCHEMA.fields])
    both = [("a" if i % 3 else None, *a) for i, a in enumerate(data)]
    cuts = [[a for a in both if a[2] < 90], [a for a in both if 90 <= a[2] < 181], [a for a in both if a[2] >= 181]]
    mixed = [both[::3], both[1::3], both[2::3]]
    by = ["topic", "partition"]
    rounded = lambda df: rows(df.withColumn("avg_latency_ms", F.round("avg_latency_ms", 9)))
    whole = rounded(op.partition_health(spark.createDataFrame(both, schema), 4_000, by))
    for parts in (cuts[::-1], mixed):
        source, root, checkpoint = (work_dir(spark, n) for n in ("in", "root", "cp"))
        for part in parts:
            spark.createDataFrame(part, schema).write.mode("append").parquet(source)
            finish(health_stream(spark.readStream.schema(schema).parquet(source), root, checkpoint, by))
        assert rounded(read_health(spark, root, 4_000, by=schema.fields[:2])) == whole


def test_average_ordered_by_sparse_times(spark):
    rng = random.Random(6)
    times = sorted(rng.sample(range(10**15), 400))
    values = [rng.uniform(0, 50) for _ in times]
    df = spark.createDataFrame([("g", t, v) for t, v in zip(times, values)], "g string, t long, v double")
    bits = scan.block_bits(df, "t")
    assert df.select(scan.block_of("t", bits)).distinct().count() == 1
    for width in (bits, 44):
        found = op.ewma(df.repartition(4), ["g"], "t", "v", bits=width).first()["ewma"]
        assert found == pytest.approx(moving_average(values))
    assert scan.block_bits(df.limit(0), "t") == scan.BLOCK_BITS


def test_inflight_with_and_without_leak(spark):
    data = [(0, 1, 0, "produce", None, None, None), (0, 1, 0, "error", None, "RequestTimedOut", False),
            (0, 2, 0, "produce", None, None, None), (0, 2, 0, "delivery", 1.0, None, None)]
    df = spark.createDataFrame(data, ATTEMPT_SCHEMA)
    assert rows(op.inflight(df)) == [(0, 0)]
    assert rows(op.inflight(df, leak=True)) == [(0, 1)]
    assert op.partition_health(df, 0, leak=True).first()["inflight"] == 1


STATE = "partition int, inflight long, recent_errors long, avg_latency_ms double, last_error_ms long, unavailable_until_ms long, available boolean"


@pytest.mark.parametrize("age, penalty", [(0, 8), (2999, 8), (3000, 4), (9999, 4), (10000, 0)])
def test_score_penalty_by_age(spark, age, penalty):
    df = spark.createDataFrame([(0, 2, 3, 40.0, 1000, 0, True)], STATE)
    assert df.select(fn.partition_score(1000 + age)).first()[0] == 2 + 40 * 0.05 + 15 + penalty


def test_never_failed_has_no_penalty(spark):
    df = spark.createDataFrame([(0, 0, 0, 0.0, None, 0, True)], STATE)
    assert df.select(fn.partition_score(5)).first()[0] == 0


def test_availability_is_strict(spark):
    data = [(0, 1, 1000, "error", None, "KafkaStorageError", False)]
    df = spark.createDataFrame(data, ATTEMPT_SCHEMA)
    assert [op.partition_health(df, now).first()["available"] for now in (5999, 6000, 6001)] == [False, False, True]


def test_lowest_score_then_lowest_id(spark):
    state = [(2, 1, 0, 0.0, None, 0, True), (1, 1, 0, 0.0, None, 0, True), (0, 0, 0, 0.0, None, 9, False)]
    df = spark.createDataFrame(state, STATE)
    assert rows(op.choose_partition(df, [], 3, 5)) == [(1, 1.0)]


def test_without_an_available_partition_a_hash_chooses(spark):
    down = [(p, 0, 0, 0.0, None, 9, False) for p in range(3)]
    df = spark.createDataFrame(down, STATE).withColumn("topic", F.lit("t"))
    first, again = (op.choose_partition(df, ["topic"], 3, 5).first() for _ in range(2))
    assert first["chosen"] == again["chosen"] and first["chosen"] in range(3) and first["score"] is None


def test_untried_partition_is_chosen_over_failing_ones(spark):
    df = spark.createDataFrame([(0, 0, 9, 0.0, None, 0, True), (1, 0, 9, 0.0, None, 0, True)], STATE)
    assert rows(op.choose_partition(df, [], 3, 5)) == [(2, 0.0)]
    assert rows(op.choose_partition(df, [], 2, 5)) == [(0, 45.0)]


def test_rows_of_unknown_groups_are_routed(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "topic string, n int")
    health = spark.createDataFrame([("a", 1, 0, 0, 0.0, None, 0, True)], f"topic string, {STATE}")
    out = op.route_batch(df, health, script("LeaderNotAvailable"), 10_000, 3, by=["topic"])
    assert rows(out.select("n", "partition", "attempts")) == [(1, 1, 2), (2, 1, 2), (3, 1, 2)]
    out = op.route_batch(df, health.limit(0).drop("topic"), script(), 10_000, 3)
    assert rows(out.select("n", "partition")) == [(1, 0), (2, 0), (3, 0)]


def script(*codes):
    """Errors of the first attempts; delivered afterwards."""
    def error_at(attempt, partition):
        return F.lit(codes[attempt - 1]) if attempt <= len(codes) else F.lit(None).cast("string")

    return error_at


def route(spark, error_at, state=None, **options):
    state = state or [(p, 0, 0, float(p), None, 0, True) for p in range(3)]
    df = spark.range(20)
    out = op.route_batch(df, spark.createDataFrame(state, STATE), error_at, 10_000, 3, **options)
    assert out.count() == 20
    return rows(out.select("partition", "attempts", "outcome", "error_code").distinct())


def test_route_delivers_to_the_best(spark):
    assert route(spark, script()) == [(0, 1, "delivered", None)]


def test_route_moves_on_after_a_cooldown(spark):
    assert route(spark, script("LeaderNotAvailable")) == [(1, 2, "delivered", None)]
    assert route(spark, script("LeaderNotAvailable", "KafkaStorageError")) == [(2, 3, "delivered", None)]


def test_route_moves_on_when_errors_weigh_more(spark):
    # 20 errors at 5 each outweigh the other partitions' latency
    assert route(spark, script("RequestTimedOut")) == [(1, 2, "delivered", None)]


def test_route_stays_when_the_topic_was_missing(spark):
    assert route(spark, script("UnknownTopicOrPart")) == [(0, 2, "delivered", None)]
    assert route(spark, script("Local_UnknownTopic")) == [(0, 2, "delivered", None)]


def test_route_rejects_and_exhausts(spark):
    assert route(spark, script("MsgSizeTooLarge")) == [(0, 1, "rejected", "MsgSizeTooLarge")]
    fatal = {"fatal": lambda code: code == "RequestTimedOut"}
    assert route(spark, script("RequestTimedOut"), **fatal) == [(0, 1, "rejected", "RequestTimedOut")]
    [(_, attempts, outcome, _)] = route(spark, script(*["RequestTimedOut"] * 12))
    assert (attempts, outcome) == (10, "exhausted")


def test_route_avoids_the_failing_partition(spark):
    fails_on_zero = lambda attempt, p: F.when(p == 0, "NotEnoughReplicas")
    assert route(spark, fails_on_zero) == [(1, 2, "delivered", None)]


def test_route_by_topic(spark):
    state = [("a", 0, 0, 0, 1.0, None, 0, True), ("a", 1, 0, 0, 2.0, None, 0, True),
             ("b", 0, 0, 0, 9.0, None, 0, True), ("b", 1, 0, 0, 2.0, None, 0, True)]
    df = spark.range(10).withColumn("topic", F.when(F.col("id") < 7, "a").otherwise("b"))
    fails = lambda attempt, p: F.when((F.col("topic") == "a") & (p == 0), "LeaderNotAvailable")
    out = op.route_batch(df, spark.createDataFrame(state, f"topic string, {STATE}"), fails, 10_000, 2, by=["topic"])
    assert rows(out.groupBy("topic", "partition", "attempts").count()) == [("a", 1, 2, 7), ("b", 1, 1, 3)]
