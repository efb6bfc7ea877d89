from pyspark.sql import functions as F

from logweave import operators as op
from logweave.session import work_dir
from logweave.sinks import mark_processed, read_ledger
from logweave.streaming import dedup, pipes
from logweave.streaming.run import finish
import pytest

from conftest import rows

SCHEMA = "k string, arrival long, v string"


def deliveries(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def test_first_arrival_wins(spark):
    df = deliveries(spark, [("a", 3, "late"), ("a", 1, "first"), ("b", 2, "only"), (None, 0, "x")])
    assert rows(op.dedup_first(df, ["k"], ["arrival"])) == [("a", 1, "first"), ("b", 2, "only")]
    assert rows(op.duplicates(df, ["k"], ["arrival"]).select("k", "arrival")) == [("a", 3)]
    assert rows(op.null_keys(df, ["k"]).select("v", "_error")) == [("x", "null_key")]


def test_key_with_most_of_the_rows(spark):
    """One key holds two thirds of the rows; each task sends one row of it."""
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias("k"),
        (30_000 - F.col("id")).alias("arrival"),
    ).repartition(8)
    first = op.dedup_first(df, ["k"], ["arrival"])
    assert first.count() == 10_001
    assert first.filter("k = 'hot'").first()["arrival"] == 1
    assert op.duplicates(df, ["k"], ["arrival"]).count() == 19_999
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in plan


def test_ledger_returns_what_was_new(spark):
    root = work_dir(spark, "ledger")
    ids = lambda *names: spark.createDataFrame([(n,) for n in names], "message_id string")
    assert rows(mark_processed(ids("a", "b", "a"), root, 0)) == [("a",), ("b",)]
    assert rows(mark_processed(ids("b", "c"), root, 1)) == [("c",)]
    assert rows(mark_processed(ids("b", "c"), root, 1)) == [("c",)]
    assert rows(read_ledger(spark, root)) == [("a",), ("b",), ("c",)]


def feed(spark, source, data):
    deliveries(spark, data).coalesce(1).write.mode("append").parquet(source)
    return spark.readStream.schema(SCHEMA).parquet(source)


def test_stream_dedup_remembers_keys_over_restarts(spark):
    for slices in (None, 4):
        source, target, checkpoint = (work_dir(spark, n) for n in ("in", "out", "cp"))
        for batch in ([("a", 1, "x"), ("a", 2, "x"), (None, 3, "y")], [("a", 4, "z"), ("b", 5, "z")]):
            stream = feed(spark, source, batch)
            finish(pipes.continuous_view(
                "dedup", stream, lambda s: dedup.dedup_stream(s, ["k"], slices=slices), target, checkpoint
            ))
        assert rows(spark.read.parquet(target).select("k")) == [("a",), ("b",)]


def test_stream_dedup_within_a_horizon(spark):
    source, target, checkpoint = (work_dir(spark, n) for n in ("in", "out", "cp"))
    select = lambda s: dedup.dedup_stream(
        s.withColumn("at", F.timestamp_seconds("arrival")), ["k"], "10 minutes", "at"
    )
    # the key comes again at once, then long after the horizon has passed
    for batch in ([("a", 0, "x"), ("a", 60, "x")], [("b", 7200, "x")], [("b", 7201, "x"), ("a", 7300, "x")]):
        finish(pipes.continuous_view("horizon", feed(spark, source, batch), select, target, checkpoint))
    assert rows(spark.read.parquet(target).select("k")) == [("a",), ("a",), ("b",)]


def consume(spark, stream, root, checkpoint, **options):
    def process(df):
        return df.withColumn("_error", F.when(F.col("v") == "bad", "failed"))

    return dedup.idempotent_consume(stream, "k", ["arrival"], process, root, checkpoint, **options)


def test_idempotent_consume(spark):
    source, root, checkpoint = (work_dir(spark, n) for n in ("in", "root", "cp"))
    schema = deliveries(spark, []).schema
    finish(consume(spark, feed(spark, source, [("a", 1, "x"), ("a", 2, "y"), ("b", 3, "bad"), (None, 4, "n")]), root, checkpoint))
    finish(consume(spark, feed(spark, source, [("a", 5, "z"), ("b", 6, "good")]), root, checkpoint))
    assert rows(dedup.read_results(spark, root, schema)) == [("a", 1, "x"), ("b", 6, "good")]
    assert rows(dedup.read_failures(spark, root, schema)) == [("b", 3, "bad", "failed")]


def test_failed_ids_can_be_marked(spark):
    source, root, checkpoint = (work_dir(spark, n) for n in ("in", "root", "cp"))
    schema = deliveries(spark, []).schema
    for data in ([("b", 3, "bad")], [("b", 6, "good")]):
        finish(consume(spark, feed(spark, source, data), root, checkpoint, mark_failed=True))
    assert dedup.read_results(spark, root, schema).count() == 0


def test_batch_that_died_before_its_commit_is_replayed(spark, monkeypatch):
    source, root, checkpoint = (work_dir(spark, n) for n in ("in", "root", "cp"))
    schema = deliveries(spark, []).schema
    finish(consume(spark, feed(spark, source, [("a", 1, "x")]), root, checkpoint))

    def die(*_):
        raise RuntimeError("lost before the commit")

    with monkeypatch.context() as m:
        m.setattr(dedup, "commit_batch", die)
        with pytest.raises(Exception, match="lost before the commit"):
            finish(consume(spark, feed(spark, source, [("a", 2, "y"), ("b", 3, "x")]), root, checkpoint))
    assert rows(dedup.read_results(spark, root, schema)) == [("a", 1, "x")]
    finish(consume(spark, feed(spark, source, [("c", 4, "x")]), root, checkpoint))
    assert rows(dedup.read_results(spark, root, schema)) == [("a", 1, "x"), ("b", 3, "x"), ("c", 4, "x")]


def test_batch_that_died_after_its_commit_is_not_repeated(spark, monkeypatch):
    """The commit row is there but the checkpoint is not: the same batch id comes again."""
    source, root, checkpoint = (work_dir(spark, n) for n in ("in", "root", "cp"))
    schema = deliveries(spark, []).schema
    real = dedup.commit_batch

    def commit_then_die(*args):
        real(*args)
        raise RuntimeError("lost after the commit")

    with monkeypatch.context() as m:
        m.setattr(dedup, "commit_batch", commit_then_die)
        with pytest.raises(Exception, match="lost after the commit"):
            finish(consume(spark, feed(spark, source, [("a", 1, "x"), ("b", 2, "x")]), root, checkpoint))
    finish(consume(spark, feed(spark, source, [("a", 3, "y")]), root, checkpoint))
    assert rows(dedup.read_results(spark, root, schema)) == [("a", 1, "x"), ("b", 2, "x")]


def test_ids_of_an_earlier_ledger_count(spark):
    source, root, checkpoint = (work_dir(spark, n) for n in ("in", "root", "cp"))
    schema = deliveries(spark, []).schema
    earlier = spark.createDataFrame([("a",)], "message_id string")
    finish(consume(spark, feed(spark, source, [("a", 1, "x"), ("b", 2, "x")]), root, checkpoint, earlier=earlier))
    assert rows(dedup.read_results(spark, root, schema)) == [("b", 2, "x")]


def test_state_store_in_place_of_the_ledger(spark):
    source, root, checkpoint = (work_dir(spark, n) for n in ("in", "root", "cp"))
    schema = deliveries(spark, []).schema
    for data in ([("a", 1, "x"), ("b", 2, "x")], [("a", 3, "y"), ("c", 4, "x")]):
        once = dedup.dedup_stream(feed(spark, source, data), ["k"])
        finish(consume(spark, once, root, checkpoint, check_ledger=False))
    assert rows(dedup.read_results(spark, root, schema)) == [("a", 1, "x"), ("b", 2, "x"), ("c", 4, "x")]
