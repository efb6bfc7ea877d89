import json

import pytest
from pyspark.sql import functions as F

from logweave import operators as op, sinks, sources
from logweave.functions import header_last, partition_by_suffix
from logweave.schemas import LOG_SCHEMA
from logweave.session import work_dir
from logweave.streaming import pipes
from logweave.streaming.run import AVAILABLE_NOW, finish

from conftest import rows


def log_of(spark, data):
    """Log rows from (partition, offset, key, value)."""
    df = spark.createDataFrame(data, "partition int, offset long, k string, v string")
    return df.select(
        F.col("k").cast("binary").alias("key"), F.col("v").cast("binary").alias("value"),
        F.lit("t").alias("topic"), "partition", "offset", F.timestamp_micros(F.col("offset")).alias("timestamp"),
        F.lit(None).cast(LOG_SCHEMA["headers"].dataType).alias("headers"),
    )


def test_broker_options():
    assert sources.broker_options("h:1", "t") == {
        "kafka.bootstrap.servers": "h:1", "startingOffsets": "earliest", "subscribe": "t",
    }
    chosen = sources.broker_options("h:1", "t", [2, 0], bounded=True, committed_only=True, max_offsets=9, group="g")
    assert json.loads(chosen["assign"]) == {"t": [0, 2]}
    assert "subscribe" not in chosen
    assert chosen["endingOffsets"] == "latest"
    assert chosen["kafka.isolation.level"] == "read_committed"
    assert chosen["maxOffsetsPerTrigger"] == "9" and chosen["kafka.group.id"] == "g"


def test_delivery_profiles():
    reliable = sinks.sink_options("reliable", "h:1", "t")
    assert reliable["kafka.acks"] == "all" and reliable["kafka.enable.idempotence"] == "true"
    assert reliable["kafka.linger.ms"] == "50" and reliable["kafka.batch.size"] == "32768"
    fast = sinks.sink_options("fire_forget", "h:1")
    assert fast["kafka.acks"] == "0" and fast["kafka.compression.type"] == "snappy" and "topic" not in fast
    assert sinks.sink_options("idempotent", "h:1")["kafka.max.in.flight.requests.per.connection"] == "5"
    assert sinks.sink_options("leader", "h:1")["kafka.acks"] == "1"


def test_snapshot_options():
    options = sources.snapshot_options("jdbc:x", "inventory.customers", "id", (1, 900), 8, fetchsize="1000")
    assert options["dbtable"] == "inventory.customers" and options["partitionColumn"] == "id"
    assert (options["lowerBound"], options["upperBound"], options["numPartitions"]) == ("1", "900", "8")
    assert options["fetchsize"] == "1000"


def test_selected_partitions_prune_directories(spark):
    path = work_dir(spark, "log")
    sinks.write_log(log_of(spark, [(p, o, "k", "v") for p in range(3) for o in range(4)]), path)
    log = sources.read_log(spark, path, partitions=[2, 0])
    assert {r["partition"] for r in log.collect()} == {0, 2}
    plan = log._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [partition" in plan
    assert log.schema.fieldNames() == LOG_SCHEMA.fieldNames()


def test_end_of_partition_notices_are_no_messages(spark):
    path = work_dir(spark, "log")
    sinks.write_log(log_of(spark, [(0, 0, "k", "v"), (0, None, None, None)]), path)
    assert sources.read_log(spark, path).count() == 1


def test_partitioner_callback(spark):
    path = work_dir(spark, "log")
    rows_in = log_of(spark, [(0, o, f"user {o}", "v") for o in range(6)])
    sinks.write_log(rows_in, path, partitioner=partition_by_suffix("key", 3))
    log = sources.read_log(spark, path)
    assert {(r["offset"] % 3, r["partition"]) for r in log.collect()} == {(0, 0), (1, 1), (2, 2)}


def test_selection_stays_fixed_when_partitions_appear(spark):
    source, root, checkpoint = (work_dir(spark, n) for n in ("log", "root", "cp"))
    schema = "partition int, offset long"
    for p in (0, 1, 2):
        sinks.write_log(log_of(spark, [(p, 0, "k", "v"), (p, 1, "k", "v")]), source)
        stream = sources.read_log(spark, source, streaming=True, partitions=[0, 2])
        finish(pipes.transactional_pipe(stream, lambda s: s.select("partition", "offset"), root, checkpoint))
    out = pipes.read_pipe(spark, root, spark.createDataFrame([], schema).schema)
    assert rows(out) == [(0, 0), (0, 1), (2, 0), (2, 1)]
    assert rows(pipes.consumed_positions(spark, root).select("partition", "position")) == [(0, 2), (2, 2)]


def test_intake_bound_sets_the_batches(spark):
    source, root, checkpoint = (work_dir(spark, n) for n in ("log", "root", "cp"))
    for o in range(4):
        sinks.write_log(log_of(spark, [(0, o, "k", "v")]).coalesce(1), source)
    stream = sources.read_log(spark, source, streaming=True, max_files=1)
    finish(pipes.transactional_pipe(stream, lambda s: s.select("offset"), root, checkpoint))
    out = sinks.read_batches(spark, root, spark.createDataFrame([], "offset long").schema)
    assert sorted(r["batch_id"] for r in out.collect()) == [0, 1, 2, 3]


def test_envelope_headers(spark):
    df = spark.createDataFrame([("1", "x")], "id string, v string")
    row = op.envelope(df, None, F.col("v"), {"kind": F.col("v"), "Producer": "again"}, producer="p", machine="m")
    names = [h["key"] for h in row.first()["headers"]]
    assert names == ["Producer", "Machine", "kind", "Producer"]
    assert row.select(header_last("headers", "Producer").cast("string")).first()[0] == "again"
    assert row.first()["key"] is None and bytes(row.first()["value"]) == b"x"


def test_keyed_log_keeps_nulls(spark):
    df = spark.createDataFrame([("7", None)], "Id string, Payload string")
    row = op.to_keyed_log(df, "Id", ["Id", "Payload"]).first()
    assert bytes(row["key"]) == b"7" and bytes(row["value"]) == b'{"Id":"7","Payload":null}'


def test_dead_letters(spark):
    df = spark.createDataFrame([(1, None), (2, "bad")], "id int, _error string")
    good, dead = sinks.split_dlq(df, attempts=3)
    assert rows(good) == [(1,)]
    row = dead.first()
    assert (row["id"], row["error"], row["attempts"]) == (2, "bad", 3) and row["failed_at"] is not None


def test_read_committed(spark):
    log = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "txn_id long, v string")
    commits = spark.createDataFrame([(1,), (1,)], "txn_id long")
    assert rows(sources.read_committed(log, commits)) == [(1, "a")]


def test_json_queue_keeps_bad_rows_on_request(spark):
    log = log_of(spark, [(0, 0, "k", '{"a":"x"}'), (1, 1, "k", "{")])
    schema = spark.createDataFrame([], "a string").schema
    assert rows(sources.json_queue(log, schema)) == [("x", "t", 0)]
    kept = sources.json_queue(log, schema, keep_bad=True)
    assert rows(kept.select("a", "_error")) == [("x", None), (None, "malformed_json")]


def test_continuous_view_resumes_with_a_new_select(spark):
    source, target, checkpoint = (work_dir(spark, n) for n in ("log", "view", "cp"))
    schema = spark.createDataFrame([], "a string").schema

    def attach(select):
        stream = sources.read_log(spark, source, streaming=True)
        return pipes.continuous_view("view", stream, select, target, checkpoint)

    sinks.write_log(log_of(spark, [(0, 0, "k", '{"a":"x"}')]), source)
    finish(attach(lambda s: sources.json_queue(s, schema).select("a")))
    sinks.write_log(log_of(spark, [(0, 1, "k", '{"a":"y"}')]), source)
    finish(attach(lambda s: sources.json_queue(s, schema).select("a", "_partition")))
    out = spark.read.option("mergeSchema", "true").parquet(target)
    assert rows(out.select("a", "_partition")) == [("x", None), ("y", 0)]


def test_chunks_of_a_stream(spark):
    """Eleven messages: a full chunk and one more, none lost."""
    source, root, checkpoint = (work_dir(spark, n) for n in ("log", "chunks", "cp"))
    sinks.write_log(log_of(spark, [(0, o, "k", "v") for o in range(11)]), source)
    stream = sources.read_log(spark, source, streaming=True).select("offset")
    finish(pipes.micro_batch_sink(stream, ["offset"], root, checkpoint, trigger=AVAILABLE_NOW))
    out = sinks.read_batches(spark, root, spark.createDataFrame([], "offset long, chunk long").schema)
    assert rows(out.groupBy("chunk").count()) == [(0, 10), (1, 1)]


def test_a_batch_leaves_no_intermediate_tables(spark, monkeypatch):
    from logweave import session

    made = []
    real = session.work_dir
    monkeypatch.setattr(session, "work_dir", lambda s, name: made.append(real(s, name)) or made[-1])
    test_chunks_of_a_stream(spark)
    assert made and not any(session.path_exists(spark, path) for path in made)


def test_state_of_another_checkpoint_is_refused(spark):
    source, root = work_dir(spark, "log"), work_dir(spark, "root")
    sinks.write_log(log_of(spark, [(0, 0, "k", "v")]), source)
    sinks.write_batch(log_of(spark, []).select("partition"), root, 4)
    with pytest.raises(RuntimeError, match="another checkpoint"):
        sinks.batches.batch_before(spark, root, 4)
    assert sinks.batches.batch_before(spark, root, 5) == 4


def test_transaction_that_died_is_not_seen_and_is_replayed(spark, monkeypatch):
    source, root, checkpoint = (work_dir(spark, n) for n in ("log", "pipe", "cp"))
    schema = spark.createDataFrame([], "v string").schema
    shout = lambda s: s.select(F.upper(F.col("value").cast("string")).alias("v"))
    sinks.write_log(log_of(spark, [(0, 0, "k", "a"), (1, 0, "k", "b")]), source)

    def run():
        finish(pipes.transactional_pipe(sources.read_log(spark, source, streaming=True), shout, root, checkpoint))

    def die(*_):
        raise RuntimeError("lost before the commit")

    with monkeypatch.context() as m:
        m.setattr(pipes, "commit_batch", die)
        with pytest.raises(Exception, match="lost before the commit"):
            run()
    assert rows(pipes.read_pipe(spark, root, schema)) == []
    assert pipes.consumed_positions(spark, root).count() == 0
    run()
    assert rows(pipes.read_pipe(spark, root, schema)) == [("A",), ("B",)]
    assert rows(pipes.consumed_positions(spark, root).select("partition", "position")) == [(0, 1), (1, 1)]


def test_new_checkpoint_on_a_used_root_is_refused(spark):
    source, root = work_dir(spark, "log"), work_dir(spark, "pipe")
    sinks.write_log(log_of(spark, [(0, 0, "k", "a")]), source)
    same = lambda s: s.select(F.col("value").cast("string").alias("v"))

    def run(checkpoint):
        finish(pipes.transactional_pipe(sources.read_log(spark, source, streaming=True), same, root, checkpoint))

    first = work_dir(spark, "cp")
    run(first)
    sinks.write_log(log_of(spark, [(0, 1, "k", "b")]), source)
    with pytest.raises(Exception, match="not written by this checkpoint"):
        run(work_dir(spark, "cp"))
    run(first)
    assert rows(pipes.read_pipe(spark, root, spark.createDataFrame([], "v string").schema)) == [("a",), ("b",)]


def test_stream_to_log_directory(spark):
    source, target, checkpoint = (work_dir(spark, n) for n in ("log", "copy", "cp"))
    sinks.write_log(log_of(spark, [(0, 0, "a", "x"), (1, 0, "b", "y")]), source)
    query = sinks.write_log(
        sources.read_log(spark, source, streaming=True), target, "fire_forget", checkpoint=checkpoint
    )
    finish(query)
    assert rows(sources.read_log(spark, target).select("partition", F.col("key").cast("string"))) == [(0, "a"), (1, "b")]
