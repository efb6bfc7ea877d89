import glob
from random import Random
from types import SimpleNamespace

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F, types as T

from logweave import operators as op, sinks, sources
from logweave.session import child_names, small_side, work_dir
from logweave.streaming import mirror
from logweave.streaming.run import finish

from conftest import rows
from test_log import log_of

ROW = T.StructType(
    [T.StructField("id", T.IntegerType())]
    + [T.StructField(n, T.StringType()) for n in ("first_name", "last_name", "email")]
)


def person(i, name):
    return f'{{"id":{i},"first_name":"{name}","last_name":"L","email":null}}'


def change(op_, before=None, after=None, enveloped=True):
    record = f'{{"before":{before or "null"},"after":{after or "null"},"op":"{op_}","ts_ms":1}}'
    return f'{{"schema":{{"type":"struct"}},"payload":{record}}}' if enveloped else record


def test_unwrap_changes(spark):
    log = log_of(spark, [
        (0, 0, "1", change("r", after=person(1, "A"))),
        (0, 1, "1", change("u", before=person(1, "A"), after=person(1, "B"), enveloped=False)),
        (0, 2, "1", change("d", before=person(1, "B"))),
        (0, 3, "1", None),
        (0, 4, "2", "{broken"),
        (0, 5, "2", '{"other":1}'),
    ])
    out = op.unwrap_changes(log, ROW).orderBy("offset").collect()
    assert [(r["id"], r["first_name"], r["__deleted"], r["op"], r["is_tombstone"], r["_error"]) for r in out] == [
        (1, "A", "false", "r", False, None), (1, "B", "false", "u", False, None), (1, "B", "true", "d", False, None),
        (None, None, None, None, True, None), (None, None, None, None, False, "malformed_change"),
        (None, None, None, None, False, "malformed_change"),
    ]
    assert op.unwrap_changes(log, ROW, keep_tombstones=False).count() == 5


def test_change_records_are_read_strictly(spark):
    good = '{"id":1,"payload":"p"}'
    values = [good, f'{{"payload":{good}}}', good + " junk", good + ',"x":2', '{"id":"x","payload":"p"}', '{"id":1,"payload":7}', "null", "7"]
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("payload", T.StringType())])
    log = log_of(spark, [(0, i, "k", v) for i, v in enumerate(values)])
    out = op.rewritten_changes(log, schema).orderBy("offset").collect()
    assert [(r["id"], r["payload"], r["_error"]) for r in out] == [(1, "p", None)] * 2 + [(None, None, "malformed_change")] * 6


def test_rows_unwrapped_upstream(spark):
    def row(name, deleted, enveloped):
        text = f'{person(1, name)[:-1]},"__deleted":"{deleted}"}}'
        return f'{{"schema":{{}},"payload":{text}}}' if enveloped else text

    log = log_of(spark, [
        (0, 0, "1", row("A", "false", True)), (0, 1, "1", row("B", "true", False)), (0, 2, "1", None),
        (0, 3, "2", "{broken"), (0, 4, "2", '{"other":1}'), (0, 5, "3", person(3, "C")),
    ])
    out = op.rewritten_changes(log, ROW).orderBy("offset").collect()
    assert [(r["id"], r["first_name"], r["__deleted"], r["op"], r["is_tombstone"], r["_error"]) for r in out] == [
        (1, "A", "false", None, False, None), (1, "B", "true", "d", False, None), (None, None, None, None, True, None),
        (None, None, None, None, False, "malformed_change"), (None, None, None, None, False, "malformed_change"),
        (3, "C", "false", None, False, None),
    ]
    source, root, checkpoint = (work_dir(spark, n) for n in ("log", "mirror", "cp"))
    sinks.write_log(log, source)
    stream = sources.read_log(spark, source, streaming=True)
    finish(mirror.cdc_mirror(stream, ROW, ["id"], root, checkpoint, unwrap=op.rewritten_changes))
    assert rows(mirror.read_mirror(spark, root, ROW, ["id"]).select("id", "first_name")) == [(1, "B"), (3, "C")]


def test_latest_row_wins_and_deleted_rows_stay(spark):
    data = [(1, "a", "false", 1), (1, "b", "true", 2), (2, "c", "true", 1), (2, "d", "false", 3), (3, "e", "false", 1)]
    df = spark.createDataFrame(data, "id int, v string, __deleted string, offset long")
    assert rows(op.latest_by_key(df, ["id"], ["offset"]).select("id", "v")) == [(1, "b"), (2, "d"), (3, "e")]
    live = op.latest_by_key(df, ["id"], ["offset"], drop_deleted=True)
    assert rows(live.select("id", "v")) == [(2, "d"), (3, "e")]


def test_mirror_follows_inserts_deletes_and_returns(spark):
    source, root, checkpoint = (work_dir(spark, n) for n in ("log", "mirror", "cp"))
    batches = [
        [(0, 0, "1004", change("r", after=person(1004, "Anne")))],
        [(0, 1, "1005", change("c", after=person(1005, "Bill"))), (0, 2, "x", "{broken")],
        [(0, 3, "1004", change("d", before=person(1004, "Anne"))), (0, 4, "1004", None)],
        [(0, 5, "1004", change("c", after=person(1004, "Anna")))],
    ]
    seen = []
    for batch in batches:
        sinks.write_log(log_of(spark, batch), source)
        finish(mirror.cdc_mirror(sources.read_log(spark, source, streaming=True), ROW, ["id"], root, checkpoint))
        seen.append(rows(mirror.read_mirror(spark, root, ROW, ["id"], drop_deleted=True).select("id", "first_name")))
    assert seen == [
        [(1004, "Anne")], [(1004, "Anne"), (1005, "Bill")], [(1005, "Bill")], [(1004, "Anna"), (1005, "Bill")],
    ]


def test_upsert_batch_written_again_changes_nothing(spark):
    root, compacted = work_dir(spark, "upsert"), work_dir(spark, "compact")
    df = spark.createDataFrame([(1, "a", 1), (1, "b", 2)], "id int, v string, offset long")
    upsert = sinks.upsert_sink(root, ["id"], ["offset"])
    for batch_id in (0, 0):
        upsert(df, batch_id)
    sinks.stage_batch(spark.createDataFrame([(1, "unseen", 9)], df.schema), root, 1)
    assert rows(sinks.read_upsert(spark, root, df.schema, ["id"], ["offset"])) == [(1, "b", 2)]
    assert sinks.read_batches(spark, root, df.schema).count() == 1
    sinks.compact_upsert(spark, root, compacted, df.schema, ["id"], ["offset"])
    assert rows(sinks.read_upsert(spark, compacted, df.schema, ["id"], ["offset"])) == [(1, "b", 2)]


def test_changes_after_compaction_are_seen(spark):
    source, root, compacted = (work_dir(spark, n) for n in ("log", "mirror", "compact"))
    sinks.write_log(log_of(spark, [(0, 0, "1", change("r", after=person(1, "old")))]), source)
    finish(mirror.cdc_mirror(sources.read_log(spark, source, streaming=True), ROW, ["id"], root, work_dir(spark, "cp")))
    sinks.compact_upsert(spark, root, compacted, mirror.mirror_schema(ROW), ["id"], ["offset"])
    sinks.write_log(log_of(spark, [(0, 1, "1", change("u", after=person(1, "new")))]), source)
    finish(mirror.cdc_mirror(sources.read_log(spark, source, streaming=True), ROW, ["id"], compacted, work_dir(spark, "cp")))
    assert rows(mirror.read_mirror(spark, compacted, ROW, ["id"]).select("id", "first_name")) == [(1, "new")]


def test_snapshot_rows_come_before_changes(spark):
    snapshot = spark.createDataFrame([(1, "a")], "id int, v string")
    changes = spark.createDataFrame([(1, "b", "u", 0)], "id int, v string, op string, offset long")
    feed = sources.cdc_source(snapshot, changes)
    assert rows(op.latest_by_key(feed, ["id"], ["offset"]).select("id", "v")) == [(1, "b")]


def test_sorted_files(spark):
    path = work_dir(spark, "sorted")
    # tables this small would otherwise end in a single file
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(setting, "false")
    df = spark.range(5000).select((F.col("id") * 7919 % 13).alias("a"), (F.col("id") * 31 % 997).alias("b"), "id")
    try:
        sinks.write_sorted(df.repartition(5), ["a", "b"], path)
    finally:
        spark.conf.unset(setting)
    spans = []
    for name in glob.glob(f"{path}/*.parquet"):
        found = [(r["a"], r["b"]) for r in pq.read_table(name).to_pylist()]
        assert found == sorted(found)
        if found:
            spans.append((found[0], found[-1]))
    spans.sort()
    assert len(spans) > 1 and all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
    assert spark.read.parquet(path).count() == 5000


def test_evolve(spark):
    old = spark.createDataFrame([(1, "x")], "id int, gone string")
    new = spark.createDataFrame([(2, "t", None)], "id int, topic string, n int")
    out = op.evolve(old, new, {"n": 0}).select("id", "gone", "topic", "n")
    # rows written with the column keep their null; rows from before it get the default
    assert rows(out) == [(1, "x", None, 0), (2, None, "t", None)]


def test_positions(spark):
    actual = spark.createDataFrame([("t", 0), ("t", 1)], "topic string, partition int")
    known = spark.createDataFrame([("t", 0, 5), ("t", 9, 7)], "topic string, partition int, position long")
    keys = ["topic", "partition"]
    assert rows(op.carry_positions(actual, known, keys)) == [("t", 0, 5), ("t", 1, 0)]
    assert rows(op.set_changes(known, actual, keys)) == [("t", 0, "kept"), ("t", 1, "added"), ("t", 9, "removed")]


@pytest.mark.parametrize("limit, local", [(10, True), (3, True), (2, False)])
def test_small_side_checks_its_size(spark, limit, local):
    df = spark.range(3)
    out = small_side(df, limit)
    assert rows(out) == [(0,), (1,), (2,)]
    assert ("LocalRelation" in out._jdf.queryExecution().optimizedPlan().toString()) == local


def test_work_dir_is_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir", None)
    first, second = work_dir(spark, "x"), work_dir(spark, "x")
    assert first != second
    if shared is not None:
        assert first.startswith(shared)


class Unset:
    """A session without the shared folder."""

    def __init__(self, context, master):
        self.conf = SimpleNamespace(get=lambda name, default: default)
        self.sparkContext = SimpleNamespace(
            master=master, applicationId=context.applicationId, getCheckpointDir=context.getCheckpointDir
        )


def test_only_a_local_master_may_do_without_the_shared_folder(spark):
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        assert "logweave-" in work_dir(Unset(context, "local[2]"), "x")
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            work_dir(Unset(context, "spark://host:7077"), "x")
    else:
        assert work_dir(Unset(context, "spark://host:7077"), "x").startswith(context.getCheckpointDir())


def versions(spark, *data):
    return spark.createDataFrame(list(data), "id int, v string, __deleted string, offset long")


def test_batches_written_during_compaction_are_seen(spark, monkeypatch):
    root, schema = work_dir(spark, "upsert"), versions(spark).schema
    upsert = sinks.upsert_sink(root, ["id"], ["offset"])
    table = lambda: rows(sinks.read_upsert(spark, root, schema, ["id"], ["offset"]).select("id", "v"))
    compact = lambda: sinks.compact_in_place(spark, root, schema, ["id"], ["offset"])
    assert compact() is None
    upsert(versions(spark, (1, "a", "false", 0), (2, "a", "false", 1)), 0)
    upsert(versions(spark, (1, "b", "false", 2)), 1)
    write = sinks.upsert.write_batch

    def slowly(df, where, batch_id):
        # a batch is committed after the parts to merge were chosen, and a reader looks before the merged part is there
        monkeypatch.setattr(sinks.upsert, "write_batch", write)
        upsert(versions(spark, (2, "c", "false", 3), (3, "c", "false", 4)), 2)
        assert table() == [(1, "b"), (2, "c"), (3, "c")]
        write(df, where, batch_id)

    started = sinks.read_upsert(spark, root, schema, ["id"], ["offset"]).select("id", "v")
    monkeypatch.setattr(sinks.upsert, "write_batch", slowly)
    assert compact() == 1
    assert table() == [(1, "b"), (2, "c"), (3, "c")]
    # a reader that began before goes on through one compaction
    assert rows(started) == [(1, "b"), (2, "a")]
    assert sorted(child_names(spark, f"{root}/data")) == ["batch_id=0", "batch_id=1", "batch_id=2"]
    assert compact() == 2 and compact() == 2
    assert child_names(spark, f"{root}/data") == ["batch_id=2"]
    upsert(versions(spark, (3, "d", "true", 5)), 3)
    assert compact() == 3
    assert sorted(child_names(spark, f"{root}/merged/data")) == ["batch_id=2", "batch_id=3"]
    assert table() == [(1, "b"), (2, "c"), (3, "d")]
    # batches stay committed, so a stream that restarts does not write them again
    assert sorted(child_names(spark, f"{root}/commits")) == [f"batch_id={n}" for n in range(4)]


def test_compaction_that_died_is_made_good(spark):
    root, schema = work_dir(spark, "upsert"), versions(spark).schema
    upsert = sinks.upsert_sink(root, ["id"], ["offset"])
    upsert(versions(spark, (1, "a", "false", 0)), 0)
    sinks.stage_batch(versions(spark, (9, "half", "false", 9)), f"{root}/merged", 0)
    read = lambda: rows(sinks.read_upsert(spark, root, schema, ["id"], ["offset"]).select("id", "v"))
    assert read() == [(1, "a")]
    assert sinks.compact_in_place(spark, root, schema, ["id"], ["offset"]) == 0
    assert read() == [(1, "a")]
    upsert(versions(spark, (1, "a", "true", 1), (2, "b", "false", 2)), 1)
    assert sinks.compact_in_place(spark, root, schema, ["id"], ["offset"], drop_deleted=True) == 1
    assert read() == [(2, "b")]


def test_changes_while_a_chunk_is_read_win(spark):
    """Against a table that is replayed change by change, with every row seen at a moment of its own."""
    random = Random(5)
    changes = [(i, f"v{n}", random.choice("uud"), n) for n in range(400) for i in [random.randrange(40)]]
    low = {c: 60 + 40 * c for c in range(4)}
    high = {c: low[c] + 55 for c in range(4)}

    def state(i, moment):
        seen = [c for c in changes if c[0] == i and c[3] <= moment]
        return seen[-1][1] if seen and seen[-1][2] != "d" else None

    seen = [(i, state(i, random.randint(low[i % 4], high[i % 4]))) for i in range(40)]
    snapshot = spark.createDataFrame([r for r in seen if r[1]], "id long, v string")
    feed = spark.createDataFrame([c for c in changes if c[3] > 60], "id long, v string, op string, offset long")
    windows = spark.createDataFrame([(c, low[c], high[c]) for c in range(4)], "chunk long, low long, high long")
    out = sources.incremental_snapshot(snapshot, feed, windows, ["id"], F.col("id") % 4)
    live = op.latest_by_key(out, ["id"], ["offset"]).filter("op <> 'd'").select("id", "v")
    assert rows(live) == rows(spark.createDataFrame([(i, state(i, 400)) for i in range(40) if state(i, 400)], "id long, v string"))
    kept = {(r["id"], r["v"], r["offset"]) for r in out.filter("op = 'r'").collect()}
    quiet = [i for i in range(40) if not any(c[0] == i and low[i % 4] < c[3] <= high[i % 4] for c in changes)]
    assert kept == {(i, state(i, low[i % 4]), high[i % 4]) for i in quiet if state(i, low[i % 4])}
    # a chunk without a window, one read twice, and empty inputs
    some = sources.incremental_snapshot(snapshot, feed, windows.filter("chunk <> 2"), ["id"], F.col("id") % 4).filter("op = 'r'")
    assert {r["id"] for r in some.collect()} == {k[0] for k in kept if k[0] % 4 != 2}
    twice = windows.union(windows.selectExpr("chunk", "low - 5", "low"))
    assert sources.incremental_snapshot(snapshot, feed.limit(0), twice, ["id"], F.col("id") % 4).count() == snapshot.count()
    assert sources.incremental_snapshot(snapshot.limit(0), feed, windows, ["id"], F.col("id") % 4).count() == feed.count()
