import random
import time
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from logweave import operators as op
from logweave.operators import commit
from logweave.plans import fixtures as fx
from logweave.schemas import MARK_SCHEMA
from logweave.session import drop_table, path_exists, work_dir
from logweave.sinks import batches
from logweave.streaming import commits
from logweave.streaming.run import AVAILABLE_NOW, every, finish

from conftest import rows
from models import Tracker

EPOCH = datetime(2024, 1, 1, tzinfo=timezone.utc)


def marks_of(spark, data):
    """Marks from (partition, seq, offset, seconds)."""
    return spark.createDataFrame(
        [("t", p, s, o, EPOCH + timedelta(seconds=at)) for p, s, o, at in data], MARK_SCHEMA
    )


def test_known_positions(spark):
    marks = fx.marks(spark, "/root/testdata/sf0.01")
    highest = op.commit_positions(marks, "max").select("partition", "position")
    assert rows(highest) == [(0, 3334), (1, 3333), (2, 3333)]
    found = op.commit_positions(marks, "contiguous").select("partition", "position", "pending")
    assert rows(found) == [(0, 50, 3250), (1, 82, 3217), (2, 17, 3281)]
    gap = op.commit_positions(marks, "gap_timeout", fx.as_of(), timedelta(seconds=3600))
    assert rows(gap.select("partition", "position", "skipped", "pending")) == [
        (0, 983, 57, 0), (1, 979, 50, 0), (2, 968, 43, 2),
    ]


def test_offsets_finishing_in_reverse(spark):
    marks = marks_of(spark, [(0, 2, 102, 1), (0, 1, 101, 2), (0, 0, 100, 3)])
    for mode in ("max", "contiguous"):
        assert op.commit_positions(marks, mode).first()["position"] == 103


def test_missing_first_number_commits_nothing(spark):
    found = op.commit_positions(marks_of(spark, [(0, 1, 11, 0), (0, 2, 12, 0)]), "contiguous").first()
    assert (found["position"], found["committed_seq"], found["pending"]) == (None, -1, 2)


def test_lost_message_is_passed_only_by_max(spark):
    marks = marks_of(spark, [(0, 0, 10, 0), (0, 2, 12, 0)])
    assert op.commit_positions(marks, "max").first()["position"] == 13
    assert op.commit_positions(marks, "contiguous").first()["position"] == 11


@pytest.mark.parametrize("age, position", [(29, 11), (30, 13)])
def test_gap_is_given_up_at_the_timeout_itself(spark, age, position):
    marks = marks_of(spark, [(0, 0, 10, 0), (0, 2, 12, 0)])
    found = op.commit_positions(marks, "gap_timeout", EPOCH + timedelta(seconds=age), timedelta(seconds=30))
    assert found.first()["position"] == position


def random_marks(rng, partitions=3, numbers=120):
    data = []
    for p in range(partitions):
        offset = 1000 * p
        for seq in range(numbers):
            offset += rng.choice([1, 1, 1, 3])
            if rng.random() < 0.07 or (30 < seq < 55 and p == 1):
                continue
            at = seq + rng.randint(0, 60)
            data.append((p, seq, offset, at))
            if rng.random() < 0.2:
                data.append((p, seq, offset, at + rng.randint(1, 50)))
    data.sort(key=lambda m: (m[3], m[0], m[1]))
    return data


@pytest.fixture(params=[2, 12])
def block_bits(request, monkeypatch):
    """Blocks of 4 numbers in groups of 4, so that gaps cross both, and the real size."""
    monkeypatch.setattr(commit, "SEQ_BITS", request.param)
    return request.param


@pytest.mark.parametrize("seed", [1, 2])
def test_batch_forms_follow_the_model(spark, block_bits, seed):
    data = random_marks(random.Random(seed))
    marks = marks_of(spark, data)
    plain, timed, now = {}, {}, 150
    for p, seq, offset, at in data:
        plain.setdefault(p, Tracker()).mark(seq, offset, at)
        if at <= now:
            timed.setdefault(p, Tracker()).mark(seq, offset, at)
    found = op.commit_positions(marks, "contiguous").select("partition", "committed_seq", "position", "pending")
    assert rows(found) == [
        (p, t.seq, t.offset + 1 if t.seq >= 0 else None, len(t.pending)) for p, t in sorted(plain.items())
    ]
    for timeout in (10, 60, 100):
        trackers = {}
        for p, seq, offset, at in data:
            if at <= now:
                trackers.setdefault(p, Tracker()).mark(seq, offset, at)
        for t in trackers.values():
            t.tick(now, timeout)
        as_of, limit = EPOCH + timedelta(seconds=now), timedelta(seconds=timeout)
        found = op.commit_positions(marks, "gap_timeout", as_of, limit)
        assert rows(found.select("partition", "committed_seq", "position", "skipped", "pending")) == [
            (p, t.seq, t.offset + 1 if t.seq >= 0 else None, sum(b - a + 1 for a, b in t.skipped), len(t.pending))
            for p, t in sorted(trackers.items())
        ]
        gaps = op.skipped_gaps(marks, as_of, limit).select("partition", "gap_start", "gap_end")
        assert rows(gaps) == sorted(((p, a, b) for p, t in trackers.items() for a, b in t.skipped), key=repr)


def test_gaps_are_the_missing_numbers(spark, block_bits):
    rng = random.Random(7)
    present = {p: sorted(rng.sample(range(300), 80)) for p in range(2)}
    marks = marks_of(spark, [(p, s, s, 0) for p, seqs in present.items() for s in seqs])
    missing = set()
    for p, a, b in rows(op.gaps(marks).select("partition", "gap_start", "gap_end")):
        missing |= {(p, n) for n in range(a, b + 1)}
    assert missing == {(p, n) for p, seqs in present.items() for n in range(max(seqs)) if n not in seqs}


def test_clean_marks_keeps_the_earliest_and_drops_the_stale(spark):
    marks = marks_of(
        spark,
        [(0, 5, 15, 9), (0, 5, 15, 3), (0, 2, 12, 1), (0, 6, 12, 1), (1, 0, 0, 1), (1, -1, 1, 1)],
    )
    committed = spark.createDataFrame(
        [("t", 0, 2, 12)], "topic string, partition int, committed_seq long, committed_offset long"
    )
    clean = op.clean_marks(marks, committed).select("partition", "seq", F.unix_seconds("processed_at"))
    start = int(EPOCH.timestamp())
    assert rows(clean) == [(0, 5, start + 3), (1, 0, start + 1)]


def test_non_monotonic_offsets_are_reported(spark):
    marks = marks_of(spark, [(0, 0, 10, 0), (0, 1, 9, 0), (0, 2, 10, 0), (0, 3, 11, 0)])
    assert rows(op.non_monotonic(marks).select("seq", "_error")) == [(1, "non_monotonic"), (2, "non_monotonic")]


def test_oldest_pending(spark):
    marks = marks_of(spark, [(0, 0, 0, 9), (0, 2, 2, 5), (0, 3, 3, 4), (1, 0, 0, 1)])
    assert rows(op.oldest_pending(marks).select("partition", "seq")) == [(0, 3)]


def run_tracker(spark, parts, **options):
    """Feed parts one by one; yields the root after each."""
    source, root, checkpoint = (work_dir(spark, n) for n in ("in", "root", "cp"))
    for data in parts:
        marks_of(spark, data).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(MARK_SCHEMA).parquet(source)
        finish(commits.track_commits(stream, root, checkpoint, trigger=AVAILABLE_NOW, **options))
        yield root


def test_tracker_follows_the_model_batch_by_batch(spark, monkeypatch):
    monkeypatch.setattr(commit, "SEQ_BITS", 3)
    data = random_marks(random.Random(3), partitions=2, numbers=60)
    cut = len(data) // 3
    parts = [data[:cut], data[cut:2 * cut], data[2 * cut:]]
    trackers = {}
    for batch, root in zip(parts, run_tracker(spark, parts)):
        for p, seq, offset, at in batch:
            trackers.setdefault(p, Tracker()).mark(seq, offset, at)
        found = commits.read_committed_positions(spark, root).select("partition", "committed_seq", "position")
        assert rows(found) == [
            (p, t.seq, t.offset + 1 if t.seq >= 0 else None) for p, t in sorted(trackers.items())
        ]
        waiting = commits.read_pending(spark, root).select(
            "partition", F.explode(F.sequence("first_seq", "last_seq")).alias("seq")
        )
        assert rows(waiting) == sorted(((p, s) for p, t in trackers.items() for s in t.pending), key=repr)


@pytest.mark.parametrize("timeout", [15, 40])
def test_tracker_with_a_tick_per_batch(spark, monkeypatch, timeout):
    """Gaps are judged after every batch, at the newest time seen; marks that come later are dropped."""
    monkeypatch.setattr(commit, "SEQ_BITS", 3)
    data = random_marks(random.Random(11), partitions=2, numbers=80)
    cut = len(data) // 4
    parts = [data[i * cut:(i + 1) * cut] for i in range(3)] + [data[3 * cut:]]
    trackers, skipped = {}, []
    roots = run_tracker(spark, parts, gap_timeout=timedelta(seconds=timeout))
    now = 0
    for batch, root in zip(parts, roots):
        for p, seq, offset, at in batch:
            trackers.setdefault(p, Tracker()).mark(seq, offset, at)
            now = max(now, at)
        for t in trackers.values():
            t.tick(now, timeout)
        found = commits.read_committed_positions(spark, root).select("partition", "committed_seq", "position")
        assert rows(found) == [
            (p, t.seq, t.offset + 1 if t.seq >= 0 else None) for p, t in sorted(trackers.items())
        ]
        skipped = sorted(((p, a, b) for p, t in trackers.items() for a, b in t.skipped), key=repr)
        assert rows(commits.read_skipped(spark, root).select("partition", "gap_start", "gap_end")) == skipped
    assert skipped


def test_tracker_position_never_moves_back(spark):
    roots = list(run_tracker(spark, [[(0, 0, 10, 0), (0, 1, 9, 1)], [(0, 2, 12, 2)]]))
    assert rows(commits.read_committed_positions(spark, roots[-1]).select("committed_seq", "position")) == [(2, 13)]
    root = list(run_tracker(spark, [[(0, 0, 10, 0), (0, 1, 9, 1)]]))[-1]
    assert rows(commits.read_committed_positions(spark, root).select("committed_seq", "position")) == [(1, 11)]


def test_tracker_gives_up_gaps_and_drops_late_marks(spark):
    parts = [[(0, 0, 10, 0), (0, 3, 13, 5)], [(0, 4, 14, 40)], [(0, 1, 11, 41), (0, 5, 15, 42)]]
    roots = list(run_tracker(spark, parts, gap_timeout=timedelta(seconds=30)))
    assert rows(commits.read_skipped(spark, roots[-1]).select("gap_start", "gap_end")) == [(1, 2)]
    assert rows(commits.read_committed_positions(spark, roots[-1]).select("committed_seq", "position")) == [(5, 16)]


def test_tracker_by_the_clock_needs_no_new_marks(spark):
    source, root, checkpoint = (work_dir(spark, n) for n in ("in", "root", "cp"))
    now = datetime.now(timezone.utc)
    marks = [("t", 0, 0, 10, now), ("t", 0, 2, 12, now)]
    spark.createDataFrame(marks, MARK_SCHEMA).coalesce(1).write.parquet(source)
    stream = commits.with_ticks(spark.readStream.schema(MARK_SCHEMA).parquet(source))
    query = commits.track_commits(
        stream, root, checkpoint, timedelta(seconds=8), trigger=every(1), wall_clock=True
    )
    try:
        end = time.monotonic() + 90
        skipped = []
        while not skipped and time.monotonic() < end and query.isActive:
            time.sleep(1)
            skipped = rows(commits.read_skipped(spark, root).select("gap_start", "gap_end"))
    finally:
        query.stop()
    assert query.exception() is None
    assert skipped == [(1, 1)]
    assert rows(commits.read_committed_positions(spark, root).select("committed_seq", "position")) == [(2, 13)]


def test_old_states_are_dropped_and_reports_are_kept(spark, monkeypatch):
    monkeypatch.setattr(batches, "KEPT_STATES", 2)
    data = [[(0, 0, 10, 0), (0, 2, 12, 0)], [(0, 3, 13, 50)], [(0, 5, 15, 51)], [(0, 6, 16, 99)]]
    root = list(run_tracker(spark, data, gap_timeout=timedelta(seconds=30)))[-1]
    assert [path_exists(spark, f"{root}/runs/batch_id={n}") for n in range(4)] == [False, False, True, True]
    assert rows(commits.read_skipped(spark, root).select("gap_start", "gap_end")) == [(1, 1), (4, 4)]
    assert rows(commits.read_committed_positions(spark, root).select("position")) == [(17,)]


def test_marks_over_the_limit_wait_and_are_reported(spark):
    waiting = [(0, s, 100 + s, s) for s in range(1, 9)]
    roots = list(run_tracker(spark, [waiting, [(0, 0, 100, 9)]], pending_limit=4))
    assert rows(commits.read_overflow(spark, roots[-1]).select("batch_id", "partition", "pending")) == [(0, 0, 8)]
    assert rows(commits.read_committed_positions(spark, roots[-1]).select("committed_seq", "position")) == [(8, 109)]


def test_default_limit_loses_no_mark(spark):
    exact = [(0, s, s, 0) for s in range(1, 10_002)]
    root = list(run_tracker(spark, [exact]))[-1]
    assert commits.read_overflow(spark, root).count() == 0
    root = list(run_tracker(spark, [[*exact, (0, 10_002, 10_002, 1)], [(0, 0, 0, 2)]]))[-1]
    assert rows(commits.read_overflow(spark, root).select("pending")) == [(10_002,)]
    assert rows(commits.read_committed_positions(spark, root).select("position")) == [(10_003,)]


def test_lost_state_stops_the_stream(spark):
    source, root, checkpoint = (work_dir(spark, n) for n in ("in", "root", "cp"))

    def run(mark):
        marks_of(spark, [mark]).write.mode("append").parquet(source)
        stream = spark.readStream.schema(MARK_SCHEMA).parquet(source)
        finish(commits.commit_batches(stream, root, checkpoint, AVAILABLE_NOW))

    run((0, 0, 10, 0))
    drop_table(spark, f"{root}/positions/batch_id=0")
    with pytest.raises(Exception, match="is gone"):
        run((0, 1, 11, 0))


def test_runs_equal_a_plain_merge(spark, monkeypatch):
    """Runs found in parts, with repeated numbers, equal those of all marks at once."""
    monkeypatch.setattr(commit, "BLOCK_BITS", 3)
    data = random_marks(random.Random(5), partitions=2, numbers=90)
    cut = len(data) // 2
    some = op.finished_runs(marks_of(spark, data[:cut])).drop("before_seq")
    found = op.finished_runs(marks_of(spark, data[cut // 2:]), some)
    want, numbers = [], {}
    for p, seq, offset, at in data:
        numbers.setdefault(p, {}).setdefault(seq, []).append((offset, at))
    for p, known in numbers.items():
        last = None
        for seq in sorted(n for n in known if n >= 0):
            offset, at = max(o for o, _ in known[seq]), min(a for _, a in known[seq])
            if last is not None and last[2] == seq - 1:
                last[2:] = [seq, max(last[3], offset), min(last[4], at), last[5]]
            else:
                before = last[2] if last else None
                last = [p, seq, seq, offset, at, before]
                want.append(last)
    columns = ["partition", "first_seq", "last_seq", "top_offset", F.unix_seconds("oldest_at") - int(EPOCH.timestamp()), "before_seq"]
    assert rows(found.select(*columns)) == sorted(map(tuple, want), key=repr)


def test_millions_of_marks_behind_a_gap_are_one_row(spark):
    source, root, checkpoint = (work_dir(spark, n) for n in ("in", "root", "cp"))
    waiting = spark.range(1, 3_000_001).select(
        F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.col("id").alias("seq"), F.col("id").alias("offset"),
        F.timestamp_seconds(F.lit(0)).alias("processed_at"),
    )
    for part in (waiting.filter("seq <= 1500000"), waiting.filter("seq > 1500000"), marks_of(spark, [(0, 0, 0, 1)])):
        part.write.mode("append").parquet(source)
        stream = spark.readStream.schema(MARK_SCHEMA).parquet(source)
        finish(commits.track_commits(stream, root, checkpoint, trigger=AVAILABLE_NOW))
        state = commits.read_pending(spark, root)
        assert state.count() <= 1
        assert state.agg(F.sum(F.col("last_seq") - F.col("first_seq") + 1)).first()[0] in (1_500_000, 3_000_000, None)
    assert rows(commits.read_committed_positions(spark, root).select("committed_seq", "position")) == [(3_000_000, 3_000_001)]


def test_a_stream_may_stop_where_too_many_marks_wait(spark):
    waiting = [(0, s, 100 + s, s) for s in range(1, 9)]
    source, root, checkpoint = (work_dir(spark, n) for n in ("marks", "root", "cp"))
    marks_of(spark, waiting).write.parquet(source)
    stream = spark.readStream.schema(MARK_SCHEMA).parquet(source)
    start = lambda **options: finish(
        commits.track_commits(stream, root, checkpoint, trigger={"availableNow": True}, **options)
    )
    with pytest.raises(Exception, match="8 marks wait, 5 are allowed"):
        start(pending_limit=4, stop_on_overflow=True)
    assert batches.last_batch(spark, root) is None
    start(pending_limit=7, stop_on_overflow=True)
    assert commits.read_overflow(spark, root).count() == 0
    marks_of(spark, [(0, 0, 100, 9)]).write.mode("append").parquet(source)
    start(pending_limit=7, stop_on_overflow=True)
    assert rows(commits.read_committed_positions(spark, root).select("committed_seq", "position")) == [(8, 109)]
