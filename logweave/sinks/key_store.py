"""Ids of earlier batches, kept so that looking some up costs by their number and not by the history.

Every batch adds one *run* of new ids. ``FANOUT`` runs of a generation are merged into one of the next, so
there are few runs however many batches came. A run is cut into 2 ** bits buckets by the first bits of the
id's hash, as many as keep a bucket near 2 ** ``BUCKET_BITS`` ids, and each file has a Bloom filter. Few ids
therefore open only the buckets they hash into, and of these only files that may hold them.

Layout below a root: ``keys/run=R/bucket=B/`` holds ids, ``runs/batch_id=N/`` the list of runs after a batch.
Runs that were merged stay until no kept list names them, so a batch that is run again finds its input.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F, types as T

from logweave.session import drop_table, small_side
from logweave.sinks import batches
from logweave.sinks.batches import read_one_batch, stage_batch

FANOUT = 8
BUCKET_BITS = 20
# Ids that are looked up by their buckets; more would open most of them anyway and are joined.
FEW_IDS = 1_000

ID_SCHEMA = T.StructType([T.StructField("id", T.StringType()), T.StructField("seen_at", T.TimestampType())])
RUNS_SCHEMA = T.StructType(
    [
        T.StructField("run", T.StringType()),
        T.StructField("generation", T.IntegerType()),
        T.StructField("rows", T.LongType()),
        T.StructField("bits", T.IntegerType()),
        T.StructField("buckets", T.ArrayType(T.IntegerType())),
        T.StructField("newest_us", T.LongType()),
        T.StructField("retired", T.LongType()),
    ]
)


def read_runs(spark: SparkSession, root: str, batch_id: int | None) -> list[Row]:
    """Runs after a batch; none for ``None``. A few rows for each generation."""
    return read_one_batch(spark, root, RUNS_SCHEMA, batch_id, "runs").collect()


def all_ids(spark: SparkSession, root: str, runs: list[Row]) -> DataFrame:
    """``id, seen_at`` of all runs that are not merged into others."""
    return _read(spark, root, [_path(root, r["run"]) for r in _live(runs)])


def known_ids(
    spark: SparkSession, root: str, runs: list[Row], ids: DataFrame, since: Column | None = None
) -> DataFrame:
    """Those of ``ids`` (column ``id``, evaluated twice) that the runs hold; ``since`` passes over older ones."""
    fresh = F.lit(True) if since is None else F.col("seen_at") >= since
    asked = ids.select("id", F.xxhash64("id").alias("hash")).limit(FEW_IDS + 1).collect()
    if len(asked) > FEW_IDS:
        # filtered where it is read, instead of shuffled, if the batch is small enough for that
        held = all_ids(spark, root, runs).filter(fresh).select("id")
        return held.join(small_side(ids.select("id")), "id", "left_semi").distinct()
    held = _read(spark, root, buckets_to_open(root, runs, [row["hash"] for row in asked]))
    with _pushed_down(spark):
        found = held.filter(fresh & F.col("id").isin([row["id"] for row in asked])).select("id").distinct().collect()
    return spark.createDataFrame(found, held.select("id").schema)


def buckets_to_open(root: str, runs: list[Row], hashes: list[int]) -> list[str]:
    """Directories that can hold ids of these hashes."""
    paths = []
    for run in _live(runs):
        wanted = {(h % 2**64) >> (64 - run["bits"]) for h in hashes}
        paths += [f"{_path(root, run['run'])}/bucket={b}" for b in sorted(wanted & set(run["buckets"]))]
    return paths


def add_ids(
    spark: SparkSession,
    root: str,
    batch_id: int,
    runs: list[Row],
    ids: DataFrame,
    newest_us: int | None = None,
    since_us: int | None = None,
) -> None:
    """Stage a batch: ``runs`` of the batch before it and one more with ``ids``, which are new and distinct.

    ``ids`` are evaluated twice, so they should be read from a table. With ``since_us`` ids seen before that
    moment are left out of merges, and a run whose ``newest_us`` is below it goes as a whole.
    """
    rows, runs = ids.count(), [r.asDict() for r in runs]
    if rows:
        runs.append(_write_run(ids, root, f"{batch_id}-0", 0, rows, newest_us))
    generation = 0
    while len(same := [r for r in _live(runs) if r["generation"] == generation]) >= FANOUT:
        merged = _read(spark, root, [_path(root, r["run"]) for r in same])
        if since_us is not None:
            merged = merged.filter(F.col("seen_at") >= F.timestamp_micros(F.lit(since_us)))
        generation += 1
        newest = max((r["newest_us"] for r in same if r["newest_us"] is not None), default=None)
        total = sum(r["rows"] for r in same)
        runs.append(_write_run(merged, root, f"{batch_id}-{generation}", generation, total, newest))
        for r in same:
            r["retired"] = batch_id
    for r in _live(runs):
        if since_us is not None and r["newest_us"] is not None and r["newest_us"] < since_us:
            r["retired"] = batch_id
    # lists before this one are gone, and with them the last readers of what was retired then
    forgotten = batch_id - batches.KEPT_STATES
    for r in [r for r in runs if r["retired"] is not None and r["retired"] <= forgotten]:
        drop_table(spark, _path(root, r["run"]))
        runs.remove(r)
    drop_table(spark, f"{root}/runs/batch_id={forgotten}")
    listed = spark.createDataFrame([tuple(r[c] for c in RUNS_SCHEMA.fieldNames()) for r in runs], RUNS_SCHEMA)
    stage_batch(listed.coalesce(1), root, batch_id, "runs")


def _live(runs: list) -> list:
    return [r for r in runs if r["retired"] is None]


def _path(root: str, run: str) -> str:
    return f"{root}/keys/run={run}"


def _read(spark: SparkSession, root: str, paths: list[str]) -> DataFrame:
    if not paths:
        return spark.createDataFrame([], ID_SCHEMA)
    found = spark.read.schema(ID_SCHEMA).option("basePath", f"{root}/keys").parquet(*paths)
    return found.select(*ID_SCHEMA.fieldNames())


def _write_run(ids: DataFrame, root: str, run: str, generation: int, rows: int, newest_us: int | None) -> dict:
    bits = max(0, (rows - 1).bit_length() - BUCKET_BITS)
    bucket = F.shiftrightunsigned(F.xxhash64("id"), 64 - bits).cast("int") if bits else F.lit(0)
    seen = F.col("seen_at") if "seen_at" in ids.columns else F.lit(None).cast("timestamp")
    (
        ids.select("id", seen.alias("seen_at"), bucket.alias("bucket"))
        .repartition(1 << bits, "bucket")
        .sortWithinPartitions("bucket", "id")
        .write.mode("overwrite")
        .option("parquet.bloom.filter.enabled#id", "true")
        .option("parquet.bloom.filter.expected.ndv#id", str(min(rows, 1 << BUCKET_BITS)))
        .partitionBy("bucket")
        .parquet(_path(root, run))
    )
    buckets = [0]
    if bits:
        written = ids.sparkSession.read.parquet(_path(root, run))
        buckets = sorted(r["bucket"] for r in written.select("bucket").distinct().collect())
    return {
        "run": run, "generation": generation, "rows": rows, "bits": bits, "buckets": buckets,
        "newest_us": newest_us, "retired": None,
    }


@contextmanager
def _pushed_down(spark: SparkSession) -> Iterator[None]:
    """Lists of ids reach the files' Bloom filters inside the block, whatever their length."""
    name = "spark.sql.parquet.pushdown.inFilterThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, FEW_IDS)
    try:
        yield
    finally:
        spark.conf.set(name, before)
