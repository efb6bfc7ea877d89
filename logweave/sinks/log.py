"""Writing a log, with one of four delivery profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql.streaming import StreamingQuery

from logweave.schemas import LOG_SCHEMA, PARTITION_KEYS

# Client settings of the delivery profiles.
PROFILES = {
    "reliable": {
        "acks": "all", "enable.idempotence": "true", "linger.ms": "50", "batch.size": "32768",
        "retries": "3", "retry.backoff.ms": "100",
    },
    "fire_forget": {
        "acks": "0", "enable.idempotence": "false", "linger.ms": "5", "batch.size": "65536",
        "compression.type": "snappy",
    },
    "idempotent": {
        "acks": "all", "enable.idempotence": "true", "linger.ms": "5", "batch.size": "32768",
        "max.in.flight.requests.per.connection": "5", "retries": "5", "retry.backoff.ms": "100",
    },
    "leader": {"acks": "1"},
}


def sink_options(profile: str, servers: str, topic: str | None = None) -> dict[str, str]:
    """Connector options of a profile."""
    options = {f"kafka.{name}": value for name, value in PROFILES[profile].items()}
    options["kafka.bootstrap.servers"] = servers
    if topic is not None:
        options["topic"] = topic
    return options


def write_log(
    df: DataFrame,
    sink: str | dict[str, str],
    profile: str = "reliable",
    partitioner: Column | None = None,
    checkpoint: str | None = None,
    trigger: dict | None = None,
) -> StreamingQuery | None:
    """Append log rows to a directory, or to a broker given connector options.

    Files are laid out by topic and partition, so a reader of some partitions lists only those.
    Every task appends to the partitions it has rows of: no shuffle, and a hot partition is written
    by many tasks. ``partitioner`` replaces the partition column. A streaming ``df`` needs
    ``checkpoint`` and returns the running query.
    """
    if partitioner is not None:
        df = df.withColumn("partition", partitioner)
    if isinstance(sink, dict):
        names = [c for c in ("key", "value", "topic", "partition", "headers") if c in df.columns]
        out = df.select(*names)
        options = {**sink_options(profile, sink["kafka.bootstrap.servers"]), **sink}
        if df.isStreaming:
            return (
                out.writeStream.format("kafka")
                .options(**options)
                .option("checkpointLocation", checkpoint)
                .trigger(**(trigger or {"availableNow": True}))
                .start()
            )
        out.write.format("kafka").options(**options).save()
        return None
    out = df.select(*LOG_SCHEMA.fieldNames())
    codec = PROFILES[profile].get("compression.type", "zstd")
    if df.isStreaming:
        return (
            out.writeStream.format("parquet")
            .option("path", sink)
            .option("compression", codec)
            .option("checkpointLocation", checkpoint)
            .partitionBy(*PARTITION_KEYS)
            .trigger(**(trigger or {"availableNow": True}))
            .start()
        )
    out.write.mode("append").option("compression", codec).partitionBy(*PARTITION_KEYS).parquet(sink)
    return None
