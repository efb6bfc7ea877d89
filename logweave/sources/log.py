"""Reading a partitioned log, from files or from a broker, in batch or as a stream."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from logweave.schemas import LOG_SCHEMA


def broker_options(
    servers: str,
    topic: str,
    partitions: list[int] | None = None,
    bounded: bool = False,
    committed_only: bool = False,
    max_offsets: int | None = None,
    group: str | None = None,
) -> dict[str, str]:
    """Options of Spark's log connector for the same choices ``read_log`` takes on files.

    Reading always begins at the earliest offset; a stream's checkpoint says where to go on.
    """
    options = {"kafka.bootstrap.servers": servers, "startingOffsets": "earliest"}
    if partitions is None:
        options["subscribe"] = topic
    else:
        options["assign"] = json.dumps({topic: sorted(partitions)})
    if bounded:
        options["endingOffsets"] = "latest"
    if committed_only:
        options["kafka.isolation.level"] = "read_committed"
    if max_offsets is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    if group is not None:
        options["kafka.group.id"] = group
    return options


def read_log(
    spark: SparkSession,
    source: str | dict[str, str],
    streaming: bool = False,
    topic: str | None = None,
    partitions: list[int] | None = None,
    max_files: int | None = None,
    max_bytes: str | None = None,
    schema: T.StructType = LOG_SCHEMA,
) -> DataFrame:
    """A log as a DataFrame.

    ``source`` is a directory written by ``write_log``, or connector options. On files a topic or a
    partition choice prunes directories; without one, a stream picks up partitions that appear later.
    ``max_files`` / ``max_bytes`` bound the intake of one micro-batch. A batch read ends at the data
    present now; a stream with the ``availableNow`` trigger does the same.
    """
    if isinstance(source, dict):
        reader = spark.readStream if streaming else spark.read
        log = reader.format("kafka").option("includeHeaders", "true").options(**source).load()
        return log.select(*LOG_SCHEMA.fieldNames())
    if streaming:
        reader = spark.readStream.schema(schema)
        if max_files is not None:
            reader = reader.option("maxFilesPerTrigger", max_files)
        if max_bytes is not None:
            reader = reader.option("maxBytesPerTrigger", max_bytes)
    else:
        reader = spark.read.schema(schema)
    log = reader.parquet(source)
    if topic is not None:
        log = log.filter(F.col("topic") == topic)
    if partitions is not None:
        log = log.filter(F.col("partition").isin(sorted(partitions)))
    # end-of-partition notices carry no offset and are no messages
    return log.filter(F.col("offset").isNotNull()).select(*schema.fieldNames())
