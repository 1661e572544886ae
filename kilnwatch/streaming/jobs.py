"""The streaming job: land readings once, then three independent queries on them.

Each query has its own checkpoint and fails on its own. A landed reading is flattened
exactly once, whatever reads it afterwards.
"""

from __future__ import annotations

import time

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from kilnwatch.operators.flatten import POISON, flatten_batches, flatten_with_poison
from kilnwatch.options import JobOptions
from kilnwatch.schemas import READING
from kilnwatch.sinks.alerts import alert_topic
from kilnwatch.sinks.documents import merge, new_run, run_of, upsert
from kilnwatch.sinks.storage import PARTITIONS, partitioned_rows
from kilnwatch.session import STATE_STORE_PROVIDER
from kilnwatch.sources.messages import (
    count_messages,
    parse_messages,
    read_topic,
    valid_batches,
    with_poison,
)
from kilnwatch.streaming.dedup import HOUR_MS, first_copies_with_ttl, first_copies_within_watermark
from kilnwatch.streaming.monitor import monitor

INGESTED_AT = "ingested_at"


def readings_of(messages: DataFrame) -> DataFrame:
    """Messages (``value, arrival_seq``) to readings; works on streams and batches."""
    return flatten_batches(valid_batches(parse_messages(messages)))


def to_files(rows: DataFrame, path: str, *partitions: str) -> DataStreamWriter:
    """K1/K7: files committed once per micro-batch through the sink's own log."""
    writer = rows.writeStream.format("parquet").option("compression", "snappy")
    if partitions:
        writer = writer.partitionBy(*partitions)
    return writer.option("path", path).outputMode("append")


def to_documents(
    readings: DataFrame, path: str, run: str | None = None, merge_every: int | None = None
) -> DataStreamWriter:
    """K2/K3: each micro-batch becomes one epoch of the latest-document table.

    ``run`` names the life of the checkpoint (``run_of``). Without it each start is a run of
    its own, which repeats what a restart replays but never replaces another run's epochs.
    ``merge_every`` has the stream merge the table's batches after every so many of its own.
    """
    run = run or new_run()

    def apply(batch: DataFrame, epoch: int) -> None:
        batch.persist()
        try:
            upsert(batch, path, epoch, run)
        finally:
            batch.unpersist()
        if merge_every and epoch % merge_every == merge_every - 1:
            merge(batch.sparkSession, path)

    return readings.writeStream.foreachBatch(apply)


LANDED = T.StructType([*READING, T.StructField(INGESTED_AT, T.TimestampType())])
KIND, A_READING, A_POISON = "kind", "reading", "poison"
_LANDING = T.StructType([*LANDED, T.StructField(POISON, T.StringType()), T.StructField(KIND, T.StringType())])


def to_landing(messages: DataFrame, path: str, retention: str | None = None) -> DataStreamWriter:
    """One parse per message lands its readings, or its text if it is poison, exactly once.

    Spark's file sink publishes the files of a micro-batch by one entry in its log; readers of the
    folder take what the log names. What a crash leaves behind is in no entry, and a repeated
    micro-batch is written anew under other names. Readings carry the time they were taken in.
    ``retention`` ("7d") has the log forget older files; it must cover the slowest reader's lag.
    Counts of received, valid and skipped messages appear in the query's progress.
    """
    parsed = with_poison(count_messages(parse_messages(messages)))
    rows = flatten_with_poison(parsed).withColumns(
        {
            INGESTED_AT: F.current_timestamp(),
            KIND: F.when(F.col(POISON).isNull(), F.lit(A_READING)).otherwise(F.lit(A_POISON)),
        }
    )
    writer = to_files(rows.select(*_LANDING.names), path, KIND)
    return writer.option("retention", retention) if retention else writer


def landed_readings(
    spark: SparkSession, path: str, max_files: int | None = None
) -> DataFrame:
    """The landed readings as a stream; ``max_files`` bounds what one micro-batch takes in."""
    reader = spark.readStream.schema(_LANDING)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path).where(F.col(KIND) == A_READING).select(*LANDED.names)


def landed_poison(spark: SparkSession, path: str) -> DataFrame:
    """A3: the quarantine: texts that could not be read, with the order and time of their arrival."""
    rows = spark.read.schema(_LANDING).parquet(path).where(F.col(KIND) == A_POISON)
    return rows.select("arrival_seq", INGESTED_AT, POISON)


def await_landing(spark: SparkSession, landing: StreamingQuery, path: str) -> None:
    """Wait for the first entry in the landing's log, without which a reader would list the folder instead."""
    while not _has_log(spark, path):
        if not landing.isActive:
            raise landing.exception() or RuntimeError("the landing query ended before it landed anything")
        time.sleep(1)


def _has_log(spark: SparkSession, path: str) -> bool:
    try:
        return not spark.read.text(f"{path}/_spark_metadata").isEmpty()
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return False


def stored_once(landed: DataFrame, options: JobOptions) -> DataFrame:
    """The landed readings without repeated copies, ready for the storage sink.

    Rows are brought together by storage partition, each spread over a few tasks: that
    bounds the number of files, and no device ends up in a single task.
    """
    ttl_ms = options.dedup_ttl_hours * HOUR_MS
    if options.exact_dedup:
        kept = first_copies_with_ttl(landed, ttl_ms)
    else:
        kept = first_copies_within_watermark(landed, INGESTED_AT, ttl_ms)
    share = F.pmod(F.xxhash64("sensorId", "measuredAt"), F.lit(options.files_per_partition))
    rows = partitioned_rows(kept).withColumn("_share", share)
    return rows.repartition(*PARTITIONS, "_share").drop("_share")


def start(writer: DataStreamWriter, options: JobOptions, name: str) -> StreamingQuery:
    """K7: start with a checkpoint of its own and the configured interval."""
    return (
        writer.queryName(name)
        .option("checkpointLocation", f"{options.checkpoint_dir.rstrip('/')}/{name}")
        .trigger(processingTime=f"{options.checkpoint_interval_ms} milliseconds")
        .start()
    )


def run(spark: SparkSession, options: JobOptions) -> dict[str, StreamingQuery]:
    """Start the whole job against the topics named in ``options``.

    The branches start once the landing has committed its first micro-batch.
    """
    missing = [
        name
        for name in ("source_topic", "output_path", "violations_topic", "checkpoint_dir")
        if not getattr(options, name)
    ]
    if missing:
        raise ValueError(f"the job needs {', '.join(missing)}")
    if spark.conf.get("spark.sql.streaming.stateStore.providerClass") != STATE_STORE_PROVIDER:
        raise ValueError(f"the job's state needs {STATE_STORE_PROVIDER}")
    base = options.output_path.rstrip("/")
    landing = f"{base}/_landing"
    checkpoints = options.checkpoint_dir.rstrip("/")
    arriving = to_landing(read_topic(spark, options), landing, options.landing_retention)
    queries = {"landing": start(arriving, options, "landing")}
    await_landing(spark, queries["landing"], landing)

    def landed() -> DataFrame:
        return landed_readings(spark, landing, options.max_landed_files)

    branches = {
        "storage": to_files(
            stored_once(landed(), options),
            f"{base}/readings",
            *PARTITIONS,
        ),
        "documents": to_documents(
            landed(), f"{base}/{options.index}", run_of(spark, f"{checkpoints}/documents"), options.merge_every
        ),
        "alerts": alert_topic(monitor(landed(), options.rules), options),
    }
    return queries | {name: start(writer, options, name) for name, writer in branches.items()}
