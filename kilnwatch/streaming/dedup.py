"""First copy of every reading on a stream."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from kilnwatch.functions.keys import dedup_key
from kilnwatch.schemas import READING

HOUR_MS = 3_600_000


def _positive(ttl_ms: int | None) -> int:
    if ttl_ms is None or ttl_ms <= 0:
        raise ValueError("the time to live of the dedup state must be positive")
    return ttl_ms


class FirstCopy(StatefulProcessor):
    """Passes the first copy of a key and stays silent until its mark expires.

    Only a passed copy writes the mark, so later copies do not prolong it.
    """

    def __init__(self, ttl_ms: int) -> None:
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "seen boolean", self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[Row], timer_values) -> Iterator[Row]:
        first = min(rows, key=lambda row: (row.arrival_seq, row.element_seq))
        if not self.seen.exists():
            self.seen.update((True,))
            yield Row(**{name: first[name] for name in READING.fieldNames()})

    def close(self) -> None:
        pass


def first_copies_with_ttl(readings: DataFrame, ttl_ms: int = 6 * HOUR_MS) -> DataFrame:
    """E1 exactly: state per key with a processing-time life.

    Needs the RocksDB state store. Such a query runs until it is stopped; it does not
    finish under an available-now trigger.
    """
    return (
        readings.select(*READING.fieldNames(), dedup_key().alias("dedup_key"))
        .groupBy("dedup_key")
        .transformWithState(
            statefulProcessor=FirstCopy(_positive(ttl_ms)),
            outputStructType=READING,
            outputMode="Append",
            timeMode="ProcessingTime",
        )
    )


def first_copies_within_watermark(
    readings: DataFrame, ingested_at: str, ttl_ms: int = 6 * HOUR_MS
) -> DataFrame:
    """E1 inside the JVM: the life of a key runs on the time of ingestion instead.

    A key is held for at least ``ttl_ms`` after its first copy and at most twice that.
    """
    return (
        readings.withWatermark(ingested_at, f"{_positive(ttl_ms)} milliseconds")
        .withColumn("dedup_key", dedup_key())
        .dropDuplicatesWithinWatermark(["dedup_key"])
        .select(*[F.col(name) for name in READING.fieldNames()])
    )
