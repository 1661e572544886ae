"""Alerts as JSON values for a topic or text files (K5)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter

from kilnwatch.operators.envelope import envelope_json
from kilnwatch.options import JobOptions


def alert_topic(alerts: DataFrame, options: JobOptions = JobOptions()) -> DataStreamWriter:
    """A stream writer to the violations topic: values only, at least once."""
    return (
        envelope_json(alerts)
        .writeStream.format("kafka")
        .option("kafka.bootstrap.servers", options.bootstrap_servers)
        .option("topic", options.violations_topic)
    )


def alert_files(alerts: DataFrame, path: str) -> DataStreamWriter:
    """The same values as JSON lines in text files."""
    return envelope_json(alerts).writeStream.format("text").option("path", path)


def write_alert_files(alerts: DataFrame, path: str, mode: str = "append") -> None:
    envelope_json(alerts).write.mode(mode).text(path)
