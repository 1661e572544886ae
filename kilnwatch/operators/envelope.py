"""The JSON envelope around an alert."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kilnwatch.functions.keys import idempotency_key
from kilnwatch.functions.time import iso_instant
from kilnwatch.operators.projections import PAYLOAD_COLUMNS

# Fixed values of the envelope.
EVENT_TYPE, ENVELOPE_TYPE, AGGREGATE_TYPE = "SensorViolation", "domain", "Equipment"
INSTANTS = ("detected_at", "window_start", "window_end")


def envelopes(alerts: DataFrame, key_scope: str = "event") -> DataFrame:
    """One row per alert with the envelope fields as columns and ``payload`` as a struct.

    The time of detection is required; without it no delivery key exists and the job fails.
    """
    payload = [
        (iso_instant(F.col(column)) if column in INSTANTS else F.col(column)).alias(name)
        for name, column in PAYLOAD_COLUMNS.items()
    ]
    key = F.when(F.col("detected_at").isNotNull(), idempotency_key(key_scope)).otherwise(
        F.raise_error(F.lit("an alert has no time of detection"))
    )
    return alerts.select(
        key.alias("idempotencyKey"),
        F.lit(EVENT_TYPE).alias("eventType"),
        F.lit(ENVELOPE_TYPE).alias("envelopeType"),
        F.lit(AGGREGATE_TYPE).alias("aggregateType"),
        F.coalesce(F.col("equipment_id").cast("string"), F.lit("null")).alias("aggregateId"),
        F.uuid().alias("traceId"),
        iso_instant(F.current_timestamp()).alias("timestamp"),
        F.struct(*payload).alias("payload"),
    )


def envelope_json(alerts: DataFrame, key_scope: str = "event") -> DataFrame:
    """K6: the envelope as one JSON text per alert, with NULL fields written out."""
    rows = envelopes(alerts, key_scope)
    text = F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"})
    return rows.select(text.alias("value"))
