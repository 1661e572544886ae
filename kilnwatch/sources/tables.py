"""The star-schema and event tables read as sensor readings and as nested batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kilnwatch.functions.time import utc_instant, whole_millis

EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)


def event_rows(spark: SparkSession, sf_dir: str, streaming: bool = False) -> DataFrame:
    # A stream accepts a single file only where the path is a pattern.
    reader, name = (spark.readStream, "event[s]") if streaming else (spark.read, "events")
    return reader.schema(EVENTS).parquet(f"{sf_dir}/{name}.parquet")


def readings_from_events(events: DataFrame, *extra: str) -> DataFrame:
    """An event as the reading of a sensor: type is the sensor, user mod 4 the equipment.

    The sequence is a 32-bit number by contract and takes the lower bits of the event's.
    """
    equipment = F.pmod("user_id", F.lit(4)).cast("bigint")
    measured = whole_millis(utc_instant(F.col("ts")))
    frequent = F.col("event_type").isin("click", "view")
    return events.select(
        F.col("ts").cast("date").cast("string").alias("batch_id"),
        F.concat(F.lit("D"), equipment.cast("string")).alias("device_id"),
        equipment.alias("equipment_id"),
        utc_instant(F.col("ts").cast("date").cast("timestamp_ntz")).alias("created_at"),
        F.lit(1).alias("interval_sec"),
        F.pmod("event_id", F.lit(1 << 31)).cast("int").alias("sequence"),
        measured.alias("measured_at"),
        F.lit("OK").alias("measurement_status"),
        F.col("event_type").alias("sensor_id"),
        F.col("event_type").alias("sensor_type"),
        "value",
        F.when(frequent, F.lit(0.3)).otherwise(F.lit(50.0)).alias("recipe_min"),
        F.when(frequent, F.lit(220.0)).otherwise(F.lit(250.0)).alias("recipe_max"),
        F.lit("C").alias("unit"),
        F.when(F.col("value") < 100, F.lit("OK")).otherwise(F.lit("HOT")).alias("sensor_status"),
        F.col("event_id").alias("arrival_seq"),
        F.lit(0).cast("bigint").alias("element_seq"),
        *extra,
    )


def batches_from_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their line items as nested batches: ``batch, arrival_seq``.

    An order without items is a batch without measurements (NULL, as an absent field).

    A line item number is a measurement, a line item its sensor reading. Both groupings
    and the join share one shuffle by order.
    """
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet").repartition("l_orderkey")
    lines = items.select(
        F.col("l_orderkey").alias("o_orderkey"),
        "l_linenumber",
        F.struct(
            utc_instant(F.col("l_shipdate")).alias("measuredAt"),
            F.col("l_returnflag").alias("status"),
            F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("sensorId"),
            F.col("l_linestatus").alias("sensorType"),
            F.col("l_quantity").alias("value"),
            F.col("l_suppkey").alias("supplier"),
        ).alias("line"),
    )
    measurements = (
        lines.groupBy("o_orderkey", "l_linenumber")
        .agg(F.array_sort(F.collect_list("line")).alias("lines"))
        .select(
            "o_orderkey",
            F.struct(
                F.col("l_linenumber").alias("sequence"),
                F.col("lines")[0]["measuredAt"].alias("measuredAt"),
                F.col("lines")[0]["status"].alias("status"),
                F.transform(
                    "lines",
                    lambda line: F.struct(
                        line["sensorId"].alias("sensorId"),
                        line["sensorType"].alias("sensorType"),
                        line["value"].alias("value"),
                        F.lit(10.0).alias("recipeMin"),
                        F.lit(40.0).alias("recipeMax"),
                        F.lit("pcs").alias("unit"),
                        F.lit("OK").alias("status"),
                    ),
                ).alias("sensors"),
            ).alias("measurement"),
        )
        .groupBy("o_orderkey")
        .agg(F.array_sort(F.collect_list("measurement")).alias("measurements"))
    )
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        "o_orderkey",
        F.concat(F.lit("B"), F.col("o_orderkey").cast("string")).alias("batchId"),
        F.col("o_orderpriority").alias("deviceId"),
        F.col("o_custkey").alias("id"),
        utc_instant(F.col("o_orderdate")).alias("createdAt"),
        F.lit(60).alias("intervalSec"),
    )
    return orders.join(measurements, "o_orderkey", "left").select(
        F.struct(
            "batchId", "deviceId", "id", "createdAt", "intervalSec", "measurements"
        ).alias("batch"),
        F.col("o_orderkey").alias("arrival_seq"),
    )
