"""First copy of every reading (E1) in batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kilnwatch.functions.keys import dedup_key
from kilnwatch.schemas import ARRIVAL
from kilnwatch.session import written


def first_copies(readings: DataFrame) -> DataFrame:
    """Keep the copy that arrived first per dedup key.

    Spark limits each key to one row before the shuffle as well, so a reading sent very
    often costs one row per task.
    """
    arrival = Window.partitionBy("dedup_key").orderBy(*ARRIVAL)
    return (
        readings.withColumn("dedup_key", dedup_key())
        .withColumn("_copy", F.row_number().over(arrival))
        .filter(F.col("_copy") == 1)
        .drop("_copy", "dedup_key")
    )


def first_copies_with_life(readings: DataFrame, ingested_at: str, ttl_ms: int) -> DataFrame:
    """Keep a key's first copy, and again the first one ``ttl_ms`` or more after the last that was kept.

    Copies are ordered by the time ``ingested_at`` and then arrival. The kept copies of a key
    form a chain: each copy points at the first one a life later, and the chain runs from the
    key's first copy. It is followed by doubling: copies within reach of 1, 2, 4, ... pointers
    are joined with pointers of that length. Nothing is worked through key by key: pointers are
    found in blocks of one life per key, and every join is on key and time, so a key with very
    many copies is spread by time. Keys whose copies all lie within one life, nearly all of
    them, take no part in it.
    """
    if ttl_ms <= 0:
        raise ValueError("the time to live of a key must be positive")
    rows = readings.withColumns({"_key": dedup_key(), "_ms": F.unix_millis(ingested_at)})
    times = written(
        rows.groupBy("_key", "_ms").agg(F.min(F.struct(*ARRIVAL)).alias("_copy")), "copy-times"
    )
    spans = times.groupBy("_key").agg(F.min("_ms").alias("_ms"), F.max("_ms").alias("_last"))
    outlived = F.col("_last") >= F.col("_ms") + F.lit(ttl_ms)
    long_lived = written(spans.where(outlived).select("_key", "_ms"), "long-keys")
    reached = _chains(times.join(long_lived.select("_key"), "_key"), long_lived, ttl_ms)
    kept = spans.where(~outlived).select("_key", "_ms").unionByName(reached)
    # A table of known size, so that readings are not shuffled to find those in a short one.
    copies = written(times.join(kept, ["_key", "_ms"]).select("_key", "_ms", "_copy.*"), "kept-copies")
    found = rows.join(copies, ["_key", "_ms", *ARRIVAL], "left_semi")
    # Equal order numbers leave one copy, as in first_copies.
    place = F.row_number().over(Window.partitionBy("_key", "_ms").orderBy(*ARRIVAL))
    return found.withColumn("_place", place).where("_place = 1").select(*readings.columns)


def _chains(copies: DataFrame, firsts: DataFrame, ttl_ms: int) -> DataFrame:
    """``_key``, ``_ms`` of the copies that the chains from ``firsts`` reach."""
    jumps = written(_pointers(copies, ttl_ms), "copy-jumps")
    reached = [firsts]
    front = firsts
    while True:
        found = written(
            front.join(jumps, ["_key", "_ms"]).select("_key", F.col("_to").alias("_ms")), "copies-reached"
        )
        if found.isEmpty():
            return _union(reached)
        reached.append(found)
        front = _union(reached)
        onwards = jumps.select("_key", F.col("_ms").alias("_to"), F.col("_to").alias("_beyond"))
        jumps = written(
            jumps.join(onwards, ["_key", "_to"]).select("_key", "_ms", F.col("_beyond").alias("_to")), "copy-jumps"
        )


def _union(tables: list[DataFrame]) -> DataFrame:
    every = tables[0]
    for table in tables[1:]:
        every = every.unionByName(table)
    return every


def _pointers(copies: DataFrame, ttl_ms: int) -> DataFrame:
    """From each copy the first one of its key a life later or more, where there is one."""
    nothing = F.lit(None).cast("long")
    own, later = F.col("_ms"), F.col("_ms") + F.lit(ttl_ms)
    # Each copy stands in its own block, and asks in the next one.
    moments = copies.select("_key", "_ms").select(
        "_key",
        F.inline(
            F.array(
                F.struct(own.alias("_at"), own.alias("_copy"), nothing.alias("_asked")),
                F.struct(later.alias("_at"), nothing.alias("_copy"), own.alias("_asked")),
            )
        ),
    )
    moments = moments.withColumn("_block", F.col("_at") - F.pmod("_at", F.lit(ttl_ms)))
    # Backwards, so that the last copy seen is the next one; a copy comes before who asks for its time.
    inside = Window.partitionBy("_key", "_block").orderBy(F.desc("_at"), F.desc_nulls_last("_copy"))
    found = moments.withColumn("_next", F.last("_copy", ignorenulls=True).over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    blocks = moments.groupBy("_key", "_block").agg(F.min("_copy").alias("_first"))
    beyond = Window.partitionBy("_key").orderBy(F.desc("_block")).rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("_key", "_block", F.last("_first", ignorenulls=True).over(beyond).alias("_beyond"))
    return (
        found.where("_asked IS NOT NULL")
        .join(blocks, ["_key", "_block"])
        .select("_key", F.col("_asked").alias("_ms"), F.coalesce("_next", "_beyond").alias("_to"))
        .where("_to IS NOT NULL")
    )
