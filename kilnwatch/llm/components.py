"""Connected components by alternating stars over a table of links; nothing is gathered on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kilnwatch.llm.tables import written


def _round(links: DataFrame) -> DataFrame:
    """One large star and one small star: every node moves its larger, then its smaller neighbours to the least one."""
    both = links.union(links.select("v", "u"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    large = large.where("u <> v").distinct()
    # Each link points from the larger to the smaller end now.
    down = large.groupBy("u").agg(F.min("v").alias("m"))
    small = large.join(down, "u")
    return (
        small.select(F.col("v").alias("u"), F.col("m").alias("v"))
        .where("u <> v")
        .union(down.select("u", F.col("m").alias("v")))
        .distinct()
    )


def components(links: DataFrame, label: str = "components") -> DataFrame:
    """``node`` and ``component``, the least node that links (u, v) connect it with; nodes without links are left out.

    Rounds go on until the links are stars; their number grows with the logarithm of the largest component.
    """
    ends = F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    now = written(links.where("u <> v").select(*ends).distinct(), label)
    state = None
    while True:
        found = now.agg(
            F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.count_distinct("u")
        ).first()
        if tuple(found) == state:
            break
        state = tuple(found)
        if not state[0]:
            break
        now = written(_round(now), label)
    # In a star each node but the centre has one link, to the centre.
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
