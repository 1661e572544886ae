"""The latest document per id (the reduction of K2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kilnwatch.operators.projections import documents
from kilnwatch.schemas import ARRIVAL


def last_per_id(rows: DataFrame, *order: str, within: tuple[str, ...] = ()) -> DataFrame:
    """The whole row that came last per ``document_id``; limited before the shuffle too.

    Columns the id determines may be named in ``within``: filters on them then reach the scan.
    """
    newest_first = Window.partitionBy(*within, "document_id").orderBy(*[F.col(c).desc() for c in order])
    return (
        rows.withColumn("_age", F.row_number().over(newest_first))
        .filter(F.col("_age") == 1)
        .drop("_age")
    )


def latest_documents(readings: DataFrame) -> DataFrame:
    """Readings as documents where a later reading of the same id replaces the earlier."""
    return last_per_id(documents(readings, *ARRIVAL), *ARRIVAL).drop(*ARRIVAL)
