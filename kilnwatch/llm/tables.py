"""Shared helpers: the given tables, Arrow batches in bounded pieces, and written intermediate tables."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

import kilnwatch
from kilnwatch.session import shared_folder

#: Bytes of text that a task works on at once; what it derives from them takes many times that.
PIECE = 2 << 20
#: The bytes that separate words.
SPACES = b" \t\n\r\x0b\x0c"


def shipped(spark: SparkSession) -> SparkSession:
    """The session, with this package sent to its executors once."""
    context = spark.sparkContext
    if not any("kilnwatch-" in name for name in context._python_includes):
        top = Path(kilnwatch.__file__).parent
        target = Path(tempfile.mkdtemp()) / f"kilnwatch-{context.applicationId}.zip"
        with zipfile.ZipFile(target, "w") as archive:
            for part in sorted(top.rglob("*.py")):
                archive.write(part, part.relative_to(top.parent))
        context.addPyFile(str(target))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return shipped(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def written(rows: DataFrame, label: str) -> DataFrame:
    """``rows`` as a table in the shared folder, which cuts the lineage and survives lost executors."""
    path = shared_folder(rows.sparkSession, label)
    rows.write.option("compression", "zstd").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def pieces(batch: pa.RecordBatch, column: str, most: int = PIECE) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts hold about ``most`` bytes; one longer text is a slice by itself."""
    texts = batch.column(column)
    start = size = 0
    for row, length in enumerate(pc.binary_length(texts).to_pylist()):
        if size and size + (length or 0) > most:
            yield batch.slice(start, row - start)
            start, size = row, 0
        size += length or 0
    if start < batch.num_rows:
        yield batch.slice(start)


def as_bytes(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """The texts of a batch in UTF-8; null is empty."""
    texts = batch.column(column)
    kind = pa.large_binary() if pa.types.is_large_string(texts.type) else pa.binary()
    return [text or b"" for text in texts.cast(kind).to_pylist()]


def map_texts(
    rows: DataFrame,
    column: str,
    schema: str,
    work: Callable[[pa.RecordBatch, list[bytes]], dict[str, object] | None],
    most: int = PIECE,
) -> DataFrame:
    """Run ``work`` on slices of bounded size; it returns the columns of ``schema`` or None."""
    spark = rows.sparkSession
    fields = _arrow_schema(spark, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, column, most):
                out = work(piece, as_bytes(piece, column))
                if out is not None:
                    yield pa.RecordBatch.from_arrays(
                        [_array(out[f.name], f.type) for f in fields], schema=fields
                    )

    return rows.mapInArrow(run, schema)


def filter_texts(rows: DataFrame, column: str, keep: Callable[[list[bytes]], list[bool]]) -> DataFrame:
    """The rows whose texts ``keep`` accepts, with all their columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, column):
                yield piece.filter(pa.array(keep(as_bytes(piece, column)), pa.bool_()))

    return rows.mapInArrow(run, rows.schema)


def _array(values, kind: pa.DataType) -> pa.Array:
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    return values.cast(kind) if isinstance(values, pa.Array) else pa.array(values, kind)


def _arrow_schema(spark: SparkSession, schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(schema))


def whole_groups(
    batches: Iterator[pa.RecordBatch], keys: list[str], rows: int = 1 << 14
) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of complete groups from a partition sorted by integer keys, with the groups' first rows and the end.

    A table holds about ``rows`` rows, or one group if that is larger.
    """
    held: list[pa.RecordBatch] = []
    count = 0

    def cut(table: pa.Table) -> np.ndarray:
        columns = [table.column(key).to_numpy() for key in keys]
        change = np.zeros(max(0, table.num_rows - 1), bool)
        for column in columns:
            change |= column[1:] != column[:-1]
        return np.concatenate([[0], np.flatnonzero(change) + 1, [table.num_rows]])

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        count += batch.num_rows
        if count < rows:
            continue
        table = pa.Table.from_batches(held)
        edges = cut(table)
        if len(edges) > 2:
            yield table.slice(0, edges[-2]), edges[:-1]
        rest = table.slice(edges[-2])
        held, count = rest.to_batches(), rest.num_rows
        rows = max(rows, 2 * count)
    if held:
        table = pa.Table.from_batches(held)
        yield table, cut(table)
