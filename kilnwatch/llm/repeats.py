"""What the two operators on repeated strings share: candidates by anchors, exact judgement by group, spans by document.

1. Texts are packed and dealt out once, by a hash of id and text, so that the rows of one id, or without one, spread;
   equal rows become one with a number of copies. The dealt table is kept by Spark (it is recomputed if an executor is
   lost), so that later joins by row move no text.
2. Anchors of all windows are counted; those that occur once are dropped. Both steps work on narrow rows, with partial
   counts before the shuffle.
3. The windows around a repeated anchor, its context, are cut out and grouped by the anchor's hash. Equal contexts are
   merged before and after the shuffle. Groups of more than ``HOT`` different contexts are dealt anew by single windows.
4. Each group is judged exactly by the operator's own method, and the verdict of each context goes back to its
   documents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kilnwatch.llm.tables import PIECE, _arrow_schema, as_bytes, whole_groups, written
from kilnwatch.llm.winnow import anchors

#: Different contexts of one anchor that one task compares.
HOT = 1 << 15
#: Packed bytes of one part of the dealt table.
PART_BYTES = 24 << 20

#: ``place`` holds further bits of the row's hash, the first window and the number of further ones: 24, 31 and 8 bits.
ANCHORS = "row bigint, place bigint, h bigint"
#: An occurrence (row, key, part, first) of a context with the row's copies, or the context itself with how often the
#: task met it and the least id.
CONTEXTS = "h bigint, c bigint, row bigint, key bigint, part int, first int, context binary, n bigint, least bigint"
WINDOWS = "row bigint, key bigint, part int, first int, n bigint, h bigint, context binary"
#: Different contexts that a task holds before it hands them on.
COMBINED = 1 << 15



@dataclass(frozen=True)
class Unit:
    """What a text is made of: bytes or words."""

    #: Units of a window and grams of a window.
    length: int
    width: int
    #: Texts to gram hashes and the end of each text, in units.
    grams: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]]
    #: Whether only other documents count as another place.
    across: bool
    #: A text to its units, which can be sliced and joined to a context.
    units: Callable[[bytes], object]
    join: Callable[[object], bytes]


def dealt(docs: DataFrame) -> DataFrame:
    """row, part, key, size, packed, copies: the texts under zstandard; ``row`` and ``part`` are hashes of id and text.

    The key is the id, null where there is none.
    """
    spark = docs.sparkSession
    names = "row bigint, part int, key bigint, size bigint, packed binary"
    schema = _arrow_schema(spark, names)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            texts = as_bytes(batch, "text")
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in ("row", "part", "key")),
                    pa.array([len(t) for t in texts], pa.int64()),
                    pa.array([packer.compress(t) for t in texts], pa.binary()),
                ],
                schema=schema,
            )

    # Hashes pass over nulls.
    key = F.coalesce("doc_id", F.lit(0)), F.col("doc_id").isNull()
    keyed = docs.select(
        F.xxhash64(*key, "text").alias("row"),
        F.xxhash64("text", *key).bitwiseAND((1 << 24) - 1).cast("int").alias("part"),
        F.col("doc_id").alias("key"),
        "text",
    )
    size = keyed.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), size // 2 // PART_BYTES + 1)
    # The windows work within the parts that are dealt already. A null text counts as an empty one of another row.
    same = Window.partitionBy("row", "part", "key")
    return (
        keyed.mapInArrow(pack, names)
        .repartition(parts, "row")
        .withColumn("copies", F.count("*").over(same))
        .withColumn("place", F.row_number().over(same.orderBy("size")))
        .where("place = 1")
        .drop("place")
        .persist(StorageLevel.MEMORY_AND_DISK)
    )


def unpacked(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[tuple[list, list[int], list[bytes]]]:
    """Rows of the dealt table in pieces of bounded text: the key and columns, the part, the texts."""
    opener = zstandard.ZstdDecompressor()
    rows, numbers, texts, held = [], [], [], 0
    for batch in batches:
        named = [batch.column(c) for c in ("key", *columns)]
        sizes, packed = batch.column("size").to_pylist(), batch.column("packed")
        parts = batch.column("part").to_pylist()
        for row, size in enumerate(sizes):
            if texts and held + size > PIECE:
                yield rows, numbers, texts
                rows, numbers, texts, held = [], [], [], 0
            rows.append(tuple(c[row].as_py() for c in named))
            numbers.append(parts[row])
            texts.append(opener.decompress(packed[row].as_py()) if size else b"")
            held += size
    if texts:
        yield rows, numbers, texts


def anchor_rows(table: DataFrame, unit: Unit) -> DataFrame:
    """Anchors of each row; those of a row with copies once more without a row, where copies count as another place."""
    schema = _arrow_schema(table.sparkSession, ANCHORS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, numbers, texts in unpacked(batches, ["row", "copies"]):
            grams, ends = unit.grams(texts)
            first, last, hashes = anchors(grams, unit.width, ends, unit.length)
            doc = np.searchsorted(ends, first, side="right")
            begins = np.concatenate([[0], ends])[doc]
            owners = np.array([row for _, row, _ in rows], np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(owners[doc]),
                    pa.array((np.array(numbers)[doc] << 39) | (first - begins) << 8 | (last - first)),
                    pa.array(hashes.view(np.int64)),
                ],
                schema=schema,
            )
            again = np.array([copies > 1 and not unit.across for _, _, copies in rows])[doc]
            if again.any():
                count = int(again.sum())
                empty = [pa.nulls(count, pa.int64())] * 2
                yield pa.RecordBatch.from_arrays([*empty, pa.array(hashes.view(np.int64)[again])], schema=schema)

    return table.mapInArrow(run, ANCHORS)


def contexts(table: DataFrame, unit: Unit) -> DataFrame:
    """Row, first window, h and context of all runs of windows whose anchor occurs more than once."""
    found = anchor_rows(table, unit)
    # Rows of one id are told apart by the verdicts.
    again = F.min("row") < F.max("row") if unit.across else F.count("*") > 1
    # Written, so that the join reads both sides from plain shuffles and Spark can split a hot anchor's rows.
    repeated = written(found.groupBy("h").agg(again.alias("again")).where("again").select("h"), "repeated")
    hits = (
        found.where("row IS NOT NULL")
        .join(repeated, "h")
        .groupBy("row")
        .agg(F.collect_list("place").alias("places"), F.collect_list("h").alias("hashes"))
    )
    schema = _arrow_schema(table.sparkSession, CONTEXTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: dict[tuple[int, bytes], list] = {}
        for rows, numbers, texts in unpacked(batches, ["row", "copies", "places", "hashes"]):
            out: list[tuple] = []
            for (key, row, copies, places, hashes), number, text in zip(rows, numbers, texts, strict=True):
                units = None
                for place, h in zip(places, hashes, strict=True):
                    if place >> 39 != number:
                        continue
                    units = unit.units(text) if units is None else units
                    first = place >> 8 & (1 << 31) - 1
                    cut = unit.join(units[first : first + (place & 0xFF) + unit.length])
                    own = met.get((h, cut))
                    if own is None:
                        own = met[h, cut] = [context_id(cut), 0, None]
                    own[1] += copies
                    if key is not None and (own[2] is None or key < own[2]):
                        own[2] = key
                    out.append((h, own[0], row, key, number, first, None, copies, None))
            if len(met) > COMBINED:
                out += _contexts_met(met)
                met = {}
            if out:
                yield _batch(out, schema)
        if met:
            yield _batch(_contexts_met(met), schema)

    return table.join(hits, "row").mapInArrow(run, CONTEXTS)


def context_id(context: bytes) -> int:
    """A number that equal contexts share; with the anchor's hash it names a context."""
    return int.from_bytes(hashlib.blake2b(context, digest_size=8).digest(), "little", signed=True)


def _contexts_met(met: dict[tuple[int, bytes], list]) -> list[tuple]:
    return [(h, c, None, None, None, None, context, n, least) for (h, context), (c, n, least) in met.items()]


def _single_windows(rows: DataFrame, unit: Unit) -> DataFrame:
    """Occurrences of contexts as their single windows, grouped by the window instead of the anchor."""
    schema = _arrow_schema(rows.sparkSession, WINDOWS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                units = unit.units(row["context"])
                for step in range(len(units) - unit.length + 1):
                    cut = unit.join(units[step : step + unit.length])
                    place = row["row"], row["key"], row["part"], row["first"] + step
                    out.append((*place, row["n"], row["h"], cut))
                if len(out) >= 1 << 14:
                    yield _batch(out, schema)
                    out = []
            if out:
                yield _batch(out, schema)

    single = rows.mapInArrow(run, WINDOWS)
    return single.withColumns({"h": F.xxhash64("h", "context"), "c": F.xxhash64("context", "h")})


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema
    )


Judge = Callable[[list[bytes], list[int], list[int], np.ndarray], list]


def judged(table: DataFrame, unit: Unit, verdict: str, judge: Judge, useful: str = "true") -> DataFrame:
    """row and spans: for each row the verdicts of its contexts, as structs of part, first and verdict.

    ``judge`` gets the different contexts of some groups, how often each occurs, the least id of each (None: no id) and
    the groups' first places; it returns a verdict of SQL type ``verdict``, or None, for each context. ``useful`` says
    of a verdict and a row's key whether it says anything to the row.
    """
    spark = table.sparkSession
    found = written(contexts(table, unit), "contexts")
    places = found.where("context IS NULL").select("row", "key", "part", "first", "n", "h", "c")
    # Tasks have combined equal contexts, so only different ones of each task move. The aggregation works within the
    # parts that the contexts are dealt to by anchor.
    different = found.where("context IS NOT NULL").select("h", "c", "context", "n", "least")
    hot = written(
        different.select("h", "c").distinct().groupBy("h").count().where(F.col("count") > HOT).select("h"), "hot"
    )
    if not hot.isEmpty():
        known = different.join(hot, "h").groupBy("h", "c").agg(F.first("context").alias("context"))
        crowded = places.join(known, ["h", "c"]).select("row", "key", "part", "first", "n", "h", "context")
        single = written(_single_windows(crowded, unit), "windows")
        merged = single.groupBy("h", "c", "context").agg(F.sum("n").alias("n"), F.min("key").alias("least"))
        places = places.join(hot, "h", "left_anti").unionByName(single.drop("context"))
        different = different.join(hot, "h", "left_anti").unionByName(merged)
    groups = (
        different.repartition("h")
        .groupBy("h", "context")
        .agg(F.sum("n").alias("n"), F.min("least").alias("least"), F.first("c").alias("c"))
    )
    output = f"h bigint, c bigint, verdict {verdict}"
    schema = _arrow_schema(spark, output)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, edges in whole_groups(batches, ["h"], 1 << 13):
            verdicts = judge(
                rows.column("context").to_pylist(), rows.column("n").to_pylist(), rows.column("least").to_pylist(), edges
            )
            given = pa.array([v is not None for v in verdicts], pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("h").combine_chunks().filter(given),
                    rows.column("c").combine_chunks().filter(given),
                    pa.array([v for v in verdicts if v is not None], schema.field("verdict").type),
                ],
                schema=schema,
            )

    ordered = groups.sortWithinPartitions("h", "context")
    verdicts = ordered.mapInArrow(run, output)
    return (
        places.select("row", "key", "part", "first", "h", "c")
        .join(verdicts, ["h", "c"])
        .where(useful)
        .groupBy("row")
        .agg(F.collect_list(F.struct("part", "first", "verdict")).alias("spans"))
    )
