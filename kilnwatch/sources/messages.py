"""Reading JSON batch messages (A1) and parsing them with poison set aside (A2, A3)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kilnwatch import schemas as S
from kilnwatch.functions.time import whole_millis
from kilnwatch.operators.flatten import POISON
from kilnwatch.options import JobOptions

# Strict JSON; the parser marks a row it could not read completely in CORRUPT.
CORRUPT = "_corrupt"
JSON_OPTIONS = {
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": CORRUPT,
    "allowSingleQuotes": "false",
    "allowNonNumericNumbers": "false",
}

# Accepted texts of instants and numbers.
_ISO = (
    r"(?i:\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{1,9})?"
    r"(Z|\+00(:?00)?|[+-]\d{2}:\d{2}(:\d{2})?))"
)
_EPOCH = r"[+-]?\d+(\.\d+)?([eE][+-]?\d+)?"
_WHOLE = r"\s*[+-]?\d+\s*"
_NUMBER = r"\s*([+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|NaN|[+-]?(Infinity|INF))\s*"
ISO_INSTANT, EPOCH_SECONDS, WHOLE_NUMBER, NUMBER = (f"^{form}$" for form in (_ISO, _EPOCH, _WHOLE, _NUMBER))

# Texts of leaves that a cast surely reads, and as the conversions below do.
_DAY = (
    r"(?:(?:0[1-9]|1[0-2])-(?:0[1-9]|1\d|2[0-8])|(?:0[13-9]|1[0-2])-(?:29|30)|(?:0[13578]|1[02])-31)"
)
PLAIN_INSTANT = rf"(?:[1-9]\d{{3}}-{_DAY}T(?:[01]\d|2[0-3]):[0-5]\d:[0-5]\d(?:\.\d{{1,3}}+)?+Z)?+"
PLAIN_WHOLE = r"(?:[+-]?+\d{1,9}+)?+"
PLAIN_NUMBER = r"(?:[+-]?+\d{1,15}+(?:\.\d{1,15}+)?+(?:[eE][+-]?+\d{1,2}+)?+)?+"
# The text that Spark makes of a number beyond a double's range, quotes included.
BEYOND = '"-?Infinity"'
# Texts outside of these are never read; a form's end may stand before a last line break.
READ_INSTANT, READ_WHOLE, READ_NUMBER = (
    rf"({forms}|\s*)\R?" for forms in (f"{_ISO}|{_EPOCH}", f"{_WHOLE}|{_EPOCH}", f"{_NUMBER}|{BEYOND}")
)
# Stands before and behind each leaf where many are looked at together. Strict JSON has it escaped only.
MARK, MARK_ESCAPED = "\x01", r"\u0001"
# How a message's leaves are converted.
UNREAD, PLAIN, BY_LEAF, BEYOND_RANGE = range(4)


#: Partitions that the order of arrival tells apart.
MOST_PARTITIONS = 1 << 12


def topic_arrival() -> Column:
    """One number per message of a topic: offsets count per partition, so the partition settles ties."""
    partition = F.when(F.col("partition") < MOST_PARTITIONS, F.col("partition")).otherwise(
        F.raise_error(F.lit(f"a topic may have at most {MOST_PARTITIONS} partitions"))
    )
    return F.col("offset") * F.lit(MOST_PARTITIONS) + partition


def read_topic(spark: SparkSession, options: JobOptions = JobOptions()) -> DataFrame:
    """A1: the batch topic as a stream of ``value, arrival_seq`` rows.

    Spark assigns its own consumer group unless one is named; offsets live in the
    query's checkpoint.
    """
    topic = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", options.bootstrap_servers)
        .option("subscribe", options.source_topic)
        .option("kafka.group.id", options.group_id)
        .option("startingOffsets", "earliest" if options.start_from_earliest else "latest")
    )
    if options.max_messages_per_trigger:
        topic = topic.option("maxOffsetsPerTrigger", options.max_messages_per_trigger)
    return topic.load().select(
        F.col("value").cast("string").alias("value"), topic_arrival().alias("arrival_seq")
    )


def read_message_files(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    """A1 for files: one JSON message per line.

    Lines carry no offset, so arrival follows the file's modification time and, inside
    it, nothing; give ``arrival_seq`` explicitly where the order matters.
    """
    reader = spark.readStream if streaming else spark.read
    return reader.text(path).select(
        "value",
        F.unix_micros("_metadata.file_modification_time").alias("arrival_seq"),
    )


def _retyped(schema: T.DataType, leaf_types: tuple, to: T.DataType) -> T.DataType:
    """The same nesting with every leaf of ``leaf_types`` replaced."""
    if isinstance(schema, T.StructType):
        return T.StructType(
            [T.StructField(f.name, _retyped(f.dataType, leaf_types, to)) for f in schema]
        )
    if isinstance(schema, T.ArrayType):
        return T.ArrayType(_retyped(schema.elementType, leaf_types, to))
    return to if isinstance(schema, leaf_types) else schema


_WHOLES, _DOUBLES, _INSTANTS = (T.LongType, T.IntegerType), (T.DoubleType,), (T.TimestampType,)
# All leaves are read as text, because numbers may stand in quotes and only some spellings of timestamps are accepted.
AS_TEXT = _retyped(S.BATCH, (*_INSTANTS, *_WHOLES, *_DOUBLES), T.StringType())
TYPED = _retyped(S.BATCH, _INSTANTS, T.StringType())


def _instant(text: Column) -> Column:
    seconds = F.when(text.rlike(EPOCH_SECONDS), text.try_cast("decimal(38,9)"))
    from_number = F.timestamp_millis(
        F.floor(seconds * F.lit(1000)).try_cast("bigint")
    )
    iso = F.when(text.rlike(ISO_INSTANT), F.upper(text).try_cast("timestamp"))
    return F.coalesce(whole_millis(iso), from_number)


def _double(text: Column) -> Column:
    return F.when(text.rlike(NUMBER), text.try_cast("double"))


def _whole(text: Column, kind: str) -> Column:
    """Whole numbers, and fractions of the JSON number form cut towards zero."""
    exact = F.when(text.rlike(WHOLE_NUMBER), F.trim(text).try_cast(kind))
    return F.coalesce(exact, F.when(text.rlike(EPOCH_SECONDS), text.try_cast("double").try_cast(kind)))


def _convert(value: Column, source: T.DataType, target: T.DataType) -> Column:
    """The value in its target type; parts that have it already are not taken apart."""
    if source == target:
        return value
    if isinstance(target, T.StructType):
        fields = [
            _convert(value[f.name], source[f.name].dataType, f.dataType).alias(f.name)
            for f in target
        ]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(target, T.ArrayType):
        return F.transform(
            value, lambda item: _convert(item, source.elementType, target.elementType)
        )
    if isinstance(target, T.TimestampType):
        return _instant(value)
    if isinstance(target, T.DoubleType):
        return _double(value)
    return _whole(value, target.simpleString())


def _lost(value: Column, converted: Column, source: T.DataType, target: T.DataType) -> Column | None:
    """True where some leaf has a text but no converted value; an empty text reads as NULL."""
    if source == target:
        return None
    if isinstance(target, T.StructType):
        checks = [
            check
            for f in target
            if (check := _lost(value[f.name], converted[f.name], source[f.name].dataType, f.dataType))
            is not None
        ]
        return reduce(Column.__or__, checks) if checks else None
    if isinstance(target, T.ArrayType):
        if _lost(F.lit(None), F.lit(None), source.elementType, target.elementType) is None:
            return None
        losses = F.zip_with(
            value,
            converted,
            lambda item, kept: _lost(item, kept, source.elementType, target.elementType),
        )
        return F.coalesce(F.exists(losses, lambda lost: F.coalesce(lost, F.lit(False))), F.lit(False))
    return F.coalesce(converted.isNull() & value.isNotNull() & (F.trim(value) != ""), F.lit(False))


def _leaves(value: Column, schema: T.StructType, of: tuple, listed: bool = False) -> list[Column]:
    """The leaves of the given types as lists of texts, one for each field; what a list holds is not visited by lambdas."""
    found = []
    for f in schema:
        if isinstance(f.dataType, T.ArrayType):
            found += _leaves(_elements(value[f.name], listed), f.dataType.elementType, of, True)
        elif isinstance(f.dataType, of):
            found.append(value[f.name] if listed else F.array(value[f.name]))
    return found


def _elements(lists: Column, listed: bool) -> Column:
    return F.flatten(lists) if listed else lists


def _all_there(value: Column, schema: T.StructType, listed: bool = False) -> list[Column]:
    """Tests that no list inside a list is missing, without which the leaves of all of them are."""
    tests = []
    for f in schema:
        if isinstance(f.dataType, T.ArrayType):
            elements = _elements(value[f.name], listed)
            tests += [elements.isNotNull() | value[f.name].isNull()] if listed else []
            tests += _all_there(elements, f.dataType.elementType, True)
    return tests


def _joined(value: Column, of: tuple) -> Column:
    """The leaves of the given types as one text, a mark before each and at the end."""
    texts = [F.concat(F.lit(MARK), F.array_join(leaves, MARK)) for leaves in _leaves(value, S.BATCH, of)]
    return F.concat_ws("", *texts, F.lit(MARK))


def _any_other(forms: dict[str, str]) -> Column:
    """Whether a leaf among the joined ones has another form. Searched from mark to mark, which needs no stack."""
    return reduce(Column.__or__, [F.col(name).rlike(rf"\x01(?!{form}\x01|\z)") for name, form in forms.items()])


def _read(schema: T.StructType) -> Column:
    marked = T.StructType([*schema, T.StructField(CORRUPT, T.StringType())])
    return F.from_json("value", marked, JSON_OPTIONS)


def _whole_message(name: str) -> Column:
    return F.col(name).isNotNull() & F.col(f"{name}.{CORRUPT}").isNull()


def parse_messages(messages: DataFrame) -> DataFrame:
    """A2: add ``batch`` (NULL for anything unreadable) next to the given columns.

    A message is read once, with all leaves as text, which also accepts numbers in quotes and
    fractions for whole numbers. Where all leaves are plain, one cast converts them; where one
    has no form that is ever read, none is converted. Only the others are converted leaf by
    leaf, and one that does not convert makes the message poison. Numbers beyond a double's
    range become infinite; only a message that may hold one is read again with real number types.
    """
    text = F.col("_text")
    read = messages.withColumn("_text", _read(AS_TEXT))
    # The texts and the tests stand in projections of their own: the JVM compiles no method beyond 8000 bytes.
    texts = {"_instants": _INSTANTS, "_wholes": _WHOLES, "_doubles": _DOUBLES}
    joined = read.withColumns({name: F.when(_whole_message("_text"), _joined(text, of)) for name, of in texts.items()})
    sure = reduce(Column.__and__, _all_there(text, S.BATCH)) & ~F.contains("value", F.lit(MARK_ESCAPED))
    plain = sure & ~_any_other(dict(zip(texts, (PLAIN_INSTANT, PLAIN_WHOLE, PLAIN_NUMBER))))
    lost = _any_other(dict(zip(texts, (READ_INSTANT, READ_WHOLE, READ_NUMBER))))
    # Where a list inside a list is missing, not all leaves are among the joined texts.
    beyond = ~sure | F.col("_doubles").rlike(BEYOND)
    way = (
        F.when(~_whole_message("_text"), F.lit(UNREAD))
        .when(plain, F.lit(PLAIN))
        .when(lost, F.lit(UNREAD))
        .when(beyond, F.lit(BEYOND_RANGE))
        .otherwise(F.lit(BY_LEAF))
    )
    judged = joined.withColumn("_way", way).drop(*texts)
    again = judged.withColumn("_typed", F.when(F.col("_way") == BEYOND_RANGE, _read(TYPED)))

    # Leaves are converted once, in a projection of their own; what got lost shows afterwards.
    sources = {"_typed": TYPED, "_text": AS_TEXT}
    chosen = {
        "_typed": _whole_message("_typed"),
        "_text": F.col("_way").isin(BY_LEAF, BEYOND_RANGE) & ~F.coalesce(_whole_message("_typed"), F.lit(False)),
    }
    converted = again.withColumns(
        {f"{n}_batch": F.when(chosen[n], _convert(F.col(n), source, S.BATCH)) for n, source in sources.items()}
    )
    at_once = F.struct(*[text[f.name].try_cast(f.dataType).alias(f.name) for f in S.BATCH])
    batch = F.when(F.col("_way") == PLAIN, at_once)
    for n, source in sources.items():
        kept = F.col(f"{n}_batch")
        batch = batch.when(kept.isNotNull(), F.when(~_lost(F.col(n), kept, source, S.BATCH), kept))
    return converted.withColumn("batch", batch).drop("_way", *sources, *[f"{n}_batch" for n in sources])


def valid_batches(parsed: DataFrame) -> DataFrame:
    """A3: the messages that became a batch.

    Written as an explode of one or no element: a filter would be pushed below the parse
    and have every message parsed a second time for its test.
    """
    kept = F.explode(F.array_compact(F.array("batch"))).alias("batch")
    return parsed.select(*[c for c in parsed.columns if c != "batch"], kept)


def _unreadable() -> Column:
    """Empty messages and JSON ``null`` are not poison."""
    text = F.trim("value")
    empty = F.col("value").isNull() | (text == "") | (text == "null")
    return F.col("batch").isNull() & ~empty


def with_poison(parsed: DataFrame) -> DataFrame:
    """A3: add the text of a message that could not be read as ``poison``."""
    return parsed.withColumn(POISON, F.when(_unreadable(), F.col("value")))


def poison_messages(parsed: DataFrame) -> DataFrame:
    """A3: the messages to quarantine."""
    others = [c for c in parsed.columns if c != "batch"]
    once = F.when(_unreadable(), F.array(F.lit(True)))
    return parsed.select(*others, F.explode(once).alias("_poison")).drop("_poison")


def count_messages(parsed: DataFrame, name: str = "messages") -> DataFrame:
    """Attach counts of valid and skipped messages as an observation."""
    return parsed.observe(
        name,
        F.count(F.lit(1)).alias("received"),
        F.count("batch").alias("valid"),
        F.count_if(F.col("batch").isNull()).alias("skipped"),
    )
