"""The latest-document table (K2, K3): change files that readers reduce to one row per id.

A micro-batch of a stream writes a folder named by its run, its epoch and an attempt, and
is published by one line in ``commits`` once the folder is whole. Readers take published
attempts only, so nobody sees half a change, and a repeated micro-batch replaces exactly
what it wrote before. A run is one life of a checkpoint: a new checkpoint starts a new run,
whose epochs count from zero beside those of older runs. Later runs win over earlier ones,
then later epochs, then later arrivals. The id contains the time of measurement, hence all
versions of a document share one ``measured_day``.

``merge`` keeps the number of batches small while streams write: as soon as ``FANOUT`` batches
of a level have gathered, it writes their last versions as one batch of the next level, whose
line in ``commits`` also says up to which epoch of which run it replaces others. A repeated
epoch that was merged stays replaced. A reader pins the batches of one look at ``commits``;
``vacuum`` removes replaced folders some time after, and the lines they no longer need.
"""

from __future__ import annotations

import time
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kilnwatch.functions.time import utc_date
from kilnwatch.operators.latest import last_per_id
from kilnwatch.operators.projections import documents
from kilnwatch.schemas import ARRIVAL, READING

RUN, EPOCH, ATTEMPT, DAY = "run", "epoch", "attempt", "measured_day"
BATCH = [RUN, EPOCH, ATTEMPT]
VERSION = [RUN, EPOCH, *ARRIVAL]
REPLACED = T.StructType(
    [
        T.StructField(RUN, T.StringType()),
        T.StructField("level", T.IntegerType()),
        T.StructField(EPOCH, T.LongType()),
    ]
)
COMMITS = T.StructType(
    [
        T.StructField(RUN, T.StringType()),
        T.StructField(EPOCH, T.LongType()),
        T.StructField(ATTEMPT, T.StringType()),
        T.StructField("published_us", T.LongType()),
        T.StructField("level", T.IntegerType()),
        T.StructField("replaces", T.ArrayType(REPLACED)),
    ]
)
#: The run of a compacted table and of writes that belong to no stream; it sorts first.
NO_RUN = "0"
#: The run of merged batches, whose rows keep their own run and epoch.
MERGED = "merged"
OWN_VERSION = {RUN: "version_run", EPOCH: "version_epoch"}
#: Batches of a level that are merged into one, and the newest epochs of a run that stay out.
FANOUT = 8
NEWEST_KEPT = 2
DAY_US = 86_400_000_000


def changes(readings: DataFrame) -> DataFrame:
    """The last document per id among the given readings, with its day."""
    rows = documents(
        readings.withColumn(DAY, utc_date(F.col("measured_at"))), *ARRIVAL, DAY
    )
    return last_per_id(rows, *ARRIVAL, within=(DAY,))


def indexable(readings: DataFrame):
    """K3: readings an index accepts. A value that is no number cannot be stored in one."""
    def finite(name):
        return F.coalesce(
            ~F.isnan(name) & (F.abs(F.col(name)) != F.lit(float("inf"))), F.lit(True)
        )

    return finite("value") & finite("recipe_min") & finite("recipe_max")


def new_run() -> str:
    """A name that sorts after those of earlier runs."""
    return f"{time.time_ns() // 1_000_000:015d}-{uuid.uuid4().hex[:8]}"


def run_of(spark: SparkSession, checkpoint: str) -> str:
    """The run of a checkpoint, kept in it: a restart goes on with it, a new checkpoint gets a new one."""
    path = f"{checkpoint.rstrip('/')}/document-run"
    (
        spark.createDataFrame([(new_run(),)], "value string")
        .coalesce(1)
        .write.mode("ignore")
        .text(path)
    )
    return spark.read.text(path).first()["value"]


def _publish(
    spark: SparkSession, path: str, run: str, epoch: int, attempt: str, level: int = 0, replaces=()
) -> None:
    row = (run, epoch, attempt, time.time_ns() // 1000, level, list(replaces))
    spark.createDataFrame([row], COMMITS).coalesce(1).write.mode("append").parquet(f"{path}/commits")


def upsert(readings: DataFrame, path: str, epoch: int, run: str = NO_RUN) -> None:
    """Apply one batch: good rows to the change files, others to the quarantine."""
    spark, good, attempt = readings.sparkSession, indexable(readings), uuid.uuid4().hex
    folder = f"{RUN}={run}/{EPOCH}={epoch}/{ATTEMPT}={attempt}"
    (
        changes(readings.filter(good))
        .hint("rebalance", DAY)
        .write.partitionBy(DAY)
        .parquet(f"{path}/changes/{folder}")
    )
    readings.filter(~good).write.parquet(f"{path}/rejected/{folder}")
    _publish(spark, path, run, epoch, attempt)


def _commits(spark: SparkSession, path: str) -> DataFrame:
    """The last published attempt of each batch, with the epoch up to which its run was merged."""
    try:
        commits = spark.read.schema(COMMITS).parquet(f"{path}/commits")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        commits = spark.createDataFrame([], COMMITS)
    last = commits.groupBy(RUN, EPOCH).agg(
        F.max_by(ATTEMPT, "published_us").alias(ATTEMPT),
        F.max("published_us").alias("published_us"),
        F.coalesce(F.max("level"), F.lit(0)).alias("level"),
        F.max_by("replaces", "published_us").alias("replaces"),
    )
    upto = (
        last.select(F.explode("replaces").alias("r"))
        .select("r.*")
        .groupBy(RUN, "level")
        .agg(F.max(EPOCH).alias("upto"))
    )
    return last.join(upto, [RUN, "level"], "left")


def _active(spark: SparkSession, path: str) -> list[Row]:
    """The batches that make up the table now; ``merge`` keeps them few."""
    return _commits(spark, path).where("upto IS NULL OR epoch > upto").collect()


def _folder(path: str, kind: str, batch: Row) -> str:
    return f"{path}/{kind}/{RUN}={batch[RUN]}/{EPOCH}={batch[EPOCH]}/{ATTEMPT}={batch[ATTEMPT]}"


def _published(
    spark: SparkSession, path: str, kind: str, schema: T.StructType, batches: list[Row] | None = None
) -> DataFrame:
    """Rows of some or all active batches with their versions; none where nothing was written."""
    keys = [T.StructField(RUN, T.StringType()), T.StructField(EPOCH, T.LongType())]
    own = [T.StructField(name, keys[k].dataType) for k, name in enumerate(OWN_VERSION.values())]
    known = T.StructType([*(f for f in schema if f.name != DAY), *own, *keys, T.StructField(ATTEMPT, T.StringType())])
    if DAY in schema.names:
        known = known.add(schema[DAY])
    batches = _active(spark, path) if batches is None else batches
    if batches:
        folders = [_folder(path, kind, batch) for batch in batches]
        rows = spark.read.schema(known).option("basePath", f"{path}/{kind}").parquet(*folders)
    else:
        rows = spark.createDataFrame([], known)
    versions = {name: F.coalesce(version, name) for name, version in OWN_VERSION.items()}
    return rows.withColumns(versions).select(*schema.names, *versions)


def _changes_schema(spark: SparkSession) -> T.StructType:
    return changes(spark.createDataFrame([], READING)).schema


def _latest(spark: SparkSession, path: str) -> DataFrame:
    rows = _published(spark, path, "changes", _changes_schema(spark))
    return last_per_id(rows, *VERSION, within=(DAY,))


def read_latest(spark: SparkSession, path: str) -> DataFrame:
    """The table as readers see it; a filter on ``measured_day`` skips other days' files."""
    return _latest(spark, path).drop(*VERSION)


def read_rejected(spark: SparkSession, path: str) -> DataFrame:
    """K3: the readings that no index accepts, once each."""
    return _published(spark, path, "rejected", READING).select(*READING.names)


def compact(spark: SparkSession, path: str, target: str) -> None:
    """Write the current table to a new folder as one batch that any run comes after.

    Readers then list one batch instead of all; a stream goes on in the new folder. Rejected
    readings stay where they are.
    """
    attempt = uuid.uuid4().hex
    (
        _latest(spark, path)
        .drop(RUN, EPOCH)
        .hint("rebalance", DAY)
        .write.partitionBy(DAY)
        .parquet(f"{target}/changes/{RUN}={NO_RUN}/{EPOCH}=-1/{ATTEMPT}={attempt}")
    )
    _publish(spark, target, NO_RUN, -1, attempt)


def merge(spark: SparkSession, path: str, fanout: int = FANOUT, newest_kept: int = NEWEST_KEPT) -> int:
    """Merge batches in place, level by level, and tell how many merged batches were written.

    May run beside streams and readers, one merge at a time. The ``newest_kept`` epochs of each
    run stay out, as a restart may still write them again.
    """
    made = 0
    while True:
        active = _active(spark, path)
        newest = {}
        for batch in active:
            newest.setdefault(batch[RUN], []).append(batch[EPOCH])
        ripe: dict[int, list[Row]] = {}
        for batch in active:
            kept = sorted(newest[batch[RUN]])[-newest_kept:] if newest_kept and batch[RUN] != MERGED else []
            if batch[EPOCH] not in kept:
                ripe.setdefault(batch["level"], []).append(batch)
        full = [level for level in sorted(ripe) if len(ripe[level]) >= max(2, fanout)]
        if not full:
            return made
        _merge_level(spark, path, full[0], ripe[full[0]])
        made += 1


def _merge_level(spark: SparkSession, path: str, level: int, batches: list[Row]) -> None:
    target = Row(**{RUN: MERGED, EPOCH: time.time_ns() // 1000, ATTEMPT: uuid.uuid4().hex})

    def own(rows: DataFrame) -> DataFrame:
        return rows.withColumnsRenamed(OWN_VERSION)

    changed = _published(spark, path, "changes", _changes_schema(spark), batches)
    (
        own(last_per_id(changed, *VERSION, within=(DAY,)))
        .hint("rebalance", DAY)
        .write.partitionBy(DAY)
        .parquet(_folder(path, "changes", target))
    )
    own(_published(spark, path, "rejected", READING, batches)).write.parquet(_folder(path, "rejected", target))
    # What earlier merges replaced stays replaced when they are merged themselves.
    upto = {(r[RUN], r["level"]): r[EPOCH] for b in _commits(spark, path).collect() for r in b["replaces"] or ()}
    for batch in batches:
        key = batch[RUN], level
        upto[key] = max(upto.get(key, batch[EPOCH]), batch[EPOCH])
    replaces = [(run, of, epoch) for (run, of), epoch in upto.items()]
    _publish(spark, path, MERGED, target[EPOCH], target[ATTEMPT], level + 1, replaces)


def vacuum(spark: SparkSession, path: str, older_than_us: int = DAY_US) -> int:
    """Remove the folders of batches that were replaced that long ago, and tell how many.

    Readers that looked at the table before must have finished by then. The lines of what is
    gone are dropped by writing the others anew as one file.
    """
    files = spark.read.schema(COMMITS).parquet(f"{path}/commits").inputFiles()
    lines = spark.read.schema(COMMITS).parquet(*files).collect() if files else []
    known = {(b[RUN], b[EPOCH]): b for b in _commits(spark, path).collect()}
    merged_us = max([b["published_us"] for b in known.values() if b[RUN] == MERGED], default=0)
    settled = merged_us <= time.time_ns() // 1000 - older_than_us
    gone, kept = [], []
    for line in lines:
        now = known.get((line[RUN], line[EPOCH]))
        replaced = now is None or now["upto"] is not None and line[EPOCH] <= now["upto"] or line[ATTEMPT] != now[ATTEMPT]
        (gone if replaced and settled else kept).append(line)
    if gone:
        for line in gone:
            for kind in ("changes", "rejected"):
                _remove(spark, _folder(path, kind, line))
        spark.createDataFrame(kept, COMMITS).coalesce(1).write.mode("append").parquet(f"{path}/commits")
        for file in files:
            _remove(spark, file)
    return len(gone)


def _remove(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
