"""Session defaults and the shared folder used for checkpoints and written tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

STATE_STORE_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)


def build_session(app_name: str = "kilnwatch", **conf: str) -> SparkSession:
    """A session with the settings the jobs expect; ``conf`` entries override them."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass": STATE_STORE_PROVIDER,
        **conf,
    }
    builder = SparkSession.builder.appName(app_name)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession, label: str) -> str:
    """A fresh path below ``spark.checkpoint.dir`` for one run's files.

    A local session without that setting gets a temporary folder. On a cluster the
    setting is required, because executors do not see the driver's disk.
    """
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="kilnwatch-")
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def written(rows: DataFrame, label: str) -> DataFrame:
    """``rows`` as a table in the shared folder, which cuts the lineage and survives lost executors."""
    path = shared_folder(rows.sparkSession, label)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
