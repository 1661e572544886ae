"""Times headline queries and the ingest path; prints one JSON line.

Query names or ``all`` may be given as arguments. ``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local threads.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from kilnwatch.operators.flatten import flatten_batches  # noqa: E402
from kilnwatch.operators.projections import documents  # noqa: E402
from kilnwatch.plans.catalog import QUERIES  # noqa: E402
from kilnwatch.session import build_session, shared_folder  # noqa: E402
from kilnwatch.sources.tables import batches_from_orders  # noqa: E402
from kilnwatch.streaming.jobs import readings_of  # noqa: E402

HEADLINES = [
    "dedup_first",
    "storage_partition",
    "document_latest",
    "document_upserts",
    "trailing_5m",
    "trailing_1m",
    "rule1",
    "rule3",
    "bias",
    "rule1_shifting_limits",
    "rule1_own_limits",
    "evaluations",
    "evaluations_arrival",
    "alerts",
    "alert_envelope",
    "stream_dedup",
    "stream_parquet",
    "stream_upsert",
    "stream_alerts",
    "flatten_documents",
    "parse_json_batches",
]
LONG_SECONDS = 12


def timed(action) -> float:
    """Seconds of the better of two runs; a long first run is not repeated."""
    best = None
    for _ in range(2):
        begin = time.perf_counter()
        action()
        taken = time.perf_counter() - begin
        best = taken if best is None else min(best, taken)
        if taken > LONG_SECONDS:
            break
    return round(best, 3)


def consume(rows) -> None:
    rows.write.format("noop").mode("overwrite").save()


def ingest_rates(spark, sf_dir: str, cpus: int) -> dict[str, float]:
    """Readings per second: nested batches to documents, and JSON text to documents."""
    folder = shared_folder(spark, "bench")
    nested = batches_from_orders(spark, sf_dir).repartition(cpus)
    nested.write.parquet(f"{folder}/nested")
    nested = spark.read.parquet(f"{folder}/nested")
    nested.selectExpr("to_json(batch) AS value", "arrival_seq").write.parquet(f"{folder}/json")
    text = spark.read.parquet(f"{folder}/json")
    count = flatten_batches(nested).count()
    mapped = timed(lambda: consume(documents(flatten_batches(nested))))
    parsed = timed(lambda: consume(documents(readings_of(text))))
    return {
        "readings": count,
        "flatten_map_per_sec": round(count / mapped),
        "flatten_map_per_sec_per_thread": round(count / mapped / cpus),
        "json_flatten_map_per_sec": round(count / parsed),
    }


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(
        "bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
            "spark.sql.shuffle.partitions": str(cpus),
            "spark.ui.enabled": "false",
            # The tables are small; splits of this size give every thread some work.
            "spark.sql.files.maxPartitionBytes": "2m",
            "spark.sql.adaptive.coalescePartitions.parallelismFirst": "true",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = list(QUERIES) if sys.argv[1:] == ["all"] else sys.argv[1:] or HEADLINES
    seconds = {}
    for name in names:
        seconds[name] = timed(lambda: consume(QUERIES[name](spark, sf_dir)))
        print(name, seconds[name], file=sys.stderr, flush=True)
    result = {
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": Path(sf_dir).name.removeprefix("sf"),
        "ingest": ingest_rates(spark, sf_dir, cpus),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
