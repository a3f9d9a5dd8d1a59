"""Time the headline queries and print one JSON line.

Each query is executed in full (every row and column is produced, nothing is kept) and the
fastest of three runs counts, so that start-up costs of the JVM do not dominate.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from promolens.plans import runs  # noqa: E402
from promolens.session import SESSION_SETTINGS, staging_path  # noqa: E402
from testkit import registry  # noqa: E402

HEADLINE = (
    "order_level",
    "cif_order_map",
    "orders_mapped",
    "cust_shop",
    "feature_table",
    "feature_table_write",
    "prepared",
    "scoring_frame",
    "stratified_split",
    "roc_auc",
    "bucketize",
    "segment_distribution",
    "score_customers",
)
RUNS = 3


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
    )
    for key, value in SESSION_SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        started = time.perf_counter()
        result = registry.QUERIES[name](spark, sf_dir)
        result.write.format("noop").mode("overwrite").save()
        return time.perf_counter() - started

    seconds = {name: min(run(name) for _ in range(RUNS)) for name in HEADLINE}
    started = time.perf_counter()
    runs.fit_model(
        spark, registry.features(spark, sf_dir), staging_path(spark, "model"), registry.CONFIG
    )
    seconds["fit_model"] = time.perf_counter() - started
    record = {
        "metric": "headline queries, fastest of three runs each, plus one model fit",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": {name: round(s, 3) for name, s in seconds.items()},
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus),
    }
    print(json.dumps(record))
    spark.stop()


if __name__ == "__main__":
    main()
