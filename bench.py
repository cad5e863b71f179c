"""Times the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

import json
import os
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from quietwire.catalogue import QUERIES  # noqa: E402
from quietwire.session import release  # noqa: E402

HEADLINE = (
    "baseline_rolling",
    "surprise_scores",
    "digest_topk",
    "stage_counts",
    "dedup_kept",
    "threshold_sweep",
    "ingest_prices",
    "ingest_news",
    "upsert_update",
    "backfill_report",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("quietwire-bench")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{folder}/region.parquet").count()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        release(spark)
    total = round(sum(seconds.values()), 3)
    scale = Path(folder).name.removeprefix("sf")
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": seconds, "sf": scale}))


if __name__ == "__main__":
    main()
