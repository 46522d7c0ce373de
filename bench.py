"""Times the headline queries and prints one line of JSON. BENCH_SF_DIR and BENCH_CPUS say on what."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

HERE = str(Path(__file__).resolve().parent)
sys.path.insert(0, HERE)

from lineweave import catalogue  # noqa: E402

HEADLINE = ["interval_overlay_full", "curb_profile_full", "curb_narrowings", "interval_edges", "station_rollup", "adaptive_sampling", "profile_summary", "tile_bbox_join", "tile_bbox_join_2d", "nearest_match", "gaps_islands", "component_rollup", "line_poly_intervals"]


def main() -> None:
    sf_dir, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), int(os.environ.get("BENCH_CPUS", os.cpu_count() or 4))
    os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, (HERE, os.environ.get("PYTHONPATH"))))  # for Python workers, wherever this is started
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").config("spark.sql.shuffle.partitions", str(2 * cpus)).config("spark.driver.memory", "16g").config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()
    took = {}
    for name in HEADLINE:
        began = time.perf_counter()
        catalogue.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        took[name] = round(time.perf_counter() - began, 3)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": os.path.basename(os.path.normpath(sf_dir)), "cpus": cpus}))


if __name__ == "__main__":
    main()
