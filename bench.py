"""Times the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from wakeline.plans.catalog import QUERIES  # noqa: E402
from wakeline.session import spark_session  # noqa: E402
from wakeline.sources.scratch import release  # noqa: E402

HEADLINE = (
    "flagship_neighbours",
    "s1_csv_scan",
    "s3_day_partition_read",
    "s8_write_groups",
    "p3_bounding_box",
    "p4_minute_snapshot",
    "p15_vessel_group",
    "p19_calendar_columns",
    "a1_build_tracks",
    "a2_first_known_attributes",
    "a6_speed_quintiles",
    "a9_latest_per_slot",
    "w3_segment_numbers",
    "w4_speed_polylines",
    "w5_retention",
    "j1_tracks_in_group",
    "j5_radius_in_all",
    "j9_proximity_pairs",
    "f9_geohash_score",
    "f11_destination_wgs84",
    "t2_ids_by_group",
    "t4_long_series",
    "t6_last_hour_lines",
    "t8_forecast_moving",
    "st1_latest_by_slot",
)


def run(query, spark, sf_dir) -> float:
    began = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = spark_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "16g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    run(QUERIES["flagship_neighbours"], spark, sf_dir)  # starts the session's threads
    times = {}
    for name in names:
        # Second run: the first one compiles the plan's code.
        run(QUERIES[name], spark, sf_dir)
        times[name] = round(run(QUERIES[name], spark, sf_dir), 3)
        release(spark)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
