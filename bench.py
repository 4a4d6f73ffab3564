"""Time the headline queries and print one JSON line.

BENCH_SF_DIR: folder of the tables (default /root/testdata/sf0.1).
BENCH_CPUS: local threads (default: all).
BENCH_QUERIES: comma-separated names instead of the headline queries.
Each query runs once to warm up and three times for the median; every row is computed.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from listenlytics.session import build_session  # noqa: E402
from listenlytics.workloads import QUERIES  # noqa: E402

HEADLINES = (
    "star_daily_genre_kpis",
    "star_song_play_counts",
    "star_top_songs_per_genre",
    "star_top_songs_per_genre_ties",
    "star_top_genres_per_day",
    "file_quality_profile",
    "validate_files",
    "upsert_kpis",
    "csv_daily_genre_kpis",
    "run_daily_genre_kpis",
)
RUNS = 3


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS") or str(os.cpu_count() or 8)
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or list(HEADLINES)
    conf = {
        "spark.sql.shuffle.partitions": cpus,
        "spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "8g"),
        "spark.ui.showConsoleProgress": "false",
    }
    spark = build_session("listenlytics-bench", f"local[{cpus}]", **conf)
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in names:
        run(name)
        seconds[name] = round(statistics.median(run(name) for _ in range(RUNS)), 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr)
    spark.stop()

    scale = re.search(r"sf([0-9.]+)$", sf_dir)
    print(
        json.dumps(
            {
                "metric": "sum of median query times",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else sf_dir,
            }
        )
    )


if __name__ == "__main__":
    main()
