"""Time the headline queries and print one JSON line.

Reads ``BENCH_SF_DIR`` (tables), ``BENCH_CPUS`` (local cores) and
``BENCH_REPEATS``: a query's time is the best of its runs.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from hourmart.session import build_session  # noqa: E402
from workload import ENTRIES  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPEATS = int(os.environ.get("BENCH_REPEATS", "2"))

HEADLINE = (
    "wn01_latest_primary_price", "wn01_latest_price_per_user", "prj02_label_instants",
    "wn02_label_weather", "jn01_merged_prices_per_user", "md06_hourly_fact",
    "md06_hourly_fact_per_user", "ag01_daily_summary", "ag01_daily_summary_per_user",
    "md08_date_dimension", "sf01_date_parts", "sf11_rounding", "ag02_headline", "ag03_hour_shape",
    "ag05_week_metrics", "ag08_all_months", "ag09_trailing_summary", "ag17_exact_quantile_large",
    "ag21_hour_grid", "ag28_measure_pack", "ag31_prior_year", "ag33_group_stats",
    "wn06_gap_runs_per_user", "dq04_orphans", "dq10_continuity_breaks_per_user",
    "snk05_history_from_log", "snk01_upsert_frame", "src04_hours_from_points",
    "src02_hours_from_units", "src08_feed_headlines", "md04_staged_headlines",
    "ud03_keyword_topics", "sf14_page_texts", "snk01_upsert_table", "ss02_streamed_rollup",
)


def main() -> None:
    spark = build_session(
        "bench",
        f"local[{CPUS}]",
        int(CPUS),
        {"spark.ui.enabled": "false", "spark.driver.memory": "16g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Start the JVM code paths and the file listing outside the timings.
    ENTRIES["wn01_latest_primary_price"][0](spark, SF_DIR).count()
    timings = {}
    for name in HEADLINE:
        runs = []
        for _ in range(REPEATS):
            start = time.perf_counter()
            ENTRIES[name][0](spark, SF_DIR).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        timings[name] = round(min(runs), 3)
    sf = Path(SF_DIR).name.removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
