"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the data (default /root/testdata/sf0.1), BENCH_CPUS the
number of local cores (default 8). Each query is planned, run and written to a
sink that discards the rows. The language model is trained once for each size, which is
timed too, and shared by the queries.
"""

from __future__ import annotations

import json
import os
import time

from reviewsieve.plans import catalog
from reviewsieve.session import build_session

HEADLINES = (
    "l0_language_profiles",
    "l1_detect_language",
    "t2_strip_html",
    "t4_normalize_review_text",
    "t7_review_hash",
    "v1_rejection_counts",
    "v2_preprocess_reviews",
    "u1_drop_duplicate_reviews",
    "u4_duplicate_report",
    "u7_new_hashes",
    "u9_increment_clean",
    "q1_record_stats",
    "c2_key_sets",
    "p2_text_missing_stats",
    "p8_exploration_summary",
    "x1_stream_clean",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    available = {**catalog.queries(), "flagship": catalog.flagship}
    # The table with a tenth of the rows warms the session up and shows how the queries grow.
    small_dir = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.01")
    small = timed(spark, available, small_dir) if small_dir != sf_dir.rstrip("/") and os.path.isdir(small_dir) else {}
    seconds = timed(spark, available, sf_dir)
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "seconds_at_sf0.01": small,
                "growth_for_ten_times_the_rows": {n: round(s / small[n], 2) for n, s in seconds.items() if small.get(n)},
            }
        )
    )
    spark.stop()


def timed(spark, available, sf_dir) -> dict[str, float]:
    """Seconds of training and of each query, which is planned, run and written to nowhere."""
    start = time.perf_counter()
    catalog.trained_model(spark, sf_dir)
    seconds = {"train_language_model": round(time.perf_counter() - start, 3)}
    for name in ("flagship", *HEADLINES):
        start = time.perf_counter()
        available[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    return seconds


if __name__ == "__main__":
    main()
