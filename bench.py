"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""
from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from checks.queries import QUERIES  # noqa: E402
from stillwater import local_session  # noqa: E402

HEADLINE = (
    "interval_summary", "pad_grid", "summary_stats", "flag_drift", "flag_do_noise", "flag_malfunction", "field_notes_asof",
    "threshold_table", "network_check", "interp_linear", "merge_archive", "final_flags",
    "archive_write_back", "incremental_archive", "stream_late_summary",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    spark = local_session("bench", cpus, partitions=cpus)
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES[HEADLINE[0]](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
    times = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(sf_dir.rstrip("/"))}))
    spark.stop()


if __name__ == "__main__":
    main()
