"""Wall seconds per headline query; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS the local cores.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from gaugeflow.plans import catalog
from gaugeflow.session import build_session

HEADLINES = [
    "kge_by_station", "goodness_of_fit", "objectives_by_run", "index_of_agreement", "objectives_low_flow",
    "monthly_boxes", "daily_means", "resampled_pairs", "period_maxima", "return_levels", "event_scores",
    "screened_stations", "station_records", "ranked_runs", "pareto_archive", "interstation_regions",
    "station_tree", "upstream_inflows", "clipped_grid", "parameter_mosaic", "series_evaluation", "children",
    "parsed_series", "job_table", "diagnostic_table",
]
REPEATS = 3


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    spark = build_session(cpus, max(8, cpus))
    seconds: dict[str, float] = {}
    for name in HEADLINES:
        runs = []
        for i in range(REPEATS + 1):  # the first run warms up
            started = time.perf_counter()
            catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            if i:
                runs.append(time.perf_counter() - started)
        seconds[name] = round(statistics.median(runs), 3)
    spark.stop()
    print(json.dumps({"metric": "total wall time of the headline queries", "value": round(sum(seconds.values()), 3),
                      "unit": "sec", "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
