"""Times the headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]`` and prints one JSON line.

Each query is computed in full into a sink that discards its rows: one run
to warm up, then the median of ``$BENCH_RUNS`` timed runs.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from conformance import frames, registry  # noqa: E402
from labwatch.plans import matrices  # noqa: E402
from labwatch.session import build_session  # noqa: E402

HEADLINE = [
    "positivity_by_week",
    "normalize_text",
    "samples",
    "panel",
    "lab_dbmol",
    "register_samples",
    "union_cutover",
    "quality_kit_pathogens",
    "matrix_01_VRISP_line_posrate_direct_week_country_h",
    "matrix_03_SC2_heat_posrate_week_state",
    "matrix_102_VRISP_posrate_posneg_week_state",
]
RUNS = int(os.environ.get("BENCH_RUNS", "1"))


def discard(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def whole_catalogue(spark, sf_dir: str) -> None:
    """All 59 tables from the written cubes."""
    for table in matrices.build_all(frames.source(spark, sf_dir)).values():
        discard(table)


def timed(run) -> float:
    start = time.perf_counter()
    run()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{
            "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "16g",
            "spark.sql.shuffle.partitions": cpus,
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries, seconds = registry.queries(), {}
    for name in HEADLINE:
        run = lambda: discard(queries[name](spark, sf_dir))  # noqa: E731, B023
        run()
        seconds[name] = round(statistics.median(timed(run) for _ in range(RUNS)), 3)
    seconds["whole_catalogue"] = round(timed(lambda: whole_catalogue(spark, sf_dir)), 3)
    print(json.dumps({"metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/"))}))
    spark.stop()


if __name__ == "__main__":
    main()
