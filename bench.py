"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` is the data folder, ``BENCH_CPUS`` the number of local cores and ``BENCH_RUNS`` how
often each query runs; the fastest run counts. The clinical tables are derived from the test tables
and written first, in one file per core, so that the queries' own work is timed; ``prepare`` is the
time that took. Every row of every result is computed and discarded.
"""

from __future__ import annotations

import json
import os
import sys
import time

from bindings.domain import Domain
from bindings.queries import BUILDERS
from tractline.session import build_session, scratch_folder

HEADLINE = (
    "a3_row_counts",
    "j3_visit_in_residence",
    "j5_geocode_address",
    "j6_point_to_tract",
    "j6_point_to_tract_shuffled",
    "x1_exposure_by_fips",
    "x6_date_shift",
    "c4_title_case",
    "u2_location_build",
    "link_coordinates",
    "link_addresses",
    "link_visits",
    "sink_category_batches",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="12g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}
    started = time.time()
    written = scratch_folder(spark, "bench")
    Domain(spark, folder).write(written, int(cpus))
    prepare = round(time.time() - started, 3)
    for name in sys.argv[1:] or HEADLINE:
        for _ in range(runs):
            started = time.time()
            BUILDERS[name](Domain(spark, folder, written)).write.format("noop").mode("overwrite").save()
            took = time.time() - started
            times[name] = round(min(took, times.get(name, took)), 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, total of the fastest runs",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "prepare": prepare,
                "cpus": int(cpus),
                "runs": runs,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
