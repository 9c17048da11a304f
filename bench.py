"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` (default sf0.1) holds the tables, ``BENCH_CPUS`` (default 8) sizes the local session.
Each query is run once to warm up and then timed; every row and column of its result is computed.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from gridspark.session import session  # noqa: E402
from gridspark.suite import QUERIES  # noqa: E402

HEADLINES = [
    "flagship_daily_sea_mean",
    "A3_time_offset",
    "A7_merge_datasets",
    "B1_write_block",
    "B4_pack_unpack",
    "C6_sel",
    "D1_apply_mask",
    "D7_masked_fill",
    "E2_products",
    "F1_get_bottom",
    "F2_fill_from_above",
    "G4_regrid_conservative",
    "G4_regrid_conservative_zero",
    "G5_regrid_stat",
    "G8_regrid_linear",
    "G13_conservation_check",
    "H1_mean",
    "H2_resample_mean",
    "H6_resample_median",
    "I3_bin_statistics",
    "I6_climatology",
    "I7_anomaly_std",
    "I9_anomalies",
    "J3_ensure_no_nans",
    "J4_guard_no_nans",
    "K2_as_run",
    "K10_lead_statistics",
    "L2_assign_block",
    "L5_retention_versions",
    "M1_stream_extend",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = session(f"local[{cpus}]", shuffle_partitions=cpus)
    names = sys.argv[1:] or HEADLINES
    times = {}
    for name in names:
        for _ in range(2):
            begin = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - begin, 3)
    line = {
        "metric": "total_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")),
        "cpus": cpus,
    }
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()
