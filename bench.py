"""Time the headline queries: prints one JSON line.

``BENCH_SF_DIR`` names the tables (default sf0.1), ``BENCH_CPUS`` the local
cores. Every query is run to its last row into a sink that drops the rows.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from matchwright.session import local_session  # noqa: E402
from matchwright.workload.queries import queries  # noqa: E402

HEADLINE = [
    "exact_match_left_join",
    "fuzzy_join_k1",
    "fuzzy_join_k2",
    "fuzzy_join_k5",
    "match_cascade",
    "candidate_report",
    "coalesce_name",
    "reconcile_agreed",
    "reconcile_value_conflicts",
    "reconcile_gaps_long",
    "reconcile_final",
    "conflict_names",
    "add_group_count",
    "duplicate_keys_composite",
    "multiset_difference",
    "object_literal_flatten",
    "normalize_names",
    "quality_report",
    "csv_roundtrip",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, extra={"spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    catalog = queries()
    names = sys.argv[1:] or HEADLINE
    # start the JVM's code paths and the Python workers before the clock runs
    run(catalog["osa_distance_pairs"](spark, sf_dir))
    seconds: dict[str, float] = {}
    for name in names:
        start = time.perf_counter()
        run(catalog[name](spark, sf_dir))
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
