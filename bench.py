"""Time the headline reports: prints one JSON line.

``BENCH_SF_DIR`` is the test-data directory, ``BENCH_CPUS`` the number of local threads. Every query is
built and run to the end (all rows are produced and discarded) after a warm-up on the same data.
"""

from __future__ import annotations

import json
import os
import time

from supplyscope.session import local_session
from testbed.bindings import queries

HEADLINE = [
    "logs_by_week",
    "operational_issues",
    "runaway_resources",
    "ended_orgs_active_endpoints",
    "entities_with_ended_orgs",
    "odp_status",
    "plan_status",
    "odp_issue",
    "plan_issue",
    "listed_building_end_date",
    "deleted_entities",
    "duplicate_pairs",
    "endpoints_documentation",
    "documentation_stats",
    "endpoints_no_provision",
    "flagged_failed_resources_all",
    "resource_detailed_counts",
    "resource_vs_platform",
    "quality_single_source",
    "quality_scores",
    "quality_detail",
    "conformance",
    "conformance_overview",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cpus)
    registered = queries()

    def run(name: str) -> float:
        start = time.perf_counter()
        registered[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    run("logs_by_week")
    seconds = {name: round(run(name), 3) for name in HEADLINE}
    result = {
        "metric": "total seconds for the headline reports",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
