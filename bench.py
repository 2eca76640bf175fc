"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import time

from checks.queries import QUERIES
from tidemark.session import local_session

HEADLINE = [
    "parsed_dates", "normalization_records", "date_audit_summary", "quality_score", "cleaning_summary", "cleaning_audit",
    "column_profile", "normalized_document_duplicates", "fuzzy_group_pairs", "cluster_members", "kruskal_event_types",
    "spearman_lines", "two_arm_lines", "monthly_cohorts", "driver_finding", "triage_finding",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(cores=os.environ.get("BENCH_CPUS", "8"), app="bench")
    times: dict[str, float] = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.mode("overwrite").format("noop").save()
        times[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({"metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
