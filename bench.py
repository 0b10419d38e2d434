"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the data, ``BENCH_CPUS`` the cores; ``BENCH_QUERIES`` (comma separated, or
``all``) picks other queries. Every query runs over its whole tables and its rows are consumed on
the executors.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "fact_rows", "reconcile_value", "reconcile_buckets", "coverage_summary", "lineage_records", "rejected_values",
    "period_finals", "rollup_coverage", "derived_total_check", "national_rollup",
    "snapshot_dedupe", "fmt_clean", "type_coerce", "fy_month", "normalize_stage", "melt_simple", "drift_ledger", "land_classify",
    "resolve_geo", "resolve_quarantine", "rule_extract",
    "query_filter", "request_triage", "cohort_count", "gap_fill", "withheld_spans", "derivations",
    "claim_audit", "quote_audit", "replay_audit",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from ledgerloom.plans import catalog
    from ledgerloom.session import local_session

    spark = local_session(cpus)
    spark.sparkContext.setLogLevel("ERROR")
    queries = catalog.queries()
    picked = os.environ.get("BENCH_QUERIES", "")
    names = list(queries) if picked == "all" else picked.split(",") if picked else HEADLINE
    # Start the JVM's scan and shuffle paths once, outside the timings.
    queries["authority_units"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds: dict[str, float] = {}
    for name in names:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "headline queries, total wall time", "value": total, "unit": "sec", "queries": seconds,
                      "sf": os.path.basename(sf_dir.rstrip("/")), "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
