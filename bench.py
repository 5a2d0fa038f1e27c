"""Times the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from screenline.plans import catalog
from screenline.session import build_session

HEADLINE = (
    "triage_first",
    "triage_second",
    "match_terms",
    "prescreen",
    "review_fulltext",
    "feedback",
    "evidence_windows",
    "normalize_jats",
    "dedupe_with_provenance",
    "blocked_venues",
    "query_sample",
    "review_batches",
    "replay_state",
    "fold_read_state",
    "shortlist",
    "check_triage_coverage",
    "coverage_counts",
    "loop_decisions",
    "link_candidates",
    "stream_fold",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "16g"),
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    registered = catalog.queries()
    chosen = sys.argv[1:] or HEADLINE
    # One small query first, so that no headline query pays for the start.
    registered["norm_venue"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in chosen:
        start = time.perf_counter()
        registered[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    sf = os.path.basename(sf_dir.rstrip("/"))
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": sf,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
