"""Benchmark the headline queries at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` and print ONE JSON line.

Each query is forced end to end with the ``noop`` sink (full computation, nothing collected). All
queries run twice to warm up, then ``$BENCH_RUNS`` rounds (default 3) are timed, each round starting
at another query, so that none always comes first; the median is reported.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pvspark.session import local_session  # noqa: E402

HEADLINE = [
    "mart_adverse_profile",      # one fact scan, shared pre-aggregate
    "mart_adverse_naive",        # same result, one scan + shuffle per branch (comparison)
    "silver_reports",            # window dedup (row_number = 1)
    "silver_reports_min_by",     # min_by dedup (partial aggregation)
    "mart_master",               # silver x4 -> 3 marts -> 4-way join
    "extract_reports",           # nested JSON parse + flatten
    "suite_reports",             # 9 checks in one pass + 1 grouped pass
    "mention_rates",
    "knn_filtered",              # 10 queries, k = 5
    "knn_all",
    "extract_articles",          # XPath over article XML
    "tfidf_knn",
    "stream_dedup",              # availableNow drain of the message files
]

WARM_UP = 2


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "16")),
                          app="pvspark-bench")
    from pvspark.plans import QUERIES
    import pvspark.plans.bench_only  # noqa: F401  (comparison forms, not registered queries)
    from pvspark.plans.bench_only import EXTRA

    names = [n for n in (sys.argv[1:] or HEADLINE)]
    times: dict[str, list[float]] = {n: [] for n in names}
    failed = set()
    for r in range(WARM_UP + runs):
        shift = r * max(1, len(names) // (WARM_UP + runs)) % max(1, len(names))
        for n in names[shift:] + names[:shift]:
            if n in failed:
                continue
            fn = QUERIES.get(n) or EXTRA[n]
            try:
                t0 = time.perf_counter()
                fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
                times[n].append(time.perf_counter() - t0)
            except Exception as e:  # noqa: BLE001
                print(f"bench {n} failed: {type(e).__name__}: {str(e)[:300]}", file=sys.stderr)
                failed.add(n)
    out = {n: None if n in failed else round(statistics.median(times[n][WARM_UP:]), 3) for n in names}
    total = round(sum(v for v in out.values() if v is not None), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_queries_total_median_sec", "value": total, "unit": "sec",
                      "queries": out, "sf": sf, "cpus": cpus, "runs": runs}))


if __name__ == "__main__":
    main()
