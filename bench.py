"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_RUNS (default 3).
Seconds are the median of the runs in one warm session, results written to the noop sink.
"""

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from thermolake.plans import inputs  # noqa: E402
from thermolake.plans.queries import registered  # noqa: E402
from thermolake.session import local_session  # noqa: E402

HEADLINE = [
    "contract_accepted", "contract_error_counts", "silver_latest", "silver_upsert", "upsert_diff",
    "kpi_daily", "gate_report", "gate_quarantine", "order_checks", "compound_dups",
    "lineitem_checks", "chunks", "term_stats", "postings", "bm25_topk", "dense_topk",
    "dense_text_topk", "rrf_fused", "funnel", "answers", "run_status", "events_pivot",
]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = local_session("bench", cores)
    seconds = {}
    if not sys.argv[1:]:
        start = time.time()
        inputs.text_index(spark, sf_dir)
        seconds["text_index_build"] = round(time.time() - start, 3)
    for name in names:
        taken = []
        for _ in range(runs):
            start = time.time()
            registered()[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.time() - start)
        seconds[name] = round(statistics.median(taken), 3)
        print(name, [round(t, 2) for t in taken], file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "sum of median query seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cores": cores,
                "rows": {t: inputs.table(spark, sf_dir, t).count() for t in ("events", "documents", "lineitem", "orders")},
            }
        )
    )


if __name__ == "__main__":
    main()
