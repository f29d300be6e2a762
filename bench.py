"""Bench: run the headline queries on ``$BENCH_SF_DIR`` with ``local[$BENCH_CPUS]``.

Prints one JSON line: {"metric": ..., "value": total_sec, "unit": "sec", "queries": {...}, "sf": ...}.
Each query is executed in full with the ``noop`` sink (no collect to the driver). A warm-up
query runs first so that JVM start-up is not charged to the first headline query.
"""
from __future__ import annotations

import json
import os
import re
import sys
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, HERE)

HEADLINE = [
    "agg_class_counts",        # flagship: search -> top-k -> filters -> metadata -> class counts
    "filter_min_cosine",       # exact cosine top-k with the length mask
    "join_vector_search",      # threshold join over all query x target blocks
    "fn_match_info",           # multi-domain chain search end to end
    "src_atoms",               # fixed-width record render + parse
    "agg_sequence",            # segment reader (filters, altloc, backbone) + ordered sequence
    "range_join_contacts",     # grid-cell distance join
    "win_clean_labels",        # label cleaning windows
    "agg_segment_summary",     # cleaning + renumbering + range strings + summary
    "agg_domain_stats",        # per-domain statistics
    "agg_organism_stats",      # reports written per structure, read back, summarised
    "graph_components",        # iterative label propagation
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from foldframe.plans.registry import all_queries
    from foldframe.session import get_session

    spark = get_session(f"local[{cpus}]", shuffle_partitions=int(cpus) * 2, app="foldframe-bench")
    queries = all_queries()
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    names = only or HEADLINE
    # warm-up on the smallest scale factor next to the measured one (JVM class loading, code
    # generation, Python workers): one-off costs that do not grow with the data
    warm_dir = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    if os.path.isdir(warm_dir):
        for name in names:
            queries[name](spark, warm_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        t0 = time.time()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(m.group(1)) if m else sf_dir, "cpus": int(cpus)}))
    spark.stop()


if __name__ == "__main__":
    main()
