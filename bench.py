"""Benchmark of the headline queries.

Runs each query on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) with
``local[$BENCH_CPUS]`` and prints one JSON line.  Every query starts from
the raw tables (fitted corpora are dropped between queries) and is forced
with a no-op write, so each time is its full work.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import rostrum  # noqa: E402,F401  (pins BLAS threads before numpy loads)
from rostrum.plans import catalog, corpora  # noqa: E402
from rostrum.session import get_session  # noqa: E402

HEADLINE = [
    "top_keywords_per_year",
    "keywords_per_member",
    "tfidf_members",
    "search",
    "batch_search",
    "top_member_pairs",
    "polarity_trend",
    "top_negative_words",
    "merge_speeches",
    "cluster_representatives",
    "silhouette",
    "lsi_concepts",
]


def _reset():
    for v in corpora._MEMO.values():
        for obj in v if isinstance(v, tuple) else (v,):
            if hasattr(obj, "unpersist"):
                obj.unpersist()
    corpora._MEMO.clear()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = get_session(f"local[{cpus}]", shuffle_partitions=int(cpus) * 2)
    qs = catalog.queries()
    # warm-up: JVM, Python workers (not timed)
    spark.range(1000).selectExpr("sum(id)").collect()
    times = {}
    for name in names:
        _reset()
        t0 = time.time()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
