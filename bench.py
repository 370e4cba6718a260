"""Benchmark: run the headline queries of the fraud analysis in pipeline
order on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) with
``local[$BENCH_CPUS]`` and print ONE JSON line.

Each query is executed completely (``write.format("noop")``), timed on its
own; a query that first needs a stage (components, similarity, PageRank,
forest, Louvain) pays for computing and writing that stage, exactly once
per run, the way the analysis writes a property before later queries
read it.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "identifier_degrees",
    "ratio_buckets_card_flagged",
    "er_p2p_shared_card",
    "er_shared_ids",
    "wcc_size_stats",
    "community_report",
    "p2p_flagged_share",
    "ratio_buckets_device_risk",
    "weighted_degree_top",
    "node_similarity",
    "similar_to_communities",
    "pagerank_p2p_sent",
    "user_feature_table",
    "roc_points",
    "rf_predictions",
    "louvain",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from riskgraph.plans.queries import QUERIES
    from riskgraph.session import get_session

    spark = get_session(f"local[{cpus}]", int(cpus) * 2,
                        extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    times: dict[str, float] = {}
    for name in HEADLINE:
        t0 = time.perf_counter()
        df = QUERIES[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    total = round(sum(times.values()), 3)
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({"metric": "fraud_pipeline_total", "value": total, "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
                      "cpus": int(cpus)}))


if __name__ == "__main__":
    main()
