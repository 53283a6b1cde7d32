"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores.
BENCH_QUERIES, a comma separated list of names, overrides the selection.
"""
from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "daily_volume", "weekly_volume_wow", "active_communities", "category_distribution", "domain_coverage",
    "standardize_opportunities", "classify_topic", "topic_match", "dedup_url", "snapshot_build", "quality_report",
    "trending_tfidf", "trending_fallback", "profile_terms", "keyword_ranker", "good_first_issue", "knn_topk", "knn_dot",
    "candidate_join", "final_scores", "rerank_simple", "rerank_mmr", "rank_and_rerank", "skip_penalty", "topic_summary",
    "proxy_labels", "ndcg_at_k", "variant_comparison", "feedback_vectors", "preference_grades", "quota_sample",
    "archive_events", "hits_items_join", "stream_dedup", "stream_feedback",
)


def main() -> None:
    from pulserank.plans import catalog
    from pulserank.session import build_session

    cpus = os.environ.get("BENCH_CPUS", "8")
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = build_session(
        "bench", f"local[{cpus}]", **{
            "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "16g",
            "spark.ui.showConsoleProgress": "false",
        }
    )
    spark.sparkContext.setLogLevel("ERROR")
    catalog.load()
    catalog.QUERIES["daily_volume"](spark, sf_dir).collect()  # starts the engine
    times, failed = {}, {}
    for name in names:
        start = time.time()
        try:
            catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.time() - start, 3)
        except Exception as error:  # one broken query must not hide the others
            failed[name] = f"{type(error).__name__}: {str(error)[:200]}"
    line = {
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")),
    }
    if failed:
        line["failed"] = failed
    print(json.dumps(line), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
