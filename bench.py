"""Wall seconds of the headline queries; prints one JSON line.

``BENCH_SF_DIR`` (default sf0.1) and ``BENCH_CPUS`` (default 8) choose the data and the local cores. Every query is
planned and run to the end into a sink that drops the rows, so all columns are computed; the figure is the median of three
runs (``BENCH_RUNS``).
"""

from __future__ import annotations

import json
import os
import statistics
import time

from agentlake.core import build_session
from agentlake.plans import load_all

HEADLINE = (
    "a1_stock_snapshot", "a3_cash_balance", "a4_financial_report", "a5_top_sellers", "a7_purchase_summary", "j2_inventory_value",
    "j4_as_of_stock", "w1_running_stock", "w1_running_cash", "x1_quote_lines", "x2_ledger_writes", "a6_overall_status",
    "p5_j1_search_quotes", "w2_recent_history", "w5_first_come_capacity", "w8_task_order_deterministic", "w13_supply_grants",
    "j10_recipe_sufficiency", "x3_allocate", "p12_masked_claims", "v7_similar_claims", "v13_fraud_rules", "v5_tfidf_search",
    "v14_fraud_assessment", "v4_vector_query", "k4_top_k_per_query", "v9_rag_context", "v10_memory_search", "w4_recent_context",
    "v1_chunk_documents", "v3_embed_documents", "m1_complete", "m2_parse_structured", "e2_single_step", "e3_trajectory",
    "j8_a15_interest_hits", "w11_step_transitions", "t1_streaming_stock", "t2_streaming_sessions",
)
LATER = (
    "x3_allocate_contested", "k4_top_k_many_queries", "v5_tfidf_search_many", "t1_streaming_balances", "t3_streaming_requests",
    "m6_dependent_routes", "v15_routed_collections",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("agentlake-bench", master=f"local[{cpus}]", partitions=int(cpus) if cpus.isdigit() else 8)
    queries, _ = load_all()

    def run(name: str) -> float:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.mode("overwrite").format("noop").save()
        return time.perf_counter() - start

    for name in ("a1_stock_snapshot", "x1_quote_lines", "v3_embed_documents"):  # warm the JVM and the Python workers
        run(name)
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    seconds = {name: round(statistics.median(run(name) for _ in range(runs)), 3) for name in HEADLINE + LATER}
    print(json.dumps({
        "metric": "headline_queries_total_wall", "value": round(sum(seconds[name] for name in HEADLINE), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
