"""Time headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS the local
cores. ``--all`` times every registered query, ``--only a,b`` some of them. A query is
run to a no-op sink, so every row and column is produced and none is collected.
"""

from __future__ import annotations

import json
import os
import sys
import time

from larkspur.plans import all_queries
from larkspur.session import build_session

HEADLINE = """sp_migration usage_by_model daily_metrics_view alerts_5min rate_violations daily_budget price_usage
cost_anomalies clean_records validate_schema expectations upsert_by_key write_table nested_total_check chunk_fixed
ingest_documents chunk_sentence pack_context top_entities conversation_history page_text guard_chain pii_by_source
injection_scan vector_topk recommend_by_history retrieve_rerank bm25_search trigram_match majority_answer eval_gate
graph_neighbors consent_gate retention_report stream_dedupe stream_ingest""".split()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "2"))
    queries = all_queries()
    names = HEADLINE
    if "--all" in sys.argv:
        names = list(queries)
    if "--only" in sys.argv:
        names = sys.argv[sys.argv.index("--only") + 1].split(",")
    spark = build_session(
        "larkspur-bench",
        f"local[{cpus}]",
        shuffle_partitions=int(cpus),
        conf={"spark.driver.memory": "12g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries["sp_migration"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    took: dict[str, float] = {}
    for name in names:
        runs = []
        try:
            for _ in range(repeats):
                start = time.perf_counter()
                queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
                runs.append(time.perf_counter() - start)
        except Exception as error:  # one broken query must not hide the others' times
            print(f"{name} FAILED {str(error)[:300]}", file=sys.stderr, flush=True)
            continue
        took[name] = round(min(runs), 3)
        print(f"{name} {took[name]}", file=sys.stderr, flush=True)
    total = round(sum(took.values()), 3)
    print(json.dumps({"metric": "total_seconds", "value": total, "unit": "sec", "queries": took, "sf": os.path.basename(sf_dir)}))
    spark.stop()


if __name__ == "__main__":
    main()
