"""Benchmark: one cold run, then the median of warm runs, each written whole to a noop sink.

Prints one JSON line. ``BENCH_SF_DIR``, ``BENCH_CPUS``, ``BENCH_RUNS`` and
``BENCH_QUERIES`` (``all`` or a comma list) change the defaults.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from tidemill.plans import load_queries
from tidemill.session import local_session

HEADLINE = [
    "pipe_monthly_spend", "pipe_daily_sales", "pipe_clv", "pipe_top_categories", "pipe_foreign", "pipe_error_log",
    "pipe_order_summary", "pipe_store_metrics", "pipe_kpi_stars", "pipe_trade_enrich", "pipe_cross_stage",
    "pipe_scd_clients", "pipe_lead_features", "pipe_lead_selection",
    "expr_notional", "cast_type_map", "join_star_left", "join_multi_key", "join_anti", "join_period_overlap",
    "join_point_in_period", "join_ip_range", "join_fuzzy", "agg_group_multi", "agg_distinct", "agg_pivot", "agg_rollup",
    "agg_status_fold", "agg_terciles", "win_global_rank", "win_ranks", "win_partition_total", "win_pct_rank_avg",
    "win_latest_per_key", "set_diff", "dq_suite", "cdc_classify", "cdc_scd2_merge", "load_upsert", "ts_gap_fill",
    "ts_business_days", "json_open", "json_project", "hierarchy_rollup", "corpus_rule_scan", "corpus_path_inventory",
    "graph_components", "graph_ancestors", "feat_trailing", "feat_moving_avg", "feat_rfm", "synth_domain",
    "synth_join_aware", "recon_compare", "ml_batch_score",
]


def once(query, spark, path: str) -> float:
    began = time.perf_counter()
    query.run(spark, path).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def main() -> None:
    path = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    wanted = os.environ.get("BENCH_QUERIES", "")
    known = load_queries()
    names = list(known) if wanted == "all" else [n for n in wanted.split(",") if n] or HEADLINE
    spark = local_session("bench", cpus)
    cold, warm = {}, {}
    for name in names:
        cold[name] = round(once(known[name], spark, path), 3)
        times = [once(known[name], spark, path) for _ in range(runs)]
        warm[name] = round(statistics.median(times), 3) if times else cold[name]
    print(
        json.dumps(
            {
                "metric": "total_seconds_of_warm_medians",
                "value": round(sum(warm.values()), 3),
                "unit": "sec",
                "queries": warm,
                "cold": cold,
                "sf": os.path.basename(path.rstrip("/")),
                "cpus": cpus,
                "runs": runs,
                "spark": spark.version,
                "shuffle_partitions": spark.conf.get("spark.sql.shuffle.partitions"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
