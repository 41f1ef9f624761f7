"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line.

Each query is run once to warm up and then timed; its whole result is
produced (written to a sink that discards it). Fits run once, with the published settings. The mart is built once as the
table the other queries scan, then built again for ``mart_build``.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from farol import queries as q  # noqa: E402
from farol.plans.mart import save_mart  # noqa: E402
from farol.session import build_session, new_path  # noqa: E402
from farol.sources.gold import gold_mart  # noqa: E402
from farol.sources.star import Star  # noqa: E402

HEADLINE = [
    "a1_municipal_same_year", "a2_school_prior_rate", "a5_census_cell", "a6_indicator_cell", "j3_prior_year_join",
    "j3_salted_join", "mart_rollup", "a13_duplicate_students", "a16_null_profile", "a18_describe",
    "a19_correlations", "a23_box_stats", "a28_id_audit", "m1_group_split", "m3_stratified_folds",
    "m14_target_encode_oof", "a26_confusion", "a27_roc_auc", "m23_threshold_sim", "m29_risk_ranking",
    "m30_goal_projection", "w1_global_rank", "m20_median_stop", "m15_logistic", "m16_forest",
]


def main() -> None:
    base = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("farol-bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false", "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
    })
    spark.sparkContext.setLogLevel("OFF")
    spark.range(1000).selectExpr("sum(id)").collect()
    times: dict[str, float] = {}
    gold_mart(spark, base)
    start = time.perf_counter()
    save_mart(Star(spark, base), new_path(spark, "mart-timed"))
    times["mart_build"] = round(time.perf_counter() - start, 3)
    by_name = {f.__name__: f for f in q.QUERIES}
    wanted = os.environ.get("BENCH_QUERIES", "").split(",") if os.environ.get("BENCH_QUERIES") else HEADLINE
    for name in wanted:
        for _ in range(1 if name in {"m15_logistic", "m16_forest"} else 2):
            start = time.perf_counter()
            by_name[name](spark, base).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(base.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
