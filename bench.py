"""Times the headline queries and prints one JSON line.

Every query is computed in full into a sink that discards its rows. The first
query that needs the statistics or the rollup pays for building them:
``build_statistics`` and ``build_rollup`` show those costs on their own.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tallybook.plans import registry  # noqa: E402
from tallybook.session import local_session  # noqa: E402

ROW_LEVEL = ("clean_tokens", "impute_price", "clean_full", "profile_nulls", "profile_duplicates",
             "validate_clean", "features_cost_dim", "engineered_full", "validate_features")
REPORTS = (
    "kpi_executive", "kpi_monthly", "kpi_quarterly", "kpi_product_quadrants", "kpi_channel",
    "kpi_payment", "kpi_anomalies", "kpi_forecast", "kpi_recommendations", "report_lines",
    *(f"sql_{q}" for q in ("q1_1", "q1_2", "q2_1", "q2_2", "q2_3", "q3_1", "q3_2", "q3_3", "q4_1",
                           "q4_2", "q4_3", "q5_1", "q5_2", "q6_1", "q6_2")),
    "measure_core", "measure_mom_calendar", "measure_yoy", "measure_ytd", "measure_contribution",
    "measure_rank_with_total", "measure_top_n", "view_kpi_cards", "view_heatmap_pivot",
    "view_driver_tree", "view_price_volume", "rfm_segments",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores)

    def consume(df) -> None:
        df.write.format("noop").mode("overwrite").save()

    def seconds(job) -> float:
        start = time.perf_counter()
        job()
        return round(time.perf_counter() - start, 3)

    # Start the engine on the data's footers only.
    spark.read.parquet(f"{folder}/region.parquet").count()
    tables = registry.Tables(spark, folder)
    timings = {
        "build_statistics": seconds(tables.statistics),
        "build_rollup": seconds(tables.sales),
    }
    run = registry.queries()
    for name in (*ROW_LEVEL, *REPORTS):
        timings[name] = seconds(lambda: consume(run[name](spark, folder)))
    print(json.dumps({
        "metric": "total_seconds",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
