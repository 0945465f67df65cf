"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores. ``queries`` holds the
median of three warm runs, ``spread`` the distance between the fastest and the slowest
of them, ``cold`` the first run. The two layer builds go into a new folder each;
``en_17_enrich`` is the enrichment of a stored layer, without writing; the views read
stored layers.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from rxstrata.checks import queries as q  # noqa: E402
from rxstrata.operators import enrichment  # noqa: E402
from rxstrata.plans import runs  # noqa: E402
from rxstrata.session import build_session, prepare, staging_path  # noqa: E402

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
WARM = 3

HEADLINE = [
    "va_11_validate",
    "vw_01_data_quality_summary",
    "vw_02_common_errors",
    "vw_06_stage_monitor",
    "wn_01_efficacy_percentile",
    "ag_09_price_quartiles",
    "ag_02_group_summary",
    "vw_03_market_analysis",
    "vw_05_risk_analysis",
    "vw_07_market_intelligence",
    "vw_08_drug_risk_matrix",
    "vw_09_executive_summary",
    "dq_03_top_revenue",
    "ct_04_gold",
    "st_05_quality_5min",
    "st_10_streaming_validation",
]


def main() -> None:
    spark = build_session(
        "rxstrata-bench",
        f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": CPUS,
            "spark.driver.memory": "12g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    prepare(spark)

    def timed(action) -> tuple[float, object]:
        started = time.perf_counter()
        result = action()
        return time.perf_counter() - started, result

    def validate() -> runs.Store:
        store = runs.Store(spark, staging_path(spark, "bench"))
        runs.run_validation(store, q.AS_OF, q.raw(spark, FOLDER)).collect()
        return store

    def noop(df) -> None:
        df.write.format("noop").mode("overwrite").save()

    # every entry is run once cold and three times warm, in rounds over all entries
    times: dict[str, list[float]] = {}
    for _ in range(1 + WARM):
        seconds, store = timed(validate)
        times.setdefault("build_validated_layer", []).append(seconds)
        seconds, _ = timed(lambda: runs.run_enrichment(store, q.AS_OF).collect())
        times.setdefault("build_enriched_layer", []).append(seconds)
        seconds, _ = timed(lambda: noop(enrichment.enrich(store.read("validated", q.AS_OF), q.AS_OF)))
        times.setdefault("en_17_enrich", []).append(seconds)
    q.full_store(spark, FOLDER)
    for _ in range(1 + WARM):
        for name in HEADLINE:
            seconds, _ = timed(lambda: noop(q.QUERIES[name](spark, FOLDER)))
            times.setdefault(name, []).append(seconds)
    cold = {name: t[0] for name, t in times.items()}
    warm = {name: statistics.median(t[1:]) for name, t in times.items()}
    spread = {name: max(t[1:]) - min(t[1:]) for name, t in times.items()}

    def rounded(times: dict[str, float]) -> dict[str, float]:
        return {name: round(seconds, 3) for name, seconds in times.items()}

    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries, warm",
                "value": round(sum(warm.values()), 3),
                "unit": "sec",
                "queries": rounded(warm),
                "cold": rounded(cold),
                "spread": rounded(spread),
                "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
