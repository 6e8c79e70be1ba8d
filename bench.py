"""Benchmark: star build plus the headline views, checks and measures.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_REPEAT (default 3). Prints one JSON line. ``value`` is the star build
(order lines → cleaned → star written) plus the median time of each
headline query over the written star. Queries run to completion through the
no-op sink, so nothing is collected to the driver.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ledgerline import registry as P  # noqa: E402
from ledgerline.session import local_session  # noqa: E402

HEADLINE = (
    "vw_executive_kpis", "vw_monthly_sales_profit", "vw_category_profitability",
    "vw_product_profitability", "vw_region_performance", "vw_customer_profitability",
    "vw_segment_profitability", "vw_discount_impact", "vw_shipping_performance",
    "vw_product_pareto", "vw_loss_making_products", "vw_sales_detail",
    "pk_violations", "fk_violations", "control_totals",
    "portfolio_segments", "rank_customers", "loss_concentration", "yoy_sales",
    "high_sales_low_profit", "conflict_summary",
)


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    spark = local_session(cores=cpus, shuffle_partitions=cpus)
    timings: dict[str, float] = {}
    t0 = time.perf_counter()
    P.star(spark, sf_dir)
    timings["star_build"] = time.perf_counter() - t0
    t0 = time.perf_counter()
    P._variants(spark, sf_dir)
    timings["conflict_variants"] = time.perf_counter() - t0
    for name in HEADLINE:
        runs = []
        for _ in range(repeat):
            t = time.perf_counter()
            run(P.QUERIES[name](spark, sf_dir))
            runs.append(time.perf_counter() - t)
        timings[name] = statistics.median(runs)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "star_build_plus_headline_queries_median",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": {k: round(v, 3) for k, v in timings.items()},
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "cpus": cpus,
        "shuffle_partitions": cpus,
        "spark": spark.version,
    }))


if __name__ == "__main__":
    main()
