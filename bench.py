"""Times the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_ONLY
(comma-separated query names), BENCH_RUNS (default 1; the best run counts).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "a6_title_value_counts",
    "a12_histogram",
    "a13_title_variants",
    "l10_admitted_links",
    "f1_reachable",
    "f6_page_states",
    "h2_select_elements",
    "h6_ingredient_groups",
    "h16_recipe_rows",
    "i28_default_weights",
    "i27_alternatives",
    "i30_conversion_lookup",
    "g1_weight_shares",
    "g3_averaged_recipes",
    "g4_coverage",
    "s6_key_rule",
    "f2_page_limit",
    "f7_reach_redirected",
    "h17_site_layouts",
    "t1_incremental_scrape",
]


def main() -> None:
    from larder.plans import catalog
    from larder.session import build_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = catalog.all_queries()
    names = [n for n in os.environ.get("BENCH_ONLY", "").split(",") if n] or HEADLINE
    # one small query first, so that starting the JVM is not charged to a query
    queries["a6_title_value_counts"](spark, sf_dir).collect()
    times = {}
    for name in names:
        runs = []
        for _ in range(int(os.environ.get("BENCH_RUNS", "1"))):
            start = time.perf_counter()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        times[name] = round(min(runs), 3)
        print(name, times[name], file=sys.stderr, flush=True)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
