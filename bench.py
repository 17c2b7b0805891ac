"""Benchmark: the full load and the headline queries, one JSON line on stdout.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the cores. ``full_load`` runs calendar,
cleaning, rules, dimensions, facts and all checks into a new mart. The other queries are timed
on the loaded mart or straight on the tables, each written out in full. Every figure is the
median of ``BENCH_RUNS`` runs after one untimed run.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from lonja.plans import catalog  # noqa: E402
from lonja.plans.registry import fresh_load, loaded  # noqa: E402
from lonja.session import build_session  # noqa: E402

HEADLINE = (
    "b15_clean_sales",
    "b15_clean_contacts",
    "b8_first_per_key",
    "c12_deficit_carry",
    "c16_sales_rules",
    "d7_orphans",
    "d8_key_violations",
    "d8_value_violations",
    "d11_validation_report",
    "e1_dim_aliado",
    "e4_dim_jerarquia",
    "f1_fact_ventas",
    "g6_sales_vs_budget_by_region",
    "g7_compliance_by_specialist",
    "g12_top_allies",
    "g15_contacts_by_campaign",
    "g16_daily_compliance_by_region",
    "i1_column_profile",
    "i4_candidate_keys",
    "i8_varying_columns",
    "i11_repeated_crosses",
    "i13_domain_overlap",
)


def seconds(action, runs: int) -> float:
    action()
    times = []
    for _ in range(runs):
        start = time.perf_counter()
        action()
        times.append(time.perf_counter() - start)
    return round(statistics.median(times), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    registered = catalog.queries()
    times = {"full_load": seconds(lambda: fresh_load(spark, sf_dir), max(1, runs - 2))}
    loaded(spark, sf_dir)
    for name in HEADLINE:
        run = registered[name]
        times[name] = seconds(
            lambda: run(spark, sf_dir).write.format("noop").mode("overwrite").save(), runs
        )
    result = {
        "metric": "full load and headline queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": Path(sf_dir).name.removeprefix("sf"),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
