"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is run to completion through the ``noop`` sink (every row is
computed, nothing is collected).  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from retentio.plans import catalog  # noqa: E402
from retentio.session import MATERIALIZE_CONF, local_session  # noqa: E402

HEADLINE = {
    "member_table": lambda s, d: catalog.members(s, d),
    "action_summary": catalog.d5_action_summary,
    "tradeoff_curve_base": lambda s, d: catalog.tradeoff_curve(
        catalog.scored_decisions(s, d, catalog.BASE, None), catalog.K),
    "tradeoff_curve": catalog.d9_tradeoff_curve,
    "score_scenarios": catalog.d15_score_scenarios,
    "compare_strategies": catalog.d12_compare_strategies,
    "target_profile": catalog.a12_target_kpis,
    "fairness_check": catalog.d13_fairness_check,
    "expected_loss_priority": catalog.d16_expected_loss_priority,
    "train_evaluate": catalog.l12_metrics,
}


def _sf(sf_dir: str) -> float | None:
    m = re.search(r"sf([0-9.]+)", sf_dir)
    return float(m.group(1)) if m else None


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    raw = os.environ.get("BENCH_CPUS", "8").strip()
    cpus = int(raw) if raw.isdigit() else (os.cpu_count() or 8)
    only = sys.argv[1:]
    spark = local_session(cpus, shuffle_partitions=max(8, 2 * cpus), app_name="retentio-bench")
    mode = os.environ.get("BENCH_MATERIALIZE", "table")  # the library's default
    spark.conf.set(MATERIALIZE_CONF, mode)
    # warm-up: JVM, parquet footers, codegen caches
    catalog.members(spark, sf_dir).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name, fn in HEADLINE.items():
        if only and name not in only:
            continue
        t0 = time.perf_counter()
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec",
                      "queries": times, "sf": _sf(sf_dir), "cpus": cpus,
                      "materialize": mode}))
    spark.stop()


if __name__ == "__main__":
    main()
