"""Bench: the full load and the five reports at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints ONE JSON line: {"metric": "...", "value": total_sec, "unit": "sec",
"queries": {...}, "sf": ...}.

The inputs are what the reference loads: tab-delimited spend files and a
reject-list XML.  They are derived once from the driver's tables
(``prepare_inputs``, reported but not part of ``value``) into the scratch
folder.  ``load`` is then the whole pipeline from those files to a
materialised star schema (text scan, reject list, redaction, typing, dedup,
five dimensions, fact; ``load_phases`` splits it).  Each report runs cold
on that warehouse into Spark's ``noop`` sink, then once more warm
(``warm``).  ``value`` is load + cold reports.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from spendstar.plans import reports  # noqa: E402
from spendstar.plans.warehouse import build_warehouse  # noqa: E402
from spendstar.session import local_session, scratch_path  # noqa: E402
from spendstar.sources.delimited import read_spend, write_spend  # noqa: E402
from spendstar.sources.reject_list import read_reject_list, write_reject_list  # noqa: E402
from spendstar.sources.tpch_adapter import rejects_from_tpch, spend_from_tpch  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None
    spark = local_session(cores=cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8,
                          app="spendstar-bench", driver_memory="16g")

    t0 = time.perf_counter()
    spend_dir = scratch_path(spark, "bench-spend")
    reject_dir = scratch_path(spark, "bench-rejects")
    write_spend(spend_from_tpch(spark, sf_dir), spend_dir)
    write_reject_list(rejects_from_tpch(spark, sf_dir), reject_dir)
    prepare = time.perf_counter() - t0

    times: dict[str, float] = {}
    phases: dict[str, float] = {}
    t0 = time.perf_counter()
    staging = read_spend(spark, spend_dir, lineage=False)
    rejects = read_reject_list(spark, reject_dir)
    wh = build_warehouse(staging, rejects, timings=phases)
    times["load"] = time.perf_counter() - t0

    runs = {
        "top_suppliers": lambda: reports.top_suppliers(wh),
        "top_suppliers_monthly": lambda: reports.top_suppliers_monthly(wh),
        "expense_types_above_avg": lambda: reports.expense_types_above_avg(wh),
        "expense_types_above_avg_json": lambda: reports.expense_types_above_avg_json(wh),
        "area_rank_movement": lambda: reports.area_rank_movement(wh),
        "supplier_time_hierarchy": lambda: reports.supplier_time_hierarchy(wh),
    }

    def run(fn) -> float:
        t = time.perf_counter()
        # The noop sink runs the whole plan on the executors without shipping
        # rows to Python, so the time is the engine's, not the client's.
        fn().write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t

    rows = {}
    for name, fn in runs.items():
        times[name] = run(fn)
        rows[name] = fn().count()
    warm = {name: run(fn) for name, fn in runs.items()}
    total = sum(times.values())
    print(json.dumps({
        "metric": "spend_load_plus_reports",
        "value": round(total, 3),
        "unit": "sec",
        "queries": {k: round(v, 3) for k, v in times.items()},
        "load_phases": {k: round(v, 3) for k, v in phases.items()},
        "warm": {k: round(v, 3) for k, v in warm.items()},
        "prepare_inputs": round(prepare, 3),
        "rows": rows,
        "counters": wh.counters,
        "sf": sf,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
