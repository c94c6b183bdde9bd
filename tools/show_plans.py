"""Print the final physical plan of every load step and report (after AQE).

Usage: python tools/show_plans.py [sf_dir] > docs/PLANS.md
Each DataFrame is collected first, so the text is the final adaptive plan
Spark actually ran.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from spendstar.operators.cleaning import dedup  # noqa: E402
from spendstar.operators.fact import star_join  # noqa: E402
from spendstar.plans import reports  # noqa: E402
from spendstar.plans.catalog import steps_for, warehouse_for  # noqa: E402
from spendstar.session import local_session  # noqa: E402


def final_plan(df) -> str:
    text = df._jdf.queryExecution().executedPlan().toString()
    # expression ids and plan ids change run to run; drop them for a stable read
    text = re.sub(r"#\d+L?", "", text)
    text = re.sub(r", \[plan_id=\d+\]", "", text)
    text = re.sub(r"Location: InMemoryFileIndex\([^)]*\)\[[^\]]*\]", "Location: <table>", text)
    # keep what a reader checks on a scan (columns, filters), drop the rest
    text = re.sub(r", ReadSchema: struct<.*", "", text)
    text = text.replace("Batched: true, ", "").replace("Format: Parquet, ", "")
    return text


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session()
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")  # print scan metadata whole
    wh = warehouse_for(spark, sf_dir)
    steps = steps_for(spark, sf_dir)
    items = {
        "dedup (clean phase)": dedup(steps.typed),
        "fact load, before it is dealt to files": star_join(wh.clean, wh.dims),
        "top_suppliers": reports.top_suppliers(wh),
        "top_suppliers_monthly": reports.top_suppliers_monthly(wh),
        "expense_types_above_avg": reports.expense_types_above_avg(wh),
        "expense_types_above_avg_json": reports.expense_types_above_avg_json(wh),
        "area_rank_movement": reports.area_rank_movement(wh),
        "supplier_time_hierarchy": reports.supplier_time_hierarchy(wh),
    }
    print(f"# Final physical plans ({os.path.basename(sf_dir.rstrip('/'))}, local[*], AQE on)\n")
    print("Generated by `python tools/show_plans.py`; expression and plan ids removed.\n")
    for name, df in items.items():
        df.collect()
        print(f"## {name}\n\n```\n{final_plan(df)}\n```\n")
    spark.stop()


if __name__ == "__main__":
    main()
