"""spendstar: a spend warehouse on Spark.

Raw payment files -> tolerant staging -> reject list and redaction ->
typed, de-duplicated clean rows -> five dimensions and a fact table ->
reports (top suppliers, expense types above average, expense-area rank
movement, supplier time hierarchy).  Built from DataFrame built-ins only.
"""

from spendstar.plans import (
    Warehouse,
    area_rank_movement,
    build_warehouse,
    clean_steps,
    expense_types_above_avg,
    expense_types_above_avg_json,
    publish,
    supplier_time_hierarchy,
    top_suppliers,
    top_suppliers_monthly,
)
from spendstar.sources import read_reject_list, read_spend, write_reject_list, write_spend

__all__ = [
    "Warehouse",
    "area_rank_movement",
    "build_warehouse",
    "clean_steps",
    "expense_types_above_avg",
    "expense_types_above_avg_json",
    "publish",
    "read_reject_list",
    "read_spend",
    "supplier_time_hierarchy",
    "top_suppliers",
    "top_suppliers_monthly",
    "write_reject_list",
    "write_spend",
]
