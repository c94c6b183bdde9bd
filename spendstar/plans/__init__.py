"""Plans: the load pipeline, the report queries and the query catalogue."""

from spendstar.plans.publish import publish
from spendstar.plans.reports import (
    area_rank_movement,
    expense_types_above_avg,
    expense_types_above_avg_json,
    supplier_time_hierarchy,
    top_suppliers,
    top_suppliers_monthly,
)
from spendstar.plans.warehouse import CleanSteps, Warehouse, build_warehouse, clean_steps

__all__ = [
    "CleanSteps",
    "Warehouse",
    "area_rank_movement",
    "build_warehouse",
    "clean_steps",
    "expense_types_above_avg",
    "expense_types_above_avg_json",
    "publish",
    "supplier_time_hierarchy",
    "top_suppliers",
    "top_suppliers_monthly",
]
