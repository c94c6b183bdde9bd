"""DataFrame operators of the load: cleaning, keys, dimensions, fact, audits."""

from spendstar.operators.audit import clean_vs_fact, integrity, stage_counters
from spendstar.operators.cleaning import (
    dedup,
    duplicate_audit,
    mark_rejected,
    redact,
    reject_suppliers,
    type_columns,
)
from spendstar.operators.dimensions import (
    build_date_dimension,
    build_dimension,
    build_dimensions,
)
from spendstar.operators.fact import build_fact, fact_rows, match_dimensions, unmatched
from spendstar.operators.keys import dense_keys, row_ids

__all__ = [
    "build_date_dimension",
    "build_dimension",
    "build_dimensions",
    "build_fact",
    "clean_vs_fact",
    "dedup",
    "dense_keys",
    "duplicate_audit",
    "fact_rows",
    "integrity",
    "mark_rejected",
    "match_dimensions",
    "redact",
    "reject_suppliers",
    "row_ids",
    "stage_counters",
    "type_columns",
    "unmatched",
]
