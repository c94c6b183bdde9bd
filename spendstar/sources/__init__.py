"""Sources and sinks: delimited spend files, reject-list XML, Parquet tables."""

from spendstar.sources.delimited import read_spend, write_spend
from spendstar.sources.reject_list import (
    RejectListError,
    check_documents,
    read_reject_list,
    write_reject_list,
)
from spendstar.sources.tables import materialize
from spendstar.sources.tpch_adapter import rejects_from_tpch, spend_from_tpch

__all__ = [
    "RejectListError",
    "check_documents",
    "materialize",
    "read_reject_list",
    "read_spend",
    "rejects_from_tpch",
    "spend_from_tpch",
    "write_reject_list",
    "write_spend",
]
