"""The toy spend file with hand-checkable answers (FIXTURES.md section 4)."""

from __future__ import annotations

from spendstar.constants import SPEND_COLUMNS

# Department, Entity, Date, Type, Area, Supplier, Txn, Amount, Postcode, SupplierType
ROWS = [
    ("BIS", "HQ", "15/01/2013", "Travel", "North", "ACME LTD", "T01", "100.00", "AB1", "SME"),
    ("BIS", "HQ", "15/01/2013", "Travel", "North", "ACME LTD", "T01", "100.00", "AB1", "SME"),
    ("BIS", "HQ", "15/01/2013", "Travel", "North", " ACME LTD", "T01", "100.00", "AB1", "SME"),
    ("BIS", "HQ", "31/02/2013", "Travel", "North", "ACME LTD", "T02", "50.00", "AB1", "SME"),
    ("BIS", "HQ", "1/3/2013", "Rent", "South", "ACME LTD", "T03", "1,234.56", "", None),
    ("BIS", " ", "05/03/2013", "Rent", "South", "BETA", "T04", "10.00", "B1", "SME"),
    ("BIS", "HQ", "05/03/2013", "Rent", "South", None, "T05", "20.00", "B1", "SME"),
    ("BIS", "HQ", "05/03/2013", "Rent", "South", " BAD CO ", "T06", "99.00", "B1", "SME"),
    ("BIS", "HQ", "28/02/2013", "Travel", "South", "BETA", "T07", "70.00", "B1", "SME"),
    ("BIS", "HQ", "06/03/2013", "Rent", "South", "Jo Personal Expense", "T08", "5.00", "", "SME"),
    ("BIS", "HQ", "06/03/2013", "Rent", "South", "BAD Name Withheld", "T09", "7.00", None, "SME"),
    ("BIS", "HQ", "30/04/2013", "Travel", "North", "BETA", "T10", "300.00", "B1", "SME"),
    ("BIS", "HQ", "30/04/2013", "Rent", "South", "BETA", "T11", "300.00", "B2", "SME"),
    ("BIS", "HQ", "30/04/2013", "Misc", "East", "GAMMA", "T12", "12.345", "G1", "SME"),
]

REJECTS = ["BAD CO"]

_FIELDS = ("Department", "Entity", "DateOfPayment", "ExpenseType", "ExpenseArea", "Supplier",
           "TransactionNumber", "Amount", "SupplierPostCode", "SupplierType")


def staging(spark):
    """The toy rows in the 14-column staging shape (unlisted fields NULL)."""
    rows = []
    for r in ROWS:
        d = dict(zip(_FIELDS, r))
        rows.append(tuple(d.get(c) for c in SPEND_COLUMNS))
    schema = ", ".join(f"{c} string" for c in SPEND_COLUMNS)
    return spark.createDataFrame(rows, schema)


def rejects(spark):
    return spark.createDataFrame([(n,) for n in REJECTS], "SupplierName string")
