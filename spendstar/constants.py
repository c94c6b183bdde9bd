"""Fixed values the warehouse must reproduce exactly.

Everything here is a contract with the input files or with report consumers:
column names, the redaction rule, the JSON root, decimal shapes.  Keep the
lists in their natural order; nothing is derived at runtime.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: staging layout (14 text fields, in file order) -----------
SPEND_COLUMNS = (
    "Department",
    "Entity",
    "DateOfPayment",
    "ExpenseType",
    "ExpenseArea",
    "Supplier",
    "TransactionNumber",
    "Amount",
    "Description",
    "SupplierPostCode",
    "SupplierType",
    "ContractNumber",
    "ProjectCode",
    "ExpenditureType",
)

# --- fixed values: natural key of a payment ---------------------------------
NATURAL_KEY = ("TransactionNumber", "Supplier", "Amount", "DateOfPayment")

# --- fixed values: redaction of personal names ------------------------------
REDACT_PATTERNS = ("Personal Expense", "Name Withheld")
REDACTED_SUPPLIER = "REDACTED_PERSONAL_EXPENSE"

# --- fixed values: reject-list XML shape -------------------------------------
REJECT_ROOT_TAG = "Suppliers"
REJECT_ROW_TAG = "Supplier"
REJECT_ATTRIBUTE = "SupplierName"

# --- fixed values: parsing ----------------------------------------------------
DAY_FIRST_DATE = "d/M/yyyy"  # dd/mm/yyyy, leading zeros optional
# A plain decimal number: optional sign, digits with an optional fraction.
# No thousands separators, currency signs, brackets or exponents.
PLAIN_NUMBER = r"^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)$"

# --- fixed values: JSON report root ------------------------------------------
EXPENSE_JSON_ROOT = "ExpenseTypesAboveAverage"

# --- fixed values: column types -----------------------------------------------
AMOUNT_TYPE = T.DecimalType(18, 2)  # a single payment
TOTAL_TYPE = T.DecimalType(38, 2)  # any sum of payments
RATIO_TYPE = T.DecimalType(38, 6)  # averages and percentages

# Declared text lengths of the star schema (checked, never truncated).
TEXT_LIMITS = {
    "DimOrganisation": {"Department": 255, "Entity": 255},
    "DimSupplier": {"SupplierName": 255, "SupplierPostCode": 50, "SupplierType": 255},
    "DimExpenseType": {"ExpenseType": 255},
    "DimExpenseArea": {"ExpenseArea": 255},
    "DimDate": {"MonthName": 20},
    "FactInvoice": {"TransactionNumber": 100},
    "InvalidSuppliers": {"SupplierName": 255},
}

SPEND_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in SPEND_COLUMNS])
