"""DuckDB SQL that computes every registered query independently.

Written from the rules of the load and the reports, not from the Spark code, so
the comparison checks our re-expression.  Types are cast to what Spark
returns: INTEGER for years, months, ranks and keys; DECIMAL(38,2) for
money; DECIMAL(38,6) for averages and percentages, computed with exact
integer arithmetic and rounded half away from zero (DuckDB's decimal AVG
and division go through DOUBLE).

The tables ``lineitem orders part supplier nation region`` are views.
"""

from __future__ import annotations

from spendstar.constants import (
    EXPENSE_JSON_ROOT,
    REDACTED_SUPPLIER,
    SPEND_COLUMNS,
)
from spendstar.operators.fact import DIAGNOSTIC_NAMES

NF = " NULLS FIRST"


def _number_pattern() -> str:
    """A sign at most, then digits with at most one point and at least one digit."""
    return r"[+-]?(\d+\.?\d*|\.\d+)"


REJECT_RULE, SHORT_REJECT_RULE = "s_suppkey % 4 = 3", "s_suppkey % 20 = 3"
STAGING = f"""
payments AS (
  SELECT l.l_orderkey AS k, l.l_linenumber AS ln, l.l_extendedprice, l.l_returnflag,
         l.l_linestatus, l.l_shipdate, o.o_orderpriority, p.p_name, p.p_type, p.p_brand,
         s.s_name, s.s_nationkey, n.n_name, r.r_name
  FROM lineitem l
  JOIN part p ON l.l_partkey = p.p_partkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation n ON s.s_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
  JOIN orders o ON l.l_orderkey = o.o_orderkey
),
staging_once AS (
  SELECT
    CASE WHEN k % 47 = 0 AND ln % 2 = 0 THEN NULL
         WHEN k % 47 = 0 THEN '  '
         ELSE r_name END AS Department,
    CASE WHEN k % 19 = 0 THEN '  ' ELSE n_name END AS Entity,
    CASE WHEN k % 13 = 0 THEN '31/02/2001'
         WHEN k % 5 = 0 THEN strftime(l_shipdate, '%-d/%-m/%Y')
         ELSE strftime(l_shipdate, '%d/%m/%Y') END AS DateOfPayment,
    CASE WHEN k % 43 = 0 AND ln % 2 = 0 THEN NULL
         WHEN k % 43 = 0 THEN '  '
         ELSE p_type END AS ExpenseType,
    CASE WHEN k % 23 = 0 THEN NULL ELSE p_brand END AS ExpenseArea,
    CASE WHEN k % 37 = 0 THEN 'Name Withheld'
         WHEN k % 31 = 0 THEN 'Personal Expense ' || CAST(ln AS VARCHAR)
         WHEN k % 29 = 0 THEN NULL
         WHEN k % 11 = 0 THEN ' ' || s_name || ' '
         ELSE s_name END AS Supplier,
    CAST(k AS VARCHAR) || '-' || CAST(ln AS VARCHAR) AS TransactionNumber,
    CASE WHEN k % 41 = 0 THEN '1e3'
         WHEN k % 17 = 0 THEN '1,234.56'
         ELSE CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) END AS Amount,
    p_name AS Description,
    CASE WHEN k % 7 = 0 AND ln % 2 = 0 THEN NULL
         WHEN k % 7 = 0 THEN ''
         ELSE 'PC' || CAST(s_nationkey AS VARCHAR) END AS SupplierPostCode,
    l_linestatus AS SupplierType,
    CAST(k AS VARCHAR) AS ContractNumber,
    o_orderpriority AS ProjectCode,
    l_returnflag AS ExpenditureType,
    k
  FROM payments
),
staging AS (
  SELECT * EXCLUDE (k) FROM staging_once
  UNION ALL
  SELECT * EXCLUDE (k) FROM staging_once WHERE k % 10 = 0
),
rejects AS (
  SELECT s_name AS SupplierName FROM supplier WHERE {REJECT_RULE}
)"""

_REST = [c for c in SPEND_COLUMNS if c not in
         ("TransactionNumber", "Supplier", "Amount", "DateOfPayment")]

CLEAN = STAGING + f""",
rejected AS (
  SELECT * FROM staging s
  WHERE NOT EXISTS (SELECT 1 FROM rejects i WHERE trim(s.Supplier) = trim(i.SupplierName))
),
redacted AS (
  SELECT * REPLACE (
    CASE WHEN Supplier LIKE '%Personal Expense%' OR Supplier LIKE '%Name Withheld%'
         THEN '{REDACTED_SUPPLIER}' ELSE Supplier END AS Supplier)
  FROM rejected
),
typed AS (
  SELECT * REPLACE (
    CAST(try_strptime(trim(DateOfPayment), '%d/%m/%Y') AS DATE) AS DateOfPayment,
    CASE WHEN regexp_full_match(trim(Amount), '{_number_pattern()}')
         THEN TRY_CAST(trim(Amount) AS DECIMAL(18,2)) END AS Amount)
  FROM redacted
),
deduped AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (
      PARTITION BY TransactionNumber, Supplier, Amount, DateOfPayment
      ORDER BY {", ".join(c + NF for c in _REST)}) AS rn
    FROM typed) t
  WHERE rn = 1
)"""

# Match keys of the fact load, in the order of the fact's keys: (fact key, dimension,
# [(payment column, dimension column, match form)]).  ``=``: both sides trimmed, a NULL
# matches nothing; ``~``: a NULL counts as blank; ``date``: equal dates.
MATCHES = [
    ("OrganisationID", "dim_org", [("Department", "Department", "="), ("Entity", "Entity", "=")]),
    ("SupplierID", "dim_sup", [("Supplier", "SupplierName", "="),
                               ("SupplierPostCode", "SupplierPostCode", "~"),
                               ("SupplierType", "SupplierType", "~")]),
    ("ExpenseTypeID", "dim_et", [("ExpenseType", "ExpenseType", "=")]),
    ("ExpenseAreaID", "dim_ea", [("ExpenseArea", "ExpenseArea", "=")]),
    ("DateID", "dim_date", [("DateOfPayment", "FullDate", "date")]),
]
_FORMS = {"=": "trim({0})", "~": "coalesce(trim({0}), '')", "date": "{0}"}


def _match_ctes() -> str:
    """``paid`` and ``<dimension>_keys`` with the match keys, normalised once a
    side, and ``matched``: every payment with the dimension keys it found."""
    sides, joins = [], []
    paid = [f"{_FORMS[form].format(column)} AS k_{column}"
            for _, _, on in MATCHES for column, _, form in on]
    for key, dim, on in MATCHES:
        keys = ", ".join(f"{_FORMS[form].format(there)} AS k_{column}" for column, there, form in on)
        sides.append(f"{dim}_keys AS (SELECT {key}, {keys} FROM {dim})")
        joins.append(f"LEFT JOIN {dim}_keys USING ({', '.join('k_' + c for c, _, _ in on)})")
    return (f"paid AS (SELECT *, {', '.join(paid)} FROM deduped),\n" + ",\n".join(sides)
            + ",\nmatched AS (SELECT OrganisationID, SupplierID, ExpenseTypeID, ExpenseAreaID, DateID,\n"
            + "  Amount, TransactionNumber, Description\n  FROM paid\n  " + "\n  ".join(joins) + ")")


WAREHOUSE = CLEAN + f""",
dim_org AS (
  SELECT CAST(row_number() OVER (ORDER BY Department NULLS FIRST, Entity NULLS FIRST) AS INTEGER)
           AS OrganisationID, Department, Entity
  FROM (SELECT DISTINCT nullif(trim(Department), '') AS Department,
                        nullif(trim(Entity), '') AS Entity FROM deduped) t
),
dim_sup AS (
  SELECT CAST(row_number() OVER (ORDER BY SupplierName NULLS FIRST, SupplierPostCode NULLS FIRST,
                                          SupplierType NULLS FIRST) AS INTEGER) AS SupplierID,
         SupplierName, SupplierPostCode, SupplierType
  FROM (SELECT DISTINCT nullif(trim(Supplier), '') AS SupplierName,
                        nullif(trim(SupplierPostCode), '') AS SupplierPostCode,
                        nullif(trim(SupplierType), '') AS SupplierType FROM deduped) t
),
dim_et AS (
  SELECT CAST(row_number() OVER (ORDER BY ExpenseType NULLS FIRST) AS INTEGER) AS ExpenseTypeID,
         ExpenseType
  FROM (SELECT DISTINCT nullif(trim(ExpenseType), '') AS ExpenseType FROM deduped) t
),
dim_ea AS (
  SELECT CAST(row_number() OVER (ORDER BY ExpenseArea NULLS FIRST) AS INTEGER) AS ExpenseAreaID,
         ExpenseArea
  FROM (SELECT DISTINCT nullif(trim(ExpenseArea), '') AS ExpenseArea FROM deduped) t
),
dim_date AS (
  SELECT CAST(row_number() OVER (ORDER BY FullDate) AS INTEGER) AS DateID, FullDate,
         CAST(year(FullDate) AS INTEGER) AS Year, CAST(month(FullDate) AS INTEGER) AS Month,
         monthname(FullDate) AS MonthName
  FROM (SELECT DISTINCT DateOfPayment AS FullDate FROM deduped
        WHERE DateOfPayment IS NOT NULL) t
),
{_match_ctes()},
fact AS (
  SELECT row_number() OVER (ORDER BY DateID, substr(md5(concat_ws('|', TransactionNumber,
             CAST(SupplierID AS VARCHAR), CAST(Amount AS VARCHAR))), 1, 4), SupplierID,
           TransactionNumber NULLS FIRST, Amount NULLS FIRST, OrganisationID, ExpenseTypeID,
           ExpenseAreaID, Description NULLS FIRST) AS FactID, *
  FROM matched
  WHERE OrganisationID IS NOT NULL AND SupplierID IS NOT NULL AND ExpenseTypeID IS NOT NULL
    AND ExpenseAreaID IS NOT NULL AND DateID IS NOT NULL
),
top3 AS (
  SELECT SupplierID, CAST(sum(Amount) AS DECIMAL(38,2)) AS TotalSpent
  FROM fact GROUP BY SupplierID
  ORDER BY TotalSpent DESC NULLS LAST, SupplierID LIMIT 3
)"""


def _with(ctes: str, body: str) -> str:
    return "WITH " + ctes.strip() + "\n" + body.strip()


def _short_list(sql: str) -> str:
    """The same with the short reject list: more rows and suppliers stay."""
    return sql.replace(REJECT_RULE, SHORT_REJECT_RULE)


def _round_div_micro(num: str, den: str) -> str:
    """round(num / den, 6) half away from zero, num and den HUGEINT, as DECIMAL(38,6)."""
    n, d = f"({num})", f"({den})"
    q = (f"(sign({n}) * sign({d}) * ((abs({n}) * 2000000 + abs({d})) // (2 * abs({d}))))")
    return f"CAST(CAST({q} AS DECIMAL(38,0)) * CAST(0.000001 AS DECIMAL(38,6)) AS DECIMAL(38,6))"


def _cents(x: str) -> str:
    return f"CAST(({x}) * 100 AS HUGEINT)"


ALL_SPEND = ", ".join(SPEND_COLUMNS)

Q3_CTES = WAREHOUSE + f""",
maxd AS (
  SELECT max(d.FullDate) AS MaxDate FROM fact f JOIN dim_date d ON d.DateID = f.DateID
),
two AS (
  SELECT et.ExpenseType, CAST(sum(f.Amount) AS DECIMAL(38,2)) AS TwoMonthTotal
  FROM fact f
  JOIN dim_et et ON et.ExpenseTypeID = f.ExpenseTypeID
  JOIN dim_date d ON d.DateID = f.DateID
  CROSS JOIN maxd
  WHERE d.FullDate > CAST(maxd.MaxDate - INTERVAL 2 MONTH AS DATE) AND d.FullDate <= maxd.MaxDate
  GROUP BY et.ExpenseType
),
avgd AS (
  SELECT {_round_div_micro(_cents('sum(TwoMonthTotal)'), 'CAST(100 * count(TwoMonthTotal) AS HUGEINT)')}
         AS AvgTwoMonth
  FROM two
),
above AS (
  SELECT two.ExpenseType, two.TwoMonthTotal, avgd.AvgTwoMonth
  FROM two CROSS JOIN avgd WHERE two.TwoMonthTotal > avgd.AvgTwoMonth
)"""

Q5_CTES = WAREHOUSE + """,
supplier_months AS (
  SELECT s.SupplierName, CAST(year(d.FullDate) AS INTEGER) AS Year,
         CAST(quarter(d.FullDate) AS INTEGER) AS Quarter,
         CAST(month(d.FullDate) AS INTEGER) AS Month,
         CAST(sum(f.Amount) AS DECIMAL(38,2)) AS MonthlyTotal
  FROM fact f JOIN dim_sup s USING (SupplierID) JOIN dim_date d USING (DateID)
  GROUP BY ALL
),
quarter_totals AS (
  SELECT Year, Quarter, CAST(sum(MonthlyTotal) AS DECIMAL(38,2)) AS QuarterTotalAllSuppliers
  FROM supplier_months GROUP BY ALL
)"""


# --- fixed values: the constraints of the star schema and the reject list ------
# table: (its CTE, key, NOT NULL columns, declared text lengths)
CONSTRAINTS = {
    "DimOrganisation": ("dim_org", "OrganisationID", [], {"Department": 255, "Entity": 255}),
    "DimSupplier": ("dim_sup", "SupplierID", [],
                    {"SupplierName": 255, "SupplierPostCode": 50, "SupplierType": 255}),
    "DimExpenseType": ("dim_et", "ExpenseTypeID", [], {"ExpenseType": 255}),
    "DimExpenseArea": ("dim_ea", "ExpenseAreaID", [], {"ExpenseArea": 255}),
    "DimDate": ("dim_date", "DateID", ["FullDate", "Year", "Month", "MonthName"], {"MonthName": 20}),
    "FactInvoice": ("fact", "FactID", ["OrganisationID", "SupplierID", "ExpenseTypeID", "ExpenseAreaID",
                                       "DateID"], {"TransactionNumber": 100}),
    "InvalidSuppliers": ("rejects", None, ["SupplierName"], {"SupplierName": 255}),
}


def _integrity_sql(ctes: str, suffix: str = "") -> str:
    """[check, violations] over the tables of ``CONSTRAINTS`` (their CTEs with ``suffix``)."""
    selects = []

    def row(check: str, expr: str, src: str) -> None:
        selects.append(f"SELECT '{check}' AS \"check\", CAST(({expr}) AS BIGINT) AS violations FROM {src}")

    for name, (cte, key, not_null, lengths) in CONSTRAINTS.items():
        src = cte + suffix
        if key:
            row(f"{name}.{key}.null", f"count_if({key} IS NULL)", src)
            # the fact's NULL ids are no duplicates; a dimension has every row keyed
            rows = f"count({key})" if name == "FactInvoice" else "count(*)"
            row(f"{name}.{key}.duplicate", f"{rows} - count(DISTINCT {key})", src)
            row(f"{name}.{key}.gaps", f"coalesce(max({key}) - count(*), 0)", src)
            row(f"{name}.{key}.start", f"coalesce(min({key}) - 1, 0)", src)
        for c in not_null:
            row(f"{name}.{c}.null", f"count_if({c} IS NULL)", src)
        for c, limit in lengths.items():
            row(f"{name}.{c}.too_long", f"count_if(length({c}) > {limit})", src)
    for name, (cte, key, _, _) in list(CONSTRAINTS.items())[:5]:
        row(f"FactInvoice.{key}.orphan",
            f"count_if({key} IS NOT NULL AND {key} NOT IN "
            f"(SELECT {key} FROM {cte}{suffix} WHERE {key} IS NOT NULL))", f"fact{suffix}")
    return _with(ctes, "\nUNION ALL\n".join(selects))


# The faults of ``integrity_of_damage``.
DAMAGED = WAREHOUSE + """,
dim_org_damaged AS (
  SELECT * REPLACE (CASE WHEN OrganisationID % 7 = 0 THEN NULL ELSE OrganisationID END AS OrganisationID,
                    CASE WHEN OrganisationID % 3 = 0 THEN repeat('x', 300) ELSE Entity END AS Entity)
  FROM dim_org
),
dim_sup_damaged AS (
  SELECT * REPLACE (CASE WHEN SupplierID % 10 = 0 THEN SupplierID - 1 ELSE SupplierID END AS SupplierID)
  FROM dim_sup
),
dim_et_damaged AS (SELECT * REPLACE (ExpenseTypeID + 4 AS ExpenseTypeID) FROM dim_et),
dim_ea_damaged AS (SELECT * FROM dim_ea),
dim_date_damaged AS (
  SELECT * REPLACE (CASE WHEN DateID % 100 = 0 THEN NULL ELSE MonthName END AS MonthName,
                    CASE WHEN DateID % 50 = 0 THEN NULL ELSE FullDate END AS FullDate)
  FROM dim_date
),
fact_damaged AS (
  SELECT * REPLACE (
    CASE WHEN FactID % 100 = 0 THEN FactID - 1 WHEN FactID % 777 = 0 THEN NULL ELSE FactID END AS FactID,
    CASE WHEN FactID % 97 = 0 THEN SupplierID + 1000000 ELSE SupplierID END AS SupplierID,
    CASE WHEN FactID % 83 = 0 THEN NULL ELSE DateID END AS DateID,
    CASE WHEN FactID % 1009 = 0 THEN repeat('x', 300) ELSE TransactionNumber END AS TransactionNumber)
  FROM fact
),
rejects_damaged AS (
  SELECT CASE WHEN SupplierName LIKE '%3' THEN NULL WHEN SupplierName LIKE '%7' THEN repeat('x', 300)
              ELSE SupplierName END AS SupplierName
  FROM rejects
)"""


def _unmatched_sql() -> str:
    return _with(WAREHOUSE, "\nUNION ALL\n".join(
        f"SELECT '{name}' AS dimension, count(*) - count({key}) AS unmatched_rows FROM matched"
        for key, name in DIAGNOSTIC_NAMES.items()))


def _publish_sql() -> str:
    tables = {"DimOrganisation": "dim_org", "DimSupplier": "dim_sup", "DimExpenseType": "dim_et",
              "DimExpenseArea": "dim_ea", "DimDate": "dim_date", "FactInvoice": "fact"}
    return _with(WAREHOUSE, "\nUNION ALL\n".join(
        f"SELECT '{name}' AS \"table\", count(*) AS rows FROM {cte}" for name, cte in tables.items()))


def _counters_sql() -> str:
    parts = [
        ("StagingRowCount", "count(*)", "staging"),
        ("InvalidSupplierCount", "count(*)", "rejects"),
        ("StagingRowCount_After", "count(*)", "rejected"),
        ("RedactedSupplierRows", f"count_if(Supplier = '{REDACTED_SUPPLIER}')", "redacted"),
        ("CleanRowCount", "count(*)", "typed"),
        ("InvalidDateCount", "count_if(DateOfPayment IS NULL)", "typed"),
        ("InvalidAmountCount", "count_if(Amount IS NULL)", "typed"),
        ("DuplicateGroups", "count(*)",
         "(SELECT 1 FROM typed GROUP BY TransactionNumber, Supplier, Amount, DateOfPayment "
         "HAVING count(*) > 1) t"),
        ("RowCount_AfterDeDup", "count(*)", "deduped"),
    ]
    selects = [f"SELECT '{m}' AS metric, CAST({e} AS BIGINT) AS value FROM {src}"
               for m, e, src in parts]
    return _with(CLEAN, "\nUNION ALL\n".join(selects))


def _load_counters_sql() -> str:
    steps = _counters_sql().split("\nSELECT 'StagingRowCount'", 1)[1]
    losses = "\nUNION ALL\n".join(f"SELECT 'No{name}Match', count(*) - count({key}) FROM matched"
                                  for key, name in DIAGNOSTIC_NAMES.items())
    return _with(WAREHOUSE, f"""
SELECT 'StagingRowCount'{steps}
UNION ALL
{losses}
UNION ALL SELECT 'CleanRows', count(*) FROM deduped
UNION ALL SELECT 'FactRows', count(*) FROM fact
UNION ALL SELECT 'MaxDateID', max(DateID) FROM fact
UNION ALL SELECT 'MalformedRows', 0""")


def _dimension_samples_sql() -> str:
    layout = [
        ("DimOrganisation", "dim_org", "OrganisationID", ["Department", "Entity"]),
        ("DimSupplier", "dim_sup", "SupplierID",
         ["SupplierName", "SupplierPostCode", "SupplierType"]),
        ("DimExpenseType", "dim_et", "ExpenseTypeID", ["ExpenseType"]),
        ("DimExpenseArea", "dim_ea", "ExpenseAreaID", ["ExpenseArea"]),
        ("DimDate", "dim_date", "DateID", ["FullDate", "Year", "Month", "MonthName"]),
    ]
    parts = []
    for name, cte, key, cols in layout:
        member = ", ".join(f"coalesce(CAST({c} AS VARCHAR), 'NULL')" for c in cols)
        parts.append(f"(SELECT '{name}' AS dimension, {key} AS id, "
                     f"concat_ws(' | ', {member}) AS member FROM {cte} ORDER BY {key} LIMIT 10)")
    return _with(WAREHOUSE, "\nUNION ALL\n".join(parts))


def _namespace_sql() -> str:
    """Tables, columns and rows of the star schema as the catalog lists them."""
    tables = {"DimOrganisation": ("dim_org", 3), "DimSupplier": ("dim_sup", 4), "DimExpenseType": ("dim_et", 2),
              "DimExpenseArea": ("dim_ea", 2), "DimDate": ("dim_date", 5), "FactInvoice": ("fact", 9)}
    # the catalog lists table names in lower case
    return _with(WAREHOUSE, "\nUNION ALL\n".join(
        f"SELECT '{name.lower()}' AS \"table\", CAST({n} AS INTEGER) AS columns, count(*) AS rows FROM {cte}"
        for name, (cte, n) in tables.items()))


_LINE = "concat_ws(chr(9), " + ", ".join(f"coalesce({c}, '')" for c in SPEND_COLUMNS) + ")"

MALFORMED = _with(STAGING, f"""
SELECT line AS "RawLine", CAST(count(*) AS BIGINT) AS "SourceRows" FROM (
  SELECT array_to_string(string_split({_LINE}, chr(9))[1:10], chr(9)) AS line FROM staging
  WHERE TransactionNumber LIKE '%7-1'
  UNION ALL
  SELECT {_LINE} || chr(9) || 'more' FROM staging WHERE TransactionNumber LIKE '%3-2')
GROUP BY line""")

# The load under the server's collation: keys in lower case without trailing blanks,
# members spelled as the smallest spelling of their class.
CASE_INSENSITIVE = STAGING + f""",
varied AS (
  SELECT * REPLACE (
    CASE WHEN TransactionNumber LIKE '%2' THEN lower(Supplier)
         WHEN TransactionNumber LIKE '%3' THEN Supplier || '  ' ELSE Supplier END AS Supplier,
    CASE WHEN TransactionNumber LIKE '%4' THEN lower(ExpenseType) ELSE ExpenseType END AS ExpenseType)
  FROM staging
),
twice AS (
  SELECT * FROM varied
  UNION ALL
  SELECT * REPLACE (upper(Supplier) AS Supplier) FROM varied WHERE TransactionNumber LIKE '%5'
),
cleaned AS (
  SELECT * REPLACE (
    CASE WHEN lower(Supplier) LIKE '%personal expense%' OR lower(Supplier) LIKE '%name withheld%'
         THEN '{REDACTED_SUPPLIER}' ELSE Supplier END AS Supplier,
    CAST(try_strptime(trim(DateOfPayment), '%d/%m/%Y') AS DATE) AS DateOfPayment,
    CASE WHEN regexp_full_match(trim(Amount), '{_number_pattern()}')
         THEN TRY_CAST(trim(Amount) AS DECIMAL(18,2)) END AS Amount)
  FROM twice t
  WHERE NOT EXISTS (SELECT 1 FROM rejects r WHERE lower(trim(t.Supplier)) = lower(trim(r.SupplierName)))
),
once AS (
  SELECT * FROM cleaned
  QUALIFY row_number() OVER (
    PARTITION BY lower(rtrim(TransactionNumber)), lower(rtrim(Supplier)), Amount, DateOfPayment
    ORDER BY {", ".join(c + NF for c in _REST)}, TransactionNumber, Supplier{NF}) = 1
),
keyed AS (
  SELECT *, lower(nullif(trim(Supplier), '')) AS ks, lower(nullif(trim(ExpenseType), '')) AS kt FROM once
),
sup_names AS (
  SELECT lower(m) AS ks, min(m) AS SupplierName
  FROM (SELECT nullif(trim(Supplier), '') AS m FROM once) WHERE m IS NOT NULL GROUP BY ALL
),
type_names AS (
  SELECT lower(m) AS kt, min(m) AS ExpenseType
  FROM (SELECT nullif(trim(ExpenseType), '') AS m FROM once) WHERE m IS NOT NULL GROUP BY ALL
)"""


def _ordered(name: str, query: str, columns: list[str], order: str) -> str:
    line = ", ".join(f"coalesce(CAST({c} AS VARCHAR), 'NULL')" for c in columns)
    return (f"SELECT '{name}' AS result_set, row_number() OVER (ORDER BY {order}) - 1 AS position, "
            f"concat_ws('|', {line}) AS line FROM ({query})")


def oracle_sql() -> dict[str, str]:
    nullif_all = ", ".join(f"nullif({c}, '') AS {c}" for c in SPEND_COLUMNS)
    # An area's rank in a month: 1 + the areas that spent more in it.  Its previous
    # rank: that of its latest earlier month with spend.
    q4 = _with(WAREHOUSE + """,
spent AS (
  SELECT ExpenseArea, Year, Month, Year * 12 + Month AS at,
         CAST(sum(Amount) AS DECIMAL(38,2)) AS TotalSpent
  FROM fact JOIN dim_ea USING (ExpenseAreaID) JOIN dim_date USING (DateID)
  GROUP BY ALL
),
ranked AS (
  SELECT s.ExpenseArea, s.Year, s.Month, s.at, s.TotalSpent, CAST(1 + (
           SELECT count(*) FROM spent o WHERE o.at = s.at
              AND (o.TotalSpent > s.TotalSpent OR (o.TotalSpent IS NOT NULL AND s.TotalSpent IS NULL))
         ) AS INTEGER) AS RankNow
  FROM spent s
),
latest AS (
  SELECT n.ExpenseArea, n.at, max(e.at) AS earlier
  FROM spent n JOIN spent e ON e.ExpenseArea IS NOT DISTINCT FROM n.ExpenseArea AND e.at < n.at
  GROUP BY ALL
)""", """
SELECT r.ExpenseArea, r.Year, r.Month, r.TotalSpent, r.RankNow, p.RankNow AS PrevRank,
       p.RankNow - r.RankNow AS Movement, r.Year * 10000 + r.Month * 100 + r.RankNow AS SortKey
FROM ranked r
LEFT JOIN latest l ON l.ExpenseArea IS NOT DISTINCT FROM r.ExpenseArea AND l.at = r.at
LEFT JOIN ranked p ON p.ExpenseArea IS NOT DISTINCT FROM r.ExpenseArea AND p.at = l.earlier
WHERE r.RankNow <= 10""")
    pct = _round_div_micro(f"CAST(100 AS HUGEINT) * {_cents('MonthlyTotal')}",
                           _cents("QuarterTotalAllSuppliers"))
    q5 = _with(Q5_CTES, f"""
SELECT m.SupplierName, m.Year, m.Quarter, m.Month,
       strftime(make_date(m.Year, m.Month, 1), '%B %Y') AS MonthLabel, m.MonthlyTotal,
       CAST(sum(m.MonthlyTotal) OVER (PARTITION BY m.SupplierName, m.Year
            ORDER BY m.Month ROWS UNBOUNDED PRECEDING) AS DECIMAL(38,2)) AS SupplierYearToDate,
       q.QuarterTotalAllSuppliers,
       CASE WHEN q.QuarterTotalAllSuppliers <> 0 THEN {pct} END AS MonthlyShareOfQuarterPercent
FROM supplier_months m JOIN quarter_totals q USING (Year, Quarter)""")
    json_doc = _with(Q3_CTES, f"""
SELECT '{{"{EXPENSE_JSON_ROOT}":' || CAST(to_json(list(
         {{'ExpenseType': ExpenseType, 'TwoMonthTotal': TwoMonthTotal,
          'AvgTwoMonth': AvgTwoMonth}}
         ORDER BY TwoMonthTotal DESC, ExpenseType)) AS VARCHAR) || '}}' AS json
FROM above HAVING count(*) > 0""")
    single = _with(WAREHOUSE, "SELECT s.SupplierName, t.TotalSpent, t.SupplierID FROM top3 t "
                   "JOIN dim_sup s ON s.SupplierID = t.SupplierID")
    monthly = _with(WAREHOUSE, """
SELECT CAST(d.Year AS INTEGER) AS Year, CAST(d.Month AS INTEGER) AS Month, s.SupplierName,
       CAST(sum(f.Amount) AS DECIMAL(38,2)) AS MonthlyTotal
FROM fact f
JOIN dim_date d ON d.DateID = f.DateID
JOIN dim_sup s ON s.SupplierID = f.SupplierID
JOIN top3 t ON t.SupplierID = f.SupplierID
GROUP BY d.Year, d.Month, s.SupplierName""")
    in_order = "\nUNION ALL\n".join([
        _ordered("top_suppliers_overall", single, ["SupplierName", "TotalSpent"],
                 "TotalSpent DESC NULLS LAST, SupplierID"),
        _ordered("top_suppliers_monthly", monthly, ["Year", "Month", "SupplierName", "MonthlyTotal"],
                 "Year, Month, MonthlyTotal DESC NULLS LAST, SupplierName"),
        _ordered("area_rank_movement", q4,
                 ["ExpenseArea", "Year", "Month", "TotalSpent", "RankNow", "PrevRank", "Movement", "SortKey"],
                 "Year, Month, RankNow, ExpenseArea"),
        _ordered("supplier_time_hierarchy", q5,
                 ["SupplierName", "Year", "Quarter", "Month", "MonthLabel", "MonthlyTotal",
                  "SupplierYearToDate", "QuarterTotalAllSuppliers", "MonthlyShareOfQuarterPercent"],
                 "Year, Quarter, Month, SupplierName NULLS FIRST")])
    quoted = ", ".join("'\"' || Description || '\", é' AS Description" if c == "Description"
                       else f"nullif({c}, '') AS {c}" for c in SPEND_COLUMNS)
    out = {
        "stage_spend": _with(STAGING, f"SELECT {ALL_SPEND} FROM staging"),
        "stage_tsv_roundtrip": _with(STAGING, f"SELECT {nullif_all} FROM staging"),
        "reject_list_xml": _with(STAGING, "SELECT SupplierName FROM rejects"),
        "reject_suppliers": _with(CLEAN, f"SELECT {ALL_SPEND} FROM rejected"),
        "redact_suppliers": _with(CLEAN, f"SELECT {ALL_SPEND} FROM redacted"),
        "clean_spend": _with(CLEAN, f"SELECT {ALL_SPEND} FROM typed"),
        "dq_counters": _counters_sql(),
        "duplicate_audit": _short_list(_with(CLEAN, """
SELECT TransactionNumber, Supplier, Amount, DateOfPayment, count(*) AS DuplicateCount
FROM typed GROUP BY TransactionNumber, Supplier, Amount, DateOfPayment HAVING count(*) > 1""")),
        "dedup_spend": _with(CLEAN, f"SELECT {ALL_SPEND} FROM deduped"),
        "dim_organisation": _with(WAREHOUSE, "SELECT * FROM dim_org"),
        "dim_supplier": _short_list(_with(WAREHOUSE, "SELECT * FROM dim_sup")),
        "dim_expense_type": _with(WAREHOUSE, "SELECT * FROM dim_et"),
        "dim_expense_area": _with(WAREHOUSE, "SELECT * FROM dim_ea"),
        "dim_date": _with(WAREHOUSE, "SELECT * FROM dim_date"),
        "fact_spend": _with(WAREHOUSE, "SELECT * FROM fact"),
        "unmatched_by_dimension": _unmatched_sql(),
        "clean_vs_fact": _with(WAREHOUSE, """
SELECT 'CleanRows' AS metric, (SELECT count(*) FROM deduped) AS value
UNION ALL SELECT 'FactRows', (SELECT count(*) FROM fact)
UNION ALL SELECT 'LostRows', (SELECT count(*) FROM deduped) - (SELECT count(*) FROM fact)"""),
        "integrity_report": _integrity_sql(WAREHOUSE),
        "integrity_of_damage": _integrity_sql(DAMAGED, "_damaged"),
        "load_counters": _load_counters_sql(),
        "top_suppliers": _with(WAREHOUSE, """
SELECT s.SupplierName, t.TotalSpent FROM top3 t JOIN dim_sup s ON s.SupplierID = t.SupplierID"""),
        "top_suppliers_monthly": monthly,
        "expense_types_above_avg": _with(Q3_CTES, "SELECT * FROM above"),
        "expense_types_above_avg_json": json_doc,
        "area_rank_movement": q4,
        "supplier_time_hierarchy": q5,
        "latest_payments": _with(CLEAN, """
SELECT Department, Entity, DateOfPayment, Supplier, Amount, TransactionNumber
FROM deduped
ORDER BY DateOfPayment DESC NULLS LAST, TransactionNumber NULLS FIRST, Supplier NULLS FIRST,
         Amount NULLS FIRST, Department NULLS FIRST, Entity NULLS FIRST
LIMIT 50"""),
        "first_rejects": _with(STAGING, "SELECT SupplierName FROM rejects ORDER BY SupplierName LIMIT 20"),
        "dimension_samples": _dimension_samples_sql(),
        "fact_sample": _with(WAREHOUSE, """
SELECT FactID, OrganisationID, SupplierID, ExpenseTypeID, ExpenseAreaID, DateID, Amount,
       TransactionNumber
FROM fact ORDER BY FactID LIMIT 10"""),
        "publish_warehouse": _publish_sql(),
        "rebuilt_namespace": _namespace_sql(),
        "procedure_result_sets": in_order,
        "stage_utf16_crlf_roundtrip": _with(STAGING, f"SELECT {quoted} FROM staging"),
        "reject_list_repaired": _with(
            STAGING, "SELECT SupplierName || ' & Sons & Co' AS SupplierName FROM rejects"),
        "malformed_rows": MALFORMED,
        "load_case_insensitive": _with(CASE_INSENSITIVE, """
SELECT SupplierName, t.ExpenseType AS ExpenseType, count(*) AS Payments,
       CAST(sum(Amount) AS DECIMAL(38,2)) AS Total
FROM keyed JOIN sup_names USING (ks) JOIN type_names t USING (kt)
WHERE trim(Department) <> '' AND trim(Entity) <> '' AND trim(ExpenseArea) <> ''
  AND DateOfPayment IS NOT NULL
GROUP BY ALL"""),
        "staging_sample_check": _with(
            STAGING, "SELECT least(50, count(*)) AS sampled, least(50, count(*)) AS found FROM staging"),
    }
    for report in ("top_suppliers", "top_suppliers_monthly", "expense_types_above_avg",
                   "area_rank_movement", "supplier_time_hierarchy"):
        out[f"view_{report}"] = out[report]
    return out
