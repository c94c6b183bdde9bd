"""Publish a loaded warehouse: Parquet folders, catalog tables, report views
(of the catalog, or of a session)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendstar.constants import RATIO_TYPE, TOTAL_TYPE
from spendstar.plans import reports
from spendstar.plans.warehouse import Warehouse

# --- fixed values: report view names, in report order ------------------------
VIEW_NAMES = {
    "vw_Top3Suppliers": reports.top_suppliers,
    "vw_Top3Suppliers_Monthly": reports.top_suppliers_monthly,
    "vw_ExpenseTypeAboveAvg2Month": reports.expense_types_above_avg,
    "vw_MonthlyExpenseAreaRanking": reports.area_rank_movement,
    "vw_SupplierTimeHierarchyAnalysis": reports.supplier_time_hierarchy,
}


def _writer(df: DataFrame, mode: str):
    """A writer that replaces the whole table, whatever the session's mode."""
    return df.write.mode(mode).option("partitionOverwriteMode", "static")


def _publish_order(wh: Warehouse) -> list[str]:
    # dimensions before the fact, as foreign keys require
    tables = wh.tables()
    return [n for n in tables if n != "FactInvoice"] + ["FactInvoice"]


def publish(wh: Warehouse, path: str, mode: str = "overwrite") -> DataFrame:
    """Write dimensions first, then the fact, under ``path/<TableName>``.

    Returns ``[table, rows]`` read back from what was written (a count over
    Parquet metadata per table).
    """
    tables = wh.tables()
    spark = wh.fact.sparkSession
    manifest = None
    for name in _publish_order(wh):
        target = os.path.join(path, name)
        _writer(tables[name], mode).parquet(target)
        rows = spark.read.parquet(target).agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("table"), "rows")
        manifest = rows if manifest is None else manifest.unionByName(rows)
    return manifest


def prepare_namespace(spark: SparkSession, database: str, location: str | None = None,
                      reset: bool = False) -> DataFrame:
    """Create ``database`` if it does not exist; with ``reset`` first drop it
    with all its tables.  [database, existed, current]: whether it was there
    before, and the session's current database."""
    existed = spark.catalog.databaseExists(database)
    if reset and existed:
        spark.sql(f"DROP DATABASE `{database}` CASCADE")
    if not spark.catalog.databaseExists(database):
        place = f" LOCATION '{location}'" if location else ""
        spark.sql(f"CREATE DATABASE `{database}`{place}")
    return spark.createDataFrame([(database, existed, spark.catalog.currentDatabase())],
                                 "database string, existed boolean, current string")


def save_tables(wh: Warehouse, database: str, mode: str = "overwrite",
                location: str | None = None) -> list[str]:
    """Save every table in the session catalog as ``database.TableName``.

    The database is created if missing (at ``location``, if given) and never
    dropped; with mode ``overwrite`` a table that exists is dropped and built
    anew.  Returns the qualified names, dimensions first.
    """
    spark = wh.fact.sparkSession
    prepare_namespace(spark, database, location)
    tables = wh.tables()
    names = []
    for name in _publish_order(wh):
        qualified = f"`{database}`.`{name}`"
        if mode == "overwrite" and spark.catalog.tableExists(f"{database}.{name}"):
            spark.sql(f"DROP TABLE {qualified}")
        _writer(tables[name], mode).format("parquet").saveAsTable(qualified)
        names.append(f"{database}.{name}")
    return names


def saved_tables(spark: SparkSession, database: str) -> DataFrame:
    """[table, columns, rows] of every table (not view) the catalog lists in ``database``."""
    out = None
    for t in spark.catalog.listTables(database):
        if t.tableType == "VIEW" or t.isTemporary:
            continue
        df = spark.table(f"`{database}`.`{t.name}`")
        part = df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(t.name).alias("table"), F.lit(len(df.columns)).alias("columns"), "rows")
        out = part if out is None else out.unionByName(part)
    if out is None:
        return spark.createDataFrame([], "table string, columns int, rows bigint")
    return out


def view_statements(database: str, k: int = 3, months: int = 2, areas: int = 10) -> dict[str, str]:
    """The five report views as SQL text over ``database``'s tables.

    No plan and no value of a session is in them: the date window of
    ``vw_ExpenseTypeAboveAvg2Month`` is a scalar subquery on the current fact,
    so the view follows the tables.
    """
    fact, sup, typ, area, day = (f"`{database}`.`{t}`" for t in (
        "FactInvoice", "DimSupplier", "DimExpenseType", "DimExpenseArea", "DimDate"))
    money, ratio = TOTAL_TYPE.simpleString(), RATIO_TYPE.simpleString()
    top = (f"SELECT SupplierID, CAST(sum(Amount) AS {money}) AS TotalSpent FROM {fact} "
           f"GROUP BY SupplierID ORDER BY TotalSpent DESC NULLS LAST, SupplierID LIMIT {k}")
    last = f"SELECT max(DateID) FROM {fact}"
    start = (f"SELECT add_months(FullDate, -{months}) FROM {day} WHERE DateID = ({last})")
    before = f"SELECT coalesce(max(DateID), 0) FROM {day} WHERE FullDate <= ({start})"
    return {
        "vw_Top3Suppliers": f"""
SELECT s.SupplierName, t.TotalSpent
FROM ({top}) t JOIN {sup} s ON s.SupplierID = t.SupplierID""",
        "vw_Top3Suppliers_Monthly": f"""
WITH top AS ({top}),
per_id AS (
  SELECT f.SupplierID, d.Year, d.Month, sum(f.Amount) AS m
  FROM {fact} f LEFT SEMI JOIN top ON top.SupplierID = f.SupplierID
  JOIN {day} d ON d.DateID = f.DateID
  GROUP BY f.SupplierID, d.Year, d.Month
)
SELECT p.Year, p.Month, s.SupplierName, CAST(sum(p.m) AS {money}) AS MonthlyTotal
FROM per_id p JOIN {sup} s ON s.SupplierID = p.SupplierID
GROUP BY p.Year, p.Month, s.SupplierName""",
        "vw_ExpenseTypeAboveAvg2Month": f"""
WITH totals AS (
  SELECT e.ExpenseType, t.TwoMonthTotal
  FROM (SELECT ExpenseTypeID, CAST(sum(Amount) AS {money}) AS TwoMonthTotal FROM {fact}
        WHERE DateID > ({before}) AND DateID <= ({last}) GROUP BY ExpenseTypeID) t
  JOIN {typ} e ON e.ExpenseTypeID = t.ExpenseTypeID
),
average AS (SELECT CAST(avg(TwoMonthTotal) AS {ratio}) AS AvgTwoMonth FROM totals)
SELECT ExpenseType, TwoMonthTotal, (SELECT AvgTwoMonth FROM average) AS AvgTwoMonth
FROM totals WHERE TwoMonthTotal > (SELECT AvgTwoMonth FROM average)""",
        "vw_MonthlyExpenseAreaRanking": f"""
WITH monthly AS (
  SELECT f.ExpenseAreaID, d.Year, d.Month, CAST(sum(f.Amount) AS {money}) AS TotalSpent
  FROM {fact} f JOIN {day} d ON d.DateID = f.DateID
  GROUP BY f.ExpenseAreaID, d.Year, d.Month
),
ranked AS (
  SELECT a.ExpenseArea, m.Year, m.Month, m.TotalSpent,
         rank() OVER (PARTITION BY m.Year, m.Month ORDER BY m.TotalSpent DESC NULLS LAST) AS RankNow
  FROM monthly m JOIN {area} a ON a.ExpenseAreaID = m.ExpenseAreaID
),
moved AS (
  SELECT *, lag(RankNow) OVER (PARTITION BY ExpenseArea ORDER BY Year, Month) AS PrevRank FROM ranked
)
SELECT ExpenseArea, Year, Month, TotalSpent, RankNow, PrevRank, PrevRank - RankNow AS Movement,
       Year * 10000 + Month * 100 + RankNow AS SortKey
FROM moved WHERE RankNow <= {areas}""",
        "vw_SupplierTimeHierarchyAnalysis": f"""
WITH per_id AS (
  SELECT f.SupplierID, d.Year, quarter(d.FullDate) AS Quarter, d.Month, sum(f.Amount) AS m
  FROM {fact} f JOIN {day} d ON d.DateID = f.DateID
  GROUP BY f.SupplierID, d.Year, quarter(d.FullDate), d.Month
),
months AS (
  SELECT s.SupplierName, p.Year, p.Quarter, p.Month, CAST(sum(p.m) AS {money}) AS MonthlyTotal
  FROM per_id p JOIN {sup} s ON s.SupplierID = p.SupplierID
  GROUP BY s.SupplierName, p.Year, p.Quarter, p.Month
),
quarters AS (
  SELECT Year, Quarter, CAST(sum(MonthlyTotal) AS {money}) AS QuarterTotalAllSuppliers
  FROM months GROUP BY Year, Quarter
)
SELECT m.SupplierName, m.Year, m.Quarter, m.Month,
       date_format(make_date(m.Year, m.Month, 1), 'MMMM yyyy') AS MonthLabel, m.MonthlyTotal,
       CAST(sum(m.MonthlyTotal) OVER (PARTITION BY m.SupplierName, m.Year ORDER BY m.Quarter, m.Month
            ROWS UNBOUNDED PRECEDING) AS {money}) AS SupplierYearToDate,
       q.QuarterTotalAllSuppliers,
       CAST(100.0 * m.MonthlyTotal / nullif(q.QuarterTotalAllSuppliers, 0) AS {ratio})
         AS MonthlyShareOfQuarterPercent
FROM months m JOIN quarters q ON q.Year = m.Year AND q.Quarter = m.Quarter""",
    }


def save_views(spark: SparkSession, database: str) -> list[str]:
    """Create the five report views in the catalog beside ``database``'s tables.

    They belong to the catalog, not to a session: any session that shares it
    (a BI tool's too, where the catalog is a metastore) reads them by name.
    """
    names = []
    for name, text in view_statements(database).items():
        spark.sql(f"CREATE OR REPLACE VIEW `{database}`.`{name}` AS {text}")
        names.append(f"{database}.{name}")
    return names


def register_views(wh: Warehouse, prefix: str = "") -> list[str]:
    """Register the star schema and the five report views as temp views.

    Report views have the report columns and no ORDER BY (the caller
    orders).  The date-window report fixes its window from the warehouse at
    registration time, as a view over a loaded warehouse would.
    """
    wh.register(prefix)
    names = []
    for view, fn in VIEW_NAMES.items():
        fn(wh).createOrReplaceTempView(prefix + view)
        names.append(prefix + view)
    return names
