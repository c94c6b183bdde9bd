"""Report queries over the star schema (the procedures and views).

Each function takes a :class:`~spendstar.plans.warehouse.Warehouse` and
returns a DataFrame with the view's columns.  Money is DECIMAL(38,2),
averages and percentages DECIMAL(38,6), never floating point.

Plan shape: aggregate the fact by surrogate keys first (partial aggregation
on the map side, so a hot supplier or area costs one row per task in the
shuffle), then join the small aggregated result to dimension names.  Only
frames with a proven row bound are broadcast by hint: top-k rows (k) and
per-quarter totals (four per calendar year); one-row values are scalar
subqueries.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spendstar.constants import EXPENSE_JSON_ROOT, RATIO_TYPE, TOTAL_TYPE
from spendstar.functions.parsing import month_label
from spendstar.plans.warehouse import Warehouse


def _total(c) -> F.Column:
    return F.sum(c).cast(TOTAL_TYPE)


def _ordered(df: DataFrame, ordered: bool, *keys) -> DataFrame:
    """The procedures' final ORDER BY, applied only on request (views are unordered)."""
    return df.orderBy(*keys) if ordered else df


def _top_supplier_ids(wh: Warehouse, k: int) -> DataFrame:
    """The k SupplierIDs with the largest total (ties broken by lower id)."""
    totals = wh.fact.groupBy("SupplierID").agg(_total("Amount").alias("TotalSpent"))
    return totals.orderBy(F.col("TotalSpent").desc_nulls_last(), F.col("SupplierID").asc()).limit(k)


def top_suppliers(wh: Warehouse, k: int = 3) -> DataFrame:
    """Q1: [SupplierName, TotalSpent] for the top-k SupplierIDs, largest first.

    Ranking is by SupplierID (one name may own several IDs and appear twice).
    """
    top = _top_supplier_ids(wh, k)
    names = wh.dim_supplier.select("SupplierID", "SupplierName")
    return (names.join(F.broadcast(top), "SupplierID")
                 .orderBy(F.col("TotalSpent").desc_nulls_last(), F.col("SupplierID").asc())
                 .select("SupplierName", "TotalSpent"))


def top_suppliers_monthly(wh: Warehouse, k: int = 3, ordered: bool = False) -> DataFrame:
    """Q2: [Year, Month, SupplierName, MonthlyTotal] for the top-k SupplierIDs.

    Months are regrouped by name, as the reference does.  ``ordered`` sorts
    by Year, Month, MonthlyTotal descending.
    """
    top = _top_supplier_ids(wh, k).select("SupplierID")
    facts = wh.fact.join(F.broadcast(top), "SupplierID", "left_semi")
    per_id = (facts.join(wh.dim_date.select("DateID", "Year", "Month"), "DateID")
                   .groupBy("SupplierID", "Year", "Month")
                   .agg(F.sum("Amount").alias("_m")))
    names = wh.dim_supplier.select("SupplierID", "SupplierName")
    out = (per_id.join(names, "SupplierID")
                 .groupBy("Year", "Month", "SupplierName")
                 .agg(_total("_m").alias("MonthlyTotal")))
    return _ordered(out, ordered, "Year", "Month", F.col("MonthlyTotal").desc_nulls_last(),
                    "SupplierName")


def top_suppliers_result_sets(wh: Warehouse, k: int = 3) -> dict[str, DataFrame]:
    """Both result sets of the top-suppliers procedure, in its order.

    ``overall``: Q1 (largest first); ``monthly``: Q2 ordered by Year, Month
    and MonthlyTotal descending.
    """
    return {"overall": top_suppliers(wh, k), "monthly": top_suppliers_monthly(wh, k, ordered=True)}


def _window_date_ids(wh: Warehouse, months: int) -> tuple[int, int] | None:
    """(lo, hi] DateID bounds of the last ``months`` months of fact data.

    DateIDs are dense in date order, so the latest fact date is the date of
    the largest DateID and a date window is a DateID range.  The bounds are
    scalars (as the reference's variables are); the fact's files hold narrow
    DateID ranges, so filtering by literal bounds lets Spark skip the row
    groups outside the window.
    """
    if "MaxDateID" in wh.counters:  # from the fact's files
        hi = wh.counters["MaxDateID"]
    else:
        hi = wh.fact.agg(F.max("DateID")).first()[0]
    if hi is None:
        return None
    d = wh.dim_date
    end = d.where(F.col("DateID") == hi)
    start = end.select(F.add_months("FullDate", -months)).scalar()
    # one action: the window start and the last DateID on or before it
    lo = d.where(F.col("FullDate") <= start).agg(
        F.coalesce(F.max("DateID"), F.lit(0))).scalar()
    return int(end.select(lo.alias("_lo")).first()._lo), int(hi)


def expense_types_above_avg(wh: Warehouse, months: int = 2, ordered: bool = False) -> DataFrame:
    """Q3: [ExpenseType, TwoMonthTotal, AvgTwoMonth] above the unweighted average.

    Window is (latest fact date - months, latest fact date].  ``ordered``
    sorts by TwoMonthTotal descending.
    """
    bounds = _window_date_ids(wh, months)
    if bounds is None:
        return wh.dim_expense_type.select(
            "ExpenseType", F.lit(None).cast(TOTAL_TYPE).alias("TwoMonthTotal"),
            F.lit(None).cast(RATIO_TYPE).alias("AvgTwoMonth")).limit(0)
    lo, hi = bounds
    window = wh.fact.where((F.col("DateID") > lo) & (F.col("DateID") <= hi))
    by_id = window.groupBy("ExpenseTypeID").agg(_total("Amount").alias("TwoMonthTotal"))
    totals = by_id.join(wh.dim_expense_type, "ExpenseTypeID").select("ExpenseType", "TwoMonthTotal")
    # the unweighted average as a scalar subquery (computed once, no join)
    avg = totals.agg(F.avg("TwoMonthTotal").cast(RATIO_TYPE)).scalar()
    out = (totals.where(F.col("TwoMonthTotal") > avg)
                 .select("ExpenseType", "TwoMonthTotal", avg.alias("AvgTwoMonth")))
    return _ordered(out, ordered, F.col("TwoMonthTotal").desc_nulls_last(), "ExpenseType")


def expense_types_above_avg_json(wh: Warehouse, months: int = 2) -> DataFrame:
    """Q3 as one JSON document: {"ExpenseTypesAboveAverage": [...]}, largest first.

    One row with column ``json``, or no row when nothing is above average.
    The array holds one entry per expense type (bounded by that dimension).
    """
    rows = expense_types_above_avg(wh, months)
    items = F.collect_list(F.struct("ExpenseType", "TwoMonthTotal", "AvgTwoMonth"))
    ordered = F.array_sort(items, lambda a, b: F.when(
        a["TwoMonthTotal"] > b["TwoMonthTotal"], -1).when(
        a["TwoMonthTotal"] < b["TwoMonthTotal"], 1).when(
        a["ExpenseType"] < b["ExpenseType"], -1).when(
        a["ExpenseType"] > b["ExpenseType"], 1).otherwise(0))
    doc = rows.agg(ordered.alias("items")).where(F.size("items") > 0)
    return doc.select(F.to_json(F.struct(F.col("items").alias(EXPENSE_JSON_ROOT))).alias("json"))


def area_rank_movement(wh: Warehouse, k: int = 10, ordered: bool = False) -> DataFrame:
    """Q4: monthly top-k expense areas with rank movement.

    [ExpenseArea, Year, Month, TotalSpent, RankNow, PrevRank, Movement, SortKey].
    RANK leaves gaps and keeps ties; PrevRank is the area's rank in its
    previous month with spend, taken before the top-k filter.  ``ordered``
    sorts by Year, Month, RankNow.
    """
    monthly = (wh.fact.join(wh.dim_date.select("DateID", "Year", "Month"), "DateID")
                 .groupBy("ExpenseAreaID", "Year", "Month")
                 .agg(_total("Amount").alias("TotalSpent")))
    base = monthly.join(wh.dim_expense_area, "ExpenseAreaID").drop("ExpenseAreaID")
    by_month = Window.partitionBy("Year", "Month").orderBy(F.col("TotalSpent").desc_nulls_last())
    by_area = Window.partitionBy("ExpenseArea").orderBy("Year", "Month")
    ranked = base.withColumn("RankNow", F.rank().over(by_month))
    prev = ranked.withColumn("PrevRank", F.lag("RankNow").over(by_area))
    out = (prev.where(F.col("RankNow") <= k)
               .select("ExpenseArea", "Year", "Month", "TotalSpent", "RankNow", "PrevRank",
                       (F.col("PrevRank") - F.col("RankNow")).alias("Movement"),
                       (F.col("Year") * 10000 + F.col("Month") * 100 + F.col("RankNow"))
                       .alias("SortKey")))
    return _ordered(out, ordered, "Year", "Month", "RankNow", "ExpenseArea")


def supplier_time_hierarchy(wh: Warehouse, ordered: bool = False) -> DataFrame:
    """Q5: supplier spend by year / quarter / month with YTD and share of quarter.

    [SupplierName, Year, Quarter, Month, MonthLabel, MonthlyTotal,
    SupplierYearToDate, QuarterTotalAllSuppliers, MonthlyShareOfQuarterPercent].
    ``ordered`` sorts by Year, Quarter, Month, SupplierName.
    """
    dates = wh.dim_date.select("DateID", "Year", F.quarter("FullDate").alias("Quarter"), "Month")
    per_id = (wh.fact.join(dates, "DateID")
                .groupBy("SupplierID", "Year", "Quarter", "Month")
                .agg(F.sum("Amount").alias("_m")))
    # The per-ID monthly rows are small; hash them once by (SupplierName,
    # Year): that partitioning serves both the regrouping by name and the
    # year-to-date window, so neither adds an exchange of its own.
    base = (per_id.join(wh.dim_supplier.select("SupplierID", "SupplierName"), "SupplierID")
                  .repartition("SupplierName", "Year")
                  .groupBy("SupplierName", "Year", "Quarter", "Month")
                  .agg(_total("_m").alias("MonthlyTotal")))
    # Whole-quarter totals as an aggregate joined back: the result has one
    # row per calendar quarter, so the broadcast is bounded; a window over
    # (Year, Quarter) would instead sort each quarter on a single task.
    quarters = base.groupBy("Year", "Quarter").agg(
        _total("MonthlyTotal").alias("QuarterTotalAllSuppliers"))
    ytd = Window.partitionBy("SupplierName", "Year").orderBy("Quarter", "Month") \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    share = (F.lit(Decimal("100.0")) * F.col("MonthlyTotal")
             / F.nullif(F.col("QuarterTotalAllSuppliers"), F.lit(0)))
    out = (base.join(F.broadcast(quarters), ["Year", "Quarter"])
               .select("SupplierName", "Year", "Quarter", "Month",
                        month_label("Year", "Month").alias("MonthLabel"),
                        "MonthlyTotal",
                        F.sum("MonthlyTotal").over(ytd).cast(TOTAL_TYPE).alias("SupplierYearToDate"),
                        "QuarterTotalAllSuppliers",
                       share.cast(RATIO_TYPE).alias("MonthlyShareOfQuarterPercent")))
    return _ordered(out, ordered, "Year", "Quarter", "Month",
                    F.col("SupplierName").asc_nulls_first())
