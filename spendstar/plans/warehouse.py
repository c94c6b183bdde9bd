"""The load, end to end: staging -> clean -> dimensions -> fact.

``clean_steps`` is lazy and returns every intermediate frame (for audits and
tests).  ``build_warehouse`` materialises the clean table (it feeds five
dimensions and the fact), each dimension and the fact as Parquet in the
shared scratch folder, or, with ``path``, in a new version folder of that
warehouse that becomes visible in one step when all of it is written
(``spendstar.sources.versions``).

All counters are sums over written tables: the clean rows carry the number of
staged rows behind them, the dimension members the clean rows that hold them,
and the fact files their rows.  So a retried task or stage cannot change them.
"""

from __future__ import annotations

import time
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendstar.constants import AMOUNT_TYPE, REDACT_PATTERNS, REDACTED_SUPPLIER, SPEND_COLUMNS
from spendstar.operators.cleaning import (
    LINEAGE,
    PART,
    RAW_LINE,
    REDACTED_ROWS,
    REJECTED_FLAG,
    SOURCE_FILE,
    SOURCE_ROWS,
    counters_of,
    dedup,
    dedup_counted,
    mark_rejected,
    redact,
    reject_suppliers,
    type_columns,
)
from spendstar.operators.dimensions import (
    DATE_DIMENSION,
    DIMENSIONS,
    ROWS,
    as_dimensions,
    keyed_members,
    read_members,
)
from spendstar.operators.fact import (
    date_layout,
    file_ranges,
    lay_out,
    member_losses,
    star_join,
    with_fact_ids,
)
from spendstar.sources import versions
from spendstar.sources.tables import materialize, size_in_bytes

AUDIT_TABLE = "LoadAudit"
FILES_TABLE = "FactFiles"
CLEAN_TABLE = "Invoice_Clean"
FACT_TABLE = "FactInvoice"
CLEAN_SCHEMA = ", ".join(
    [f"{c} {({'DateOfPayment': 'date', 'Amount': AMOUNT_TYPE.simpleString()}).get(c, 'string')}"
     for c in SPEND_COLUMNS]
    + [f"{SOURCE_ROWS} bigint", f"{REDACTED_ROWS} bigint"]
    + [f"{c} string" for c in (SOURCE_FILE, RAW_LINE, PART)])
# A fact file holds 1 to 128 MB of clean input; within that, one file for each
# shuffle partition of the session.
LEAST_FILE_BYTES = 1 << 20
MOST_FILE_BYTES = 128 << 20


@dataclass
class CleanSteps:
    staging: DataFrame
    rejects: DataFrame
    rejected: DataFrame
    redacted: DataFrame
    typed: DataFrame
    deduped: DataFrame


@dataclass
class Warehouse:
    clean: DataFrame
    dims: dict[str, DataFrame]
    fact: DataFrame
    counters: dict[str, int | None] = field(default_factory=dict)
    fact_files: DataFrame | None = None
    malformed: DataFrame | None = None
    version: str | None = None

    @property
    def dim_supplier(self) -> DataFrame:
        return self.dims["DimSupplier"]

    @property
    def dim_date(self) -> DataFrame:
        return self.dims["DimDate"]

    @property
    def dim_expense_type(self) -> DataFrame:
        return self.dims["DimExpenseType"]

    @property
    def dim_expense_area(self) -> DataFrame:
        return self.dims["DimExpenseArea"]

    @property
    def dim_organisation(self) -> DataFrame:
        return self.dims["DimOrganisation"]

    def tables(self) -> dict[str, DataFrame]:
        return {**self.dims, "FactInvoice": self.numbered_fact}

    @cached_property
    def numbered_fact(self) -> DataFrame:
        """The fact with its FactID, computed from file metadata as it is read;
        reports use ``fact``, whose scans do not carry that metadata."""
        if self.fact_files is None:
            raise ValueError("FactID needs the fact's file ranges (a loaded warehouse)")
        ranges = self.fact_files.orderBy("Part").collect()  # one row for each file
        return with_fact_ids(self.fact, ranges)

    def register(self, prefix: str = "") -> None:
        """Expose every table as a temp view (``DimSupplier``, ``FactInvoice``...)."""
        for name, df in self.tables().items():
            df.createOrReplaceTempView(prefix + name)


def clean_steps(staging: DataFrame, rejects: DataFrame, *, case_insensitive: bool = False,
                redact_patterns=REDACT_PATTERNS, redact_columns=("Supplier",),
                replacement: str = REDACTED_SUPPLIER) -> CleanSteps:
    """Reject list (before redaction) -> redaction -> typing -> dedup, all lazy."""
    rejected = reject_suppliers(staging, rejects, case_insensitive=case_insensitive)
    redacted = redact(rejected, redact_patterns, replacement, redact_columns,
                      case_insensitive=case_insensitive)
    typed = type_columns(redacted)
    return CleanSteps(staging, rejects, rejected, redacted, typed,
                      dedup(typed, case_insensitive=case_insensitive))


def fact_files_wanted(size: int, partitions: int) -> int:
    """The number of fact files for ``size`` bytes of clean rows."""
    return max(1, min(partitions, size // LEAST_FILE_BYTES), -(-size // MOST_FILE_BYTES))


def load_fact(clean: DataFrame, dims: dict[str, DataFrame], members: dict[str, DataFrame],
              path: str | None = None, files_path: str | None = None,
              case_insensitive: bool = False) -> tuple[DataFrame, DataFrame, dict[str, int | None]]:
    """Write the fact and its file ranges: (fact, file ranges, counters).

    ``members`` are the dimensions' members with their row counts; those of
    the dates say how the fact is dealt to files (``lay_out``).
    """
    spark = clean.sparkSession
    dates = members[DATE_DIMENSION[0]].select(DATE_DIMENSION[1], ROWS)
    lost, dated = member_losses(members)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = fact_files_wanted(size_in_bytes(clean), partitions)
    layout = date_layout(dates, max(1, -(-dated // wanted)))
    files = layout.agg(F.max(F.col("_first") + F.col("_files"))).first()[0] or 1
    stored = materialize(lay_out(star_join(clean, dims, case_insensitive), layout, files),
                         FACT_TABLE, path)
    ranges = materialize(file_ranges(stored).coalesce(1), FILES_TABLE, files_path)
    size = ranges.agg(F.coalesce(F.sum("Rows"), F.lit(0)).alias("n"), F.max("MaxDateID").alias("last")).first()
    return stored, ranges, {**lost, "FactRows": size.n, "MaxDateID": size.last}


def build_warehouse(staging: DataFrame, rejects: DataFrame, *, path: str | None = None,
                    case_insensitive: bool = False, redact_columns=("Supplier",),
                    timings: dict[str, float] | None = None) -> Warehouse:
    """Run the whole load and return the materialised star schema.

    With ``path`` the tables are written to a new version folder of the
    warehouse at ``path``, one folder for each table, and committed together
    at the end; :func:`open_warehouse` reads the latest.  Otherwise they go to
    fresh folders in the shared scratch area.  ``timings``, when given,
    receives seconds per phase (clean, dimensions, fact).

    Staging rows that carry the reader's lineage columns also give
    ``Warehouse.malformed``: file and raw line of each row with too few or too
    many fields, written in the same pass.  ``case_insensitive`` compares all
    text under the server's collation (case and trailing blanks ignored).
    """
    clock = [time.perf_counter()]

    def lap(phase: str) -> None:
        now = time.perf_counter()
        if timings is not None:
            timings[phase] = now - clock[0]
        clock[0] = now

    spark = staging.sparkSession
    version = versions.new_version(path) if path else None

    def target(name: str) -> str | None:
        return f"{versions.version_path(path, version)}/{name}" if path else None

    flagged = type_columns(
        redact(mark_rejected(staging, rejects, case_insensitive=case_insensitive),
               columns=redact_columns, case_insensitive=case_insensitive),
        keep=[REJECTED_FLAG, *[c for c in LINEAGE if set(LINEAGE) <= set(staging.columns)]])
    written = materialize(dedup_counted(flagged, case_insensitive=case_insensitive), CLEAN_TABLE,
                          target(CLEAN_TABLE), partition_by=[PART])
    clean = _kept(written)
    counters = {k: int(v) for k, v in counters_of(written).first().asDict().items()}
    counters["InvalidSupplierCount"] = rejects.count()
    lap("clean")
    members = read_members(spark, *keyed_members(clean, case_insensitive))
    dims = as_dimensions(members)
    if path:  # a folder for each table, also for a dimension without members
        dims = {name: materialize(df, name, target(name)) for name, df in dims.items()}
    lap("dimensions")
    fact, files, found = load_fact(clean, dims, members, target(FACT_TABLE), target(FILES_TABLE),
                                   case_insensitive)
    counters.update(found, CleanRows=counters["RowCount_AfterDeDup"])
    if path:
        # the load audit travels with the tables (step counts, latest DateID)
        audit = spark.createDataFrame(sorted(counters.items()), "metric string, value bigint")
        materialize(audit.coalesce(1), AUDIT_TABLE, target(AUDIT_TABLE))
        versions.commit(spark, path, version, {"counters": counters, "tables": _TABLES})
    lap("fact")
    return Warehouse(clean=clean, dims=dims, fact=fact, counters=counters, fact_files=files,
                     malformed=_malformed(written), version=version)


def _kept(written: DataFrame) -> DataFrame:
    return written.where(F.col(PART) == "kept").select(*SPEND_COLUMNS)


def _malformed(written: DataFrame) -> DataFrame:
    """[SourceFile, RawLine, SourceRows] of staged rows with a wrong field count."""
    return written.where(F.col(PART) == "malformed").select(SOURCE_FILE, RAW_LINE, SOURCE_ROWS)


_TABLES = [CLEAN_TABLE, *DIMENSIONS, DATE_DIMENSION[0], FACT_TABLE, FILES_TABLE, AUDIT_TABLE]


def open_warehouse(spark: SparkSession, path: str, version: str | None = None) -> Warehouse:
    """The current load of the warehouse that ``build_warehouse(..., path=path)``
    wrote (or an earlier ``version`` that has not been expired).

    The tables are those of one load, also while another is being written; a
    missing table is an error, never an empty one.
    """
    manifest = versions.current(spark, path)
    version = version or manifest["version"]
    folder = versions.version_path(path, version)

    def stored(name: str) -> DataFrame:
        return spark.read.parquet(f"{folder}/{name}")

    written = spark.read.schema(CLEAN_SCHEMA).parquet(f"{folder}/{CLEAN_TABLE}")
    counters = {r.metric: r.value for r in stored(AUDIT_TABLE).collect()}  # two dozen rows at most
    return Warehouse(clean=_kept(written),
                     dims={name: stored(name) for name in [*DIMENSIONS, DATE_DIMENSION[0]]},
                     fact=stored(FACT_TABLE), counters=counters, fact_files=stored(FILES_TABLE),
                     malformed=_malformed(written), version=version)
