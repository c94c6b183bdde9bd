"""Command line: load spend files into a warehouse, then run reports on it.

    python -m spendstar load --spend 'raw/*.txt' --rejects suppliers.xml --out wh/
    python -m spendstar report top_suppliers --warehouse wh/ [--output out/] [--ordered]
    python -m spendstar ingest --inbox raw/ --staging staging/   # append new files once
    python -m spendstar load --staging staging/ --rejects suppliers.xml --out wh/
    python -m spendstar publish --warehouse wh/ --database spend   # catalog tables and views
    python -m spendstar views                           # list the report view names

``load`` prints the step counters, the row loss per dimension and the
integrity report (all zero when the load is sound), like the validation
queries of a warehouse load script.  ``report`` shows the first rows, or
writes the whole result (Parquet, or JSON for the JSON report) to
``--output``.  The session is whatever ``spark-submit`` provides; run
locally it is a ``local[*]`` session.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from spendstar.operators.audit import integrity
from spendstar.operators.fact import DIAGNOSTIC_NAMES, MISS_COUNTERS
from spendstar.plans import reports
from spendstar.plans.publish import VIEW_NAMES, save_tables, save_views
from spendstar.plans.warehouse import build_warehouse, open_warehouse
from spendstar.session import DEFAULT_CONF
from spendstar.sources.delimited import read_spend
from spendstar.sources.reject_list import read_reject_list
from spendstar.streaming.ingest import ingest_spend

REPORTS = {
    "top_suppliers": reports.top_suppliers,
    "top_suppliers_monthly": reports.top_suppliers_monthly,
    "expense_types_above_avg": reports.expense_types_above_avg,
    "expense_types_above_avg_json": reports.expense_types_above_avg_json,
    "area_rank_movement": reports.area_rank_movement,
    "supplier_time_hierarchy": reports.supplier_time_hierarchy,
}


LINE_ENDINGS = {"auto": None, "lf": "\n", "crlf": "\r\n", "cr": "\r"}


def _session() -> SparkSession:
    builder = SparkSession.builder.appName("spendstar")
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def _load(args) -> int:
    spark = _session()
    if args.staging:
        staging = spark.read.parquet(args.staging)
    else:
        staging = read_spend(spark, args.spend, sep=args.sep, encoding=args.encoding,
                             line_sep=LINE_ENDINGS[args.line_ending])
    rejects = read_reject_list(spark, args.rejects, repair=args.repair_xml)
    wh = build_warehouse(staging, rejects, path=args.out, case_insensitive=args.case_insensitive)
    print(json.dumps({"counters": wh.counters, "version": wh.version}))
    for key, counter in MISS_COUNTERS.items():
        print(f"unmatched {DIAGNOSTIC_NAMES[key]}: {wh.counters[counter]}")
    violations = [r for r in integrity(wh.dims, wh.numbered_fact, rejects).collect() if r.violations]
    for r in violations:
        print(f"integrity {r.check}: {r.violations}")
    return 1 if violations else 0


def _ingest(args) -> int:
    spark = _session()
    ingest_spend(spark, args.inbox, args.staging, checkpoint=args.checkpoint,
                 sep=args.sep).awaitTermination()
    print(json.dumps({"staging_rows": spark.read.parquet(args.staging).count()}))
    return 0


def _publish(args) -> int:
    spark = _session()
    wh = open_warehouse(spark, args.warehouse)
    for name in save_tables(wh, args.database, location=args.location) + save_views(spark, args.database):
        print(name)
    return 0


def _report(args) -> int:
    spark = _session()
    wh = open_warehouse(spark, args.warehouse)
    fn = REPORTS[args.name]
    kwargs = {"ordered": True} if args.ordered and args.name not in (
        "top_suppliers", "expense_types_above_avg_json") else {}
    df = fn(wh, **kwargs)
    if args.output:
        writer = df.write.mode("overwrite")
        if args.name.endswith("_json"):
            writer.text(args.output)
        else:
            writer.parquet(args.output)
    else:
        df.show(args.rows, truncate=False)
    return 0


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="spendstar")
    sub = p.add_subparsers(dest="cmd", required=True)
    load = sub.add_parser("load", help="spend files + reject list -> warehouse")
    source = load.add_mutually_exclusive_group(required=True)
    source.add_argument("--spend", nargs="+", help="files, folders or globs")
    source.add_argument("--staging", help="the staging table that `ingest` writes")
    load.add_argument("--rejects", required=True, help="reject-list XML file(s)")
    load.add_argument("--out", required=True, help="warehouse folder (shared storage)")
    load.add_argument("--sep", default="\t")
    load.add_argument("--encoding", help="default: by byte-order mark, else UTF-8")
    load.add_argument("--line-ending", choices=list(LINE_ENDINGS), default="auto",
                      help="default: that of each file's first line")
    load.add_argument("--repair-xml", action="store_true", help="escape bare '&' first")
    load.add_argument("--case-insensitive", action="store_true",
                      help="ignore case (and trailing spaces in keys) everywhere")
    rep = sub.add_parser("report", help="run one report on a loaded warehouse")
    rep.add_argument("name", choices=sorted(REPORTS))
    rep.add_argument("--warehouse", required=True)
    rep.add_argument("--output")
    rep.add_argument("--ordered", action="store_true", help="apply the procedure's ORDER BY")
    rep.add_argument("--rows", type=int, default=20)
    ing = sub.add_parser("ingest", help="append newly arrived spend files to a staging table")
    ing.add_argument("--inbox", required=True, help="folder the spend files arrive in")
    ing.add_argument("--staging", required=True, help="Parquet staging table (shared storage)")
    ing.add_argument("--checkpoint", help="stream checkpoint (default: under spark.checkpoint.dir)")
    ing.add_argument("--sep", default="\t")
    pub = sub.add_parser("publish", help="loaded warehouse -> catalog tables and report views")
    pub.add_argument("--warehouse", required=True)
    pub.add_argument("--database", required=True)
    pub.add_argument("--location", help="folder of a new database (default: the session's warehouse)")
    sub.add_parser("views", help="list the report view names")
    args = p.parse_args(argv)
    if args.cmd == "load":
        return _load(args)
    if args.cmd == "report":
        return _report(args)
    if args.cmd == "publish":
        return _publish(args)
    if args.cmd == "ingest":
        return _ingest(args)
    print("\n".join(VIEW_NAMES))
    return 0


if __name__ == "__main__":
    sys.exit(main())
