"""Command line: ``python -m ledgerline <command> ...``.

* ``extract``  one extraction run (INIT / DELTA / NONE per table) from a change log and source
               tables into bronze;
* ``build``    the daily build: gold tables from bronze, then the data-quality checks;
* ``history``  the published batches of a bronze table (batch, load type, rows, watermark);
* ``rollback`` remove the batches of a table that landed after a day;
* ``demo``     derive the ERP tables from a TESTDATA folder, then build and check them.

Every command prints one JSON document; ``build`` and ``demo`` end with 1 if a table broke its
constraints or a check found violations. Spark settings come from the launcher (spark-submit)
or the library defaults.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="ledgerline")
    sub = p.add_subparsers(dest="command", required=True)
    e = sub.add_parser("extract", help="extract changes into bronze")
    e.add_argument("--bronze", required=True, help="bronze root folder (shared file system)")
    e.add_argument("--log", required=True, help="change-log path")
    e.add_argument("--log-format", default="parquet", choices=["parquet", "csv"])
    e.add_argument("--source", action="append", default=[], metavar="TABLE=PATH[:FORMAT]",
                   help="a source table (format parquet or csv; default parquet)")
    e.add_argument("--parallelism", type=int, default=1)
    e.add_argument("--safe", action="store_true",
                   help="also delete keys created and removed in the window that bronze holds as live")
    b = sub.add_parser("build", help="build gold tables and run the checks")
    b.add_argument("--bronze", required=True)
    b.add_argument("--gold", required=True)
    h = sub.add_parser("history", help="published batches of a bronze table")
    h.add_argument("--bronze", required=True)
    h.add_argument("--table", required=True)
    r = sub.add_parser("rollback", help="remove the batches that landed after a day")
    r.add_argument("--bronze", required=True)
    r.add_argument("--table", required=True)
    r.add_argument("--day", required=True, help="last landing day that stays, YYYY-MM-DD")
    d = sub.add_parser("demo", help="derive ERP tables from TESTDATA, then build and check")
    d.add_argument("--sf-dir", required=True)
    d.add_argument("--gold", required=True)
    return p


def run(argv: list[str], spark: SparkSession | None = None) -> dict:
    args = _parser().parse_args(argv)
    from ledgerline.session import get_session
    spark = spark or get_session()
    if args.command == "extract":
        from ledgerline.sources import bronze, erp
        log = erp.read_change_log(spark, args.log, args.log_format)
        sources = {}
        for item in args.source:
            table, _, rest = item.partition("=")
            path, _, fmt = rest.partition(":")
            reader = erp.read_csv if fmt == "csv" else erp.read_parquet
            sources[table.lower()] = reader(spark, table.lower(), path)
        return {"runs": bronze.extract_all(spark, log, sources, args.bronze,
                                           parallelism=args.parallelism, safe=args.safe)}
    if args.command == "history":
        from ledgerline.sources import bronze
        hist = bronze.batch_history(bronze.read_bronze(spark, args.bronze, args.table.lower()))
        rows = hist.orderBy("watermark").collect()    # one row per published batch
        return {"batches": [{**r.asDict(), "extracted_at": str(r["extracted_at"]),
                             "extracted_day": str(r["extracted_day"])} for r in rows]}
    if args.command == "rollback":
        from ledgerline.sources import bronze
        return {"watermark": bronze.roll_back(spark, args.bronze, args.table.lower(), args.day)}
    from ledgerline.plans import build
    from ledgerline.plans.lakehouse import Lakehouse
    if args.command == "build":
        lh = Lakehouse.from_bronze_root(spark, args.bronze)
    else:
        lh = Lakehouse.from_fixtures(spark, args.sf_dir)
    return build.run_daily(lh, args.gold)


def main() -> int:
    """Prints the result; 1 if a build rejected a table or a check found violations."""
    result = run(sys.argv[1:])
    print(json.dumps(result, default=str))
    return 0 if result.get("ok", True) else 1


if __name__ == "__main__":
    sys.exit(main())
