"""Command line: the nightly job and single queries.

    python -m tidemark run --extracts DIR --out DIR      # CSV extracts
    python -m tidemark run --testdata SF_DIR --out DIR   # the driver's tables
    python -m tidemark query NAME --testdata SF_DIR [--out DIR]
    python -m tidemark list

`run` prints a JSON summary: written paths, failed checks, overall status. It
exits with 1, and publishes nothing, if a declared test fails (`--no-gate`
publishes anyway and exits with 0).
The master and every other setting come from spark-submit / the session
defaults unless `--master` is given.
"""

from __future__ import annotations

import argparse
import json
import sys


def _session(master: str | None):
    if master:
        from tidemark.session import build_session
        return build_session(master)
    return _default_session()


def _default_session():
    from pyspark.sql import SparkSession

    from tidemark.session import DEFAULT_CONF, ensure_checkpoint_dir
    builder = SparkSession.builder.appName("tidemark")
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def _sources(spark, args):
    """The sources, and the malformed rows that were left out of them."""
    if not args.extracts:
        from tidemark.sources.testviews import load_sources
        return load_sources(spark, args.testdata), None
    from tidemark.sources import extracts
    read = extracts.read_extracts(spark, args.extracts,
                                  {name: False for name in args.single_line})
    good = {name: extracts.good_rows(df, name, args.on_malformed) for name, df in read.items()}
    return good, extracts.rejects(read) if args.on_malformed == "reject" else None


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="tidemark")
    sub = p.add_subparsers(dest="cmd", required=True)
    r = sub.add_parser("run", help="build marts, run checks, write the health report")
    src = r.add_mutually_exclusive_group(required=True)
    src.add_argument("--extracts", help="folder with plans.csv, invoices.csv, "
                                        "usage_events.csv, crm_customers/customers_*.csv")
    src.add_argument("--testdata", help="folder of the driver's Parquet tables")
    r.add_argument("--out", required=True)
    r.add_argument("--master")
    r.add_argument("--z-threshold", type=float, default=2.0)
    r.add_argument("--warn-threshold", type=float, default=0.05)
    r.add_argument("--no-gate", action="store_true", help="publish whatever the tests say")
    r.add_argument("--on-malformed", choices=("fail", "reject"), default="fail",
                   help="stop at a malformed CSV row, or write it to _rejects")
    r.add_argument("--single-line", action="append", default=[], metavar="SOURCE",
                   help="an extract without quoted line ends, to be read in splits")
    r.add_argument("--calendar", nargs=2, metavar=("FIRST", "LAST"), help="days of dim_date")
    r.add_argument("--null-safe", action="store_true",
                   help="a change to or from NULL opens a version")
    r.add_argument("--fill-calendar", action="store_true",
                   help="days without snapshot rows count as 0 in the volume check")
    q = sub.add_parser("query", help="run one registered query")
    q.add_argument("name")
    q.add_argument("--testdata", required=True)
    q.add_argument("--out", help="write Parquet here instead of showing rows")
    q.add_argument("--master")
    sub.add_parser("list", help="list the registered queries")
    args = p.parse_args(argv)

    if args.cmd == "list":
        from tidemark.catalog import QUERIES
        print("\n".join(sorted(QUERIES)))
        return 0

    spark = _session(args.master)
    if args.cmd == "query":
        from tidemark.catalog import QUERIES
        df = QUERIES[args.name](spark, args.testdata)
        if args.out:
            df.write.mode("overwrite").parquet(args.out)
        else:
            df.show(50, truncate=False)
        return 0

    from pyspark.sql import functions as F

    from tidemark.plans.pipeline import ChecksFailed, run
    sources, rejects = _sources(spark, args)
    try:
        paths = run(spark, sources, args.out, z_threshold=args.z_threshold,
                    warn_threshold=args.warn_threshold, gate=not args.no_gate,
                    calendar=tuple(args.calendar) if args.calendar else None,
                    null_safe=args.null_safe, fill_calendar=args.fill_calendar, rejects=rejects)
    except ChecksFailed as e:
        print(json.dumps({"published": False, "failed_checks": e.failed, "checks": e.path}))
        return 1
    # one row per declared test: 32 rows at most
    failed = [r.asDict() for r in spark.read.parquet(paths["_checks"])
              .where(~F.col("passed")).drop("passed").collect()]
    status = spark.read.json(paths["dq_report"]).select("overall_status").first()[0]
    loaded = {r.table_name: r.row_count
              for r in spark.read.parquet(paths["_load_summary"]).collect()}   # 4 rows
    print(json.dumps({"published": True, "loaded": loaded, "paths": paths,
                      "failed_checks": failed, "overall_status": status}))
    return 0


if __name__ == "__main__":
    sys.exit(main())
