"""Command line: derive/store the tables, run registered jobs.

    python -m schemelens load --source /data/driver --warehouse /shared/wh [--buckets N]
    python -m schemelens run q24_officer_dashboard --warehouse /shared/wh --out /shared/reports/q24
    python -m schemelens pay --warehouse /shared/wh --batch 2001-08-15
    python -m schemelens list

On a cluster submit the same module (``spark-submit --py-files schemelens.zip``);
session settings come from the submit configuration.
"""

from __future__ import annotations

import argparse
import sys


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="schemelens")
    sub = ap.add_subparsers(dest="cmd", required=True)
    ld = sub.add_parser("load", help="derive the tables from the driver parquet and store them")
    ld.add_argument("--source", required=True)
    ld.add_argument("--warehouse", required=True)
    ld.add_argument("--buckets", type=int, default=0)
    ld.add_argument("--check", action="store_true", help="count rows that break NOT NULL and CHECK rules in the same pass")
    rn = sub.add_parser("run", help="run one registered job and write its result as parquet")
    rn.add_argument("job")
    rn.add_argument("--warehouse", help="stored tables (from `load`)")
    rn.add_argument("--source", help="driver parquet folder (tables derived on the fly; also the stream source)")
    rn.add_argument("--out", required=True)
    py = sub.add_parser("pay", help="append the payment run's rows to the stored payments and bring the pools up to date")
    py.add_argument("--warehouse", required=True)
    py.add_argument("--batch", required=True, help="id of the run; a run that was stored already is not made again")
    sub.add_parser("list", help="list the registered jobs")
    args = ap.parse_args(argv)

    from schemelens.registry import load_all, to_output
    jobs = load_all()
    if args.cmd == "list":
        for name, job in jobs.items():
            print(f"{name:40s} {job.doc}")
        return 0

    from schemelens.session import build_session
    from schemelens.sources.catalog import Catalog
    from schemelens.sources.sinks import write_result
    spark = build_session()
    if args.cmd == "load":
        cat = Catalog.from_testdata(spark, args.source).materialize(args.warehouse, buckets=args.buckets or None, check=args.check)
        for (table, rule), n in sorted(cat.failed_rules.items()):
            if n:
                print(f"{table}: {n} rows break {rule}")
        return 0
    if args.cmd == "pay":
        from schemelens.operators.ledger import run_payments
        print(run_payments(Catalog.from_warehouse(spark, args.warehouse), args.batch))
        return 0
    if args.job not in jobs:
        print(f"unknown job {args.job}; see `list`", file=sys.stderr)
        return 2
    if args.warehouse:
        cat = Catalog.from_warehouse(spark, args.warehouse, source_dir=args.source)
    elif args.source:
        cat = Catalog.from_testdata(spark, args.source)
    else:
        print("give --warehouse or --source", file=sys.stderr)
        return 2
    write_result(to_output(jobs[args.job].fn(cat)), args.out)
    return 0


if __name__ == "__main__":
    sys.exit(main())
