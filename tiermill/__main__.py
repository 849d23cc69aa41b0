"""Command line: run all layer steps, or only the named ones, then report checks.

    python -m tiermill RAW_PATH LAKE_ROOT OUT_DIR [bronze silver gold results]
        [--gate] [--register] [--checks] [--reference FILE] [--show] [--month MONTH]
        [--silver-layout rebalance|local|range] [--source-per-file]

The session is the one submitted (``spark-submit``) with its own settings.
"""

from __future__ import annotations

import argparse
import sys

from tiermill.operators import quality
from tiermill.plans.medallion import STEPS, load_bronze, load_golds, load_rankings, load_silver, run, run_month
from tiermill.plans.results import RESULTS, result
from tiermill.session import active_session
from tiermill.sources.raw_csv import SourceNotFound, read_raw


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="tiermill", description=__doc__.splitlines()[0])
    p.add_argument("raw_path")
    p.add_argument("root")
    p.add_argument("out_dir")
    p.add_argument("steps", nargs="*", help=f"subset of {list(STEPS)} (default: all)")
    p.add_argument("--gate", action="store_true", help="promote a layer only when its checks pass")
    p.add_argument("--register", action="store_true", help="register layer tables in the session catalog")
    p.add_argument("--checks", action="store_true", help="run the validation suite afterwards")
    p.add_argument("--silver-layout", default="rebalance", choices=["rebalance", "sorted", "local", "range"])
    p.add_argument("--source-per-file", action="store_true", help="record each row's input file in bronze")
    p.add_argument("--reference", help="JSON lines file with the row of expected values (adds those checks)")
    p.add_argument("--show", action="store_true", help="print the first 20 rows of each result")
    p.add_argument("--month", help="the raw path is the delivery of this month: replace it and refresh what depends on it")
    args = p.parse_args(argv)

    spark = active_session()
    try:
        if args.month:
            paths = run_month(spark, args.raw_path, args.root, args.out_dir, args.month, gate=args.gate)
        else:
            paths = run(
                spark, args.raw_path, args.root, args.out_dir, [s.lower() for s in args.steps] or None,
                silver_layout=args.silver_layout, register=args.register, gate=args.gate,
                source_per_file=args.source_per_file,
            )
    except SourceNotFound as err:
        print(f"error: {err}", file=sys.stderr)
        return 1
    for name, path in paths.items():
        print(f"{name}: {path}")
    if args.show:
        golds = load_golds(spark, args.root)
        for name in RESULTS:
            print(f"-- {name}")
            result(golds, name).show(20, truncate=False)
    if args.checks:
        reference = spark.read.json(args.reference) if args.reference else None
        suite = quality.checks(
            read_raw(spark, args.raw_path), load_bronze(spark, args.root), load_silver(spark, args.root),
            load_golds(spark, args.root), args.out_dir, reference, ranked=load_rankings(spark, args.root),
        )
        rows = suite.collect()  # about twenty rows, run once
        for r in rows:
            print(f"{'ok  ' if r['passed'] else 'FAIL'} {r['check']}: {r['detail']}")
        n_passed = sum(bool(r["passed"]) for r in rows)
        print(f"{n_passed} of {len(rows)} checks passed")
        return 0 if rows and n_passed == len(rows) else 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
