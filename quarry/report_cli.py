"""spark-submit entry point of the reports: one row as a line of JSON.

    spark-submit -m quarry.cli report lookup --left table:prices --right /tables/speed --on name=country \\
        --value Chile --column country=name --column mbit_per_s=avg_mbit_per_s
    spark-submit -m quarry.cli report extreme --left table:users --label country --measure internet_users --query-type highest
    spark-submit -m quarry.cli report group --left table:prices --group region --measure avg_price
    spark-submit -m quarry.cli report joined --left table:speed --right table:users --on country=country \\
        --group sub_region --measure avg_mbit_per_s --query-type highest

A table is a Parquet path, ``parts:PATH`` (a table in hash partitions) or ``table:NAME``. Arguments are
checked before a session is made; without a row for them the command ends with code 1 and says so.
"""

from __future__ import annotations

import argparse
import json
import sys

from quarry.specs import QueryType

_NEEDS = {"lookup": ("right", "on", "value", "column"), "extreme": ("label", "measure"),
          "group": ("group", "measure"), "joined": ("right", "on", "group", "measure")}


def _pair(text: str) -> tuple[str, str]:
    a, mark, b = text.partition("=")
    if not (a and mark and b):
        raise argparse.ArgumentTypeError(f"expected NAME=NAME, got {text!r}")
    return a, b


def parse_args(argv=None):
    p = argparse.ArgumentParser(prog="quarry report")
    p.add_argument("report", choices=_NEEDS)
    p.add_argument("--left", required=True, help="the (first) table")
    p.add_argument("--right", help="the table joined to it")
    p.add_argument("--on", type=_pair, metavar="LEFT=RIGHT", help="key columns of the two")
    p.add_argument("--value", help="lookup: the key's value")
    p.add_argument("--column", type=_pair, action="append", metavar="NAME=COLUMN", help="lookup: result column, repeatable")
    p.add_argument("--label", help="extreme: the column that names a row")
    p.add_argument("--group", help="the column to group by")
    p.add_argument("--measure", help="the column whose extreme or mean is wanted")
    p.add_argument("--query-type", type=QueryType.parse, default=QueryType.LOWEST)
    args = p.parse_args(argv)
    missing = [n for n in _NEEDS[args.report] if not getattr(args, n)]
    if missing:
        p.error(f"{args.report} needs {', '.join('--' + n for n in missing)}")
    return args


def _table(spark, name: str):
    from quarry.sinks.partitions import read_partitioned

    if name.startswith("table:"):
        return spark.table(name[len("table:"):])
    if name.startswith("parts:"):
        return read_partitioned(spark, name[len("parts:"):])
    return spark.read.parquet(name)


def main(argv=None, spark=None) -> int:
    """Run one report; a given ``spark`` session is used and left running."""
    args = parse_args(argv)
    from quarry.plans import reports
    from quarry.session import build_session

    own = spark is None
    if own:
        spark = build_session(app=f"quarry-report-{args.report}")
    left, qt = _table(spark, args.left), args.query_type
    if args.report == "lookup":
        found = reports.lookup(left, _table(spark, args.right), *args.on, args.value, dict(args.column))
    elif args.report == "extreme":
        found = reports.extreme_row(left, args.label, args.measure, qt, args.label, args.measure)
    elif args.report == "group":
        found = reports.best_group(left, args.group, args.measure, qt, args.group, args.measure)
    else:
        found = reports.best_group_joined(left, _table(spark, args.right), args.on, args.group, args.measure, qt, args.group, args.measure)
    try:
        print(json.dumps(reports.fetch_one(found), default=str, ensure_ascii=False))
    except reports.NoDataError as e:
        print(e, file=sys.stderr)
        return 1
    finally:
        if own:
            spark.stop()
    return 0
