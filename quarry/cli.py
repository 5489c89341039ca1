"""spark-submit entry point: run one of the three migration jobs, or (``report ...``, see
``report_cli``) one of the four reports.

    spark-submit -m quarry.cli file overwrite --source speed.csv --target /tables/speed
    spark-submit -m quarry.cli delimited update --source /landing/prices/ \\
        --target /tables/prices/v1 --out /tables/prices/v2
    spark-submit -m quarry.cli documents overwrite --source /exports/users/ --target table:users \\
        --location /tables/users/v1

Text files of the delimited job begin with a header line each, which is skipped whatever
its text; ``--payloads`` reads JSON arrays of lines instead, whose first element is skipped.

The insert mode and job name are checked before a session is created.
Errors propagate (non-zero exit with the Spark error), they are not mapped
to codes by message text.
"""

from __future__ import annotations

import argparse
import json
import sys

from quarry.specs import InsertMode

JOBS = ("file", "documents", "delimited")


def parse_args(argv=None):
    p = argparse.ArgumentParser(prog="quarry")
    p.add_argument("job", choices=JOBS)
    p.add_argument("mode", type=InsertMode.parse)
    p.add_argument("--source", required=True, help="input path (CSV, JSON documents, text lines)")
    p.add_argument("--target", required=True, help="Parquet path, table:NAME, or a JDBC URL#TABLE")
    p.add_argument("--out", help="new table path for update mode (path targets)")
    p.add_argument("--location", help="folder of a catalog table that does not exist yet")
    p.add_argument("--property", action="append", default=[], metavar="KEY=VALUE",
                   help="JDBC connection property, repeatable")
    p.add_argument("--payloads", action="store_true",
                   help="delimited job: the source holds JSON arrays of lines, one per text line")
    p.add_argument("--header-map", help="JSON file with the ordered header map (delimited job)")
    p.add_argument("--format", default="json", help="document source format (json, mongodb)")
    p.add_argument("--option", action="append", default=[], metavar="KEY=VALUE",
                   help="source option, repeatable (e.g. connection.uri=...)")
    p.add_argument("--replace-missing", action="store_true",
                   help="update: drop target rows whose key is not in the source")
    p.add_argument("--allow-empty", action="store_true")
    return p.parse_args(argv)


def main(argv=None, spark=None) -> int:
    """Run one job; a given ``spark`` session is used and left running."""
    argv = sys.argv[1:] if argv is None else list(argv)
    if argv[:1] == ["report"]:
        from quarry import report_cli
        return report_cli.main(argv[1:], spark)
    args = parse_args(argv)
    from quarry.plans import jobs
    from quarry.session import build_session
    from quarry.sinks.targets import parse_target
    from quarry.sources.delimited import header_names, read_lines, read_payloads
    from quarry.sources.files import read_csv, read_documents

    own = spark is None
    if own:
        spark = build_session(app=f"quarry-{args.job}")
    options = dict(kv.split("=", 1) for kv in args.option)
    target = parse_target(args.target, args.out, args.location, dict(kv.split("=", 1) for kv in args.property))
    rejects = None
    if args.job == "file":
        spec = jobs.FILE_JOB
        source = read_csv(spark, args.source, schema=jobs.SPEED_CSV_SCHEMA, extra=True, **options)
    elif args.job == "documents":
        spec = jobs.DOCUMENT_JOB
        source = read_documents(spark, None if args.format != "json" else args.source,
                                schema=jobs.USER_DOC_SCHEMA, format=args.format, **options)
    else:
        spec = jobs.DELIMITED_JOB
        names = header_names(args.header_map) if args.header_map else jobs.PRICE_NAMES
        read = read_payloads if args.payloads else read_lines
        how = {} if args.payloads else {"first_is_header": True}
        source, rejects = read(spark, args.source, names, with_rejects=True, **how)
    result = jobs.run_job(spark, spec, source, args.mode, target, allow_empty=args.allow_empty,
                          keep_missing=not args.replace_missing, rejects=rejects)
    print(json.dumps(result.__dict__, default=str))
    if own:
        spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
