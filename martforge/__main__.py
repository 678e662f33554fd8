"""Command line for the delivered sales files.

    python -m martforge load    --lake ROOT --table Sales.SalesOrderHeader.csv --file PATH [--batch-id ID]
    python -m martforge stream  --lake ROOT --table Sales.SalesOrderHeader.csv --landing DIR --checkpoint DIR
    python -m martforge refresh --lake ROOT

``--spec FILE`` takes the tables from a JSON file instead (see ``config.read_specs``);
``--modified COLUMN`` loads incrementally by that column of the file.
Run it with spark-submit on a cluster (the master comes from there); ``--master``
is for local runs. Scheduling (daily, per table) is left to the scheduler.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
from dataclasses import asdict

from .config import REFERENCE_SPECS, read_specs, with_modified
from .operators.marts import REFERENCE_STAR
from .plans.load import load_file
from .plans.refresh import refresh_marts
from .session import build_session
from .sources.layers import LakeLayout
from .streaming.file_stream import ingest_stream

STAR_FILES = {
    "detail": "Sales.SalesOrderDetail.csv",
    "header": "Sales.SalesOrderHeader.csv",
    "customer": "Sales.Customer.csv",
    "product": "Production.Product.csv",
    "person": "Person.Person.csv",
}


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="martforge")
    parser.add_argument("--master", default=None)
    sub = parser.add_subparsers(dest="command", required=True)
    for name in ("load", "stream", "refresh"):
        p = sub.add_parser(name)
        p.add_argument("--lake", required=True)
        if name != "refresh":
            p.add_argument("--table", required=True)
            p.add_argument("--spec", default=None)
            p.add_argument("--modified", default=None)
            p.add_argument("--quarantine", action="store_true")
    sub.choices["load"].add_argument("--file", required=True)
    sub.choices["load"].add_argument("--batch-id", default=None)
    sub.choices["load"].add_argument("--force", action="store_true")
    sub.choices["load"].add_argument("--archive", action="store_true")
    sub.choices["stream"].add_argument("--landing", required=True)
    sub.choices["stream"].add_argument("--checkpoint", required=True)
    sub.choices["stream"].add_argument("--archive", default=None)
    args = parser.parse_args(argv)

    if args.command != "refresh":
        specs = read_specs(args.spec) if args.spec else REFERENCE_SPECS
        if args.table not in specs:
            parser.error(f"unknown table {args.table!r}; known: {', '.join(sorted(specs))}")
        spec = with_modified(specs[args.table], args.modified) if args.modified else specs[args.table]

    spark = build_session(args.master, app_name=f"martforge-{args.command}")
    lake = LakeLayout(args.lake.rstrip("/"))
    if args.command == "load":
        batch_id = args.batch_id or dt.datetime.now(dt.timezone.utc).strftime("%Y%m%d%H%M%S")
        result = load_file(spark, spec, args.file, lake, batch_id, quarantine=args.quarantine, force=args.force,
                           archive=args.archive)
        print(json.dumps(asdict(result), default=str))
    elif args.command == "stream":
        for result in ingest_stream(spark, spec, args.landing, lake, args.checkpoint, archive_dir=args.archive,
                                    quarantine=args.quarantine):
            print(json.dumps(asdict(result), default=str))
    else:
        specs = {role: REFERENCE_SPECS[name] for role, name in STAR_FILES.items()}
        print(json.dumps(refresh_marts(spark, lake, REFERENCE_STAR, specs)))


if __name__ == "__main__":
    main()
