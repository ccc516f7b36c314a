"""Command line: the daily chain for a range of days.

    python -m ventilake run 2021-02-03 2021-02-05 --acq DIR --store DIR --dims DIR
    python -m ventilake run 2021-02-03 2021-02-05 --acq DIR --store DIR \\
        --jdbc-url URL --jdbc-user U --jdbc-password-env VAR [--jdbc-driver CLASS]

Like the original ``run <first day> <day after the last>``: the end day is
excluded.  Dimension tables come from parquet folders named after the tables
(``--dims``) or from a JDBC database; credentials are passed by the caller,
the password through an environment variable named on the command line.
"""

from __future__ import annotations

import argparse
import os

from .plans.daily import TABLES, run_files
from .plans.incremental import run_changed
from .plans.partials import PARTIALS, refresh
from .session import build_session

DIMENSIONS = (
    "capteur",
    "facteur_temperature",
    "facteur_debit_position1",
    "facteur_debit_position2",
    "facteur_debit_pression2",
    "facteur_somme_surface_equivalente",
)


def load_dimensions(spark, args) -> dict:
    if args.dims:
        return {name: spark.read.parquet(os.path.join(args.dims, name)) for name in DIMENSIONS}
    props = {"user": args.jdbc_user or "", "password": os.environ.get(args.jdbc_password_env or "", "")}
    if args.jdbc_driver:
        props["driver"] = args.jdbc_driver
    return {name: spark.read.jdbc(args.jdbc_url, name, properties=props) for name in DIMENSIONS}


def main(argv=None, spark=None) -> dict[str, str]:
    parser = argparse.ArgumentParser(prog="ventilake")
    sub = parser.add_subparsers(dest="command", required=True)
    run = sub.add_parser("run", help="ingest files and transform a range of days")
    run.add_argument("day_from")
    run.add_argument("day_to", help="first day NOT processed")
    run.add_argument("--acq", required=True, help="root folder of the .acq files (searched recursively)")
    run.add_argument("--store", required=True, help="folder of the raw and output tables")
    run.add_argument("--dims", help="folder with one parquet folder per dimension table")
    run.add_argument("--jdbc-url")
    run.add_argument("--jdbc-user")
    run.add_argument("--jdbc-password-env")
    run.add_argument("--jdbc-driver")
    run.add_argument("--strict", action="store_true", help="stop before the outputs if a required factor is missing")
    run.add_argument("--real-only", action="store_true", help="household means over real sensors only")
    run.add_argument("--quarantine", action="store_true", help="keep lines that do not parse apart, with file and reason")
    run.add_argument("--changed-only", action="store_true", help="load only the days whose files changed since they were loaded")
    run.add_argument("--partials", action="store_true", help="bring the stored partial sums per household-day up to date")
    run.add_argument("--master", default=None, help="default: the launcher's (spark-submit)")
    run.add_argument("--shuffle-partitions", type=int, default=200)
    args = parser.parse_args(argv)
    if not args.dims and not args.jdbc_url:
        parser.error("give --dims or --jdbc-url")
    if spark is None:
        spark = build_session(args.master, shuffle_partitions=args.shuffle_partitions)
    dims = load_dimensions(spark, args)
    span = (args.day_from, args.day_to)
    options = {"strict": args.strict, "real_only": args.real_only, "quarantine": args.quarantine}
    if args.changed_only:
        run_changed(spark, args.acq, args.store, dims, *span, **options)
        paths = {name: os.path.join(args.store, name) for name in TABLES}
    else:
        paths = run_files(spark, args.acq, args.store, dims, *span, **options)
    if args.partials:
        refresh(spark, args.store, dims, *span)
        paths[PARTIALS] = os.path.join(args.store, PARTIALS)
    return paths


if __name__ == "__main__":
    main()
