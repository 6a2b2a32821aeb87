"""Runs one report or conversion with spark-submit or ``python -m incident_analytics``."""

from __future__ import annotations

import argparse
import sys
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession

from incident_analytics.operators import STRATEGIES
from incident_analytics.plans import (
    daypart_counts,
    daypart_counts_sql,
    station_distance,
    top_months,
    top_months_report,
    top_months_script,
    top_months_sql,
    victims_by_income,
)
from incident_analytics.functions.times import DAYPARTS, DAYPARTS_GREEK
from incident_analytics.plans.station_distance import ROUTES
from incident_analytics.plans.victims import SIDES
from incident_analytics.sources import (
    Conversion,
    convert,
    convert_new,
    read_incidents,
    read_income,
    read_revgeo,
    read_stations,
    write_csv,
    write_parquet,
)
from incident_analytics.sources.schemas import TABLES

_LABELS = {"english": DAYPARTS, "greek": DAYPARTS_GREEK}
# The columns that each report reads.
_COLUMNS = {
    "top-months": ("date_occ",),
    "dayparts": ("time_occ", "premis_desc"),
    "victims": ("rptd_year", "vict_descent", "lat", "lon"),
    "station-distance": ("dr_no", "area", "weapon_cd", "lat", "lon"),
}


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="incident_analytics")
    commands = parser.add_subparsers(dest="command", required=True)

    def dialect(command: argparse.ArgumentParser) -> None:
        command.add_argument("--in-sep", default=",", help="delimiter of the CSV read")
        command.add_argument("--multi-line", action="store_true", help="quoted values of the CSV read have line breaks")

    def report(name: str, text: str) -> argparse.ArgumentParser:
        command = commands.add_parser(name, help=text)
        command.add_argument("--incidents", nargs="+", required=True, help="one path per era")
        command.add_argument("--format", choices=("csv", "parquet"), default="csv")
        where = command.add_mutually_exclusive_group(required=True)
        where.add_argument("--out", help="folder to write the whole result to")
        where.add_argument("--show", type=int, metavar="N", help="print the first N rows instead")
        command.add_argument("--out-format", choices=("csv", "parquet"), default="csv")
        command.add_argument("--sep", default=",", help="delimiter of the CSV written")
        dialect(command)
        return command

    months = report("top-months", "months with the most incidents of each year")
    months.add_argument("--api", choices=("dataframe", "sql", "script"), default="dataframe")
    months.add_argument("-k", type=int, default=3)
    months.add_argument("--pad", action="store_true", help="pad the columns for printing")

    dayparts = report("dayparts", "incidents on a kind of premises by part of the day")
    dayparts.add_argument("--api", choices=("dataframe", "sql"), default="dataframe")
    dayparts.add_argument("--premise", default="STREET")
    dayparts.add_argument("--labels", choices=sorted(_LABELS), default="english")
    dayparts.add_argument("--prefix2", action="store_true", help="take the first two digits for the hour")

    victims = report("victims", "victims by descent where incomes are highest or lowest")
    victims.add_argument("--revgeo", required=True)
    victims.add_argument("--income", required=True)
    victims.add_argument("--year", type=int, default=2015)
    victims.add_argument("-n", type=int, default=3)
    victims.add_argument("--side", choices=SIDES, default="top")
    victims.add_argument("--strategy", choices=STRATEGIES, default="auto")

    distance = report("station-distance", "firearm incidents and distance to the station")
    distance.add_argument("--stations", required=True)
    distance.add_argument("--route", choices=ROUTES, default="auto")

    copy = commands.add_parser("convert", help="CSV to Parquet")
    copy.add_argument("--table", choices=sorted(TABLES), help="give the copy this table's types")
    copy.add_argument("--partition-by", action="append", default=[])
    copy.add_argument("--manifest", help="sources are folders; convert only files that this table doesn't list yet")
    copy.add_argument("paths", nargs="+", metavar="SOURCE TARGET", help="one pair per file")
    dialect(copy)
    return parser


def build(spark: SparkSession, args: argparse.Namespace, account: Observation | None = None) -> DataFrame:
    """The result of the report that the arguments name; ``account`` counts unreadable values of the incidents."""
    dialect = {"fmt": args.format, "sep": args.in_sep, "multi_line": args.multi_line}
    columns = list(_COLUMNS[args.command])
    if args.command == "top-months" and args.format == "csv":
        columns.append("date_occ_text")
    incidents = read_incidents(spark, *args.incidents, columns=columns, account=account, **dialect)
    if args.command == "top-months":
        if args.api == "dataframe":
            ranked = top_months(incidents, args.k)
        else:
            by_text = top_months_sql if args.api == "sql" else top_months_script
            ranked = by_text(spark, incidents, args.k)
        return top_months_report(ranked) if args.pad else ranked
    if args.command == "dayparts":
        compat = "prefix2" if args.prefix2 else None
        if args.api == "sql":
            return daypart_counts_sql(spark, incidents, args.premise, _LABELS[args.labels], compat)
        return daypart_counts(incidents, args.premise, _LABELS[args.labels], compat)
    if args.command == "victims":
        return victims_by_income(
            incidents,
            read_revgeo(spark, args.revgeo, **dialect),
            read_income(spark, args.income, **dialect),
            args.year,
            args.n,
            args.side,
            args.strategy,
        )
    stations = read_stations(spark, args.stations, **dialect)
    return station_distance(incidents, stations, args.route)


def _tell(name: str, counts: Mapping[str, int]) -> None:
    """Say on standard error how many rows were read and which columns had unreadable values."""
    bad = [f"{n} unreadable in {c}" for c, n in counts.items() if c != "rows" and n]
    print(f"{name}: {counts['rows']} rows" + "".join(f", {b}" for b in bad), file=sys.stderr)


def run(spark: SparkSession, argv: Sequence[str] | None = None) -> None:
    """Carry out one command line."""
    args = _parser().parse_args(argv)
    if args.command == "convert":
        if len(args.paths) % 2:
            raise ValueError("convert takes pairs of source and target")
        jobs = [
            Conversion(
                source, target, args.table, args.in_sep,
                partition_by=tuple(args.partition_by), multi_line=args.multi_line,
            )
            for source, target in zip(args.paths[::2], args.paths[1::2], strict=True)
        ]
        if args.manifest:
            for job in jobs:
                for path in convert_new(spark, job, args.manifest):
                    print(f"converted {path}", file=sys.stderr)
            return
        for job, counts in zip(jobs, convert(spark, jobs), strict=True):
            _tell(job.source, counts)
        return
    # A report of no rows at all reads nothing, so nothing would be counted.
    account = Observation() if min(getattr(args, "k", 1), getattr(args, "n", 1)) > 0 else None
    result = build(spark, args, account)
    if args.out is None:
        result.show(args.show, truncate=False)
    elif args.out_format == "parquet":
        write_parquet(result, args.out)
    else:
        write_csv(result, args.out, args.sep)
    if account is not None:
        _tell("incidents", account.get)


if __name__ == "__main__":
    run(
        SparkSession.builder.appName("incident-analytics")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
