"""Run one day: python -m accountloom 2025-01-01 --inputs ... --base ... --database ..."""

from __future__ import annotations

import argparse

from accountloom.functions import run_date
from accountloom.plans.daily import run_day
from accountloom.schemas import ENTITIES
from accountloom.settings import build_session, is_local
from accountloom.sources.warehouse import create_database


def main() -> None:
    parser = argparse.ArgumentParser(prog="accountloom", description="Load and model one day.")
    parser.add_argument("day", type=run_date, help="run date, YYYY-MM-DD")
    parser.add_argument("--inputs", required=True, help="folder of <entity>.csv files")
    parser.add_argument("--base", required=True, help="folder of the raw and processed zones")
    parser.add_argument("--database", required=True, help="database of the tables and views")
    parser.add_argument(
        "--location",
        help="folder of the database, if it is new; on a cluster one that all executors share",
    )
    parser.add_argument("--as-of", type=run_date, help="day renewals count from; default today")
    parser.add_argument("--reload", action="store_true", help="replace the day, not append to it")
    parser.add_argument(
        "--all-days",
        action="store_true",
        help="rebuild the core tables from all stored days, not this day's part from this day",
    )
    parser.add_argument(
        "--changed-only",
        action="store_true",
        help="as --all-days, but build only the customers anew that this day or an expiring one has rows of",
    )
    parser.add_argument(
        "--retain-days", type=int, help="delete days that are this old on the run date"
    )
    parser.add_argument(
        "--run-id", help="name of the run; repeated under it after a failure, a run goes on where it stopped"
    )
    parser.add_argument(
        "--id-type", choices=["bigint", "int"], default="bigint", help="width of parsed ids"
    )
    parser.add_argument(
        "--multi-line", action="store_true", help="records may hold line breaks inside quotes"
    )
    parser.add_argument(
        "--any-header-order", action="store_true", help="take the order of columns from the header"
    )
    parser.add_argument(
        "--warehouse-text",
        action="store_true",
        help="in staging, trim all whitespace and capitalize after punctuation",
    )
    args = parser.parse_args()

    spark = build_session()
    if not args.location and not is_local(spark) and not spark.catalog.databaseExists(args.database):
        parser.error("a new database on a cluster needs --location, a folder all executors share")
    create_database(spark, args.database, args.location)
    counts = run_day(
        spark,
        {e: f"{args.inputs}/{e}.csv" for e in ENTITIES},
        args.base,
        args.database,
        args.day,
        as_of=args.as_of,
        all_days=args.all_days,
        changed_only=args.changed_only,
        reload=args.reload,
        warehouse_text=args.warehouse_text,
        id_type=args.id_type,
        retain_days=args.retain_days,
        run_id=args.run_id,
        multi_line=args.multi_line,
        any_header_order=args.any_header_order,
    )
    counts.show(truncate=False)
    spark.stop()


if __name__ == "__main__":
    main()
