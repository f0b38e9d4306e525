"""The daily run: land, clean, store, load, model, in that order."""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Callable, Mapping, Sequence
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from accountloom.functions import WIDE, run_date
from accountloom.plans.cleaning import CLEANERS, clean_contacts, clean_customers
from accountloom.plans.core import build_core
from accountloom.plans import bitmaps, changes, sums
from accountloom.plans.dashboard import register_reports
from accountloom.plans.staging import create_staging_views, stage_all
from accountloom.schemas import CORE_COLUMNS, ENTITIES
from accountloom.settings import size_for, stored_bytes
from accountloom.sources import landing, warehouse
from accountloom.sources.ledger import Ledger
from accountloom.sources.parallel import write_together

log = logging.getLogger(__name__)


def process_day(
    spark: SparkSession,
    base: str,
    day: dt.date | str,
    id_type: str = WIDE,
    multi_line: bool = False,
) -> None:
    """Clean a landed day into Parquet.

    Contacts are checked against the customers just written, so the
    deduplication runs once. multi_line is what the day was landed with.
    """
    sources = landing.read_run(spark, base, day, multi_line=multi_line)
    customers = clean_customers(sources["customers"], day, id_type)
    landing.write_processed(customers, base, day, "customers")
    kept = landing.read_processed(spark, base, day, "customers").select("customer_id")
    rest = {
        e: clean(sources[e], day, id_type) for e, clean in CLEANERS.items() if e != "customers"
    }
    rest["contacts"] = clean_contacts(sources["contacts"], kept, day, id_type)
    write_together(
        spark, [partial(landing.write_processed, df, base, day, e) for e, df in rest.items()]
    )


def load_day(
    spark: SparkSession,
    base: str,
    day: dt.date | str,
    database: str,
    reload: bool = False,
    ledger: Ledger | None = None,
) -> None:
    """Load a processed day into the raw tables, and its sums and bitmaps for the reports.

    Appending is the default and stores a day twice if it is run twice; reload
    replaces the day instead. With a ledger a run that is repeated appends once.
    """
    warehouse.create_raw_tables(spark, database)
    processed = {e: landing.read_processed(spark, base, day, e) for e in ENTITIES}
    if reload:
        warehouse.reload_raw(processed, database, day)
    elif ledger:
        value = run_date(day).isoformat()
        write_together(
            spark, [partial(ledger.append_once, df, database, e, value) for e, df in processed.items()]
        )
    else:
        warehouse.append_raw(processed, database)
    write_together(spark, [partial(part.refresh, spark, database, day) for part in (sums, bitmaps)])


def raw_layer(spark: SparkSession, database: str) -> dict[str, DataFrame]:
    return {e: warehouse.raw_table(spark, database, e) for e in ENTITIES}


def build_models(
    spark: SparkSession,
    database: str,
    as_of: dt.date | str | None = None,
    only_day: dt.date | str | None = None,
    warehouse_text: bool = False,
    changed_days: Sequence[dt.date | str] | None = None,
) -> None:
    """Refresh the core tables and the stored views from the raw tables.

    Without only_day the core tables are rebuilt from all stored days. With it,
    that day alone is read, and only its part of the core tables is replaced. With
    changed_days, the customers of those days are rebuilt from all stored days.
    """
    warehouse.create_core_tables(spark, database)
    create_staging_views(spark, database, warehouse_text)
    if changed_days:
        changes.refresh(spark, database, changed_days, as_of)
    else:
        staged = {e: spark.table(f"{database}.stg_{e}") for e in ENTITIES}
        models = build_core(staged, as_of, only_day)
        warehouse.replace_core(models, database, only_day)
        if only_day is None:
            changes.remember(spark, database)
    sums.create_views(spark, database)
    sums.create_functions(spark, database)


def drop_expired(
    spark: SparkSession, base: str, database: str, as_of: dt.date | str, days: int
) -> None:
    """Delete what is `days` old or older, from both zones and from every table."""
    landing.drop_expired_folders(spark, base, as_of, days)
    warehouse.create_core_tables(spark, database)
    for name in [f"raw_{e}" for e in ENTITIES] + list(CORE_COLUMNS):
        warehouse.drop_expired_days(spark, database, name, as_of, days)
    for part in (sums, bitmaps):
        part.create_table(spark, database)
        part.drop_expired(spark, database, as_of, days)


def run_day(
    spark: SparkSession,
    inputs: Mapping[str, str],
    base: str,
    database: str,
    day: dt.date | str,
    *,
    as_of: dt.date | str | None = None,
    all_days: bool = False,
    changed_only: bool = False,
    reload: bool = False,
    warehouse_text: bool = False,
    id_type: str = WIDE,
    retain_days: int | None = None,
    run_id: str | None = None,
    **options: bool,
) -> DataFrame:
    """One whole run; returns the row count of every table.

    The core tables are refreshed for this day; all_days rebuilds them from all stored
    days, and changed_only gives the same by building anew only the customers of this day
    and of the days that expire. With retain_days, what is older on this day is deleted at
    the end (with changed_only, before the core tables are refreshed). A run with a run_id
    may be repeated after a failure, and goes on where it stopped. options are those of
    landing.read_source.
    """
    size_for(spark, stored_bytes(spark, *inputs.values()))
    ledger = Ledger(spark, base, run_id) if run_id else None

    def step(name: str, work: Callable[[], object]) -> None:
        ledger.once(name, work) if ledger else work()

    def land() -> None:
        for entity, found in landing.land_sources(spark, inputs, base, day, **options).items():
            if found.malformed:
                log.warning("%s: %d of %d records are malformed", entity, found.malformed, found.rows)

    step("land", land)
    step("process", lambda: process_day(spark, base, day, id_type, options.get("multi_line", False)))
    step("load", lambda: load_day(spark, base, day, database, reload, ledger))

    def model() -> None:
        if changed_only and retain_days is not None:
            drop_expired(spark, base, database, day, retain_days)
        changed = [day] if changed_only else None
        build_models(spark, database, as_of, None if all_days else day, warehouse_text, changed)

    step("models", model)
    if retain_days is not None and not changed_only:
        step("expire", lambda: drop_expired(spark, base, database, day, retain_days))
    tables = [f"raw_{e}" for e in ENTITIES] + list(CORE_COLUMNS)
    return warehouse.row_counts(spark, database, tables)


def register_layers(raw: Mapping[str, DataFrame], as_of: dt.date | str | None = None) -> None:
    """All layers as temporary views, to be queried as SQL text."""
    staged = stage_all(raw)
    for entity in ENTITIES:
        raw[entity].createOrReplaceTempView(f"raw_{entity}")
        staged[entity].createOrReplaceTempView(f"stg_{entity}")
    for model, df in build_core(staged, as_of).items():
        df.createOrReplaceTempView(model)
    register_reports(raw, as_of)
