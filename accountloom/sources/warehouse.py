"""Parquet tables in one database, one folder per ingestion day.

Rows are dealt to files by ranges of the table's clustering columns and sorted by them,
so file and row-group statistics let a reader skip other plans, stages or customers.

Replacing is one step. A day is written to a new folder, and then the catalog's entry of
that day is pointed to it. A core table is a view of the table that holds its present
state; a full refresh builds another table and then points the view to it. Whatever
fails, readers see the old rows or the new ones. The state before the last is deleted.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Iterable, Mapping
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from accountloom.functions.dates import run_date
from accountloom.operators.filters import retain
from accountloom.schemas import (
    CORE_CLUSTERING,
    CORE_COLUMNS,
    DAY,
    ENTITIES,
    RAW_CLUSTERING,
    column_ddl,
    raw_columns,
    table_type,
    write_options,
)
from accountloom.settings import setting
from accountloom.sources import files, versions
from accountloom.sources.parallel import write_together


def create_database(spark: SparkSession, database: str, location: str | None = None) -> None:
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{place}")


def _folder(spark: SparkSession, database: str, name: str) -> str:
    """The folder of all that belongs to a table."""
    return f"{spark.catalog.getDatabase(database).locationUri}/{name}"


def _day_spec(day: str) -> str:
    return f"PARTITION ({DAY} = DATE '{day}')"


def _point_day(spark: SparkSession, table: str, day: str, path: str) -> None:
    """Let a day of the table be what lies at the path. Either statement does it alone."""
    spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {_day_spec(day)} LOCATION '{path}'")
    spark.sql(f"ALTER TABLE {table} {_day_spec(day)} SET LOCATION '{path}'")


def _day_location(spark: SparkSession, table: str, day: str) -> str | None:
    if not spark.sql(f"SHOW PARTITIONS {table} {_day_spec(day)}").take(1):
        return None
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table} {_day_spec(day)}").collect()
    return next(r["data_type"] for r in described if r["col_name"] == "Location")


def day_folder(spark: SparkSession, database: str, name: str, day: str) -> str:
    """Where the rows of a day lie, or would lie."""
    found = _day_location(spark, _holder(spark, database, name), day)
    return found or f"{_folder(spark, database, name)}/{DAY}={day}"


def _options(name: str, columns: list[str]) -> dict[str, str]:
    cluster = {f"raw_{e}": c for e, c in RAW_CLUSTERING.items()} | CORE_CLUSTERING
    return write_options(columns, cluster.get(name.partition("__")[0], []))


def _create_over(
    spark: SparkSession, table: str, columns: list[str], place: str | None, days: Mapping[str, versions.Version]
) -> None:
    """Create a table over the days that lie in the place and those that replace some of them."""
    where = f" LOCATION '{place}'" if place else ""
    options = ", ".join(f"'{k}' '{v}'" for k, v in _options(table.rpartition(".")[2], columns).items())
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({column_ddl(columns)}) "
        f"USING parquet OPTIONS ({options}) PARTITIONED BY ({DAY}){where}"
    )
    if place and files.exists(spark, place):
        spark.sql(f"MSCK REPAIR TABLE {table}")
    for day, version in days.items():
        _point_day(spark, table, day, version.path)


def create_table(spark: SparkSession, database: str, name: str, columns: list[str]) -> None:
    """Create the table if it is absent.

    A catalog that lives only as long as its session forgets tables whose files
    remain; such a table is put back over its files.
    """
    if spark.catalog.tableExists(f"{database}.{name}"):
        return
    folder = _folder(spark, database, name)
    kept = files.exists(spark, folder)
    _, days = versions.current(versions.finished(spark, folder))
    _create_over(spark, f"{database}.{name}", columns, folder if kept else None, days)


def _state(model: str, version: versions.Version) -> str:
    """The table that holds a state of a core table."""
    return f"{model}__{version.stamp}"


def _point_view(spark: SparkSession, database: str, model: str, state: str) -> None:
    spark.sql(f"CREATE OR REPLACE VIEW {database}.{model} AS SELECT * FROM {database}.{state}")


def _holder(spark: SparkSession, database: str, name: str) -> str:
    """The table that holds a table's rows: for a core table its present state."""
    if name not in CORE_COLUMNS:
        return f"{database}.{name}"
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {database}.{name}").collect()
    text = next(r["data_type"] for r in described if r["col_name"] == "View Text")
    return f"{database}.{re.search(rf'{name}__[0-9a-f]+', text)[0]}"


def _create_core(spark: SparkSession, database: str, model: str, columns: list[str]) -> None:
    if spark.catalog.tableExists(f"{database}.{model}"):
        if spark.catalog.getTable(f"{database}.{model}").tableType != "VIEW":
            raise ValueError(f"{database}.{model} is a table; drop it, a full refresh builds its rows again")
        return
    folder = _folder(spark, database, model)
    base, days = versions.current(versions.finished(spark, folder))
    base = base or versions.new_version(folder, versions.ALL)
    _create_over(spark, f"{database}.{_state(model, base)}", columns, base.path, days)
    _point_view(spark, database, model, _state(model, base))


def create_raw_tables(spark: SparkSession, database: str) -> None:
    for entity in ENTITIES:
        create_table(spark, database, f"raw_{entity}", raw_columns(entity))


def create_core_tables(spark: SparkSession, database: str) -> None:
    for model, columns in CORE_COLUMNS.items():
        _create_core(spark, database, model, columns)


def _clustered(df: DataFrame, columns: list[str], cluster: list[str]) -> DataFrame:
    """Rows laid out for a table write.

    They are dealt by ranges of day, clustering columns and a hash of the whole row;
    the hash lets a large day or a frequent value spread over many tasks. Ranges come
    from a sample of the rows; adaptive execution merges ranges that turn out small.
    """
    typed = df.select([F.col(c).cast(table_type(c)).alias(c) for c in columns])
    ranges = [DAY, *cluster, F.xxhash64(*columns)]
    return typed.repartitionByRange(*ranges).sortWithinPartitions(DAY, *cluster)


# insertInto reads the overwrite mode from the session, not from writer options.
_OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"


def _insert_raw(frames: Mapping[str, DataFrame], database: str, mode: str) -> None:
    def insert(entity: str, df: DataFrame) -> None:
        rows = _clustered(df, raw_columns(entity), RAW_CLUSTERING[entity])
        rows.write.mode(mode).insertInto(f"{database}.raw_{entity}")

    spark = next(iter(frames.values())).sparkSession
    write_together(spark, [partial(insert, e, df) for e, df in frames.items()])


def append_raw(frames: Mapping[str, DataFrame], database: str) -> None:
    """Add rows by entity; loading the same day twice stores it twice."""
    _insert_raw(frames, database, "append")


def replace_day(rows: DataFrame, database: str, name: str, day: dt.date | str) -> None:
    """Replace one day of a table, also by nothing if there are no rows."""
    spark, value = rows.sparkSession, run_date(day).isoformat()
    table, folder = _holder(spark, database, name), _folder(spark, database, name)
    old = _day_location(spark, table, value)
    new = versions.new_version(folder, value)
    try:
        rows.drop(DAY).write.options(**_options(name, rows.columns)).parquet(new.path)
        _point_day(spark, table, value, new.path)
    except Exception:
        if _day_location(spark, table, value) == old:
            files.delete(spark, new.path)
        raise
    spark.catalog.refreshTable(f"{database}.{name}")
    for version in versions.finished(spark, folder):
        if version.of == value and version.stamp < new.stamp and not (old or "").endswith(version.name):
            files.delete(spark, version.path)


def _overwrite_all(rows: DataFrame, database: str, model: str) -> None:
    """Replace all days of a core table; days without rows are gone afterwards."""
    spark, folder = rows.sparkSession, _folder(rows.sparkSession, database, model)
    old, new = _holder(spark, database, model), versions.new_version(folder, versions.ALL)
    table = f"{database}.{_state(model, new)}"
    try:
        rows.write.options(**_options(model, rows.columns)).partitionBy(DAY).parquet(new.path)
        _create_over(spark, table, CORE_COLUMNS[model], new.path, {})
        _point_view(spark, database, model, _state(model, new))
    except Exception:
        if _holder(spark, database, model) == old:
            spark.sql(f"DROP TABLE IF EXISTS {table}")
            files.delete(spark, new.path)
        raise
    spark.catalog.refreshTable(f"{database}.{model}")
    before = old.rpartition("__")[2]
    for known in spark.catalog.listTables(database, f"{model}__*"):
        if known.name.rpartition("__")[2] < before:
            spark.sql(f"DROP TABLE IF EXISTS {database}.{known.name}")
    for version in versions.finished(spark, folder):
        if version.stamp < before:
            files.delete(spark, version.path)


def reload_raw(
    frames: Mapping[str, DataFrame], database: str, day: dt.date | str | None = None
) -> None:
    """Replace a day and leave all others; safe to repeat.

    The frames hold that day's rows. Without `day`, every day that occurs in a
    frame is replaced in its table.
    """
    spark = next(iter(frames.values())).sparkSession
    if day is None:
        with setting(spark, _OVERWRITE_MODE, "dynamic"):
            _insert_raw(frames, database, "overwrite")
        return

    def reload(entity: str, df: DataFrame) -> None:
        rows = _clustered(df, raw_columns(entity), RAW_CLUSTERING[entity])
        replace_day(rows, database, f"raw_{entity}", day)

    write_together(spark, [partial(reload, e, df) for e, df in frames.items()])


def replace_core(
    models: Mapping[str, DataFrame], database: str, day: dt.date | str | None = None
) -> None:
    """Full refresh of core tables, or of one day's part, whose rows the models hold."""

    def replace(model: str, df: DataFrame) -> None:
        rows = _clustered(df, CORE_COLUMNS[model], CORE_CLUSTERING[model])
        if day is None:
            _overwrite_all(rows, database, model)
        else:
            replace_day(rows, database, model, day)

    spark = next(iter(models.values())).sparkSession
    write_together(spark, [partial(replace, m, df) for m, df in models.items()])


def raw_table(spark: SparkSession, database: str, entity: str) -> DataFrame:
    return spark.table(f"{database}.raw_{entity}")


def _from_footers(spark: SparkSession, table: str) -> DataFrame:
    """One row (row_count) of a table. Parquet's reader is asked for the count alone."""
    names = spark.table(table).inputFiles()
    if not names:
        return spark.range(1).select(F.lit(0).cast("long").alias("row_count"))
    folders = sorted({name.rpartition("/")[0] for name in names})
    # The newer reader answers counts from the files' footers. Which reader is used is
    # settled here; PLAN_SETTINGS lets it push the count down.
    with setting(spark, "spark.sql.sources.useV1SourceList", "csv,text,json,orc"):
        rows = spark.read.schema("_none int").parquet(*folders)
    return rows.agg(F.count(F.lit(1)).alias("row_count"))


def row_counts(spark: SparkSession, database: str, tables: list[str]) -> DataFrame:
    """Rows per table, one row each, from file footers; no data page is read."""
    counts = [
        _from_footers(spark, f"{database}.{t}").select(F.lit(t).alias("table_name"), "row_count")
        for t in tables
    ]
    result = counts[0]
    for count in counts[1:]:
        result = result.unionAll(count)
    return result


def stored_days(spark: SparkSession, database: str, name: str) -> DataFrame:
    """The days of a table, from the catalog's partition list; rows without a day have none here."""
    listed = spark.sql(f"SHOW PARTITIONS {_holder(spark, database, name)}").select(
        F.split("partition", "=")[1].try_cast("date").alias(DAY)
    )
    return listed.filter(F.col(DAY).isNotNull())


def drop_days(spark: SparkSession, database: str, name: str, days: Iterable[dt.date]) -> None:
    """Drop days of a table, and their files; no data is read or rewritten."""
    table, folder = _holder(spark, database, name), _folder(spark, database, name)
    replaced = versions.finished(spark, folder)
    for day in map(dt.date.isoformat, days):
        place = _day_location(spark, table, day)
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {_day_spec(day)}")
        # A table put back over its files does not own them.
        for path in {place, f"{folder}/{DAY}={day}", *(v.path for v in replaced if v.of == day)} - {None}:
            files.delete(spark, path)


def drop_expired_days(
    spark: SparkSession,
    database: str,
    name: str,
    as_of: dt.date | str | None = None,
    days: int = 30,
) -> list[dt.date]:
    """Drop the day partitions that retain() would not keep, and return their days.

    Rows without a day have no age and stay.
    """
    dated = stored_days(spark, database, name)
    expired = sorted(row[DAY] for row in dated.exceptAll(retain(dated, as_of, days)).collect())
    drop_days(spark, database, name, expired)
    return expired
