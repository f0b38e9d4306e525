from __future__ import annotations

import datetime as dt
import re

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from accountloom.operators import with_ingestion_date
from accountloom.plans import daily
from accountloom.queries import Layers
from accountloom.schemas import CORE_COLUMNS, ENTITIES, raw_columns
from accountloom.sources import files, landing, warehouse
from tests.support import TESTDATA, plan, rows, settings

DAYS = [dt.date(2025, 1, d) for d in (1, 2, 3)]


@pytest.fixture(scope="module")
def layers(spark):
    return Layers(spark, TESTDATA)


@pytest.fixture
def deals(layers):
    return layers.raw["deals"]


def per_day(spark, table):
    return {r[0]: r[1] for r in spark.table(table).groupBy("ingestion_date").count().collect()}


@pytest.fixture
def two_days(spark, database, deals):
    """A table of two days."""
    warehouse.create_raw_tables(spark, database)
    both = deals.unionByName(with_ingestion_date(deals, DAYS[1]))
    warehouse.append_raw({"deals": both}, database)
    return f"{database}.raw_deals"


def test_tables_have_the_declared_columns_and_are_kept(spark, database, deals):
    warehouse.create_raw_tables(spark, database)
    warehouse.append_raw({"deals": deals}, database)
    warehouse.create_raw_tables(spark, database)
    table = spark.table(f"{database}.raw_deals")
    assert table.columns == raw_columns("deals")
    assert dict(table.dtypes)["deal_id"] == "bigint"
    assert table.count() == deals.count()


def test_columns_are_stored_by_name(spark, database, layers):
    """Clean contacts come with customer_id first; the table has contact_id first."""
    warehouse.create_raw_tables(spark, database)
    contacts = layers.raw["contacts"]
    warehouse.append_raw({"contacts": contacts}, database)
    stored = spark.table(f"{database}.raw_contacts")
    assert rows(stored.select(contacts.columns)) == rows(contacts)


def test_append_doubles_and_reload_does_not(spark, database, deals):
    warehouse.create_raw_tables(spark, database)
    n = deals.count()
    for expected in (n, 2 * n):
        warehouse.append_raw({"deals": deals}, database)
        assert spark.table(f"{database}.raw_deals").count() == expected
    for day in (None, DAYS[0], DAYS[0]):
        warehouse.reload_raw({"deals": deals}, database, day)
        assert spark.table(f"{database}.raw_deals").count() == n


@pytest.mark.parametrize("mode", ["static", "dynamic"])
def test_reload_leaves_other_days_in_either_session_mode(spark, database, deals, two_days, mode):
    with settings(spark, spark__sql__sources__partitionOverwriteMode=mode):
        few = with_ingestion_date(deals.filter("deal_id < 100"), DAYS[1])
        warehouse.reload_raw({"deals": few}, database, DAYS[1])
        assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == mode
    assert per_day(spark, two_days) == {DAYS[0]: deals.count(), DAYS[1]: few.count()}


@pytest.mark.parametrize("mode", ["static", "dynamic"])
def test_days_that_occur_are_replaced_in_either_session_mode(spark, database, deals, two_days, mode):
    few = with_ingestion_date(deals.filter("deal_id < 100"), DAYS[1])
    new = with_ingestion_date(deals.filter("deal_id < 50"), DAYS[2])
    with settings(spark, spark__sql__sources__partitionOverwriteMode=mode):
        warehouse.reload_raw({"deals": few.unionByName(new)}, database)
    assert per_day(spark, two_days) == {DAYS[0]: deals.count(), DAYS[1]: 100, DAYS[2]: 50}


@pytest.mark.parametrize("mode", ["static", "dynamic"])
def test_a_day_reloaded_without_rows_is_emptied(spark, database, deals, two_days, mode):
    with settings(spark, spark__sql__sources__partitionOverwriteMode=mode):
        warehouse.reload_raw({"deals": deals.limit(0)}, database, DAYS[1])
    assert per_day(spark, two_days) == {DAYS[0]: deals.count()}


@pytest.mark.parametrize("mode", ["static", "dynamic"])
def test_full_refresh_removes_days_in_either_session_mode(spark, database, layers, mode):
    warehouse.create_core_tables(spark, database)
    fact = layers.stg["deals"].withColumns(
        {c: F.lit(None).cast("string") for c in ("plan_tier", "company", "country")}
    )
    with settings(spark, spark__sql__sources__partitionOverwriteMode=mode):
        for day in DAYS:
            warehouse.replace_core({"fact_deals": with_ingestion_date(fact, day)}, database)
    table = f"{database}.fact_deals"
    assert set(per_day(spark, table)) == {DAYS[-1]}
    first = {"fact_deals": with_ingestion_date(fact, DAYS[0])}
    for _ in range(2):
        warehouse.replace_core(first, database, DAYS[0])
    assert per_day(spark, table) == {d: fact.count() for d in (DAYS[0], DAYS[-1])}
    warehouse.replace_core({"fact_deals": fact.limit(0)}, database, DAYS[0])
    assert set(per_day(spark, table)) == {DAYS[-1]}


def test_expired_days_are_dropped_and_undated_rows_stay(spark, database, layers):
    warehouse.create_raw_tables(spark, database)
    customers = layers.raw["customers"]
    dated = with_ingestion_date(customers, DAYS[0])
    for day in DAYS[1:]:
        dated = dated.unionByName(with_ingestion_date(customers, day))
    undated = customers.withColumn("ingestion_date", F.lit(None).cast("date"))
    stored = {"customers": dated.unionByName(undated)}
    warehouse.append_raw(stored, database)
    table = f"{database}.raw_customers"
    warehouse.drop_expired_days(spark, database, "raw_customers", dt.date(2025, 2, 1), 30)
    assert set(per_day(spark, table)) == {DAYS[2], None}
    assert spark.sql(f"SHOW PARTITIONS {table}").count() == 2


def test_tables_are_put_back_over_their_files(spark, database, folder, deals, two_days):
    """Another database name over the same folder stands for a later session."""
    later = f"{database}_later"
    warehouse.create_database(spark, later, f"{folder}/tables")
    warehouse.create_raw_tables(spark, later)
    table = f"{later}.raw_deals"
    n = deals.count()
    assert per_day(spark, table) == {DAYS[0]: n, DAYS[1]: n}
    warehouse.append_raw({"deals": with_ingestion_date(deals, DAYS[2])}, later)
    warehouse.reload_raw({"deals": with_ingestion_date(deals, DAYS[1])}, later)
    assert per_day(spark, table) == {d: n for d in DAYS}
    warehouse.drop_expired_days(spark, later, "raw_deals", dt.date(2025, 2, 1), 30)
    assert per_day(spark, table) == {DAYS[2]: n}
    spark.sql(f"MSCK REPAIR TABLE {table}")
    assert per_day(spark, table) == {DAYS[2]: n}


def test_a_day_range_reads_only_its_days(spark, two_days):
    read = spark.table(two_days).filter(f"ingestion_date >= date'{DAYS[1]}' AND deal_stage = 'x'")
    text = plan(read.select("deal_id"))
    assert "PartitionFilters: [isnotnull(ingestion_date" in text
    assert "EqualTo(deal_stage,x)" in text
    assert "ReadSchema: struct<deal_id:bigint,deal_stage:string>" in text


def test_files_are_sorted_by_the_clustering_columns(spark, two_days):
    pairs = [
        (r.file, r.deal_stage)
        for r in spark.table(two_days)
        .select(F.input_file_name().alias("file"), "deal_stage")
        .collect()
    ]
    for file in {f for f, _ in pairs}:
        stages = [s for f, s in pairs if f == file]
        assert stages == sorted(stages)


def test_a_run_repeats_and_reloads(spark, folder, database, layers):
    inputs = layers.source_files()

    def run(day, **options):
        counts = daily.run_day(
            spark, inputs, f"{folder}/zone", database, day, as_of="2002-01-01", **options
        )
        return {r.table_name: r.row_count for r in counts.collect()}

    first = run(DAYS[0])
    assert set(first) == {f"raw_{e}" for e in ENTITIES} | set(CORE_COLUMNS)
    assert run(DAYS[0], reload=True) == first

    two = run(DAYS[1])
    assert two == {table: 2 * n for table, n in first.items()}
    assert run(DAYS[1], reload=True) == two
    assert run(DAYS[1], reload=True, all_days=True)["fact_deals"] > 3 * first["fact_deals"]

    assert run(DAYS[1])["raw_deals"] == 3 * first["raw_deals"]
    stages = spark.table(f"{database}.deal_distribution_by_stage")
    assert sum(r.deal_count for r in stages.collect()) == 3 * first["raw_deals"]
    landed = landing.read_processed(spark, f"{folder}/zone", DAYS[1], "deals")
    assert landed.count() == first["raw_deals"]


def test_stored_views_equal_the_reports(spark, database, layers):
    from accountloom.plans import dashboard

    warehouse.create_raw_tables(spark, database)
    raw = {e: layers.raw[e] for e in ENTITIES}
    warehouse.append_raw(raw, database)
    today = with_ingestion_date(raw["customers"], dt.date.today())
    warehouse.append_raw({"customers": today}, database)
    dashboard.create_report_views(spark, database)
    tables = daily.raw_layer(spark, database)
    daily.register_layers(tables)
    for view in (
        "deal_distribution_by_stage", "customer_signups_over_time", "mrr_by_plan",
        "pipeline_health_check",
    ):
        stored = spark.table(f"{database}.{view}")
        assert rows(stored) == rows(spark.table(view))
        assert stored.count() > 0


def test_quoted_line_breaks_survive_a_whole_run(spark, folder, database, layers):
    inputs = layers.source_files()
    path = f"{folder}/activities.csv"
    with open(path, "w") as f:
        f.write('activity_id,customer_id,activity_type,timestamp,outcome,notes\n')
        f.write('1,2,call,2024-01-01 00:00:00,,"two\nlines"\n')
    daily.run_day(
        spark, {**inputs, "activities": path}, f"{folder}/zone", database, DAYS[0], multi_line=True
    )
    assert [r.notes for r in spark.table(f"{database}.raw_activities").collect()] == ["two\nlines"]


def test_a_run_leaves_staging_views_and_keeps_no_expired_days(spark, folder, database, layers):
    from accountloom.plans import staging

    inputs = layers.source_files()
    for day in (dt.date(2024, 11, 1), DAYS[0]):
        daily.run_day(spark, inputs, f"{folder}/zone", database, day, retain_days=30)
    assert spark.table(f"{database}.raw_deals").select("ingestion_date").distinct().collect() == [(DAYS[0],)]
    assert spark.table(f"{database}.fact_deals").select("ingestion_date").distinct().collect() == [(DAYS[0],)]
    with pytest.raises(FileNotFoundError):
        landing.read_run(spark, f"{folder}/zone", "2024-11-01")
    for entity, staged in staging.stage_all(daily.raw_layer(spark, database)).items():
        assert rows(spark.table(f"{database}.stg_{entity}")) == rows(staged)


def _failing(fact):
    """Rows whose computation fails in some tasks of the write."""
    bad = F.when(F.col("deal_id") % 97 == 5, F.raise_error(F.lit("no such row"))).otherwise(F.col("owner"))
    return fact.withColumn("owner", bad.cast("string"))


@pytest.mark.parametrize("day", [None, DAYS[0]])
def test_a_failed_replacement_keeps_the_old_rows(spark, database, layers, day):
    warehouse.create_core_tables(spark, database)
    fact = layers.stg["deals"].withColumns(
        {c: F.lit(None).cast("string") for c in ("plan_tier", "company", "country")}
    )
    dated = with_ingestion_date(fact, DAYS[0])
    warehouse.replace_core({"fact_deals": dated}, database)
    views = {t.name for t in spark.catalog.listTables()}
    with pytest.raises(Exception, match="no such row"):
        warehouse.replace_core({"fact_deals": _failing(dated)}, database, day)
    assert per_day(spark, f"{database}.fact_deals") == {DAYS[0]: fact.count()}
    spark.catalog.refreshTable(f"{database}.fact_deals")
    assert per_day(spark, f"{database}.fact_deals") == {DAYS[0]: fact.count()}
    assert {t.name for t in spark.catalog.listTables()} == views


def _files_touched(spark, table, column, value):
    """(files that can hold the value by their statistics, files), from the Parquet footers."""
    import pyarrow.parquet as pq

    paths = {r[0].removeprefix("file://") for r in spark.table(table).select(F.input_file_name()).distinct().collect()}
    hit = 0
    for path in paths:
        meta = pq.ParquetFile(path).metadata
        at = meta.schema.names.index(column)
        stats = [meta.row_group(g).column(at).statistics for g in range(meta.num_row_groups)]
        hit += any(s.min <= value <= s.max for s in stats)
    return hit, len(paths)


def test_filters_on_clustering_columns_skip_files(spark, database):
    warehouse.create_raw_tables(spark, database)
    loaded = Layers(spark, "/root/testdata/sf0.01")
    with settings(
        spark, spark__sql__adaptive__coalescePartitions__enabled="false", spark__sql__shuffle__partitions="12"
    ):
        warehouse.append_raw({e: loaded.raw[e].repartition(6) for e in ("contacts", "deals")}, database)
    hit, files = _files_touched(spark, f"{database}.raw_contacts", "customer_id", 500)
    assert files >= 10 and hit <= 2
    hit, files = _files_touched(spark, f"{database}.raw_deals", "deal_stage", "closed_won")
    assert files >= 10 and hit <= files // 2
    largest = spark.table(f"{database}.raw_deals").groupBy(F.input_file_name()).count().agg(F.max("count"))
    assert largest.first()[0] < spark.table(f"{database}.raw_deals").count() / 4


class Breaks:
    """Lets the nth step of some functions fail: before it, or just after it was done."""

    def __init__(self, monkeypatch, at, after):
        self.at, self.after, self.n = at, after, 0
        for name in ("_create_over", "_point_view", "_point_day"):
            monkeypatch.setattr(warehouse, name, self.step(getattr(warehouse, name)))
        sql = SparkSession.sql
        monkeypatch.setattr(SparkSession, "sql", lambda s, text, *a, **k: self.step(sql)(s, text, *a, **k) if re.match("ALTER|CREATE|MSCK|DROP", text) else sql(s, text, *a, **k))

    def step(self, function):
        def run(*args, **kwargs):
            self.n += 1
            mine = self.n == self.at
            if mine and not self.after:
                raise OSError("lost")
            result = function(*args, **kwargs)
            if mine:
                raise OSError("lost")
            return result

        return run


def _facts(layers, owner):
    fact = layers.stg["deals"].limit(50).withColumns({c: F.lit(None).cast("string") for c in ("plan_tier", "company", "country")})
    return fact.withColumn("owner", F.lit(owner))


def _owners(spark, table):
    spark.catalog.refreshTable(table)
    found = spark.table(table).groupBy("ingestion_date").agg(F.collect_set("owner").alias("o"), F.count("*").alias("n")).collect()
    return {r.ingestion_date: (tuple(r.o), r.n) for r in found}


@pytest.mark.parametrize("after", [False, True])
@pytest.mark.parametrize("day", [None, DAYS[0]])
def test_whatever_step_fails_a_table_is_entirely_old_or_new(spark, database, folder, layers, day, after):
    warehouse.create_core_tables(spark, database)
    table = f"{database}.fact_deals"
    two = lambda owner: with_ingestion_date(_facts(layers, owner), DAYS[0]).unionByName(with_ingestion_date(_facts(layers, owner), DAYS[1]))
    warehouse.replace_core({"fact_deals": two("first")}, database)
    old = _owners(spark, table)
    assert old == {d: (("first",), 50) for d in DAYS[:2]}
    broken = steps = 0
    while True:
        owner = f"next{steps}"
        rows = two(owner) if day is None else with_ingestion_date(_facts(layers, owner), day)
        new = {d: ((owner,), 50) if day in (None, d) else v for d, v in old.items()}
        steps += 1
        with pytest.MonkeyPatch.context() as m:
            breaks = Breaks(m, steps, after)
            try:
                warehouse.replace_core({"fact_deals": rows}, database, day)
            except OSError:
                broken += 1
        now = _owners(spark, table)
        assert now in (old, new), (steps, now)
        # Another database over the same files stands for a later session.
        later = f"{database}_{day is None}_{after}_{steps}"
        warehouse.create_database(spark, later, f"{folder}/tables")
        warehouse.create_core_tables(spark, later)
        assert _owners(spark, f"{later}.fact_deals") == now
        old = now
        if breaks.n < steps:
            break
    assert now == new and broken >= 2


def test_the_state_before_the_last_is_deleted(spark, database, folder, layers):
    warehouse.create_core_tables(spark, database)
    place = f"{folder}/tables/fact_deals"
    for n in range(4):
        warehouse.replace_core({"fact_deals": with_ingestion_date(_facts(layers, f"o{n}"), DAYS[0])}, database)
    assert len(files.names(spark, place)) == 2
    assert len(spark.catalog.listTables(database, "fact_deals__*")) == 2
    for n in range(4):
        warehouse.replace_core({"fact_deals": with_ingestion_date(_facts(layers, f"p{n}"), DAYS[0])}, database, DAYS[0])
    assert len(files.names(spark, place)) == 4
    assert _owners(spark, f"{database}.fact_deals") == {DAYS[0]: (("p3",), 50)}
    warehouse.drop_expired_days(spark, database, "fact_deals", dt.date(2025, 3, 1), 30)
    assert _owners(spark, f"{database}.fact_deals") == {}


def test_a_table_under_the_name_of_a_model_is_left_alone(spark, database):
    spark.sql(f"CREATE TABLE {database}.fact_deals (x int) USING parquet")
    with pytest.raises(ValueError, match="drop it"):
        warehouse.create_core_tables(spark, database)


def test_a_reader_of_the_old_state_ends_undisturbed(spark, database, layers):
    """A query planned before a switch reads the old rows after it."""
    warehouse.create_core_tables(spark, database)
    warehouse.replace_core({"fact_deals": with_ingestion_date(_facts(layers, "old"), DAYS[0])}, database)
    reader = spark.table(f"{database}.fact_deals")
    reader.count()
    for day in (None, DAYS[0]):
        warehouse.replace_core({"fact_deals": with_ingestion_date(_facts(layers, "new"), DAYS[0])}, database, day)
    assert {r.owner for r in spark.table(f"{database}.fact_deals").collect()} == {"new"}


def test_appends_after_a_reload_join_the_reloaded_day(spark, database, folder, deals):
    warehouse.create_raw_tables(spark, database)
    n = deals.count()
    warehouse.append_raw({"deals": deals}, database)
    warehouse.reload_raw({"deals": deals}, database, DAYS[0])
    warehouse.append_raw({"deals": deals}, database)
    assert per_day(spark, f"{database}.raw_deals") == {DAYS[0]: 2 * n}
    later = f"{database}_later"
    warehouse.create_database(spark, later, f"{folder}/tables")
    warehouse.create_raw_tables(spark, later)
    assert per_day(spark, f"{later}.raw_deals") == {DAYS[0]: 2 * n}
    warehouse.reload_raw({"deals": deals.limit(3)}, later)
    assert per_day(spark, f"{later}.raw_deals") == {DAYS[0]: 3}
