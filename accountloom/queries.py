"""Every operator as a named query over a folder of test tables."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from functools import cached_property, lru_cache, partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from accountloom import functions as fn
from accountloom.operators import (
    keep_recent,
    positive,
    require,
    retain,
    with_ingestion_date,
    within_days,
)
from accountloom.plans import bitmaps, changes, cleaning, core, daily, dashboard, staging, sums
from accountloom.schemas import CORE_COLUMNS, DAY, ENTITIES, raw_columns
from accountloom.settings import apply_plan_settings, scratch_folder, size_for, stored_bytes
from accountloom.sources import landing, warehouse
from accountloom.sources.derived import derive_source
from accountloom.sources.parallel import write_together

RUN_DAY = dt.date(2025, 1, 1)
NEXT_DAY = dt.date(2025, 1, 2)
RENEWALS_AS_OF = dt.date(2002, 1, 1)
HEALTH_AS_OF = dt.date(2025, 1, 7)
SNAPSHOT_START = dt.date(2024, 12, 1)
SNAPSHOT_DAYS = 45

STAGE = "closed_won"


@lru_cache(maxsize=None)
def _input_bytes(spark: SparkSession, folder: str) -> int:
    tables = ("customer", "nation", "orders", "events")
    return stored_bytes(spark, *[f"{folder}/{t}.parquet" for t in tables])


class _OnDemand(dict):
    """Frames by entity, each built when first asked for."""

    def __init__(self, build: Callable[[str], DataFrame]):
        super().__init__()
        self._build = build

    def __missing__(self, entity: str) -> DataFrame:
        self[entity] = self._build(entity)
        return self[entity]


class Layers:
    """The layers derived from one folder, all lazy."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = apply_plan_settings(spark)
        size_for(spark, _input_bytes(spark, folder))
        self.src = _OnDemand(lambda e: derive_source(spark, folder, e))
        self.raw = _OnDemand(self._clean)
        self.stg = _OnDemand(lambda e: staging.STAGES[e](self.raw[e]))
        # The raw layer holding two days with the same rows, and its staging.
        self.twice = _OnDemand(
            lambda e: self.raw[e].unionByName(with_ingestion_date(self.raw[e], NEXT_DAY))
        )
        self.stg_twice = _OnDemand(lambda e: staging.STAGES[e](self.twice[e]))

    def _clean(self, entity: str) -> DataFrame:
        if entity == "contacts":
            ids = cleaning.customer_ids(self.src["customers"])
            return cleaning.clean_contacts(self.src["contacts"], ids, RUN_DAY)
        return cleaning.CLEANERS[entity](self.src[entity], RUN_DAY)

    @cached_property
    def snapshots(self) -> DataFrame:
        """Clean customers spread over many ingestion days."""
        offset = F.expr(f"cast(customer_id % {SNAPSHOT_DAYS} AS int)")
        return self.raw["customers"].withColumn(DAY, F.date_add(F.lit(SNAPSHOT_START), offset))

    def signups(self) -> DataFrame:
        return dashboard.customer_signups_over_time(self.raw["customers"])

    def folder(self, label: str) -> str:
        return scratch_folder(self.spark, label)

    def database(self) -> str:
        """A new database with empty raw tables, stored in a scratch folder."""
        name = f"accountloom_{uuid.uuid4().hex}"
        warehouse.create_database(self.spark, name, self.folder("tables"))
        warehouse.create_raw_tables(self.spark, name)
        return name

    def source_files(self) -> dict[str, str]:
        """The sources written as CSV, by entity."""
        base = self.folder("inputs")
        paths = {e: f"{base}/{e}.csv" for e in ENTITIES}
        write_together(
            self.spark, [partial(landing.write_source, self.src[e], p) for e, p in paths.items()]
        )
        return paths


# -- sources and sinks ------------------------------------------------------


def scan(entity: str) -> Callable[[Layers], DataFrame]:
    def run(x: Layers) -> DataFrame:
        path = f"{x.folder('scan')}/{entity}.csv"
        landing.write_source(x.src[entity], path)
        return landing.read_source(x.spark, path, entity)

    return run


def scan_dated_zone(x: Layers) -> DataFrame:
    """Two days are landed, one is read."""
    base = x.folder("zone")
    for day in (RUN_DAY, NEXT_DAY):
        landing.write_source(x.src["deals"], landing.raw_path(base, day, "deals"))
    read = landing.read_source(x.spark, landing.raw_path(base, NEXT_DAY, "deals"), "deals")
    return with_ingestion_date(read, NEXT_DAY)


def land_sources(x: Layers) -> DataFrame:
    """Rows, distinct keys and distinct customers of each landed file."""
    base = x.folder("zone")
    landing.land_sources(x.spark, x.source_files(), base, RUN_DAY)
    result = None
    for entity, df in landing.read_run(x.spark, base, RUN_DAY).items():
        key = df.columns[0]
        counts = df.agg(
            F.count(F.lit(1)).alias("row_count"),
            F.count_distinct(key).alias("distinct_keys"),
            F.count_distinct("customer_id").alias("distinct_customers"),
        ).select(F.lit(entity).alias("source"), "*")
        result = counts if result is None else result.unionAll(counts)
    return result


def sink_parquet_roundtrip(x: Layers) -> DataFrame:
    """Writing a day again replaces it."""
    base = x.folder("zone")
    for _ in range(2):
        landing.write_processed(x.raw["activities"], base, RUN_DAY, "activities")
    return landing.read_processed(x.spark, base, RUN_DAY, "activities")


def _per_stage_and_day(df: DataFrame) -> DataFrame:
    return df.groupBy(DAY, "deal_stage").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_distinct("deal_id").alias("distinct_deals"),
    )


def sink_append_table(x: Layers) -> DataFrame:
    """Appending the same day twice doubles every count."""
    database = x.database()
    for _ in range(2):
        warehouse.append_raw({"deals": x.raw["deals"]}, database)
    return _per_stage_and_day(warehouse.raw_table(x.spark, database, "deals"))


def sink_reload_partition(x: Layers) -> DataFrame:
    """Two days are loaded and one of them again; no count changes."""
    database = x.database()
    warehouse.append_raw({"deals": x.twice["deals"]}, database)
    again = {"deals": with_ingestion_date(x.raw["deals"], NEXT_DAY)}
    warehouse.reload_raw(again, database, NEXT_DAY)
    return _per_stage_and_day(warehouse.raw_table(x.spark, database, "deals"))


def _loaded(x: Layers, *entities: str) -> str:
    database = x.database()
    warehouse.append_raw({e: x.raw[e] for e in entities}, database)
    return database


def load_raw_tables(x: Layers) -> DataFrame:
    return warehouse.row_counts(x.spark, _loaded(x, *ENTITIES), [f"raw_{e}" for e in ENTITIES])


def stored_staging(entity: str) -> Callable[[Layers], DataFrame]:
    """The stored staging view over a loaded table."""

    def run(x: Layers) -> DataFrame:
        database = _loaded(x, entity)
        staging.create_staging_views(x.spark, database)
        return x.spark.table(f"{database}.stg_{entity}")

    return run


def create_raw_tables(x: Layers) -> DataFrame:
    """Creating tables again keeps what they hold; ids come back widened."""
    database = x.database()
    warehouse.append_raw({"customers": x.raw["customers"]}, database)
    warehouse.create_raw_tables(x.spark, database)
    return warehouse.raw_table(x.spark, database, "customers")


_READS = {
    "fact_deals": ("deals", "customers"),
    "dim_customers": ("customers", "subscriptions", "activities"),
    "dim_subscriptions": ("subscriptions", "customers"),
}


def materialize(model: str) -> Callable[[Layers], DataFrame]:
    """A core table built from the stored tables that it reads."""

    def run(x: Layers) -> DataFrame:
        database = _loaded(x, *_READS[model])
        warehouse.create_core_tables(x.spark, database)
        staged = staging.stage_all(daily.raw_layer(x.spark, database))
        frame = core.build_core(staged, RENEWALS_AS_OF)[model]
        warehouse.replace_core({model: frame}, database)
        return x.spark.table(f"{database}.{model}")

    return run


def refreshed_by_change(model: str) -> Callable[[Layers], DataFrame]:
    """A core table of one day, then brought up to date for a tenth of the customers."""

    def run(x: Layers) -> DataFrame:
        database = _loaded(x, *ENTITIES)
        daily.build_models(x.spark, database, RENEWALS_AS_OF)
        few = {e: with_ingestion_date(x.raw[e].filter("customer_id % 10 = 3"), NEXT_DAY) for e in ENTITIES}
        warehouse.append_raw(few, database)
        daily.build_models(x.spark, database, RENEWALS_AS_OF, changed_days=[NEXT_DAY])
        return x.spark.table(f"{database}.{model}")

    return run


def retention_drop_days(x: Layers) -> DataFrame:
    """As retention_30d, on a stored table: whole days are dropped from it."""
    database = x.database()
    dated = require(x.snapshots, DAY)
    warehouse.append_raw({"customers": dated}, database)
    warehouse.drop_expired_days(x.spark, database, "raw_customers", HEALTH_AS_OF, 30)
    return warehouse.raw_table(x.spark, database, "customers")


def retention_drop_folders(x: Layers) -> DataFrame:
    """Two days are landed, one has expired; rows per day that are left."""
    base = x.folder("zone")
    for day in (SNAPSHOT_START, RUN_DAY):
        landing.write_source(x.src["deals"], landing.raw_path(base, day, "deals"))
    landing.drop_expired_folders(x.spark, base, HEALTH_AS_OF, 30)
    left = landing.read_source(x.spark, f"{base}/raw/crm/*/deals.csv", "deals")
    day = F.regexp_extract(F.input_file_name(), "/crm/([0-9-]+)/", 1).cast("date")
    return left.groupBy(day.alias(DAY)).agg(F.count(F.lit(1)).alias("row_count"))


def verify_counts(x: Layers) -> DataFrame:
    database = x.database()
    warehouse.append_raw({e: x.raw[e] for e in ("customers", "deals")}, database)
    return warehouse.row_counts(x.spark, database, ["raw_customers", "raw_deals"])


def summed_report(name: str, entity: str) -> Callable[[Layers], DataFrame]:
    """A stored report over sums: two days are loaded, one of them again."""

    def run(x: Layers) -> DataFrame:
        database = x.database()
        warehouse.append_raw({entity: x.twice[entity]}, database)
        warehouse.reload_raw({entity: with_ingestion_date(x.raw[entity], NEXT_DAY)}, database, NEXT_DAY)
        for day in (RUN_DAY, NEXT_DAY):
            sums.refresh(x.spark, database, day)
        sums.create_views(x.spark, database)
        return x.spark.table(f"{database}.{name}")

    return run


def health_check_on_a_day(x: Layers) -> DataFrame:
    """The stored function of a day, by SQL text, over customers of many days."""
    database = x.database()
    warehouse.append_raw({"customers": x.snapshots}, database)
    sums.refresh(x.spark, database)
    sums.create_functions(x.spark, database)
    before = x.spark.catalog.currentDatabase()
    x.spark.catalog.setCurrentDatabase(database)
    try:
        return x.spark.sql(f"SELECT * FROM pipeline_health_check_on(DATE '{HEALTH_AS_OF}')")
    finally:
        x.spark.catalog.setCurrentDatabase(before)


def cross_filter_stored_bitmaps(x: Layers) -> DataFrame:
    """Two loaded days of deals, the second with few of them; stages of both days count."""
    database = x.database()
    late = with_ingestion_date(x.raw["deals"].filter("deal_id % 10 = 4"), NEXT_DAY)
    warehouse.append_raw({"deals": x.raw["deals"].filter("deal_id % 10 < 4").unionByName(late)}, database)
    for day in (RUN_DAY, NEXT_DAY):
        bitmaps.refresh(x.spark, database, day)
    stored = x.spark.table(f"{database}.{bitmaps.TABLE}")
    return bitmaps.signups_by_stages(x.raw["customers"], stored, any_of=[STAGE, "proposal"])


def read_one_customer(x: Layers) -> DataFrame:
    """One customer's deals, from a table that is not ranged by customer."""
    database = x.database()
    warehouse.append_raw({"deals": x.raw["deals"]}, database)
    return warehouse.raw_table(x.spark, database, "deals").filter("customer_id = 31")


def read_pruned_range(x: Layers) -> DataFrame:
    """A few days and one tier of a table of many days."""
    database = x.database()
    warehouse.append_raw({"customers": x.snapshots}, database)
    table = warehouse.raw_table(x.spark, database, "customers")
    days = within_days(table, dt.date(2024, 12, 10), dt.date(2024, 12, 20))
    return days.filter(F.col("plan_tier") == "growth")


def daily_run(x: Layers) -> DataFrame:
    """Row counts of every table after one whole run."""
    database = f"accountloom_{uuid.uuid4().hex}"
    warehouse.create_database(x.spark, database, x.folder("tables"))
    return daily.run_day(
        x.spark, x.source_files(), x.folder("zone"), database, RUN_DAY, as_of=RENEWALS_AS_OF
    )


def daily_run_repeated(x: Layers) -> DataFrame:
    """Row counts after a run that fails once it has appended, and its repetition."""
    database = f"accountloom_{uuid.uuid4().hex}"
    warehouse.create_database(x.spark, database, x.folder("tables"))
    inputs, zone = x.source_files(), x.folder("zone")

    def run() -> DataFrame:
        return daily.run_day(x.spark, inputs, zone, database, RUN_DAY, as_of=RENEWALS_AS_OF, run_id="first")

    # A table of another kind under a model's name stops the run after the load.
    x.spark.sql(f"CREATE TABLE {database}.fact_deals (x int) USING parquet")
    try:
        run()
    except ValueError:
        x.spark.sql(f"DROP TABLE {database}.fact_deals")
    return run()


def sql_over_views(x: Layers) -> DataFrame:
    """SQL text over views of three layers."""
    daily.register_layers({e: x.raw[e] for e in ENTITIES}, RENEWALS_AS_OF)
    return x.spark.sql(
        """
        SELECT f.plan_tier, v.deal_stage, v.deal_count AS stage_deals,
               count(*) AS deals, count(DISTINCT d.customer_id) AS active_customers
        FROM fact_deals f
        JOIN deal_distribution_by_stage v ON lower(v.deal_stage) = f.deal_stage
        LEFT JOIN dim_customers d ON d.customer_id = f.customer_id AND d.total_activities > 0
        GROUP BY f.plan_tier, v.deal_stage, v.deal_count
        """
    )


# -- functions --------------------------------------------------------------


def apply(entity: str, value: Callable[[], Column]) -> Callable[[Layers], DataFrame]:
    """The source's key beside a computed value."""

    def run(x: Layers) -> DataFrame:
        key = x.src[entity].columns[0]
        return x.src[entity].select(F.col(key).alias("row_key"), value().alias("value"))

    return run


_QUERIES: dict[str, Callable[[Layers], DataFrame]] = {
    # sources and sinks
    **{f"scan_{e}": scan(e) for e in ENTITIES},
    "scan_dated_zone": scan_dated_zone,
    "land_sources": land_sources,
    "sink_parquet_roundtrip": sink_parquet_roundtrip,
    "sink_append_table": sink_append_table,
    "sink_reload_partition": sink_reload_partition,
    "load_raw_tables": load_raw_tables,
    "create_raw_tables": create_raw_tables,
    **{f"stored_stg_{e}": stored_staging(e) for e in ENTITIES},
    "materialize_core": materialize("dim_customers"),
    "materialize_fact_deals": materialize("fact_deals"),
    "materialize_dim_subscriptions": materialize("dim_subscriptions"),
    **{f"{m}_by_change": refreshed_by_change(m) for m in CORE_COLUMNS},
    "retention_30d": lambda x: retain(x.snapshots, HEALTH_AS_OF, 30),
    "retention_drop_days": retention_drop_days,
    "retention_drop_folders": retention_drop_folders,
    "verify_counts": verify_counts,
    **{
        f"summed_{name}": summed_report(name, entity)
        for name, entity in {
            "deal_distribution_by_stage": "deals",
            "customer_signups_over_time": "customers",
            "mrr_by_plan": "subscriptions",
        }.items()
    },
    "health_check_on_a_day": health_check_on_a_day,
    "read_pruned_range": read_pruned_range,
    "read_one_customer": read_one_customer,
    # projections and filters
    "add_ingestion_date": lambda x: with_ingestion_date(x.src["deals"], RUN_DAY),
    "filter_not_null_keys": lambda x: require(x.raw["customers"], "customer_id", "email"),
    "filter_positive_value": lambda x: positive(x.raw["deals"], "deal_value"),
    "filter_unparsed_ts": lambda x: require(x.raw["activities"], "timestamp"),
    "filter_last_7_days": lambda x: keep_recent(x.snapshots, HEALTH_AS_OF, 7),
    # joins
    "join_inner_valid_contacts": lambda x: cleaning.type_contacts(x.src["contacts"], RUN_DAY)
    .join(x.raw["customers"].select("customer_id"), "customer_id", "inner"),
    "join_semi_valid_contacts": lambda x: cleaning.clean_contacts_once(
        x.src["contacts"], cleaning.customer_ids(x.src["customers"]), RUN_DAY
    ).select(raw_columns("contacts")),
    "join_left_fact": lambda x: core.fact_deals(x.stg["deals"], x.stg["customers"]),
    "join_left_chain": lambda x: core.customer_activity_chain(
        x.stg["customers"], x.stg["subscriptions"], x.stg["activities"]
    ).select("customer_id", "email", "mrr", "subscription_status", "activity_id", "timestamp"),
    "join_left_subscriptions": lambda x: core.dim_subscriptions(
        x.stg["subscriptions"], x.stg["customers"], RENEWALS_AS_OF
    ),
    "cross_filter_signups_by_stage": lambda x: dashboard.signups_by_stage(
        x.raw["customers"], x.raw["deals"], STAGE
    ),
    "cross_filter_by_bitmap": lambda x: bitmaps.signups_by_stages(
        x.raw["customers"], bitmaps.stage_bitmaps(x.raw["deals"]), any_of=[STAGE]
    ),
    "cross_filter_all_stages": lambda x: bitmaps.signups_by_stages(
        x.raw["customers"], bitmaps.stage_bitmaps(x.raw["deals"]), all_of=[STAGE, "proposal", "CLOSED_LOST"]
    ),
    "cross_filter_no_deal_won": lambda x: bitmaps.keep_customers(
        x.raw["customers"], bitmaps.customers_of(bitmaps.stage_bitmaps(x.raw["deals"]), any_of=[STAGE]), inside=False
    ),
    "cross_filter_stored_bitmaps": cross_filter_stored_bitmaps,
    # aggregations, window, tiles
    "deal_distribution_by_stage": lambda x: dashboard.deal_distribution_by_stage(x.raw["deals"]),
    "customer_signups_over_time": lambda x: x.signups(),
    "mrr_by_plan": lambda x: dashboard.mrr_by_plan(x.raw["subscriptions"]),
    "pipeline_health_check": lambda x: dashboard.pipeline_health_check(x.snapshots, HEALTH_AS_OF),
    "agg_count_distinct_activities": lambda x: core.activity_summary(x.stg["activities"]).select(
        "customer_id", "total_activities"
    ),
    "agg_last_activity": lambda x: core.activity_summary(x.stg["activities"]).select(
        "customer_id", "last_activity_at"
    ),
    "tile_deals_by_stage": lambda x: dashboard.tile_deals_by_stage(
        dashboard.deal_distribution_by_stage(x.raw["deals"])
    ),
    "tile_signups_by_tier": lambda x: dashboard.tile_signups_by_tier(x.signups()),
    "tile_signups_one_tier": lambda x: dashboard.tile_signups_one_tier(x.signups(), "Starter"),
    "tile_mrr_by_plan": lambda x: dashboard.tile_mrr_by_plan(
        dashboard.mrr_by_plan(x.raw["subscriptions"])
    ),
    "dedup_customers_by_email": lambda x: x.raw["customers"].select(
        "customer_id", "email", "name"
    ),
    # functions
    "fn_normalize_enum": apply("deals", lambda: fn.normalize_enum("deal_stage")),
    "fn_normalize_email": apply("customers", lambda: fn.normalize_email("email")),
    "fn_initcap_company": apply("customers", lambda: fn.capitalize_words("company")),
    "fn_initcap_delims": apply("customers", lambda: fn.capitalize_parts("company")),
    "fn_try_cast_int": apply("customers", lambda: fn.to_int("customer_id")),
    "fn_try_cast_double": apply("deals", lambda: fn.to_double("deal_value")),
    "fn_parse_date": apply("customers", lambda: fn.parse_date("signup_date")),
    "fn_parse_timestamp": apply("activities", lambda: fn.parse_timestamp("timestamp")),
    "fn_round_money": apply("deals", lambda: fn.round_money(fn.to_double("deal_value"))),
    "fn_month_trunc": apply("customers", lambda: fn.month_of(fn.parse_date("signup_date"))),
    "fn_days_until": apply(
        "subscriptions", lambda: fn.days_until(fn.parse_date("renewal_date"), RENEWALS_AS_OF)
    ),
    # layers
    **{f"clean_{e}": (lambda x, e=e: x.raw[e]) for e in ENTITIES},
    **{f"stg_{e}": (lambda x, e=e: x.stg[e]) for e in ENTITIES},
    "fact_deals": lambda x: core.fact_deals(x.stg["deals"], x.stg["customers"]),
    "dim_customers": lambda x: core.dim_customers(
        x.stg["customers"], x.stg["subscriptions"], x.stg["activities"]
    ),
    "dim_subscriptions": lambda x: core.dim_subscriptions(
        x.stg["subscriptions"], x.stg["customers"], RENEWALS_AS_OF
    ),
    "stg_customers_warehouse_text": lambda x: staging.stage_customers(
        x.raw["customers"], warehouse_text=True
    ),
    # two stored days: joined across days, and built from one of them
    **{
        f"{m}_two_days": (lambda x, m=m: core.build_core(x.stg_twice, RENEWALS_AS_OF)[m])
        for m in CORE_COLUMNS
    },
    **{
        f"{m}_snapshot": (
            lambda x, m=m: core.build_core(x.stg_twice, RENEWALS_AS_OF, RUN_DAY)[m]
        )
        for m in CORE_COLUMNS
    },
    # whole runs
    "daily_run": daily_run,
    "daily_run_repeated": daily_run_repeated,
    "sql_over_views": sql_over_views,
}


def _bind(run: Callable[[Layers], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: run(Layers(spark, folder))


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _bind(run) for name, run in _QUERIES.items()}
