"""Dated folders: landed text under raw/, cleaned Parquet under processed/."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Mapping
from dataclasses import dataclass
from functools import partial

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, DataFrameReader, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from accountloom.functions.dates import run_date
from accountloom.schemas import ENTITIES, SOURCE_COLUMNS, source_schema
from accountloom.sources import files
from accountloom.sources.parallel import write_together


def raw_path(base: str, day: dt.date | str, entity: str) -> str:
    return f"{base}/raw/crm/{run_date(day).isoformat()}/{entity}.csv"


def processed_path(base: str, day: dt.date | str, entity: str) -> str:
    return f"{base}/processed/crm/{run_date(day).isoformat()}/{entity}"


def _reader(spark: SparkSession, multi_line: bool) -> DataFrameReader:
    return spark.read.options(header=True, escape='"', multiLine=multi_line)


def read_source(
    spark: SparkSession,
    path: str,
    entity: str,
    *,
    any_header_order: bool = False,
    multi_line: bool = False,
) -> DataFrame:
    """One source as text columns; the path is a CSV file or a folder of them.

    By default every file's header must list the declared columns in order, and
    a wrong one fails the read. any_header_order takes the names from the header
    instead, allowing other orders and additional columns. multi_line admits line
    breaks inside quotes, but one file is then one task.
    """
    reader = _reader(spark, multi_line)
    try:
        if any_header_order:
            return reader.csv(path).select(SOURCE_COLUMNS[entity])
        return reader.option("enforceSchema", False).schema(source_schema(entity)).csv(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"no {entity} source at {path}") from error
        raise


def read_run(spark: SparkSession, base: str, day: dt.date | str, **options) -> dict[str, DataFrame]:
    """All sources landed for one day; no other day's folder is listed."""
    return {e: read_source(spark, raw_path(base, day, e), e, **options) for e in ENTITIES}


def write_source(df: DataFrame, path: str) -> None:
    """Text as it is: the CSV writer would otherwise trim values."""
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


@dataclass(frozen=True)
class Landed:
    """Records of one source, and how many of them have too few or too many fields."""

    rows: int
    malformed: int


_DAMAGED = "_malformed"
# All that a parser takes for blank at the edges of a line.
_BLANK = "".join(map(chr, range(33)))


def _is_header(entity: str) -> Column:
    header = ",".join(SOURCE_COLUMNS[entity])
    likely = F.octet_length("value") < 3 * len(header)
    return likely & (F.lower(F.trim(F.translate("value", '"\r', ""))) == header)


def _damaged_line(entity: str) -> Column:
    schema = source_schema(entity).add(_DAMAGED, T.StringType())
    options = {"columnNameOfCorruptRecord": _DAMAGED, "columnPruning": "false", "escape": '"'}
    return F.from_csv(F.rtrim("value", F.lit("\r")), schema.simpleString()[len("struct<") : -1].replace(":", " "), options)[_DAMAGED]


def _files_with_content(spark: SparkSession, path: str) -> int:
    """How many files under the path are not empty, by their sizes alone."""
    return spark.read.format("binaryFile").load(path).select("length").filter("length > 0").count()


def _missing(entity: str, path: str) -> FileNotFoundError:
    return FileNotFoundError(f"no {entity} source at {path}")


def copy_lines(spark: SparkSession, path: str, target: str, entity: str) -> Landed:
    """Copy a source line by line, as it was sent, and count its records on the way.

    A line ends at a line feed; no other character has a meaning, and none is changed.
    Headers are left out and one is put first in every file written. Raises if a file
    that is not empty has none; what was written is then of no use.
    """
    try:
        text = spark.read.option("lineSep", "\n").text(path).select("value", F.col("_metadata.file_path").alias("file"))
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise _missing(entity, path) from error
        raise
    if not text.inputFiles():
        raise _missing(entity, path)
    is_header = _is_header(entity)
    is_record = ~is_header & (F.btrim("value", F.lit(_BLANK)) != "")
    counts = Observation()
    seen = text.observe(
        counts,
        F.count(F.when(is_record, 1)).alias("rows"),
        F.count(F.when(is_record, _damaged_line(entity))).alias("malformed"),
        F.size(F.collect_set(F.when(is_header, F.col("file")))).alias("headed"),
    )
    header = ",".join(SOURCE_COLUMNS[entity])
    # A task's rows are one file's; ids count on from a multiple of 2^33 in each task.
    first = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1) == 0
    lines = seen.filter(~is_header & (F.length("value") > 0)).select("value", first.alias("first"))
    headed = F.when(F.col("first"), F.concat(F.lit(f"{header}\n"), F.col("value"))).otherwise(F.col("value"))
    writing = {"lineSep": "\n", "maxRecordsPerFile": "0"}
    lines.select(headed.alias("value")).write.mode("overwrite").options(**writing).text(target)
    found = counts.get
    if found["headed"] < _files_with_content(spark, path):
        raise ValueError(f"a file of {path} lacks the CSV header of {entity}: {header}")
    if not found["rows"]:
        only = spark.createDataFrame([(header,)], "value string").coalesce(1)
        only.write.mode("overwrite").options(**writing).text(target)
    return Landed(found["rows"], found["malformed"])


def rewrite_records(spark: SparkSession, path: str, target: str, entity: str, **options) -> Landed:
    """Parse a source, put its columns in the declared order and write it anew, counting on the way.

    With any_header_order the files of a source may have any header, but all the same one.
    """
    multi_line, any_order = options.get("multi_line", False), options.get("any_header_order", False)
    reader = _reader(spark, multi_line)
    plain = read_source(spark, path, entity, **options)
    if not plain.inputFiles():
        raise _missing(entity, path)
    names = reader.csv(path).columns if any_order else SOURCE_COLUMNS[entity]
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, _DAMAGED]])
    counting = {"columnNameOfCorruptRecord": _DAMAGED, "columnPruning": False, "enforceSchema": False}
    counts = Observation()
    parsed = reader.options(**counting).schema(schema).csv(path).observe(
        counts, F.count(F.lit(1)).alias("rows"), F.count(_DAMAGED).alias("malformed")
    )
    write_source(parsed.select(SOURCE_COLUMNS[entity]), target)
    return Landed(counts.get["rows"], counts.get["malformed"])


def land_sources(
    spark: SparkSession, inputs: Mapping[str, str], base: str, day: dt.date | str, **options
) -> dict[str, Landed]:
    """Copy all sources into the day's folder, or none if one is missing or has a wrong header.

    Every source is read once. What it holds is counted while it is copied to a folder
    beside the day's, which takes the day's place only when all sources are found good.
    Lines are copied as they are. With any_header_order the columns are put in the
    declared order, and with multi_line a record may span lines; then records are
    parsed and written anew.
    """
    missing = [e for e in ENTITIES if e not in inputs]
    if missing:
        raise FileNotFoundError(f"no path given for {', '.join(missing)}")
    found: dict[str, Landed] = {}
    day_folder = raw_path(base, day, "").rpartition("/")[0]
    zone, _, name = day_folder.rpartition("/")
    new = f"{zone}/_new-{name}-{uuid.uuid4().hex}"

    def land(entity: str) -> None:
        target = f"{new}/{entity}.csv"
        copy = rewrite_records if any(options.values()) else copy_lines
        found[entity] = copy(spark, inputs[entity], target, entity, **{k: v for k, v in options.items() if v})

    try:
        write_together(spark, [partial(land, e) for e in ENTITIES])
        files.put_in_place(spark, new, day_folder)
    finally:
        files.delete(spark, new)
    return found


def write_processed(df: DataFrame, base: str, day: dt.date | str, entity: str) -> None:
    df.write.mode("overwrite").parquet(processed_path(base, day, entity))


def read_processed(
    spark: SparkSession, base: str, day: dt.date | str, entity: str
) -> DataFrame:
    return spark.read.parquet(processed_path(base, day, entity))


def drop_expired_folders(
    spark: SparkSession, base: str, as_of: dt.date | str | None = None, days: int = 30
) -> list[dt.date]:
    """Delete the dated folders of both zones that are `days` old or older.

    Only folder names are listed. A folder whose name is no date stays. Returns
    the days that were deleted.
    """
    today = dt.datetime.now(dt.timezone.utc).date() if as_of is None else run_date(as_of)
    dropped = set()
    for zone in ("raw", "processed"):
        root = f"{base}/{zone}/crm"
        for name in files.names(spark, root):
            try:
                day = run_date(name)
            except ValueError:
                continue
            if day <= today - dt.timedelta(days=days):
                files.delete(spark, f"{root}/{name}")
                dropped.add(day)
    return sorted(dropped)
