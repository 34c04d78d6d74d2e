"""A warehouse loaded from the ``events`` table, shared by the registered queries."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeworks.operators.quality import run_suite
from gaugeworks.plans.analytics import Star
from gaugeworks.plans.quality import as_log_rows, standard_checks, tables_of
from gaugeworks.plans.staging import load_staging
from gaugeworks.plans.star import load_star
from gaugeworks.schemas import RAW, RAW_TABLE
from gaugeworks.session import landed, scratch_path
from gaugeworks.sources.events import readings_from_events
from gaugeworks.sources.logs import log_ingestion
from gaugeworks.sources.readings import add_lineage, load_raw
from gaugeworks.sources.tables import Warehouse

SOURCE = "events.parquet"
BATCH = "batch_20240101_000000_aaaaaa"
NEXT_BATCH = "batch_20240102_000000_bbbbbb"
LOADED_AT = datetime(2024, 1, 1, 0, 0, 0, tzinfo=UTC)
RELOADED_AT = datetime(2024, 1, 2, 0, 0, 0, tzinfo=UTC)
FIRST_RUN = datetime(2024, 1, 1, 6, 0, 0, tzinfo=UTC)
SECOND_RUN = datetime(2024, 1, 1, 6, 10, 0, tzinfo=UTC)

_loaded: dict[tuple[str, str], Warehouse] = {}


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readings_from_events(events(spark, sf_dir))


def raw_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    stamped = add_lineage(readings(spark, sf_dir), SOURCE, BATCH, LOADED_AT)
    return stamped.select(*RAW.names)


def second_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events once more, under odd ids: half of them known, half of them new.

    Torque, failure flag and one mode flag differ from the first batch.
    """
    again = readings(spark, sf_dir).withColumns(
        {
            "udi": F.col("udi") * 2 - 1,
            "torque_nm": (F.col("torque_nm") + 1).cast("decimal(8,2)"),
            "machine_failure": 1 - F.col("machine_failure"),
            "hdf": 1 - F.col("hdf"),
        }
    )
    return add_lineage(again, SOURCE, NEXT_BATCH, RELOADED_AT).select(*RAW.names)


def load(spark: SparkSession, sf_dir: str) -> Warehouse:
    """Load a fresh warehouse: raw, staging, star, with the ingestion logged."""
    warehouse = Warehouse(spark, scratch_path(spark, "warehouse"))
    rows = events(spark, sf_dir).count()
    log_ingestion(warehouse, BATCH, SOURCE, rows, "IN_PROGRESS", LOADED_AT)
    with landed(raw_batch(spark, sf_dir), "landing") as batch:
        load_raw(warehouse, batch)
    log_ingestion(warehouse, BATCH, SOURCE, rows, "SUCCESS", LOADED_AT)
    load_staging(warehouse, LOADED_AT)
    load_star(warehouse, LOADED_AT)
    return warehouse


def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The loaded warehouse of this session; queries only read it."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _loaded:
        _loaded[key] = load(spark, sf_dir)
    return _loaded[key]


def star(spark: SparkSession, sf_dir: str) -> Star:
    return Star.of(warehouse(spark, sf_dir))


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warehouse(spark, sf_dir).read(RAW_TABLE)


def check_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs of the gate, ten minutes apart, with stricter volumes in the second."""
    tables = tables_of(warehouse(spark, sf_dir))
    first = run_suite(tables, standard_checks(1_000, 1_000, 100))
    second = run_suite(tables, standard_checks(1_000, 1_000_000_000, 1_000))
    return as_log_rows(first, BATCH, FIRST_RUN).unionByName(
        as_log_rows(second, NEXT_BATCH, SECOND_RUN, last_id=12)
    )


def comparable(df: DataFrame) -> DataFrame:
    """Types every SQL engine has: bigint, double, string, boolean."""
    columns = []
    for field in df.schema:
        column = F.col(f"`{field.name}`")
        kind = field.dataType
        if isinstance(kind, (T.DecimalType, T.FloatType)):
            column = column.cast("double")
        elif isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType)):
            column = column.cast("bigint")
        elif isinstance(kind, T.TimestampType):
            utc = F.to_utc_timestamp(column, F.current_timezone())
            column = F.date_format(utc, "yyyy-MM-dd HH:mm:ss")
        columns.append(column.alias(field.name))
    return df.select(*columns)
