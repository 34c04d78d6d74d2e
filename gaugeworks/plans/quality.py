"""The quality gate, its log and the reports over the log."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.functions.numeric import percent
from gaugeworks.operators.quality import (
    check_null_percentage,
    check_numeric_range,
    check_referential_integrity,
    check_row_count,
    enforce,
    run_suite,
)
from gaugeworks.schemas import (
    CHECK_LOG,
    CHECK_LOG_TABLE,
    EQUIPMENT_TABLE,
    FACT_TABLE,
    FAILURE_MODE_TABLE,
    RAW_TABLE,
)
from gaugeworks.session import landed
from gaugeworks.sources.tables import Warehouse


def standard_checks(
    min_raw: int = 10_000, min_fact: int = 10_000, min_equipment: int = 1_000
) -> list:
    """The twelve checks of the gate; the volumes depend on the installation."""
    return [
        check_row_count(RAW_TABLE, min_raw),
        check_row_count(FACT_TABLE, min_fact),
        check_row_count(EQUIPMENT_TABLE, min_equipment),
        check_null_percentage(FACT_TABLE, "equipment_key"),
        check_null_percentage(FACT_TABLE, "torque_nm"),
        check_null_percentage(FACT_TABLE, "rotational_speed_rpm"),
        check_numeric_range(FACT_TABLE, "rotational_speed_rpm", 1000, 3500),
        check_numeric_range(FACT_TABLE, "torque_nm", 1.0, 100.0),
        check_numeric_range(FACT_TABLE, "air_temp_c", 10.0, 50.0),
        check_numeric_range(FACT_TABLE, "tool_wear_min", 0, 300),
        check_referential_integrity(
            FACT_TABLE, "equipment_key", EQUIPMENT_TABLE, "equipment_key"
        ),
        check_referential_integrity(
            FACT_TABLE, "failure_mode_key", FAILURE_MODE_TABLE, "failure_mode_key"
        ),
    ]


def tables_of(warehouse: Warehouse) -> dict[str, DataFrame]:
    names = [RAW_TABLE, FACT_TABLE, EQUIPMENT_TABLE, FAILURE_MODE_TABLE]
    return {name: warehouse.read(name) for name in names}


def as_log_rows(
    results: DataFrame, batch_id: str | None, now: datetime | Column, last_id: int = 0
) -> DataFrame:
    """Verdicts as log rows; ids follow the order of the checks."""
    instant = now if isinstance(now, Column) else F.lit(now)
    return results.select(
        (F.col("position") + F.lit(last_id)).cast("bigint").alias("check_id"),
        F.lit(batch_id).cast("string").alias("batch_id"),
        *[c for c in results.columns if c != "position"],
        instant.cast("timestamp").alias("checked_at"),
    )


def append_check_log(
    warehouse: Warehouse, results: DataFrame, batch_id: str | None, now: datetime
) -> list:
    """Evaluate verdicts straight into the log and return the rows written.

    Their ids are leased: no look at the log, and no other run gets the same ones.
    """
    with landed(results, "verdicts") as verdicts:
        count = verdicts.count()
        first = warehouse.lease(CHECK_LOG_TABLE, count)
        rows = as_log_rows(verdicts, batch_id, now, first - 1)
        # a row per check: one small file instead of one per check
        warehouse.append(CHECK_LOG_TABLE, rows.coalesce(1))
    added = logged_run(warehouse.read(CHECK_LOG_TABLE), first, count)
    return sorted(added.collect(), key=lambda row: row.check_id)


def logged_run(log: DataFrame, first: int, count: int) -> DataFrame:
    """The rows of one run of the gate, by the ids it leased."""
    return log.filter(F.col("check_id").between(first, first + count - 1))


def run_gate(
    warehouse: Warehouse,
    now: datetime,
    batch_id: str | None = None,
    checks: list | None = None,
) -> list:
    """Evaluate the checks, log every verdict, then raise on a critical failure."""
    checks = standard_checks() if checks is None else checks
    results = run_suite(tables_of(warehouse), checks)
    verdicts = append_check_log(warehouse, results, batch_id, now)
    enforce(verdicts)
    return verdicts


def _passed() -> Column:
    return F.count_if(F.col("status") == "PASSED")


def _failed() -> Column:
    return F.count_if(F.col("status") == "FAILED")


def quality_by_category(log: DataFrame) -> DataFrame:
    """Health per check category, healthiest first."""
    return (
        log.groupBy("check_category")
        .agg(
            F.count("*").alias("total_assertions_run"),
            _passed().alias("passed_count"),
            _failed().alias("failed_count"),
        )
        .withColumn(
            "pass_rate_pct",
            percent(F.col("passed_count"), F.col("total_assertions_run")),
        )
        .orderBy(F.desc("pass_rate_pct"), "check_category")
    )


def quality_by_table(log: DataFrame) -> DataFrame:
    """Health per checked table."""
    return (
        log.groupBy("table_name")
        .agg(
            F.count("*").alias("total_checks"),
            _passed().alias("passed"),
            _failed().alias("failed"),
        )
        .withColumn(
            "pass_rate_pct", percent(F.col("passed"), F.col("total_checks"), 1)
        )
        .orderBy("table_name")
    )


def quality_stats(log: DataFrame) -> DataFrame:
    """Counts over the whole history."""
    return log.agg(
        F.count("*").alias("total_checks"),
        _passed().alias("total_passed"),
        _failed().alias("total_failed"),
    )


def latest_run(log: DataFrame, minutes: int = 5) -> DataFrame:
    """Checks of the latest run: those in the last minutes before the newest one."""
    newest = log.agg(F.max("checked_at").alias("newest")).scalar()
    return log.filter(
        F.col("checked_at") >= newest - F.make_dt_interval(mins=F.lit(minutes))
    )


def latest_run_counts(log: DataFrame, minutes: int = 5) -> DataFrame:
    return latest_run(log, minutes).agg(
        F.count("*").alias("total"), _passed().alias("passed"), _failed().alias("failed")
    )


def pass_rate_pct(log: DataFrame) -> DataFrame:
    """Whole-number pass rate; NULL when nothing was checked."""
    return log.agg(
        percent(_passed(), F.count("*"), 0).cast("bigint").alias("pass_rate_pct")
    )


def recent_checks(log: DataFrame, n: int = 50) -> DataFrame:
    """Newest checks first."""
    return (
        log.orderBy(F.desc("checked_at"), F.desc("check_id"))
        .limit(n)
        .select(*CHECK_LOG.names)
    )
