"""Row counts and health of a whole warehouse, as single rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.plans.quality import latest_run_counts
from gaugeworks.sources.logs import latest_ingestion


def counts_row(counted: Mapping[str, DataFrame]) -> DataFrame:
    """One row with the row count of every frame, under the given names.

    Each frame is counted on its own; what is brought together is one number each.
    """
    parts = [
        frame.agg(F.count("*").alias("_n")).select(F.lit(name).alias("_name"), "_n")
        for name, frame in counted.items()
    ]
    return _one_row(parts, list(counted))


def run_summary(raw: DataFrame, fact: DataFrame, check_log: DataFrame) -> DataFrame:
    """Raw rows, fact rows, failures, and passed checks of the whole history."""
    return counts_row(
        {
            "raw_rows": raw,
            "fact_rows": fact,
            "failure_rows": fact.filter("is_failure"),
            "passed_quality_checks": check_log.filter("status = 'PASSED'"),
        }
    )


def warehouse_summary(
    layers: Mapping[str, DataFrame],
    features: DataFrame,
    check_log: DataFrame,
    ingestion_log: DataFrame,
) -> DataFrame:
    """Layer counts, anomalies, checks of all time and of the latest run, last batch.

    ``layers`` has the frames raw, staging, fact, dim_equipment, dim_failure_mode.
    """
    counts = counts_row(
        {
            **layers,
            "anomalies": features.filter("is_torque_anomaly"),
            "total_historical_checks": check_log,
        }
    )
    latest = latest_run_counts(check_log)
    batch = latest_ingestion(ingestion_log)
    return counts.select(
        "*",
        _scalar(latest, "total").alias("latest_total"),
        _scalar(latest, "passed").alias("latest_passed"),
        _scalar(latest, "failed").alias("latest_failed"),
        _scalar(batch, "batch_id").alias("last_batch_id"),
        _scalar(batch, "status").alias("last_status"),
        _scalar(batch, "row_count").alias("last_row_count"),
        _scalar(batch, "ingested_at").alias("last_ingested_at"),
    )


def _scalar(one_row: DataFrame, column: str) -> Column:
    return one_row.select(column).scalar()


def _one_row(parts: list[DataFrame], names: list[str]) -> DataFrame:
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part)
    return stacked.agg(
        *[F.max(F.when(F.col("_name") == n, F.col("_n"))).alias(n) for n in names]
    )
