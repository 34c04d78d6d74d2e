"""The ingestion log: appended state changes, read as current states."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.schemas import INGESTION_LOG, INGESTION_LOG_TABLE, INGESTION_STATUSES
from gaugeworks.session import literal_rows
from gaugeworks.sources.tables import Warehouse


def log_ingestion(
    warehouse: Warehouse,
    batch_id: str,
    source: str,
    rows: int,
    status: str,
    now: datetime,
    error: str | None = None,
) -> None:
    """Append one state change of a batch."""
    if status not in INGESTION_STATUSES:
        raise ValueError(f"status must be one of {INGESTION_STATUSES}, not {status!r}")
    step = 0 if status == "IN_PROGRESS" else 1
    row = (batch_id, source, rows, status, now, error, step)
    entry = literal_rows(warehouse.spark, [row], INGESTION_LOG)
    warehouse.append(INGESTION_LOG_TABLE, entry)


def ingestion_states(log: DataFrame) -> DataFrame:
    """One row per batch: its latest state. A retry supersedes the earlier attempt."""
    fields = [c for c in log.columns if c != "batch_id"]
    newest = F.max_by(F.struct(*fields), F.struct("ingested_at", "state_seq"))
    return (
        log.groupBy("batch_id")
        .agg(newest.alias("state"))
        .select("batch_id", *[f"state.{c}" for c in fields if c != "state_seq"])
    )


def latest_ingestion(log: DataFrame) -> DataFrame:
    """The batch ingested last, as one row."""
    return (
        ingestion_states(log)
        .select("batch_id", "status", "row_count", "ingested_at")
        .orderBy(F.desc("ingested_at"), F.desc("batch_id"))
        .limit(1)
    )
