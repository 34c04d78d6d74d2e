"""The end-to-end load: ingest, staging, star, quality gate, views."""

from __future__ import annotations

import time
from dataclasses import dataclass, field
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession

from gaugeworks.plans.adhoc import FEATURES_VIEW, LEADERBOARD_VIEW, ROOT_CAUSE_VIEW
from gaugeworks.plans.analytics import Star, anomaly_features, leaderboard, root_cause
from gaugeworks.plans.quality import run_gate
from gaugeworks.plans.staging import incomplete, load_staging
from gaugeworks.plans.star import load_star
from gaugeworks.plans.summary import run_summary
from gaugeworks.schemas import CHECK_LOG_TABLE, FACT_TABLE, RAW_TABLE, STAGING_TABLE
from gaugeworks.sources.readings import ingest_batch
from gaugeworks.sources.tables import STORED_ROWS, Warehouse


@dataclass
class StageReport:
    stage: str
    status: str
    details: str
    duration_s: float


@dataclass
class RunReport:
    status: str = "success"
    batch_id: str | None = None
    error: str | None = None
    total_duration_s: float = 0.0
    steps: list[StageReport] = field(default_factory=list)
    summary: dict | None = None


def analytics_views(warehouse: Warehouse) -> dict[str, DataFrame]:
    """The three analytics views as lazy frames over the current star."""
    star = Star.of(warehouse)
    return {
        FEATURES_VIEW: anomaly_features(star),
        ROOT_CAUSE_VIEW: root_cause(star),
        LEADERBOARD_VIEW: leaderboard(star),
    }


def run_transforms(
    spark: SparkSession,
    root: str,
    now: datetime,
    pending_only: bool = False,
    rows: int = STORED_ROWS,
) -> dict[str, DataFrame]:
    """Staging, then star, then views, which are registered and returned.

    With ``pending_only`` staging and star take what they have not taken in yet.
    """
    warehouse = Warehouse(spark, root, rows)
    load_staging(warehouse, now, pending_only)
    load_star(warehouse, now, pending_only)
    views = analytics_views(warehouse)
    warehouse.register_views(views)
    return views


def materialize_features(warehouse: Warehouse, path: str) -> None:
    """Write the anomaly features once, for readers that ask often."""
    features = anomaly_features(Star.of(warehouse))
    features.write.mode("overwrite").partitionBy("product_type").parquet(path)


def check_parity(warehouse: Warehouse) -> dict[str, int]:
    """Rows of raw, staging and fact. Raises unless all are equal, not counting readings of
    raw that lack a value staging requires and so were set aside.

    The counts stand in the commit; only the missing values are looked for in the data.
    """
    counts = {t: sum(warehouse.sizes(t).values()) for t in (RAW_TABLE, STAGING_TABLE, FACT_TABLE)}
    if len(set(counts.values())) > 1:
        # a reading that was complete before keeps the staging row it had
        aside = warehouse.read(RAW_TABLE).filter(incomplete()).select("udi")
        aside = aside.join(warehouse.read(STAGING_TABLE).select("udi"), "udi", "left_anti")
        fitting = counts[RAW_TABLE] - aside.count()
        if {fitting} != {counts[STAGING_TABLE], counts[FACT_TABLE]}:
            raise ValueError(f"rows got lost between layers: {counts}, {fitting} complete")
    return counts


def run_load(
    spark: SparkSession,
    csv_path: str,
    root: str,
    now: datetime | None = None,
    batch_id: str | None = None,
    checks: list | None = None,
    incremental: bool = False,
    summary: bool = False,
    skip_unchanged: bool = False,
    on_missing: str = "raise",
    rows: int = STORED_ROWS,
    **ingest_options,
) -> RunReport:
    """All stages in order. The first failure ends the run; the report says how far.

    The views are only registered once the gate has passed. With ``incremental`` staging
    and star take the blocks they have not taken in yet, this batch's and any that an
    earlier run left behind. Either way raw, staging and fact must end with equal counts,
    readings that ``on_missing="quarantine"`` keeps out of staging taken off. With
    ``skip_unchanged`` readings that come again as they are cause no writes.
    """
    now = now or datetime.now(UTC)
    warehouse = Warehouse(spark, root, rows)
    report = RunReport()
    started = time.perf_counter()

    def ingest():
        report.batch_id = ingest_batch(
            spark, csv_path, root, batch_id, now, rows=rows,
            skip_unchanged=skip_unchanged, **ingest_options,
        )
        return f"merged source records into {RAW_TABLE} (batch {report.batch_id})"

    def staging():
        load_staging(warehouse, now, incremental, on_missing, skip_unchanged)
        return "computed units, power, overstrain and failure labels"

    def star():
        load_star(warehouse, now, incremental, skip_unchanged)
        check_parity(warehouse)
        return "loaded dimensions and fact with surrogate keys"

    def gate():
        verdicts = run_gate(warehouse, now, report.batch_id, checks)
        passed = sum(v.status == "PASSED" for v in verdicts)
        return f"evaluated {len(verdicts)} checks ({passed} passed)"

    def views():
        warehouse.register_views(analytics_views(warehouse))
        return "registered features, root cause and leaderboard"

    stages = [
        ("extract", ingest),
        ("staging", staging),
        ("star", star),
        ("quality", gate),
        ("views", views),
    ]
    for name, stage in stages:
        began = time.perf_counter()
        try:
            details = stage()
        except Exception as error:
            report.status = "error"
            report.error = f"{name}: {error}"
            break
        seconds = round(time.perf_counter() - began, 2)
        report.steps.append(StageReport(name, "SUCCESS", details, seconds))
    report.total_duration_s = round(time.perf_counter() - started, 2)
    if summary and report.status == "success":
        row = run_summary(
            warehouse.read(RAW_TABLE),
            warehouse.read(FACT_TABLE),
            warehouse.read(CHECK_LOG_TABLE),
        ).first()
        report.summary = row.asDict()
    return report
