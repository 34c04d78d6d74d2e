"""Raw readings -> staging: units, features and the failure label."""

from __future__ import annotations

from datetime import datetime
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.functions import features
from gaugeworks.operators.changes import effective
from gaugeworks.operators.upsert import upsert
from gaugeworks.schemas import (
    QUARANTINE_TABLE,
    RAW_TABLE,
    STAGING,
    STAGING_TABLE,
)
from gaugeworks.session import landed
from gaugeworks.sources.tables import Warehouse

# A reload recomputes everything but identity: a changed type shows in the grade only.
RELOAD_COLUMNS = [
    c for c in STAGING.names if c not in ("udi", "product_id", "product_type")
]

# What makes a staging row another one; the rest are stamps.
COMPARED = [c for c in RELOAD_COLUMNS if c not in ("batch_id", "transformed_at")]


class MissingValuesError(ValueError):
    """Staging rows lack a required value."""


def to_staging(raw: DataFrame, now: datetime) -> DataFrame:
    """The staging projection of raw readings; one narrow stage, no shuffle."""
    return raw.select(
        "udi",
        "product_id",
        "product_type",
        features.quality_grade("product_type").alias("product_quality_grade"),
        features.kelvin_to_celsius("air_temperature_k").alias("air_temp_c"),
        features.kelvin_to_celsius("process_temperature_k").alias("process_temp_c"),
        features.temp_differential(
            "process_temperature_k", "air_temperature_k"
        ).alias("temp_differential_c"),
        "rotational_speed_rpm",
        "torque_nm",
        features.mechanical_power_kw("rotational_speed_rpm", "torque_nm").alias(
            "mechanical_power_kw"
        ),
        "tool_wear_min",
        features.overstrain("tool_wear_min", "torque_nm").alias("overstrain_metric"),
        "machine_failure",
        features.failure_mode().alias("failure_mode"),
        "batch_id",
        F.lit(now).cast("timestamp").alias("transformed_at"),
    )


# Raw columns that may be missing, but not in staging: a feature is missing exactly
# when one of its inputs is.
REQUIRED_INPUTS = [
    "air_temperature_k",
    "process_temperature_k",
    "rotational_speed_rpm",
    "torque_nm",
    "tool_wear_min",
    "machine_failure",
]


def incomplete() -> Column:
    """Predicate on raw rows: staging could not be filled.

    On the stored raw table it is pushed to the scan, where the files' statistics
    rule out row groups without a NULL.
    """
    return reduce(or_, [F.col(name).isNull() for name in REQUIRED_INPUTS])


def load_staging(
    warehouse: Warehouse,
    now: datetime,
    pending_only: bool = False,
    on_missing: str = "raise",
    skip_unchanged: bool = False,
) -> None:
    """Merge the staging projection of raw into the staging table by ``udi``.

    With ``pending_only`` only the blocks of raw are read and recomputed that were
    written since staging last took from it, by whatever batch and however long ago. So
    no batch is left out, and the cost follows the touched blocks, not the table. With
    ``skip_unchanged`` rows that would only get new stamps keep theirs, and blocks of such
    rows are not written.
    """
    taken = warehouse.version(RAW_TABLE)
    if pending_only:
        since = warehouse.mark(STAGING_TABLE, "consumed")
        blocks = warehouse.pending_blocks(RAW_TABLE, since)
        if not blocks and warehouse.version(STAGING_TABLE):
            return
        raw = warehouse.read(RAW_TABLE, blocks)
    else:
        blocks = warehouse.blocks(RAW_TABLE)
        raw = warehouse.read(RAW_TABLE)
    if on_missing == "raise":
        if not raw.filter(incomplete()).isEmpty():
            raise MissingValuesError("raw rows lack values that staging requires")
    elif on_missing == "quarantine":
        warehouse.append(QUARANTINE_TABLE, to_staging(raw.filter(incomplete()), now))
        raw = raw.filter(~incomplete())
    else:
        raise ValueError(f"on_missing must be raise or quarantine, not {on_missing!r}")

    projected = to_staging(raw, now)
    marks = {"consumed": taken}
    if warehouse.version(STAGING_TABLE) == 0:
        starts = warehouse.blocks(RAW_TABLE)
        warehouse.replace(STAGING_TABLE, projected, marks, starts=starts, clustered=True)
        return
    own = warehouse.overlapping(STAGING_TABLE, RAW_TABLE, blocks)
    if skip_unchanged:
        known = warehouse.read(STAGING_TABLE, own)
        with landed(effective(projected, known, ["udi"], COMPARED), "staging-changes") as news:
            touched = warehouse.touched(STAGING_TABLE, news)
            if touched:
                rows = sum(touched.values())
                _merge_staging(warehouse, news, sorted(touched), rows, marks)
            else:
                warehouse.publish(marks={STAGING_TABLE: marks})
        return
    sizes = warehouse.sizes(RAW_TABLE)
    _merge_staging(warehouse, projected, own, sum(sizes[b] for b in blocks), marks)


def _merge_staging(
    warehouse: Warehouse,
    projected: DataFrame,
    own: list[int],
    rows: int,
    marks: dict[str, int],
) -> None:
    # raw is keyed by udi, so the projection cannot repeat a key
    merged = upsert(
        warehouse.read(STAGING_TABLE, own),
        projected,
        ["udi"],
        RELOAD_COLUMNS,
        duplicates="unique",
        large=warehouse.is_large(STAGING_TABLE, own, rows),
    )
    starts = warehouse.blocks(RAW_TABLE)
    warehouse.replace(STAGING_TABLE, merged, marks, starts=starts, replaced=own)
