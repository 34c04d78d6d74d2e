"""Staging -> star schema: two dimensions with stable keys, one fact table."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import datetime
from itertools import accumulate

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.functions import features
from gaugeworks.operators.blocks import LEAST_KEY, Blocks
from gaugeworks.operators.changes import effective
from gaugeworks.operators.ordinal import counted_ordinal, text_ordinal
from gaugeworks.operators.upsert import resolve_duplicates, upsert
from gaugeworks.schemas import (
    DIM_EQUIPMENT,
    DIM_FAILURE_MODE,
    EQUIPMENT_TABLE,
    FACT,
    FACT_TABLE,
    FAILURE_MODE_SEED,
    FAILURE_MODE_TABLE,
    STAGING_TABLE,
)
from gaugeworks.session import landed, literal_rows
from gaugeworks.sources.tables import Warehouse


def seed_failure_modes(
    spark: SparkSession, existing: DataFrame | None = None
) -> DataFrame:
    """The failure-mode dimension with any missing seed row added at its end."""
    if existing is None:
        existing = literal_rows(spark, [], DIM_FAILURE_MODE)
    # seven rows: names and the greatest key fit on the driver
    present = {r.failure_mode_name: r.failure_mode_key for r in existing.collect()}
    top = max(present.values(), default=0)
    absent = [row for row in FAILURE_MODE_SEED if row[0] not in present]
    fresh = [(top + place, *row) for place, row in enumerate(absent, 1)]
    return existing.unionByName(literal_rows(spark, fresh, DIM_FAILURE_MODE))


def equipment_rows(staging: DataFrame) -> DataFrame:
    """Distinct equipment; partial aggregation shrinks it before the shuffle."""
    return staging.select(
        "product_id", "product_type", F.col("product_quality_grade").alias("quality_grade")
    ).distinct()


def assign_keys(fresh: DataFrame, natural_key: str, key: str, top: int) -> DataFrame:
    """Number new rows above ``top`` in the order of their natural key."""
    numbered = text_ordinal(fresh, natural_key, "_number")
    return numbered.withColumn(key, F.col("_number") + F.lit(top)).drop("_number")


def build_dim_equipment(
    found: DataFrame, existing: DataFrame, now: datetime
) -> DataFrame:
    """The equipment dimension after a load of ``found`` equipment.

    Known products get the new grade and update time and keep key, type and creation
    time; new products get keys above all existing ones. A product that shows up with
    two types is refused.
    """
    found = resolve_duplicates(found, ["product_id"], "error")
    instant = F.lit(now).cast("timestamp")
    fresh = found.join(existing.select("product_id"), "product_id", "left_anti")
    top = existing.agg(F.coalesce(F.max("equipment_key"), F.lit(0))).first()[0]
    keyed = assign_keys(fresh, "product_id", "equipment_key", top).withColumns(
        {"created_at": instant, "updated_at": instant}
    )
    current = found.select(
        "product_id",
        F.col("quality_grade").alias("_grade"),
        F.lit(True).alias("_seen"),
    )
    kept = existing.join(current, "product_id", "left").select(
        "equipment_key",
        "product_id",
        "product_type",
        F.coalesce("_grade", "quality_grade").alias("quality_grade"),
        "created_at",
        F.when(F.col("_seen"), instant).otherwise(F.col("updated_at")).alias(
            "updated_at"
        ),
    )
    return kept.unionByName(keyed.select(*DIM_EQUIPMENT.names))


def build_fact(
    staging: DataFrame, dim_equipment: DataFrame, dim_mode: DataFrame, now: datetime
) -> DataFrame:
    """Fact rows without their surrogate key: two lookups by natural key.

    The seven modes are broadcast. The equipment dimension grows with the data, so
    the join strategy - and the splitting of a product that holds much of the data -
    is left to adaptive execution.
    """
    return (
        staging.join(
            dim_equipment.select("equipment_key", "product_id"), "product_id"
        )
        .join(
            F.broadcast(
                dim_mode.select(
                    "failure_mode_key", F.col("failure_mode_name").alias("failure_mode")
                )
            ),
            "failure_mode",
        )
        .select(
            "udi",
            "equipment_key",
            "failure_mode_key",
            "air_temp_c",
            "process_temp_c",
            "temp_differential_c",
            "rotational_speed_rpm",
            "torque_nm",
            "mechanical_power_kw",
            "tool_wear_min",
            "overstrain_metric",
            features.is_failure("machine_failure").alias("is_failure"),
            F.lit(now).cast("timestamp").alias("loaded_at"),
        )
    )


# What makes a fact row another one: neither its keys nor its time.
COMPARED = [c for c in FACT.names if c not in ("telemetry_key", "udi", "loaded_at")]


def merge_fact(
    existing: DataFrame | None,
    rows: DataFrame,
    first: int = 1,
    leases: Blocks | None = None,
    large: bool = False,
) -> DataFrame:
    """Fact rows merged by ``udi``; known rows keep their key, new ones get larger.

    Keys from ``first`` on are this load's. Each block of ids leases as many of them as it
    has rows, and numbers its rows within its lease: no look at keys given out before, and
    the same form whether ids are dense or far apart. Keys of known rows stay unused.
    """
    numbered = counted_ordinal(rows, "udi", name="_number", blocks=leases)
    keyed = numbered.withColumn("telemetry_key", F.col("_number") + F.lit(first - 1))
    if existing is None:
        return keyed.select(*FACT.names)
    return upsert(
        existing,
        keyed,
        ["udi"],
        [c for c in FACT.names if c not in ("telemetry_key", "udi")],
        duplicates="unique",
        large=large,
    )


def key_leases(sizes: Mapping[int, int], blocks: Iterable[int]) -> Blocks:
    """Blocks of ids with the keys that blocks before them may use up."""
    starts = sorted(blocks)
    ahead = list(accumulate((sizes[b] for b in starts), initial=0))
    return Blocks(("udi",), tuple((b,) for b in starts) or ((LEAST_KEY,),), tuple(ahead), ahead[-1])


def load_star(
    warehouse: Warehouse,
    now: datetime,
    pending_only: bool = False,
    skip_unchanged: bool = False,
) -> None:
    """Load dimensions and fact; all become current together at the end.

    With ``pending_only`` only the blocks of staging are read and loaded that were
    written since the fact last took from it. With ``skip_unchanged`` rows that would only
    get a new time keep theirs: neither their blocks nor a dimension without news are
    written.
    """
    taken = warehouse.version(STAGING_TABLE)
    if pending_only:
        since = warehouse.mark(FACT_TABLE, "consumed")
        blocks = warehouse.pending_blocks(STAGING_TABLE, since)
        if not blocks and warehouse.version(FACT_TABLE):
            return
    else:
        blocks = warehouse.blocks(STAGING_TABLE)
    staging = warehouse.read(STAGING_TABLE, blocks)
    staged = []

    modes = warehouse.read(FAILURE_MODE_TABLE)
    if not skip_unchanged or modes.count() < len(FAILURE_MODE_SEED):
        seeded = seed_failure_modes(warehouse.spark, modes)
        staged.append(warehouse.stage(FAILURE_MODE_TABLE, seeded))
        modes = warehouse.read_staged(staged[-1])
    equipment = warehouse.read(EQUIPMENT_TABLE)
    with landed(equipment_rows(staging), "equipment") as found:
        if skip_unchanged:
            found = effective(found, equipment, ["product_id"], ["quality_grade"])
        if not skip_unchanged or not found.isEmpty():
            built = build_dim_equipment(found, equipment, now)
            staged.append(warehouse.stage(EQUIPMENT_TABLE, built))
            equipment = warehouse.read_staged(staged[-1])
    rows = build_fact(staging, equipment, modes, now)

    starts = warehouse.blocks(STAGING_TABLE)
    leases = key_leases(warehouse.sizes(STAGING_TABLE), blocks)
    used = warehouse.mark(FACT_TABLE, "leased")
    marks = {"consumed": taken, "leased": used + leases.total}
    if warehouse.version(FACT_TABLE) == 0:
        # numbering brings a block's rows together, so they are written as they come
        merged = merge_fact(None, rows, used + 1, leases)
        staged.append(warehouse.stage(FACT_TABLE, merged, starts, clustered=True))
        warehouse.publish(*staged, marks={FACT_TABLE: marks})
        return
    own = warehouse.overlapping(FACT_TABLE, STAGING_TABLE, blocks)
    if skip_unchanged:
        rows = effective(rows, warehouse.read(FACT_TABLE, own), ["udi"], COMPARED)
    count = leases.total
    with landed(rows, "fact-batch") as batch:
        if skip_unchanged:
            touched = warehouse.touched(FACT_TABLE, batch)
            own, count = sorted(touched), sum(touched.values())
        if own:
            large = warehouse.is_large(FACT_TABLE, own, count)
            merged = merge_fact(warehouse.read(FACT_TABLE, own), batch, used + 1, leases, large)
            staged.append(warehouse.stage(FACT_TABLE, merged, starts, replaced=own))
        warehouse.publish(*staged, marks={FACT_TABLE: marks})


def star_join(
    fact: DataFrame, dim_equipment: DataFrame, dim_mode: DataFrame
) -> DataFrame:
    """Fact with both dimensions on their surrogate keys."""
    return fact.join(dim_equipment, "equipment_key").join(
        F.broadcast(dim_mode), "failure_mode_key"
    )
