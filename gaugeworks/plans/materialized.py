"""The anomaly features as a stored table that follows the fact.

A changed reading changes its own row and, through the row frame, the next nine of its
product type - wherever those lie. ``refresh_features`` finds the changed readings in the
blocks of the fact that were written since, adds the blocks that their frames reach, and
replaces the rows concerned and no others.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.operators.changes import effective
from gaugeworks.operators.rolling import rolling
from gaugeworks.operators.upsert import upsert
from gaugeworks.plans.analytics import (
    FEATURE_COLUMNS,
    FRAME_PRECEDING,
    Star,
    anomaly_features,
    feature_readings,
    rolling_sums,
    scored,
)
from gaugeworks.plans.partials import START, refresh_partials
from gaugeworks.schemas import BLOCK_COUNTS_TABLE, FACT_TABLE, FEATURES_TABLE
from gaugeworks.session import landed
from gaugeworks.sources.tables import Warehouse


def store_features(warehouse: Warehouse) -> None:
    """Compute the features of all readings and store them by block."""
    taken = warehouse.version(FACT_TABLE)
    features = anomaly_features(Star.of(warehouse))
    starts = warehouse.blocks(FACT_TABLE)
    warehouse.replace(FEATURES_TABLE, features, {"consumed": taken}, starts=starts)


def refresh_features(warehouse: Warehouse) -> int:
    """Bring the stored features up to the fact; returns the number of rows replaced."""
    if warehouse.version(FEATURES_TABLE) == 0:
        store_features(warehouse)
        return sum(warehouse.sizes(FEATURES_TABLE).values())
    taken = warehouse.version(FACT_TABLE)
    pending = warehouse.pending_blocks(FACT_TABLE, warehouse.mark(FEATURES_TABLE, "consumed"))
    if not pending:
        return 0
    refresh_partials(warehouse)
    star = Star.of(warehouse)
    with landed(changed_readings(warehouse, star, pending), "changed") as changed:
        reached = reached_blocks(warehouse, changed)
        if not reached:
            warehouse.publish(marks={FEATURES_TABLE: {"consumed": taken}})
            return 0
        part = replace(star, fact=warehouse.read(FACT_TABLE, reached))
        with landed(dirty_features(part, changed), "dirty") as dirty:
            touched = sorted(warehouse.touched(FEATURES_TABLE, dirty))
            kept = warehouse.read(FEATURES_TABLE, touched)
            merged = upsert(kept, dirty, ["udi"], "all", duplicates="unique")
            warehouse.replace(
                FEATURES_TABLE,
                merged,
                {"consumed": taken},
                starts=warehouse.blocks(FACT_TABLE),
                replaced=touched,
            )
            return dirty.count()


def changed_readings(warehouse: Warehouse, star: Star, blocks: list[int]) -> DataFrame:
    """udi, type and block of the readings in ``blocks`` of the fact whose stored features
    were made from other values, or that have none."""
    fact = warehouse.read(FACT_TABLE, blocks, block_column=START)
    named = star.joined(fact).select(*FEATURE_COLUMNS, START)
    own = warehouse.overlapping(FEATURES_TABLE, FACT_TABLE, blocks)
    stored = warehouse.read(FEATURES_TABLE, own)
    compared = [c for c in FEATURE_COLUMNS if c != "udi"]
    found = effective(named, stored, ["udi"], compared)
    return found.select("udi", "product_type", START)


def reached_blocks(
    warehouse: Warehouse, changed: DataFrame, reach: int = FRAME_PRECEDING
) -> list[int]:
    """Blocks of the fact that hold changed readings, the ``reach`` readings of their type
    behind them, and the ``reach`` ahead of them that those frames need.

    The counts per block and type say how many blocks that takes. Blocks between without a
    reading of the type are not needed.
    """
    pairs = changed.select("product_type", START).distinct().collect()
    kinds = {kind for kind, _ in pairs}
    counts = warehouse.read(BLOCK_COUNTS_TABLE).filter(F.col("product_type").isin(*kinds))
    series: dict[str, tuple[list[int], list[int]]] = {kind: ([], []) for kind in kinds}
    for row in counts.orderBy(START).collect() if kinds else []:
        starts, sizes = series[row.product_type]
        starts.append(row[START])
        sizes.append(row.n)
    found: set[int] = set()
    for kind, block in pairs:
        starts, sizes = series[kind]
        behind = range(bisect_right(starts, block), len(starts))
        ahead = range(bisect_left(starts, block) - 1, -1, -1)
        for side in (behind, ahead):
            rows = 0
            for k in side:
                if rows >= reach:
                    break
                found.add(starts[k])
                rows += sizes[k]
        found.add(block)
    return sorted(found)


def dirty_features(star: Star, changed: DataFrame) -> DataFrame:
    """New features of changed readings and of those whose frame has one.

    ``star`` holds the part of the fact that these frames reach; whether a frame has a
    changed reading is one more column of the same windows.
    """
    flags = changed.select("udi", F.lit(1).alias("_changed"))
    readings = feature_readings(star).join(flags, "udi", "left")

    def build(ordered, framed):
        return rolling_sums(ordered, framed) | {"_dirty": F.max("_changed").over(framed)}

    summed = rolling(
        readings,
        "product_type",
        "udi",
        build,
        FRAME_PRECEDING,
        inputs=["torque_nm", "mechanical_power_kw", "_changed"],
        blocks=star.blocks,
    )
    return scored(star, summed.filter("_dirty = 1"))
