"""Reports over the star schema.

Every function takes the three star tables and returns a frame. A top-k takes its rows
from the readings that have both dimension rows, then looks up the dimensions of those
few.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeworks.functions.numeric import (
    RollingStats,
    mean_rounded,
    percent,
    round_double,
)
from gaugeworks.operators.blocks import Blocks, equal_blocks
from gaugeworks.operators.rolling import rolling, rolling_plain
from gaugeworks.operators.tiles import MAX_CELLS, tile_report
from gaugeworks.plans.star import star_join
from gaugeworks.schemas import EQUIPMENT_TABLE, FACT_TABLE, FAILURE_MODE_TABLE
from gaugeworks.sources.tables import Warehouse

FRAME_PRECEDING = 9


@dataclass(frozen=True)
class Star:
    fact: DataFrame
    equipment: DataFrame
    modes: DataFrame

    @cached_property
    def blocks(self) -> Blocks:
        """The fact in blocks of ids for windows, counted once."""
        return equal_blocks(self.fact, "udi")

    @classmethod
    def of(cls, warehouse: Warehouse) -> Star:
        return cls(
            warehouse.read(FACT_TABLE),
            warehouse.read(EQUIPMENT_TABLE),
            warehouse.read(FAILURE_MODE_TABLE),
        )

    def joined(self, fact: DataFrame | None = None) -> DataFrame:
        return star_join(
            self.fact if fact is None else fact, self.equipment, self.modes
        )


FEATURE_COLUMNS = [
    "udi",
    "product_id",
    "product_type",
    "quality_grade",
    "rotational_speed_rpm",
    "torque_nm",
    "temp_differential_c",
    "mechanical_power_kw",
    "tool_wear_min",
    "overstrain_metric",
    "failure_mode_name",
    "is_failure",
]


def rolling_sums(ordered, framed) -> dict[str, Column]:
    return {
        **RollingStats.over("torque_nm", framed),
        **RollingStats.over("mechanical_power_kw", framed),
        "_previous": F.lag(F.struct("torque_nm")).over(ordered),
    }


def anomaly_features(
    star: Star, rows: int | None = None, plain: bool = False
) -> DataFrame:
    """Each reading with its rolling torque statistics, step, z-score and flag.

    The frame is the reading and the nine before it of the same product type. The
    first reading of a type has step 0; a previous reading without torque gives NULL.
    A frame without variance has no score and is not an anomaly.

    The fact is cut into blocks of at most ``rows`` rows. ``plain`` asks for one window per type,
    the yardstick of the tests; the results are the same.
    """
    readings = feature_readings(star)
    if plain:
        summed = rolling_plain(
            readings, "product_type", "udi", rolling_sums, FRAME_PRECEDING
        )
    else:
        summed = rolling(
            readings,
            "product_type",
            "udi",
            rolling_sums,
            FRAME_PRECEDING,
            inputs=["torque_nm", "mechanical_power_kw"],
            blocks=equal_blocks(star.fact, "udi", rows=rows) if rows else star.blocks,
        )
    return scored(star, summed)


def feature_readings(star: Star) -> DataFrame:
    """What the windows work on. The mode's name is looked up after them: its key is what
    gets shuffled."""
    carried = [c for c in FEATURE_COLUMNS if c != "failure_mode_name"]
    return star.fact.join(star.equipment, "equipment_key").select(
        *carried, "failure_mode_key"
    )


def scored(star: Star, summed: DataFrame) -> DataFrame:
    """Features from readings with their rolling sums."""
    torque = RollingStats.of("torque_nm")
    power = RollingStats.of("mechanical_power_kw")
    first = F.col("_previous").isNull()
    before = F.when(first, F.col("torque_nm")).otherwise(F.col("_previous.torque_nm"))
    named = summed.join(F.broadcast(star.modes), "failure_mode_key")
    return named.select(
        *FEATURE_COLUMNS,
        torque.mean().alias("rolling_avg_torque"),
        torque.std().alias("rolling_std_torque"),
        (F.col("torque_nm") - before).alias("torque_step_delta"),
        power.mean().alias("rolling_avg_power_kw"),
        round_double(torque.zscore(), 2).alias("torque_z_score"),
        torque.is_anomaly().alias("is_torque_anomaly"),
    )


def top_steps(features: DataFrame, n: int = 10) -> DataFrame:
    """Anomalous readings with the largest torque steps."""
    return (
        features.filter("is_torque_anomaly")
        .orderBy(F.desc(F.abs("torque_step_delta")), "udi")
        .limit(n)
        .select(
            "udi",
            "product_id",
            "quality_grade",
            "torque_nm",
            round_double(F.col("rolling_avg_torque"), 2).alias("rolling_mean"),
            F.round("torque_step_delta", 2).alias("step_delta"),
            F.col("torque_z_score").alias("z_score"),
        )
    )


FEED_COLUMNS = [
    "udi",
    "product_id",
    "product_type",
    "quality_grade",
    "rotational_speed_rpm",
    "torque_nm",
    "temp_differential_c",
    "mechanical_power_kw",
    "tool_wear_min",
    "failure_mode_name",
    "is_failure",
    "rolling_avg_torque",
    "rolling_std_torque",
    "torque_step_delta",
    "torque_z_score",
    "is_torque_anomaly",
]


def anomaly_feed(
    features: DataFrame, limit: int = 50, anomaly_only: bool = True
) -> DataFrame:
    """Readings by the size of their z-score, largest first; no score comes first."""
    rows = features.filter("is_torque_anomaly") if anomaly_only else features
    return (
        rows.orderBy(F.abs("torque_z_score").desc_nulls_first(), "udi")
        .limit(limit)
        .select(*FEED_COLUMNS)
    )


def anomaly_preset(features: DataFrame, n: int = 20) -> DataFrame:
    """The ready-made anomaly query: eleven columns of the strongest anomalies."""
    return anomaly_feed(features, n).select(
        "udi",
        "product_id",
        "product_type",
        "rotational_speed_rpm",
        "torque_nm",
        "rolling_avg_torque",
        "rolling_std_torque",
        "torque_step_delta",
        "torque_z_score",
        "is_torque_anomaly",
        "failure_mode_name",
    )


ROOT_CAUSE_MEASURES = [
    "temp_differential_c",
    "rotational_speed_rpm",
    "torque_nm",
    "mechanical_power_kw",
]


def _failures_by_mode(
    star: Star, measures: list[str], sums: DataFrame | None = None
) -> DataFrame:
    """Failure counts and measure sums per (type, grade, mode).

    Failures are summed per pair of surrogate keys first, so what meets the
    dimensions is one row per machine and mode, not one per reading. ``sums`` has such
    sums, ``n`` and the measures, of parts of the fact that make up the whole.
    """
    rows = star.fact.filter("is_failure") if sums is None else sums
    count = F.count("*") if sums is None else F.sum("n")
    by_key = rows.groupBy("equipment_key", "failure_mode_key").agg(
        count.alias("_n"), *[F.sum(m).alias(m) for m in measures]
    )
    return (
        star.joined(by_key)
        .groupBy("product_type", "quality_grade", "failure_mode_name")
        .agg(F.sum("_n").alias("_n"), *[F.sum(m).alias(m) for m in measures])
    )


def _tier_rank() -> Column:
    tier = Window.partitionBy("product_type")
    return F.dense_rank().over(tier.orderBy(F.desc("_n")))


def _tier_share() -> Column:
    return percent(F.col("_n"), F.sum("_n").over(Window.partitionBy("product_type")))


def _mean(measure: str, places: int) -> Column:
    return mean_rounded(F.col(measure), F.col("_n"), places)


def root_cause(star: Star, sums: DataFrame | None = None) -> DataFrame:
    """Failure modes per product type: counts, mean conditions, rank and share."""
    grouped = _failures_by_mode(star, ROOT_CAUSE_MEASURES, sums)
    return grouped.select(
        "product_type",
        "quality_grade",
        "failure_mode_name",
        F.col("_n").alias("occurrence_count"),
        _mean("temp_differential_c", 2).alias("avg_temp_diff_c"),
        _mean("rotational_speed_rpm", 0).alias("avg_rpm"),
        _mean("torque_nm", 2).alias("avg_torque_nm"),
        _mean("mechanical_power_kw", 2).alias("avg_power_kw"),
        _tier_rank().alias("failure_rank_in_tier"),
        _tier_share().alias("failure_pct_share"),
    )


def failure_feed(star: Star) -> DataFrame:
    """``root_cause`` in reading order."""
    return root_cause(star).orderBy(
        "product_type", "failure_rank_in_tier", "failure_mode_name"
    )


def failure_ranking(star: Star) -> DataFrame:
    """The ready-made ranking query: ``failure_feed`` without two of its means."""
    return failure_feed(star).drop("avg_rpm", "avg_torque_nm")


def tier_failures(star: Star, sums: DataFrame | None = None) -> DataFrame:
    """The shorter root-cause report, in reading order."""
    measures = ["temp_differential_c", "mechanical_power_kw"]
    grouped = _failures_by_mode(star, measures, sums)
    return grouped.select(
        "product_type",
        "quality_grade",
        "failure_mode_name",
        F.col("_n").alias("failure_count"),
        _tier_rank().alias("rank_in_tier"),
        _tier_share().alias("pct_of_tier_failures"),
        _mean("temp_differential_c", 2).alias("avg_thermal_delta_c"),
        _mean("mechanical_power_kw", 2).alias("avg_power_kw"),
    ).orderBy("product_type", "rank_in_tier", "failure_mode_name")


def _most_strained(star: Star, n: int, rank: str) -> DataFrame:
    """The ``n`` readings with the highest overstrain and their dense rank.

    The first ``n`` rows hold every value above the last one, so ranking them alone
    gives the ranks of the whole table.
    """
    top = most_strained_readings(star, n)
    place = F.dense_rank().over(Window.orderBy(F.desc("overstrain_metric")))
    return _dimensions_of(star, top).withColumn(rank, place)


def most_strained_readings(star: Star, n: int) -> DataFrame:
    """The ``n`` readings with the highest overstrain; equal ones go by ``udi``."""
    return _complete(star).orderBy(F.desc("overstrain_metric"), "udi").limit(n)


def _complete(star: Star) -> DataFrame:
    """Readings that the join with both dimensions keeps; each stays one row."""
    equipment = star.equipment.select("equipment_key")
    modes = F.broadcast(star.modes.select("failure_mode_key"))
    return star.fact.join(equipment, "equipment_key", "left_semi").join(
        modes, "failure_mode_key", "left_semi"
    )


def _dimensions_of(star: Star, few: DataFrame) -> DataFrame:
    """Look up the dimensions of a top-k; the k rows are the broadcast side."""
    return (
        star.equipment.join(F.broadcast(few), "equipment_key")
        .join(F.broadcast(star.modes), "failure_mode_key")
    )


def leaderboard(star: Star, n: int = 25) -> DataFrame:
    """Readings at highest risk, by overstrain."""
    return (
        _most_strained(star, n, "risk_rank")
        .select(
            "udi",
            "product_id",
            "quality_grade",
            "overstrain_metric",
            "tool_wear_min",
            "torque_nm",
            "temp_differential_c",
            "mechanical_power_kw",
            "failure_mode_name",
            "is_failure",
            "risk_rank",
        )
        .orderBy("risk_rank", "udi")
    )


def stress_top(star: Star, n: int = 10) -> DataFrame:
    """The shorter stress report."""
    return (
        _most_strained(star, n, "global_stress_rank")
        .select(
            "udi",
            "product_id",
            "quality_grade",
            "tool_wear_min",
            "torque_nm",
            "overstrain_metric",
            "failure_mode_name",
            "global_stress_rank",
        )
        .orderBy("global_stress_rank", "udi")
    )


def speed_quintiles(
    star: Star, tiles: int = 5, max_cells: int | None = None
) -> DataFrame:
    """Failure rate per speed bucket of equal size; equal speeds go by ``udi``.

    Rows are counted by cells, at most ``max_cells`` at a time.
    """
    report = tile_report(
        star.fact,
        tiles,
        "rotational_speed_rpm",
        "udi",
        F.col("is_failure"),
        max_cells or MAX_CELLS,
    )
    return report.select(
        F.col("tile").alias("speed_quintile"),
        F.col("min_value").alias("min_rpm"),
        F.col("max_value").alias("max_rpm"),
        F.col("rows").alias("total_readings"),
        F.col("hits").alias("failures_count"),
        percent(F.col("hits"), F.col("rows")).alias("failure_rate_pct"),
    ).orderBy("speed_quintile")


def orphans(
    fact: DataFrame, foreign_key: str, dim: DataFrame, key: str, n: int | None = 10
) -> DataFrame:
    """Fact rows whose key has no dimension row; a NULL key has none either."""
    known = dim.select(F.col(key).alias("_key"))
    found = fact.join(known, F.col(foreign_key) == F.col("_key"), "left_anti").select(
        "udi", foreign_key
    )
    return found if n is None else found.orderBy("udi").limit(n)


def star_sample(star: Star, n: int = 25) -> DataFrame:
    """The first readings with their dimensions."""
    first = _complete(star).orderBy("udi").limit(n)
    return (
        _dimensions_of(star, first)
        .select(
            "udi",
            "product_id",
            "product_type",
            "quality_grade",
            "failure_mode_name",
            "severity_level",
            "air_temp_c",
            "rotational_speed_rpm",
            "torque_nm",
            "mechanical_power_kw",
            "is_failure",
        )
        .orderBy("udi")
    )
