"""Aggregates of the fact by block, kept beside it and merged by reports.

A load rewrites some blocks of the fact. ``refresh_partials`` reads those blocks alone and
replaces their partial sums; reports add up the sums of all blocks. So after a small batch
a report costs its blocks, not the table. The sums are integers and decimals: adding them in
another order changes nothing.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeworks.functions.numeric import percent
from gaugeworks.operators.ordinal import tile_of
from gaugeworks.plans import analytics
from gaugeworks.plans.analytics import Star
from gaugeworks.schemas import (
    BLOCK_COUNTS_TABLE,
    EQUIPMENT_TABLE,
    FACT_TABLE,
    FAILURE_SUMS_TABLE,
    RAW_TABLE,
    SPEED_COUNTS_TABLE,
    STAGING_TABLE,
)
from gaugeworks.session import literal_rows
from gaugeworks.sources.tables import Warehouse

START = "block_start"


def failure_sums(fact: DataFrame) -> DataFrame:
    """Failures and the sums of their conditions per block, machine and mode."""
    sums = [F.sum(m).alias(m) for m in analytics.ROOT_CAUSE_MEASURES]
    grouped = fact.filter("is_failure").groupBy(START, "equipment_key", "failure_mode_key")
    return grouped.agg(F.count("*").alias("n"), *sums)


def speed_counts(fact: DataFrame) -> DataFrame:
    """Readings and failures per block and speed."""
    return fact.groupBy(START, "rotational_speed_rpm").agg(
        F.count("*").alias("n"), F.count_if("is_failure").alias("failures")
    )


def block_counts(fact: DataFrame, equipment: DataFrame) -> DataFrame:
    """Readings, failures and the highest overstrain per block and product type.

    Readings are counted per machine before they meet the dimension, which has the type.
    """
    per_machine = fact.groupBy(START, "equipment_key").agg(
        F.count("*").alias("n"),
        F.count_if("is_failure").alias("failures"),
        F.max("overstrain_metric").alias("overstrain"),
    )
    types = equipment.select("equipment_key", "product_type")
    typed = per_machine.join(types, "equipment_key", "left")
    return typed.groupBy(START, "product_type").agg(
        F.sum("n").alias("n"),
        F.sum("failures").alias("failures"),
        F.max("overstrain").alias("max_overstrain"),
    )


def refresh_partials(warehouse: Warehouse) -> list[int]:
    """Bring the partial aggregates up to the fact; returns the blocks that were read.

    All three tables become current together, with the version of the fact they hold.
    """
    taken = warehouse.version(FACT_TABLE)
    since = warehouse.mark(BLOCK_COUNTS_TABLE, "consumed")
    blocks = warehouse.pending_blocks(FACT_TABLE, since)
    if not blocks:
        return []
    fact = warehouse.read(FACT_TABLE, blocks, block_column=START)
    equipment = warehouse.read(EQUIPMENT_TABLE)
    starts = warehouse.blocks(FACT_TABLE)
    staged = []
    for table, rows in (
        (FAILURE_SUMS_TABLE, failure_sums(fact)),
        (SPEED_COUNTS_TABLE, speed_counts(fact)),
        (BLOCK_COUNTS_TABLE, block_counts(fact, equipment)),
    ):
        replaced = None
        if warehouse.version(table):
            replaced = warehouse.overlapping(table, FACT_TABLE, blocks)
        staged.append(warehouse.stage(table, rows, starts, replaced))
    warehouse.publish(*staged, marks={BLOCK_COUNTS_TABLE: {"consumed": taken}})
    return blocks


@dataclass(frozen=True)
class Partials:
    """The partial aggregates of a warehouse, which must be up to its fact."""

    warehouse: Warehouse
    star: Star
    failures: DataFrame
    speeds: DataFrame
    counts: DataFrame

    @classmethod
    def of(cls, warehouse: Warehouse) -> Partials:
        held = warehouse.mark(BLOCK_COUNTS_TABLE, "consumed")
        if held != warehouse.version(FACT_TABLE):
            raise ValueError("the partial aggregates are behind the fact: refresh them")
        return cls(
            warehouse,
            Star.of(warehouse),
            warehouse.read(FAILURE_SUMS_TABLE),
            warehouse.read(SPEED_COUNTS_TABLE),
            warehouse.read(BLOCK_COUNTS_TABLE),
        )

    def root_cause(self) -> DataFrame:
        return analytics.root_cause(self.star, self.failures)

    def tier_failures(self) -> DataFrame:
        return analytics.tier_failures(self.star, self.failures)

    def counts_row(self) -> DataFrame:
        """Rows of raw, staging and fact, and failures. The first two stand in the commit,
        so no table of readings is opened."""
        sizes = {t: sum(self.warehouse.sizes(t).values()) for t in (RAW_TABLE, STAGING_TABLE)}
        return self.counts.agg(
            F.lit(sizes[RAW_TABLE]).cast("bigint").alias("raw_rows"),
            F.lit(sizes[STAGING_TABLE]).cast("bigint").alias("staging_rows"),
            F.coalesce(F.sum("n"), F.lit(0)).alias("fact_rows"),
            F.coalesce(F.sum("failures"), F.lit(0)).alias("failure_rows"),
        )

    def speed_quintiles(self, tiles: int = 5) -> DataFrame:
        """The quintile report. Speeds are counted from the partials; only a speed in which
        a bucket ends is split by id, and for that one block is opened per bucket end."""
        total = self.speeds.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        counted = self.speeds.groupBy(F.col("rotational_speed_rpm").alias("rpm")).agg(
            F.sum("n").alias("n"), F.sum("failures").alias("failures")
        )
        # a row per distinct speed: a few thousand, whatever the table
        earlier = Window.orderBy("rpm").rowsBetween(Window.unboundedPreceding, -1)
        before = F.coalesce(F.sum("n").over(earlier), F.lit(0))
        placed = counted.withColumn("before", before)
        rows = F.lit(total).cast("bigint")
        placed = placed.withColumns(
            {
                "tile": tile_of(F.col("before") + 1, rows, tiles),
                "last": tile_of(F.col("before") + F.col("n"), rows, tiles),
            }
        )
        whole = placed.filter("tile = last").select("tile", "rpm", "n", "failures")
        split = placed.filter("tile < last").collect()
        pieces = [piece for row in split for piece in self._split(row, total, tiles)]
        both = whole.unionByName(literal_rows(whole.sparkSession, pieces, whole.schema))
        report = both.groupBy(F.col("tile").alias("speed_quintile")).agg(
            F.min("rpm").alias("min_rpm"),
            F.max("rpm").alias("max_rpm"),
            F.sum("n").alias("total_readings"),
            F.sum("failures").alias("failures_count"),
        )
        rate = percent(F.col("failures_count"), F.col("total_readings"))
        return report.withColumn("failure_rate_pct", rate).orderBy("speed_quintile")

    def _split(self, row, total: int, tiles: int) -> list[tuple]:
        """(tile, rpm, readings, failures) of a speed that lies in several buckets."""
        size, extra = divmod(total, tiles)
        ends = [t * size + min(t, extra) - row.before for t in range(row.tile, row.last)]
        of_speed = F.col("rotational_speed_rpm") == row.rpm
        blocks = self.speeds.filter(of_speed).orderBy(START).collect()
        done, hits, pieces = 0, 0, []
        for tile, end in zip(range(row.tile, row.last), ends, strict=True):
            upto = self._failures_upto(blocks, of_speed, end)
            pieces.append((tile, row.rpm, end - done, upto - hits))
            done, hits = end, upto
        return [*pieces, (row.last, row.rpm, row.n - done, row.failures - hits)]

    def _failures_upto(self, blocks: list, of_speed: Column, end: int) -> int:
        """Failures among the first ``end`` readings of a speed, by id."""
        rows = failures = 0
        for block in blocks:
            if rows + block.n > end:
                inside = self.warehouse.read(FACT_TABLE, [block[START]]).filter(of_speed)
                first = inside.orderBy("udi").limit(end - rows)
                return failures + first.agg(F.count_if("is_failure")).first()[0]
            rows, failures = rows + block.n, failures + block.failures
        return failures

    def leaderboard(self, n: int = 25) -> DataFrame:
        """The leaderboard from the few blocks that can hold it."""
        star = replace(self.star, fact=self.warehouse.read(FACT_TABLE, self.top_blocks(n)))
        return analytics.leaderboard(star, n)

    def top_blocks(self, n: int) -> list[int]:
        """Blocks that can hold one of the ``n`` most strained readings.

        A threshold scan: blocks are opened by falling maximum until ``n`` readings with
        dimension rows lie above the next block's maximum. On a tie the block is opened
        too, as ids decide then. Each turn opens twice as many blocks as the one before.
        """
        bounds = self.counts.groupBy(START).agg(F.max("max_overstrain").alias("bound"))
        ranked = bounds.orderBy(F.desc("bound"), START).collect()
        opened = 1
        while opened < len(ranked):
            blocks = [row[START] for row in ranked[:opened]]
            star = replace(self.star, fact=self.warehouse.read(FACT_TABLE, blocks))
            top = analytics.most_strained_readings(star, n).select("overstrain_metric").collect()
            if len(top) == n and min(r[0] for r in top) > ranked[opened]["bound"]:
                break
            opened *= 2
        return [row[START] for row in ranked[:opened]]
