"""NTILE reports that never number, sort or shuffle the rows."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeworks.operators.ordinal import tile_end, tile_of

MAX_CELLS = 1 << 20


@dataclass(frozen=True)
class _Cell:
    """A box of (value, tie-break) ranges and the number of rows that sort before it."""

    before: int = 0
    ranges: dict[str, tuple[int, int]] = field(default_factory=dict)

    def holds(self) -> Column:
        inside = F.lit(True)
        for column, (low, high) in self.ranges.items():
            inside = inside & F.col(column).between(low, high)
        return inside

    def narrowed(self, column: str, low: int, high: int, before: int) -> _Cell:
        return _Cell(before, self.ranges | {column: (low, high)})


def _steps(width: int, max_cells: int) -> list[int]:
    """Cell widths from coarse to 1, each cutting the one before into few cells."""
    steps = []
    while width > max_cells:
        width = -(-width // max_cells)
        steps.append(width)
    return [*steps, 1]


def tile_ends(
    df: DataFrame,
    tiles: int,
    value: str,
    tiebreak: str,
    max_cells: int = MAX_CELLS,
) -> list[tuple[int, int]]:
    """The last (value, tie-break) of every NTILE bucket but the last one.

    A selection by digits: rows are counted per cell, from coarse cells to single
    rows, and only the cells in which a bucket ends are opened at the next level.
    Those are at most ``tiles - 1``; they come to the driver and return as literal
    ranges that reach the scan as pushed filters. A level has at most ``max_cells``
    cells per opened cell, and a value held by a third of all rows is opened by ranges
    of the tie-break like any other. Rows are only ever counted, in partial
    aggregates.
    """
    bounds = df.agg(
        F.count("*").alias("n"),
        *[f(c).alias(f"{f.__name__}_{c}") for c in (value, tiebreak) for f in (F.min, F.max)],
    ).first()
    if bounds["n"] == 0 or tiles == 1:
        return []
    total = F.lit(bounds["n"]).cast("bigint")
    final_end = tile_end(F.lit(tiles - 1).cast("bigint"), total, tiles)

    opened = [_Cell()]
    for column in (value, tiebreak):
        low = bounds[f"min_{column}"]
        for step in _steps(bounds[f"max_{column}"] - low + 1, max_cells):
            opened = _open(df, opened, column, low, step, total, tiles, final_end)
    return sorted((c.ranges[value][0], c.ranges[tiebreak][0]) for c in opened)


def _open(df, parents, column, low, step, total, tiles, final_end) -> list[_Cell]:
    """Cut the parents into cells of ``step`` and keep those where a bucket ends."""
    offset = F.col(column).cast("bigint") - F.lit(low)
    parent = F.coalesce(*[F.when(p.holds(), F.lit(i)) for i, p in enumerate(parents)])
    base = F.coalesce(
        *[F.when(F.col("_parent") == i, F.lit(p.before)) for i, p in enumerate(parents)]
    )
    earlier = (
        Window.partitionBy("_parent")
        .orderBy("_cell")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    before = base.cast("bigint") + F.coalesce(F.sum("_n").over(earlier), F.lit(0))
    after = F.col("_before") + F.col("_n")
    last = tile_of(after, total, tiles)
    found = (
        df.filter(reduce(lambda a, b: a | b, [p.holds() for p in parents]))
        .groupBy(parent.alias("_parent"), (offset - F.pmod(offset, F.lit(step))).alias("_cell"))
        .agg(F.count("*").alias("_n"))
        .withColumn("_before", before)
        .filter(F.col("_before") < final_end)
        .filter(
            (last > tile_of(F.col("_before") + 1, total, tiles))
            | (after == tile_end(last, total, tiles))
        )
        .select("_parent", (F.col("_cell") + F.lit(low)).alias("low"), "_before")
        .collect()
    )
    return [
        parents[row["_parent"]].narrowed(
            column, row["low"], row["low"] + step - 1, row["_before"]
        )
        for row in found
    ]


def tile_report(
    df: DataFrame,
    tiles: int,
    value: str,
    tiebreak: str,
    counted: Column,
    max_cells: int = MAX_CELLS,
) -> DataFrame:
    """Per NTILE bucket of (value, tie-break): min, max, rows and ``counted`` rows.

    Both are integers without NULLs and the tie-break is unique. Once the bucket ends
    are known, a row's bucket follows from comparing it with them, so one scan with
    partial aggregation makes the report.
    """
    tile = F.lit(1)
    for end_value, end_tie in tile_ends(df, tiles, value, tiebreak, max_cells):
        past = (F.col(value) > end_value) | (
            (F.col(value) == end_value) & (F.col(tiebreak) > end_tie)
        )
        tile = tile + F.when(past, 1).otherwise(0)
    return df.groupBy(tile.alias("tile")).agg(
        F.min(value).alias("min_value"),
        F.max(value).alias("max_value"),
        F.count("*").alias("rows"),
        F.count_if(counted).alias("hits"),
    )
