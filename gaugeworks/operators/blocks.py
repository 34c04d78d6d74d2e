"""Cutting ordered integer keys into blocks of bounded size.

Blocks are cut by counts, not by width: however the keys are spread, and however far one of
them lies off, a block has at most the rows asked for.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MIN_ROWS = 1 << 14
MAX_BLOCKS = 100_000
MAX_CELLS = 1 << 16
# the least stands for any second part of a first key
LEAST_KEY, LAST_KEY = -(1 << 63), (1 << 63) - 1


@dataclass(frozen=True)
class Blocks:
    """Consecutive blocks of rows in the order of one or two integer columns.

    ``starts`` has each block's first key, ``before`` the rows ahead of it. The order is
    that of ``columns``; of two, the second breaks ties of the first. ``total`` counts all
    rows.
    """

    columns: tuple[str, ...]
    starts: tuple[tuple[int, ...], ...]
    before: tuple[int, ...]
    total: int

    def number(self) -> Column:
        """The number of a row's block, from 0, by binary search."""
        firsts = [_longs(start[i] for start in self.starts) for i in range(len(self.columns))]
        steps = [1 << k for k in reversed(range(max(len(self.starts) - 1, 1).bit_length()))]
        own = [F.col(c).cast("bigint") for c in self.columns]

        def step(at: Column, width: Column) -> Column:
            reached = _at_most([F.get(f, at + width) for f in firsts], own)
            return F.when(reached, at + width).otherwise(at)

        # beyond the last block there is no first key, and NULL is not reached
        return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), step)

    def ahead(self, number: Column) -> Column:
        """The rows ahead of a block."""
        return F.get(_longs(self.before), number)


def _longs(values) -> Column:
    """A constant array, folded once, however long it is."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def _at_most(first: list[Column], own: list[Column]) -> Column:
    if len(own) == 1:
        return first[0] <= own[0]
    return (first[0] < own[0]) | ((first[0] == own[0]) & (first[1] <= own[1]))


@dataclass(frozen=True)
class _Cell:
    """Rows between two keys: how many, and the extremes of each column among them."""

    n: int
    low: tuple[int, ...]
    high: tuple[int, ...]

    def cut(self, half: int) -> list[tuple[int, ...]]:
        """First keys of parts of equal width: of the first column, or of the second where
        all rows agree in the first."""
        place = 0 if self.low[0] < self.high[0] else len(self.low) - 1
        low, width = self.low[place], self.high[place] - self.low[place] + 1
        parts = min(-(-2 * self.n // half), MAX_CELLS, width)
        step = -(-width // parts)
        firsts = range(low, low + width, step)
        if place < len(self.low) - 1:
            return [(first, LEAST_KEY) for first in firsts]
        return [(*self.low[:place], first) for first in firsts]

    @property
    def single(self) -> bool:
        return self.low == self.high


def equal_blocks(df: DataFrame, *columns: str, rows: int | None = None) -> Blocks:
    """Blocks of at most ``rows`` rows of ``df``, without NULLs in ``columns``.

    A histogram that is refined where rows are dense: rows are counted per cell, in partial
    aggregates, and a cell with more than half a block is cut by the extremes of its own
    keys at the next level. So one key far off the others costs one cell and one level, not
    the resolution of all. Cells of at most half a block are then joined, by the number of
    rows ahead, to blocks of at most ``rows``. A cell of one key is not cut; keys that are
    unique, or made so by the second column, have none of two rows.

    There are at most ``MAX_BLOCKS`` blocks or so by default, and a level counts at most two
    cells per half block; those counts are what the driver sees.
    """
    total = _counted(df, columns, [])
    if not total:
        return Blocks(columns, ((0,) * len(columns),), (0,), 0)
    n = total[0].n
    rows = rows or max(MIN_ROWS, -(-2 * n // MAX_BLOCKS))
    half = max(rows // 2, 1)
    settled: list[_Cell] = []
    dense = total
    while dense:
        large = [cell for cell in dense if cell.n > half and not cell.single]
        settled += [cell for cell in dense if cell.n <= half or cell.single]
        dense = _counted(df, columns, large, half) if large else []
    settled.sort(key=lambda cell: cell.low)
    starts, before, number = [], [], -1
    ahead = accumulate((cell.n for cell in settled), initial=0)
    for cell, count in zip(settled, ahead, strict=False):
        if count // half > number:
            number = count // half
            starts.append(cell.low)
            before.append(count)
    return Blocks(columns, tuple(starts), tuple(before), n)


def _counted(df: DataFrame, columns, large: list[_Cell], half: int = 1) -> list[_Cell]:
    """Counts and extremes of the parts of ``large`` cells, or of all rows."""
    keys = df.select(*[F.col(c).cast("bigint").alias(c) for c in columns])
    if large:
        # each large cell's parts, and behind them the gap up to the next large cell
        starts: dict[tuple[int, ...], bool] = {}
        for cell in large:
            starts.update(dict.fromkeys(cell.cut(half), True))
            if cell.high[-1] < LAST_KEY:
                starts.setdefault((*cell.high[:-1], cell.high[-1] + 1), False)
        # and the gap ahead of all
        starts.setdefault((LEAST_KEY,) * len(columns), False)
        firsts = sorted(starts)
        parts = Blocks(tuple(columns), tuple(firsts), (), 0)
        lowest, highest = min(c.low[0] for c in large), max(c.high[0] for c in large)
        keys = keys.filter(F.col(columns[0]).between(lowest, highest)).withColumn("_part", parts.number())
    else:
        firsts = [()]
        starts = {(): True}
        keys = keys.withColumn("_part", F.lit(0))
    found = keys.groupBy("_part").agg(
        F.count("*").alias("n"),
        *[f(c).alias(f"{f.__name__}_{c}") for c in columns for f in (F.min, F.max)],
    )
    return [
        _Cell(
            row.n,
            tuple(row[f"min_{c}"] for c in columns),
            tuple(row[f"max_{c}"] for c in columns),
        )
        for row in found.collect()
        if starts[firsts[row["_part"]]]
    ]
