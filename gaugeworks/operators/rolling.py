"""Row-frame windows over few, long series."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from gaugeworks.operators.blocks import Blocks, equal_blocks

BuildColumns = Callable[[WindowSpec, WindowSpec], dict[str, Column]]


def rolling(
    df: DataFrame,
    series: str,
    order: str,
    build: BuildColumns,
    preceding: int,
    inputs: Sequence[str],
    blocks: Blocks | None = None,
    rows: int | None = None,
) -> DataFrame:
    """Add ``build(ordered, framed)`` computed per ``series`` in ``order``.

    ``ordered`` is the series' plain ordered window (for lag), ``framed`` the frame
    of the current row and the ``preceding`` rows before it. ``inputs`` are the
    columns the expressions read and ``order`` is a unique integer.

    A window partitioned by the series alone runs in one task per series. Here the order
    is cut into blocks of at most ``rows`` rows (``equal_blocks``, unless given), and every
    block of a series receives copies of the last ``preceding`` rows before it. The copies
    are few, and the results equal the plain window's, row by row.
    """
    if blocks is None:
        blocks = equal_blocks(df, order, rows=rows)
    rows = df.withColumn("_block", blocks.number())
    halo = _halo(rows.select(series, order, *inputs, "_block"), series, order, preceding)
    stacked = rows.withColumn("_own", F.lit(True)).unionByName(
        halo.withColumn("_own", F.lit(False)), allowMissingColumns=True
    )
    ordered = Window.partitionBy(series, "_block").orderBy(order)
    framed = ordered.rowsBetween(-preceding, Window.currentRow)
    columns = build(ordered, framed)
    return (
        stacked.withColumns(columns).filter("_own").select(*df.columns, *columns.keys())
    )


def rolling_plain(
    df: DataFrame, series: str, order: str, build: BuildColumns, preceding: int
) -> DataFrame:
    """The same columns from one window per series; the yardstick for ``rolling``."""
    ordered = Window.partitionBy(series).orderBy(order)
    columns = build(ordered, ordered.rowsBetween(-preceding, Window.currentRow))
    return df.withColumns(columns)


def _halo(rows: DataFrame, series: str, order: str, preceding: int) -> DataFrame:
    """Each block's last rows, addressed to the later blocks whose frames reach them.

    Only a block's last ``preceding`` rows can be in reach of another block. Among
    these tails, laid end to end, a row is in reach of a block exactly when the
    block's first row is among the next ``preceding`` rows - also when the blocks in
    between hold fewer rows than the frame. There are at most ``preceding`` tail rows
    per block and series, however long the series is.
    """
    last = Window.partitionBy(series, "_block").orderBy(F.desc(order))
    tails = (
        rows.withColumn("_back", F.row_number().over(last))
        .filter(F.col("_back") <= preceding)
        .drop("_back")
    )
    ahead = (
        Window.partitionBy(series).orderBy(order).rowsBetween(1, preceding)
    )
    reached = F.array_remove(F.collect_set("_block").over(ahead), F.col("_block"))
    return tails.withColumn("_reached", reached).select(
        *[c for c in rows.columns if c != "_block"],
        F.explode("_reached").alias("_block"),
    )
