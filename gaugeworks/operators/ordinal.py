"""Exact global numbering without sorting the data in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeworks.operators.blocks import LAST_KEY, Blocks, equal_blocks
from gaugeworks.session import written

# monotonically_increasing_id keeps the row's place in the low 33 bits.
_PLACE_BITS = 33


def global_ordinal(
    df: DataFrame,
    *order: Column,
    name: str = "ordinal",
    partitions: int | None = None,
) -> DataFrame:
    """Number rows 1..n by ``order``, which must end in a unique tie-break.

    A range shuffle puts every partition after the one before it and splits ties by
    the tie-break, so a value held by a third of the rows still spreads out. Each
    task sorts its own range; the only global step is a running sum over one row
    per range, and that table is what gets broadcast. The ranges are drawn from a
    sample, so they are written once and both readers see the same ones.
    """
    if partitions:
        ranged = df.repartitionByRange(partitions, *order)
    else:
        ranged = df.repartitionByRange(*order)
    placed = written(
        ranged.sortWithinPartitions(*order).withColumn(
            "_place", F.monotonically_increasing_id()
        ),
        "ordinal",
    ).withColumns(
        {
            "_range": F.shiftright("_place", _PLACE_BITS),
            "_row": F.col("_place").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1)),
        }
    )
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_range")
        .agg(F.count("*").alias("_rows"))
        .select(
            "_range",
            F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"),
        )
    )
    return placed.join(F.broadcast(offsets), "_range").select(
        *df.columns, (F.col("_before") + F.col("_row") + 1).alias(name)
    )


def counted_ordinal(
    df: DataFrame,
    value: str,
    tiebreak: str | None = None,
    name: str = "ordinal",
    rows: int | None = None,
    blocks: Blocks | None = None,
) -> DataFrame:
    """Number rows 1..n by an integer ``value`` without NULLs, lazily and without sampling.

    Rows are counted level by level until blocks of at most ``rows`` rows are known, and
    with them the rows ahead of each. A row's block follows from its key, its number in
    the block from a window over the block. A value held by a third of the rows is cut by
    the integer ``tiebreak``; without one, values must be unique.
    """
    order = [value] if tiebreak is None else [value, tiebreak]
    if blocks is None:
        blocks = equal_blocks(df, *order, rows=rows)
    cut = df.withColumn("_block", blocks.number())
    place = F.row_number().over(Window.partitionBy("_block").orderBy(*order))
    ordinal = blocks.ahead(F.col("_block")) + place
    return cut.withColumn(name, ordinal).drop("_block")


# Bytes of a text that make one integer column.
_BYTES = 7


def text_ordinal(df: DataFrame, text: str, name: str = "ordinal", rows: int | None = None) -> DataFrame:
    """Number rows 1..n by the bytes of a text column without NULLs, as ``counted_ordinal``.

    Blocks are cut by the first fourteen bytes, which say the order of two texts that differ
    there; texts that agree in them share a block, where the whole text orders them.
    """
    keyed = df.withColumns({"_head": _digits(text, 1), "_tail": _digits(text, _BYTES + 1)})
    blocks = equal_blocks(keyed, "_head", "_tail", rows=rows)
    cut = keyed.withColumn("_block", blocks.number())
    place = F.row_number().over(Window.partitionBy("_block").orderBy(text))
    ordinal = blocks.ahead(F.col("_block")) + place
    return cut.withColumn(name, ordinal).select(*df.columns, name)


def _digits(text: str, start: int) -> Column:
    part = F.hex(F.substring(F.encode(text, "UTF-8"), start, _BYTES))
    return F.conv(F.rpad(part, 2 * _BYTES, "0"), 16, 10).cast("bigint")


def tile_of(ordinal: Column, rows: Column, tiles: int) -> Column:
    """The NTILE bucket of an ordinal: the first ``rows % tiles`` get one row more."""
    size = _div(rows, tiles)
    extra = rows % tiles
    long_rows = extra * (size + 1)
    in_long = _div(ordinal - 1, size + 1) + 1
    in_short = _div(ordinal - long_rows - 1, F.greatest(size, F.lit(1))) + extra + 1
    return F.when(ordinal <= long_rows, in_long).otherwise(in_short).cast("int")


def tile_end(tile: Column, rows: Column, tiles: int) -> Column:
    """The ordinal of a bucket's last row."""
    return tile * _div(rows, tiles) + F.least(tile, rows % tiles)


def _div(numerator: Column, denominator: Column | int) -> Column:
    """Integer division of non-negative bigints, without going through doubles."""
    bottom = F.lit(denominator) if isinstance(denominator, int) else denominator
    return F.call_function("div", numerator.cast("bigint"), bottom.cast("bigint"))


def ntile_exact(
    df: DataFrame, tiles: int, value: str, tiebreak: str, name: str = "tile", rows: int | None = None
) -> DataFrame:
    """NTILE over the whole table, row by row, in ascending order of ``value``, NULLs last."""
    keyed = df.withColumn("_value", _nulls_last(value))
    blocks = equal_blocks(keyed, "_value", tiebreak, rows=rows)
    numbered = counted_ordinal(keyed, "_value", tiebreak, "_ordinal", blocks=blocks)
    total = F.lit(blocks.total).cast("bigint")
    return numbered.select(*df.columns, tile_of(F.col("_ordinal"), total, tiles).alias(name))


def dense_rank_exact(
    df: DataFrame,
    value: str,
    tiebreak: str,
    descending: bool = True,
    name: str = "dense_rank",
    scale: int = 0,
    rows: int | None = None,
) -> DataFrame:
    """DENSE_RANK over the whole table of a value with ``scale`` decimal places; NULLs rank
    first where the order descends, else last.

    The rank is the number of distinct values ahead of the row's block plus the rank in the
    block. A value may go on in later blocks: it counts where it starts. So neither the
    distinct values nor a hot value are gathered, and no row meets another table.
    """
    key = (F.col(value) * 10**scale).cast("bigint") if scale else F.col(value)
    key = _nulls_last(key)
    keyed = df.withColumn("_value", -key if descending else key)
    blocks = equal_blocks(keyed, "_value", tiebreak, rows=rows)
    cut = keyed.withColumn("_block", blocks.number())
    per_value = cut.groupBy("_block", "_value").agg(F.lit(1).alias("_one"))
    per_block = per_value.groupBy("_block").agg(
        F.count("*").alias("n"), F.min("_value").alias("low"), F.max("_value").alias("high")
    )
    # one row per block
    ahead, last, seen = {}, None, 0
    for row in sorted(per_block.collect(), key=lambda r: r["_block"]):
        shared = row.low == last
        ahead[row["_block"]] = seen - shared
        seen += row.n - shared
        last = row.high
    firsts = Blocks(("_value",), (), tuple(ahead.get(k, 0) for k in range(len(blocks.starts))), 0)
    place = F.dense_rank().over(Window.partitionBy("_block").orderBy("_value"))
    rank = firsts.ahead(F.col("_block")) + place
    return cut.withColumn(name, rank).select(*df.columns, name)


def _nulls_last(value: Column | str) -> Column:
    column = F.col(value) if isinstance(value, str) else value
    return F.coalesce(column.cast("bigint"), F.lit(LAST_KEY))
