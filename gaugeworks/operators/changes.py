"""Telling new, changed and unchanged rows of a batch apart, with one join."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHANGE = "change"
KINDS = ("new", "changed", "unchanged")


def row_digest(columns: Sequence[Column]) -> Column:
    """128 bits of the columns' values. NULLs take part: hashing alone skips them."""
    parts = [part for column in columns for part in (column, column.isNull())]
    return F.struct(
        F.xxhash64(*parts).alias("high"), F.xxhash64(F.lit("low"), *parts).alias("low")
    )


def with_change(
    batch: DataFrame, target: DataFrame, keys: Sequence[str], compared: Sequence[str]
) -> DataFrame:
    """``batch`` with a column that says what each row would do to ``target``.

    Of the target only its keys and a digest of the compared columns take part, so what is
    shuffled does not grow with the width of its rows. Both tables have unique keys.
    Columns are compared in the target's types.
    """
    kinds = {f.name: f.dataType for f in target.schema}
    mine = row_digest([F.col(c).cast(kinds[c]) for c in compared])
    known = target.select(*keys, row_digest([F.col(c) for c in compared]).alias("_known"))
    change = (
        F.when(F.col("_known").isNull(), "new")
        .when(F.col("_known") == F.col("_mine"), "unchanged")
        .otherwise("changed")
    )
    joined = batch.withColumn("_mine", mine).join(known, list(keys), "left")
    return joined.withColumn(CHANGE, change).select(*batch.columns, CHANGE)


def effective(
    batch: DataFrame, target: DataFrame, keys: Sequence[str], compared: Sequence[str]
) -> DataFrame:
    """The rows of ``batch`` that are not in ``target`` as they are."""
    told = with_change(batch, target, keys, compared)
    return told.filter(F.col(CHANGE) != "unchanged").drop(CHANGE)


def change_counts(told: DataFrame) -> DataFrame:
    """Rows per kind of change, all kinds shown."""
    return told.agg(*[F.count_if(F.col(CHANGE) == kind).alias(f"{kind}_rows") for kind in KINDS])
