"""Keyed merge of a batch into a table, with a policy per column."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


class DuplicateKeyError(ValueError):
    """A batch holds one key more than once."""


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their counts."""
    return (
        df.groupBy(*keys).agg(F.count("*").alias("occurrences")).filter("occurrences > 1")
    )


def resolve_duplicates(
    updates: DataFrame,
    keys: Sequence[str],
    duplicates: str,
    order_by: str | Column | None = None,
) -> DataFrame:
    """One row per key: refuse duplicates, or keep the last row by ``order_by``."""
    if duplicates == "error":
        found = duplicate_keys(updates, keys).take(5)
        if found:
            shown = ", ".join(str(tuple(row[k] for k in keys)) for row in found)
            raise DuplicateKeyError(f"keys occur more than once in one batch: {shown}")
        return updates
    if duplicates == "last":
        if order_by is None:
            raise ValueError("duplicates='last' needs order_by")
        column = F.col(order_by) if isinstance(order_by, str) else order_by
        latest = Window.partitionBy(*keys).orderBy(column.desc_nulls_last())
        return (
            updates.withColumn("_rank", F.row_number().over(latest))
            .filter("_rank = 1")
            .drop("_rank")
        )
    if duplicates == "unique":
        return updates
    raise ValueError(f"duplicates must be error, last or unique, not {duplicates!r}")


def upsert(
    target: DataFrame,
    updates: DataFrame,
    keys: Sequence[str],
    update_cols: Iterable[str] | str = "all",
    on_conflict: str = "update",
    duplicates: str = "error",
    order_by: str | Column | None = None,
    touch_cols: dict[str, Column] | None = None,
    large: bool = False,
) -> DataFrame:
    """``target`` after inserting ``updates``.

    A new key brings all its columns. A key already there takes ``update_cols`` from
    the batch and ``touch_cols`` from the given expressions, and keeps the target's
    value elsewhere; ``on_conflict="nothing"`` leaves it alone.

    The target is the probe side of a left join and only its keys take part in
    finding the new rows, so a batch small enough to broadcast merges without
    shuffling the target. A full outer join would always shuffle it. With ``large``, for a
    batch that is not small beside the target, one full outer join does it all: either side
    is shuffled once, where three joins shuffle the batch three times.
    """
    keys = list(keys)
    columns = target.columns
    chosen = _chosen_columns(columns, keys, update_cols, touch_cols or {})
    batch = resolve_duplicates(updates, keys, duplicates, order_by).select(*columns)
    touched = touch_cols or {}
    if large and on_conflict == "update":
        return _outer_merge(target, batch, keys, chosen, touched)

    known = target.select(*keys)
    fresh = batch.join(_matched(known, batch, keys), keys, "left_anti").select(*columns)
    if on_conflict == "nothing":
        return target.unionByName(fresh)
    if on_conflict != "update":
        raise ValueError(f"on_conflict must be update or nothing, not {on_conflict!r}")

    incoming = batch.select(
        *keys,
        F.lit(True).alias("_hit"),
        *[F.col(c).alias(f"_new_{c}") for c in chosen],
    )
    hit = F.col("_hit").isNotNull()
    merged = target.join(incoming, keys, "left").select(
        *[
            F.when(hit, touched[c]).otherwise(F.col(c)).alias(c)
            if c in touched
            else F.when(hit, F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c)
            if c in chosen
            else F.col(c)
            for c in columns
        ]
    )
    return merged.unionByName(fresh)


def _outer_merge(
    target: DataFrame,
    batch: DataFrame,
    keys: list[str],
    chosen: list[str],
    touched: dict[str, Column],
) -> DataFrame:
    """The merge as one full outer join."""
    others = [c for c in target.columns if c not in keys]
    incoming = batch.select(
        *keys, F.lit(True).alias("_hit"), *[F.col(c).alias(f"_new_{c}") for c in others]
    )
    joined = target.withColumn("_old", F.lit(True)).join(incoming, keys, "full")
    fresh, hit = F.col("_old").isNull(), F.col("_hit").isNotNull()

    def merged(c: str) -> Column:
        if c in keys:
            return F.col(c)
        new = F.col(f"_new_{c}")
        if c in touched:
            return F.when(fresh, new).when(hit, touched[c]).otherwise(F.col(c)).alias(c)
        return F.when(hit if c in chosen else fresh, new).otherwise(F.col(c)).alias(c)

    return joined.select(*[merged(c) for c in target.columns])


def _matched(known: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """Keys of the batch that the target already has; no larger than the batch."""
    return known.join(batch.select(*keys), keys, "left_semi")


def _chosen_columns(columns, keys, update_cols, touch_cols) -> list[str]:
    others = [c for c in columns if c not in keys and c not in touch_cols]
    if update_cols == "all":
        return others
    update_cols = list(update_cols)
    unknown = set(update_cols) | set(touch_cols)
    unknown -= set(columns)
    if unknown:
        raise ValueError(f"not columns of the target: {sorted(unknown)}")
    return [c for c in others if c in update_cols]
