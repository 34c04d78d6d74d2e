"""Exact single-link classes from candidate regions, without all pairs of a region."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import nullcontext

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.common import attach
from gaugeworks.session import landed, written


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("node", "other"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node that is not the smallest of its component of the pairs
    (a, b). Stars are formed in turn around larger and smaller neighbours until nothing
    changes; each round is written, so a lost executor costs one round."""
    now = written(
        edges.filter("a <> b")
        .select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("other"))
        .distinct(),
        "links",
    )
    mark = _mark(now)
    while mark[0]:
        both = now.unionByName(now.select(F.col("other").alias("node"), F.col("node").alias("other")))
        least = both.groupBy("node").agg(
            F.least(F.min("other"), F.col("node")).alias("root"), F.count("*").alias("n_rows")
        )
        large = attach(both, written(least, "large"), "node").filter("other > node")
        large = written(
            large.select(F.col("other").alias("node"), F.col("root").alias("other")).distinct(), "stars"
        )
        least = written(
            large.groupBy("node").agg(F.min("other").alias("root"), F.count("*").alias("n_rows")), "small"
        )
        small = attach(large, least, "node").filter("other <> root")
        small = small.select(F.col("other").alias("node"), F.col("root").alias("other"))
        now = written(
            small.unionByName(least.select("node", F.col("root").alias("other"))).distinct(), "links"
        )
        if (after := _mark(now)) == mark:
            break
        mark = after
    return now.select("node", F.col("other").alias("root"))


def link_classes(
    regions: DataFrame,
    verifier: Callable[[DataFrame], Callable[[DataFrame], DataFrame]],
    size_ratio: float = 0.0,
    size_gap: int | None = None,
    pivots: int = 3,
    shares: int = 1,
    costly: bool = False,
) -> DataFrame:
    """(id, root) of items linked to a smaller one, from ``regions`` (region, id, size):
    two items that link share ``shares`` regions, or ``size_ratio`` times the larger size if
    that is less. ``verifier`` gets the ids that share a region with others and returns a
    function that keeps the true pairs of (a, b).

    Per region a pivot is compared with all members first; members that thereby fall in one
    class need no further comparison. After ``pivots`` such rounds, which cost a pair per
    member, the rest is joined exactly: pairs of a region still in different classes and
    within the size window. So no link between classes is lost, and a region of many close
    members makes no square of pairs."""
    spark = regions.sparkSession
    # read twice, so costly ones are written until those that are shared are known
    with landed(regions, "own-regions") if costly else nullcontext(regions) as regions:
        shared = regions.groupBy("region").agg(F.min("id").alias("x"), F.max("id").alias("y"))
        # written by itself, so that the shuffles of both steps are never on disk together
        with landed(shared.filter("x <> y").select("region"), "shared-regions") as shared:
            rows = written(regions.join(shared, "region", "left_semi").distinct(), "regions")
    verified = verifier(rows.select("id").distinct())
    edges = None
    labels = None

    def labelled() -> DataFrame:
        if labels is None:
            return rows.withColumn("label", F.col("id"))
        named = labels.select(F.col("node").alias("id"), "root")
        return rows.join(named, "id", "left").select(
            "region", "id", "size", F.coalesce("root", "id").alias("label")
        )

    def in_window(a: str, b: str):
        low, high = F.least(a, b), F.greatest(a, b)
        fits = low >= high * F.lit(size_ratio)
        return fits if size_gap is None else fits & (high - low <= size_gap)

    for turn in range(pivots + 1):
        now = labelled()
        open_regions = now.groupBy("region").agg(
            F.min("label").alias("x"),
            F.max("label").alias("y"),
            F.min_by(
                F.struct("id", "size", "label"),
                F.struct(F.lit(0) if turn == 0 else F.xxhash64("id", F.lit(turn)), "id"),
            ).alias("pivot"),
        )
        open_regions = open_regions.filter("x <> y").select(
            "region",
            F.col("pivot.id").alias("b"),
            F.col("pivot.size").alias("b_size"),
            F.col("pivot.label").alias("b_label"),
        )
        if turn < pivots:
            pairs = now.join(open_regions, "region")
        else:
            left = written(now.join(open_regions, "region", "left_semi"), "open")
            right = left.select(
                "region",
                F.col("id").alias("b"),
                F.col("size").alias("b_size"),
                F.col("label").alias("b_label"),
            )
            pairs = left.join(right, "region").filter("id > b")
        pairs = pairs.filter((F.col("label") != F.col("b_label")) & in_window("size", "b_size"))
        needed = F.least(F.lit(shares), F.ceil(F.greatest("size", "b_size") * F.lit(size_ratio)))
        pairs = pairs.select(
            F.greatest("id", "b").alias("a"), F.least("id", "b").alias("b"), needed.alias("needed")
        )
        pairs = pairs.groupBy("a", "b", "needed").count().filter("count >= needed").select("a", "b")
        pairs = written(pairs.distinct(), "pairs")
        if pairs.isEmpty():
            if turn < pivots:
                continue
            break
        found = written(verified(pairs).select("a", "b"), "verified")
        edges = found if edges is None else edges.unionByName(found)
        labels = written(components(edges), "labels")
    if labels is None:
        kind = rows.schema["id"].dataType
        empty = spark.range(0).select(F.lit(None).cast(kind).alias("id"))
        return empty.withColumn("root", F.col("id"))
    return labels.select(F.col("node").alias("id"), "root")
