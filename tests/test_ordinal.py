import os
import random
import re

import pytest
from gaugeworks.session import shared_dir
from gaugeworks.operators.ordinal import (
    dense_rank_exact,
    counted_ordinal,
    global_ordinal,
    ntile_exact,
    text_ordinal,
)
from gaugeworks.operators.tiles import tile_ends, tile_report
from pyspark.sql import Window
from pyspark.sql import functions as F


def frame(spark, rows):
    return spark.createDataFrame(rows, "v int, id long").repartition(4)


def hot_rows(n, seed, hot=0.35):
    """A third of the rows share one value."""
    pick = random.Random(seed)
    ids = pick.sample(range(10 * n), n)
    return [
        (1500 if pick.random() < hot else pick.randrange(1100, 2900), i) for i in ids
    ]


@pytest.mark.parametrize("seed", [1, 2])
def test_global_ordinal_equals_row_number(spark, seed):
    df = frame(spark, hot_rows(700, seed))
    plain = df.withColumn("ordinal", F.row_number().over(Window.orderBy(F.desc("v"), "id")))
    ours = global_ordinal(df, F.desc("v"), F.asc("id"), partitions=7)
    assert ours.exceptAll(plain).isEmpty() and ours.count() == 700


def test_hot_value_is_spread_over_ranges(spark):
    df = frame(spark, [(1, i) for i in range(2000)])
    ranged = df.repartitionByRange(8, "v", "id").withColumn("p", F.spark_partition_id())
    sizes = [r["count"] for r in ranged.groupBy("p").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 600


@pytest.mark.parametrize("rows", [2, 50, 10_000, None])
def test_counted_ordinal_equals_row_number(spark, rows):
    df = frame(spark, hot_rows(500, 3) + [(1500, 2**61)])
    for order in (["id"], ["v", "id"]):
        plain = df.withColumn("n", F.row_number().over(Window.orderBy(*order)))
        ours = counted_ordinal(df, *order, name="n", rows=rows)
        assert ours.exceptAll(plain).isEmpty() and ours.count() == 501


@pytest.mark.parametrize("rows", [3, 40, None])
def test_text_ordinal_equals_row_number(spark, rows):
    pick = random.Random(6)
    heads = ["", "a", "same start of many ", "é", "~", "\x00"]
    texts = {pick.choice(heads) + "".join(pick.choices("ab\x00é9", k=pick.randint(0, 9))) for _ in range(300)}
    df = spark.createDataFrame([(t,) for t in texts], "t string").repartition(3)
    plain = df.withColumn("n", F.row_number().over(Window.orderBy("t")))
    ours = text_ordinal(df, "t", name="n", rows=rows)
    assert ours.exceptAll(plain).isEmpty() and ours.count() == len(texts)


def test_numbering_leaves_nothing_behind(spark):
    """No written copy, no sampled ranges, and a window per block of rows."""
    df = frame(spark, hot_rows(500, 3))
    before = files_below(shared_dir(spark))
    for numbered in (
        ntile_exact(df, 5, "v", "id", rows=40),
        dense_rank_exact(df, "v", "id", rows=40),
    ):
        text = numbered._jdf.queryExecution().executedPlan().toString()
        assert "rangepartitioning" not in text and "SinglePartition" not in text
        assert re.search(r"hashpartitioning\(_block#\d+", text)
        assert numbered.count() == 500
    assert files_below(shared_dir(spark)) == before


def files_below(path):
    return sum(len(names) for _, _, names in os.walk(path))


@pytest.mark.parametrize("tiles", [1, 4, 5])
def test_ntile_equals_builtin(spark, tiles):
    df = frame(spark, hot_rows(503, 4))
    plain = df.withColumn("tile", F.ntile(tiles).over(Window.orderBy("v", "id")))
    ours = ntile_exact(df, tiles, "v", "id", rows=60)
    assert ours.exceptAll(plain).isEmpty()


def test_ntile_with_equal_values_and_remainder(spark):
    df = frame(spark, [(7, i) for i in range(13)])
    tiles = ntile_exact(df, 5, "v", "id", rows=3)
    sizes = {r.tile: r["count"] for r in tiles.groupBy("tile").count().collect()}
    assert sizes == {1: 3, 2: 3, 3: 3, 4: 2, 5: 2}


def test_dense_rank_equals_builtin_and_keeps_nulls(spark):
    rows = [*hot_rows(300, 5), (None, -1), (None, -2)]
    df = frame(spark, rows)
    plain = df.withColumn(
        "dense_rank", F.dense_rank().over(Window.orderBy(F.desc_nulls_first("v")))
    )
    for rows in (4, 40, None):
        ours = dense_rank_exact(df, "v", "id", rows=rows)
        assert ours.exceptAll(plain).isEmpty() and ours.count() == 302
    ascending = df.withColumn(
        "dense_rank", F.dense_rank().over(Window.orderBy(F.asc_nulls_last("v")))
    )
    ours = dense_rank_exact(df, "v", "id", descending=False, rows=30)
    assert ours.exceptAll(ascending).isEmpty()


def reports(df, tiles, max_cells):
    plain = (
        df.withColumn("tile", F.ntile(tiles).over(Window.orderBy("v", "id")))
        .groupBy("tile")
        .agg(F.min("v"), F.max("v"), F.count("*"), F.count_if(F.col("id") % 3 == 0))
    )
    ours = tile_report(df, tiles, "v", "id", F.col("id") % 3 == 0, max_cells=max_cells)
    order = lambda rows: sorted(tuple(r) for r in rows)
    return order(ours.collect()), order(plain.collect())


@pytest.mark.parametrize("max_cells", [3, 64, 1 << 20])
@pytest.mark.parametrize("tiles", [1, 5, 7])
def test_tile_report_equals_builtin(spark, tiles, max_cells):
    ours, plain = reports(frame(spark, hot_rows(601, tiles)), tiles, max_cells)
    assert ours == plain


def test_tile_report_where_one_value_spans_all_tiles(spark):
    ours, plain = reports(frame(spark, [(5, i * i) for i in range(101)]), 5, 8)
    assert ours == plain


def test_tile_report_with_fewer_rows_than_tiles(spark):
    ours, plain = reports(frame(spark, [(2, 1), (1, 9), (2, 4)]), 5, 16)
    assert ours == plain


def test_tile_report_of_nothing(spark):
    empty = frame(spark, [])
    assert tile_ends(empty, 5, "v", "id") == []
    assert tile_report(empty, 5, "v", "id", F.lit(True)).isEmpty()


def test_tile_sizes_differ_by_at_most_one(spark):
    ours, _ = reports(frame(spark, hot_rows(1003, 9)), 5, 32)
    sizes = [row[3] for row in ours]
    assert sum(sizes) == 1003 and max(sizes) - min(sizes) <= 1
