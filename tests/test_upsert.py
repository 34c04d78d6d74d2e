import pytest
from gaugeworks.operators.upsert import DuplicateKeyError, duplicate_keys, upsert
from pyspark.sql import functions as F

SCHEMA = "k int, a string, b string, at string"


@pytest.fixture
def frames(spark):
    target = spark.createDataFrame(
        [(1, "a1", "b1", "old"), (2, "a2", None, "old")], SCHEMA
    )
    batch = spark.createDataFrame(
        [(2, "A2", "B2", "new"), (3, "A3", "B3", "new")], SCHEMA
    )
    return target, batch


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_update_only_named_columns(frames):
    target, batch = frames
    assert rows(upsert(target, batch, ["k"], ["b"])) == [
        (1, "a1", "b1", "old"),
        (2, "a2", "B2", "old"),
        (3, "A3", "B3", "new"),
    ]


def test_update_everything(frames):
    target, batch = frames
    assert rows(upsert(target, batch, ["k"]))[1] == (2, "A2", "B2", "new")


def test_update_can_write_null(frames, spark):
    target, _ = frames
    batch = spark.createDataFrame([(1, None, None, None)], SCHEMA)
    assert rows(upsert(target, batch, ["k"], ["b"]))[0] == (1, "a1", None, "old")


def test_touch_columns(frames):
    target, batch = frames
    merged = upsert(target, batch, ["k"], ["a"], touch_cols={"at": F.lit("touched")})
    assert [r[3] for r in rows(merged)] == ["old", "touched", "new"]


def test_do_nothing(frames):
    target, batch = frames
    merged = upsert(target, batch, ["k"], on_conflict="nothing")
    assert rows(merged)[1:] == [(2, "a2", None, "old"), (3, "A3", "B3", "new")]


def test_twice_is_once(frames):
    target, batch = frames
    once = upsert(target, batch, ["k"], ["b", "at"])
    assert rows(upsert(once, batch, ["k"], ["b", "at"])) == rows(once)


def test_duplicates_are_refused(frames):
    target, batch = frames
    twice = batch.unionByName(batch)
    assert rows(duplicate_keys(twice, ["k"])) == [(2, 2), (3, 2)]
    with pytest.raises(DuplicateKeyError):
        upsert(target, twice, ["k"])


def test_last_duplicate_wins(frames, spark):
    target, _ = frames
    batch = spark.createDataFrame(
        [(1, "x", "x", "n", 5), (1, "y", "y", "n", 9), (1, "z", "z", "n", None)],
        SCHEMA + ", seq int",
    )
    merged = upsert(target, batch, ["k"], duplicates="last", order_by="seq")
    assert rows(merged)[0] == (1, "y", "y", "n")


def test_composite_keys(spark):
    target = spark.createDataFrame([(1, "x", 10)], "k int, l string, v int")
    batch = spark.createDataFrame([(1, "x", 11), (1, "y", 12)], "k int, l string, v int")
    assert rows(upsert(target, batch, ["k", "l"])) == [(1, "x", 11), (1, "y", 12)]


@pytest.mark.parametrize(
    "options",
    [
        {"update_cols": ["nope"]},
        {"on_conflict": "maybe"},
        {"duplicates": "maybe"},
        {"duplicates": "last"},
    ],
)
def test_bad_options(frames, options):
    with pytest.raises(ValueError):
        upsert(*frames, ["k"], **options)


def test_small_batch_does_not_shuffle_the_target(spark):
    target = spark.range(1000).select("id", F.lit("x").alias("v"))
    batch = spark.range(5).select("id", F.lit("y").alias("v"))
    merged = upsert(target, batch, ["id"], duplicates="unique")
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "FullOuter" not in plan
    assert "Exchange hashpartitioning" not in plan


@pytest.mark.parametrize("cols", ["all", ["b"], []])
def test_large_batch_merges_alike_and_is_shuffled_once(spark, cols):
    target = spark.createDataFrame(
        [(1, "a1", "b1", "old"), (2, "a2", None, "old"), (None, "a0", "b0", "old"), (4, None, "b4", "old")], SCHEMA
    )
    batch = spark.createDataFrame(
        [(2, "A2", "B2", "new"), (3, "A3", None, "new"), (None, "A0", "B0", "new"), (4, "A4", None, "new")], SCHEMA
    )
    how = {"update_cols": cols, "duplicates": "unique", "touch_cols": {"at": F.concat("at", F.lit("+"))}}

    def told(df):
        return sorted(map(str, df.collect()))

    merged = upsert(target, batch, ["k"], large=True, **how)
    assert told(merged) == told(upsert(target, batch, ["k"], **how))
    joins = merged._jdf.queryExecution().optimizedPlan().toString()
    assert joins.count("Join") == 1 and "Join FullOuter" in joins
