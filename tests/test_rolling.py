import random
from decimal import Decimal

import pytest
from conftest import reading
from gaugeworks.operators.blocks import equal_blocks
from gaugeworks.operators.rolling import rolling, rolling_plain
from gaugeworks.plans.analytics import Star, anomaly_features, anomaly_feed
from pyspark.sql import functions as F


def build(ordered, framed):
    return {
        "mean": F.avg("x").over(framed),
        "std": F.stddev("x").over(framed),
        "previous": F.lag("x").over(ordered),
        "n": F.count("*").over(framed),
    }


def series_rows(seed, n):
    """Three series of very different density over sparse, uneven ids."""
    pick = random.Random(seed)
    ids = sorted(pick.sample(range(5 * n), n) + [50 * n + i for i in range(n // 4)])
    weights = {"L": 60, "M": 37, "H": 3}
    kinds = pick.choices(list(weights), weights.values(), k=len(ids))
    return [(k, i, pick.uniform(0, 100)) for k, i in zip(kinds, ids, strict=True)]


@pytest.mark.parametrize("preceding", [1, 9])
@pytest.mark.parametrize("size", [1, 4, 9, 37, 10_000, None])
def test_rolling_equals_plain_window(spark, size, preceding):
    rows = series_rows(size or 7, 400)
    df = spark.createDataFrame(rows, "series string, id long, x double").repartition(4)
    plain = rolling_plain(df, "series", "id", build, preceding)
    ours = rolling(df, "series", "id", build, preceding, inputs=["x"], rows=size)
    assert ours.columns == plain.columns
    assert ours.exceptAll(plain).isEmpty() and ours.count() == len(rows)


def test_a_far_id_does_not_coarsen_blocks(spark):
    rows = [("L", i, float(i % 7)) for i in range(1, 401)] + [("L", 2**60, 1.0), ("L", -(2**60), 2.0)]
    df = spark.createDataFrame(rows, "series string, id long, x double")
    blocks = equal_blocks(df, "id", rows=50)
    sizes = df.groupBy(blocks.number().alias("b")).count().collect()
    assert sum(r["count"] for r in sizes) == 402 == blocks.total
    assert max(r["count"] for r in sizes) <= 50 and len(sizes) <= 20
    assert list(blocks.before) == sorted(blocks.before)
    plain = rolling_plain(df, "series", "id", build, 9)
    ours = rolling(df, "series", "id", build, 9, ["x"], rows=50)
    assert ours.exceptAll(plain).isEmpty()


@pytest.mark.parametrize("seed", range(4))
def test_blocks_hold_at_most_their_rows(spark, seed):
    """Ids whose density differs by many powers of two, and one hot value."""
    pick = random.Random(seed)
    keys = {pick.randrange(1 << pick.randint(1, 62)) for _ in range(600)}
    pairs = [(7 if pick.random() < 0.4 else k % 50, k) for k in keys]
    df = spark.createDataFrame(pairs, "v long, id long")
    for columns in (["id"], ["v", "id"]):
        blocks = equal_blocks(df, *columns, rows=20)
        found = df.withColumn("b", blocks.number()).groupBy("b").agg(F.count("*").alias("n"))
        sizes = {r.b: r.n for r in found.collect()}
        assert max(sizes.values()) <= 20 and len(sizes) <= 2 * len(pairs) // 10 + 2
        ahead = 0
        for number, before in enumerate(blocks.before):
            assert before == ahead
            ahead += sizes.get(number, 0)
        assert ahead == len(pairs)


def features_of(loaded, readings, **options):
    star = Star.of(loaded(readings))
    rows = {r.udi: r for r in anomaly_features(star, **options).collect()}
    plain = {r.udi: r for r in anomaly_features(star, plain=True).collect()}
    assert rows == plain
    return rows


def torques(values, kind="L", start=1):
    return [
        reading(udi=start + i, torque_nm=v if v is None else Decimal(str(v)), product_type=kind,
                product_id=f"{kind}1")
        for i, v in enumerate(values)
    ]


def test_single_reading_has_fallback_deviation(loaded):
    row = features_of(loaded, torques([40], "H"), rows=4)[1]
    assert row.rolling_std_torque == 0.01
    assert row.torque_step_delta == 0 and row.torque_z_score == 0
    assert row.is_torque_anomaly is False


def test_no_variance_gives_no_score(loaded):
    rows = features_of(loaded, torques([40] * 12), rows=4)
    assert all(rows[i].torque_z_score is None for i in range(2, 13))
    assert not any(r.is_torque_anomaly for r in rows.values())


def test_frames_below_nine_rows_cannot_be_anomalous(loaded):
    rows = features_of(loaded, torques([40] * 7 + [99]), rows=4)
    assert rows[8].torque_z_score == Decimal("2.47")
    assert rows[8].is_torque_anomaly is False


def test_nine_rows_can(loaded):
    row = features_of(loaded, torques([40] * 8 + [41]), rows=4)[9]
    assert row.torque_z_score == Decimal("2.67") and row.is_torque_anomaly is True


def test_previous_reading_without_torque(spark):
    df = spark.createDataFrame(
        [("L", 1, 1.0), ("L", 2, None), ("L", 3, 3.0)], "s string, id long, x double"
    )
    out = rolling(df, "s", "id", build, 9, ["x"], rows=1).orderBy("id").collect()
    assert [r.previous for r in out] == [None, 1.0, None]


def test_scores_stay_within_their_bound(loaded):
    pick = random.Random(11)
    values = [round(pick.lognormvariate(2, 1), 2) for _ in range(300)]
    rows = features_of(loaded, torques(values), rows=16)
    # (n - 1) / sqrt(n) for n = 10
    assert max(abs(r.torque_z_score) for r in rows.values()) <= Decimal("2.85")
    assert any(r.is_torque_anomaly for r in rows.values())


def test_feed_puts_missing_scores_first_unless_filtered(loaded):
    star = Star.of(loaded(torques([40] * 9 + [41] + [60, 2, 33])))
    features = anomaly_features(star)
    assert anomaly_feed(features, 3, anomaly_only=False).first().torque_z_score is None
    assert all(r.is_torque_anomaly for r in anomaly_feed(features).collect())
