"""Rounded results against arbitrary-precision arithmetic."""

import random
from decimal import ROUND_HALF_UP, Decimal, localcontext

import pytest
from conftest import reading
from gaugeworks.operators.ordinal import tile_end, tile_of
from gaugeworks.plans import analytics
from gaugeworks.plans.analytics import Star, anomaly_features
from pyspark.sql import Window
from pyspark.sql import functions as F


def rounded(value: Decimal, places: str = "0.01") -> Decimal:
    return value.quantize(Decimal(places), rounding=ROUND_HALF_UP)


def exact_score(frame: list[Decimal]):
    """z-score of a frame's last value with fifty digits, and whether it is extreme."""
    with localcontext() as context:
        context.prec = 50
        n = len(frame)
        mean = sum(frame) / n
        if n == 1:
            return Decimal(0), False
        variance = sum((v - mean) ** 2 for v in frame) / (n - 1)
        if variance == 0:
            return None, False
        score = (frame[-1] - mean) / variance.sqrt()
        return rounded(score), abs(score) > Decimal("2.5")


@pytest.mark.parametrize("kind", ["spread", "few values", "rare spikes"])
def test_scores_equal_fifty_digit_arithmetic(loaded, kind):
    pick = random.Random(kind)
    draw = {
        "spread": lambda: Decimal(pick.randrange(0, 999_999)) / 100,
        "few values": lambda: Decimal(pick.choice([1, 2, 2, 3])) / 100,
        "rare spikes": lambda: Decimal(pick.choices([40, 41, 99], [60, 30, 10])[0]),
    }[kind]
    values = [draw() for _ in range(400)]
    # overstrain is stored with eight digits before the point
    star = Star.of(
        loaded(
            [
                reading(udi=u, torque_nm=v, rotational_speed_rpm=100)
                for u, v in enumerate(values, 1)
            ]
        )
    )
    rows = anomaly_features(star, rows=32).orderBy("udi").collect()
    for place, row in enumerate(rows):
        score, extreme = exact_score(values[max(0, place - 9) : place + 1])
        assert row.torque_z_score == score
        assert row.is_torque_anomaly is extreme


def test_means_and_shares_equal_exact_arithmetic(loaded):
    pick = random.Random(3)
    flags = ["hdf", "pwf", "osf", "twf"]
    readings = [
        reading(
            udi=u,
            machine_failure=1,
            torque_nm=Decimal(pick.randrange(0, 9_999)) / 100,
            **{pick.choices(flags, [9, 5, 3, 1])[0]: 1},
        )
        for u in range(1, 300)
    ]
    rows = analytics.root_cause(Star.of(loaded(readings))).collect()
    groups = {}
    for r in readings:
        flag = next(f for f in flags if r[f])
        groups.setdefault(flag, []).append(r["torque_nm"])
    expected = sorted(
        (len(v), rounded(sum(v) / len(v)), rounded(Decimal(100 * len(v)) / 299))
        for v in groups.values()
    )
    found = sorted(
        (r.occurrence_count, r.avg_torque_nm, r.failure_pct_share) for r in rows
    )
    assert found == expected


@pytest.mark.parametrize("tiles", [1, 2, 5, 9])
def test_tile_formulas_equal_ntile(spark, tiles):
    rows = spark.range(1, 41).select(
        F.col("id").alias("n"), F.explode(F.sequence(F.lit(1), "id")).alias("ordinal")
    )
    group = Window.partitionBy("n").orderBy("ordinal")
    last = F.max("ordinal").over(Window.partitionBy("n", "plain"))
    checked = rows.withColumn("plain", F.ntile(tiles).over(group)).select(
        F.col("plain") == tile_of(F.col("ordinal"), F.col("n"), tiles),
        last == tile_end(F.col("plain"), F.col("n"), tiles),
    )
    assert checked.distinct().collect() == [(True, True)]
