from decimal import Decimal

from conftest import reading
from gaugeworks.plans import analytics
from gaugeworks.plans.analytics import Star
from gaugeworks.schemas import EQUIPMENT_TABLE
from pyspark.sql import functions as F


def strained(udi, wear, **changes):
    return reading(udi=udi, tool_wear_min=wear, torque_nm=Decimal("10.00"), **changes)


def test_leaderboard_breaks_ties_by_id(loaded):
    # ids 19..24 share the value at places 20 to 25 and 26
    wears = {u: 200 - u if u < 20 else 100 if u < 27 else 50 for u in range(1, 31)}
    star = Star.of(loaded([strained(u, w) for u, w in wears.items()]))
    rows = analytics.leaderboard(star).collect()
    assert [r.udi for r in rows] == list(range(1, 26))
    assert [r.risk_rank for r in rows[-6:]] == [20] * 6
    ranks = star.fact.selectExpr(
        "udi", "dense_rank() over (order by overstrain_metric desc) AS r"
    )
    everywhere = {r.udi: r.r for r in ranks.collect()}
    assert all(everywhere[r.udi] == r.risk_rank for r in rows)


def test_stress_top_has_ten(loaded):
    star = Star.of(loaded([strained(u, u) for u in range(1, 15)]))
    rows = analytics.stress_top(star).collect()
    assert [r.udi for r in rows] == list(range(14, 4, -1))
    assert [r.global_stress_rank for r in rows] == list(range(1, 11))


def test_random_failures_are_absent_from_root_cause(loaded):
    star = Star.of(
        loaded(
            [
                reading(udi=1, rnf=1),
                reading(udi=2, hdf=1, machine_failure=1),
                reading(udi=3, hdf=1, machine_failure=1, product_id="L2"),
                reading(udi=4, machine_failure=1),
            ]
        )
    )
    rows = {r.failure_mode_name: r for r in analytics.root_cause(star).collect()}
    assert set(rows) == {"Heat Dissipation Failure", "Unclassified Failure"}
    heat = rows["Heat Dissipation Failure"]
    assert heat.occurrence_count == 2 and heat.failure_rank_in_tier == 1
    assert heat.failure_pct_share == Decimal("66.67")


def test_equal_counts_share_a_rank(loaded):
    star = Star.of(
        loaded(
            [
                reading(udi=1, hdf=1, machine_failure=1),
                reading(udi=2, pwf=1, machine_failure=1),
                reading(udi=3, twf=1, machine_failure=1, product_type="M", product_id="M1"),
            ]
        )
    )
    rows = analytics.tier_failures(star).collect()
    assert [r.rank_in_tier for r in rows] == [1, 1, 1]
    assert [r.failure_mode_name for r in rows][:2] == [
        "Heat Dissipation Failure",
        "Power Failure",
    ]
    assert [r.pct_of_tier_failures for r in rows] == [50, 50, 100]


def test_shares_add_up(loaded):
    flags = ["hdf", "pwf", "osf", "twf"]
    star = Star.of(
        loaded(
            [
                reading(udi=u, machine_failure=1, **{flags[u * u % 4]: 1})
                for u in range(1, 40)
            ]
        )
    )
    total = analytics.root_cause(star).agg(F.sum("failure_pct_share")).first()[0]
    assert abs(total - 100) <= Decimal("0.04")


def test_mean_rounds_once(loaded):
    # 0.1249999 would become 0.125 and then 0.13 if rounded twice
    readings = [
        reading(udi=u, machine_failure=1, torque_nm=Decimal("0.12")) for u in range(1, 5)
    ]
    readings.append(reading(udi=5, machine_failure=1, torque_nm=Decimal("0.14")))
    star = Star.of(loaded(readings))
    assert analytics.root_cause(star).first().avg_torque_nm == Decimal("0.12")


def test_null_and_unknown_keys_are_orphans(spark, loaded, warehouse):
    loaded([reading()])
    fact = spark.createDataFrame([(1, 1), (2, 99), (3, None)], "udi long, fk long")
    dim = warehouse.read(EQUIPMENT_TABLE)
    found = analytics.orphans(fact, "fk", dim, "equipment_key").collect()
    assert [r.udi for r in found] == [2, 3]
    assert analytics.orphans(fact, "fk", dim, "equipment_key", n=1).count() == 1


def test_quintiles_of_stored_fact(loaded):
    star = Star.of(
        loaded(
            [
                reading(udi=u, rotational_speed_rpm=1200 + u % 7, machine_failure=u % 2)
                for u in range(1, 64)
            ]
        )
    )
    rows = analytics.speed_quintiles(star, max_cells=4).collect()
    assert [r.speed_quintile for r in rows] == [1, 2, 3, 4, 5]
    assert [r.total_readings for r in rows] == [13, 13, 13, 12, 12]
    assert sum(r.failures_count for r in rows) == 32


def test_star_sample_is_ordered(loaded):
    star = Star.of(loaded([reading(udi=u) for u in range(40, 0, -1)]))
    rows = analytics.star_sample(star, 3).collect()
    assert [r.udi for r in rows] == [1, 2, 3]
    assert rows[0].severity_level == "None"
