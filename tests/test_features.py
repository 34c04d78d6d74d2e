from decimal import Decimal

import pytest
from conftest import NOW, reading
from gaugeworks.functions import features
from gaugeworks.plans.staging import to_staging
from pyspark.sql import functions as F


def staged(raw, **changes):
    return to_staging(raw([reading(**changes)]), NOW).first()


@pytest.mark.parametrize(
    "kind, grade",
    [
        ("L", "Low (50% variant)"),
        ("M", "Medium (30% variant)"),
        ("H", "High (20% variant)"),
        ("X", "Unknown"),
        (None, "Unknown"),
    ],
)
def test_grades(raw, kind, grade):
    assert staged(raw, product_type=kind).product_quality_grade == grade


def test_temperatures_are_exact(raw):
    row = staged(
        raw,
        air_temperature_k=Decimal("273.10"),
        process_temperature_k=Decimal("308.65"),
    )
    assert row.air_temp_c == Decimal("-0.05")
    assert row.process_temp_c == Decimal("35.50")
    assert row.temp_differential_c == Decimal("35.55")


def test_power_uses_the_short_pi(raw):
    row = staged(raw, rotational_speed_rpm=1551, torque_nm=Decimal("42.80"))
    exact = Decimal(2) * Decimal("3.1415926535") * 1551 * Decimal("42.80") / 60000
    assert row.mechanical_power_kw == exact.quantize(Decimal("0.01"))


def test_overstrain(raw):
    row = staged(raw, tool_wear_min=253, torque_nm=Decimal("76.60"))
    assert row.overstrain_metric == Decimal("19379.80")


def test_rounding_is_half_away_from_zero(spark):
    value = F.lit("-0.125").cast("decimal(8,3)")
    assert spark.range(1).select(F.round(value, 2)).first()[0] == Decimal("-0.13")


@pytest.mark.parametrize(
    "flags, mode",
    [
        ({}, "Normal Operation"),
        ({"hdf": 1, "pwf": 1, "osf": 1}, "Heat Dissipation Failure"),
        ({"pwf": 1, "osf": 1, "twf": 1}, "Power Failure"),
        ({"osf": 1, "twf": 1, "rnf": 1}, "Overstrain Failure"),
        ({"twf": 1, "rnf": 1}, "Tool Wear Failure"),
        ({"rnf": 1}, "Random Failure"),
        ({"machine_failure": 1}, "Unclassified Failure"),
        ({"hdf": None, "pwf": None}, "Normal Operation"),
    ],
)
def test_failure_mode_priority(raw, flags, mode):
    assert staged(raw, **flags).failure_mode == mode


def test_random_failure_alone_is_no_failure(raw, spark):
    frame = raw([reading(rnf=1)]).withColumn(
        "failed", features.is_failure("machine_failure")
    )
    assert frame.first().failed is False
