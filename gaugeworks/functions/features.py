"""Physical features of a reading, all in exact decimal arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gaugeworks.schemas import MEASURE, WIDE_MEASURE

# Fixed values.
KELVIN_OFFSET = "273.15"
PI = "3.1415926535"
GRADES = {
    "L": "Low (50% variant)",
    "M": "Medium (30% variant)",
    "H": "High (20% variant)",
}
UNKNOWN_GRADE = "Unknown"
# Flag column -> failure mode, strongest first.
MODE_PRIORITY = {
    "hdf": "Heat Dissipation Failure",
    "pwf": "Power Failure",
    "osf": "Overstrain Failure",
    "twf": "Tool Wear Failure",
    "rnf": "Random Failure",
    "machine_failure": "Unclassified Failure",
}
NORMAL_MODE = "Normal Operation"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _decimal(literal: str) -> Column:
    digits = literal.replace(".", "").lstrip("0")
    scale = len(literal.partition(".")[2])
    return F.lit(literal).cast(f"decimal({max(len(digits), scale + 1)},{scale})")


def quality_grade(product_type: Column | str) -> Column:
    """Grade label of a product type; anything but L, M, H is ``Unknown``."""
    kind = _col(product_type)
    label = F
    for code, grade in GRADES.items():
        label = label.when(kind == code, F.lit(grade))
    return label.otherwise(F.lit(UNKNOWN_GRADE))


def kelvin_to_celsius(kelvin: Column | str) -> Column:
    return F.round(_col(kelvin) - _decimal(KELVIN_OFFSET), 2).cast(MEASURE)


def temp_differential(process_k: Column | str, air_k: Column | str) -> Column:
    """Process minus air temperature; the Kelvin offset cancels exactly."""
    return F.round(_col(process_k) - _col(air_k), 2).cast(MEASURE)


def mechanical_power_kw(rpm: Column | str, torque: Column | str) -> Column:
    """2 pi n M / 60 / 1000 with n in rpm and M in Nm."""
    watts_minute = F.lit(2) * _decimal(PI) * _col(rpm) * _col(torque)
    return F.round(watts_minute / _decimal("60000.0"), 2).cast(MEASURE)


def overstrain(wear_min: Column | str, torque: Column | str) -> Column:
    return F.round(_col(wear_min) * _col(torque), 2).cast(WIDE_MEASURE)


def failure_mode(prefix: str = "") -> Column:
    """The strongest failure flag that is set, as a label."""
    label = F
    for flag, mode in MODE_PRIORITY.items():
        label = label.when(F.col(prefix + flag) == 1, F.lit(mode))
    return label.otherwise(F.lit(NORMAL_MODE))


def is_failure(machine_failure: Column | str) -> Column:
    return _col(machine_failure) == 1
