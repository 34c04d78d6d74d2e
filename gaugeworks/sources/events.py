"""Telemetry readings derived from an event stream table.

Gives the warehouse something to load where no sensor file is at hand: every event
becomes one reading. The expressions use only what Spark and other SQL engines agree
on, so an oracle can state the same mapping.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

_MODULUS = {"twf": 97, "hdf": 43, "pwf": 53, "osf": 61, "rnf": 89}
_FAILING = [43, 53, 61, 97, 211]


def readings_from_events(events: DataFrame, *keep: str) -> DataFrame:
    """The fourteen reading columns of every event, and the columns to ``keep``."""
    prepared = events.selectExpr(
        *keep,
        "event_id",
        "user_id",
        "value",
        "cast(get_json_object(props, '$.k') as int) AS k",
        "CASE WHEN user_id % 10 < 5 THEN 'L' WHEN user_id % 10 < 8 THEN 'M'"
        " ELSE 'H' END AS pt",
    )
    failing = " OR ".join(f"event_id % {m} = 0" for m in _FAILING)
    return prepared.selectExpr(
        "cast(event_id + 1 as bigint) AS udi",
        "concat(pt, cast(user_id as string)) AS product_id",
        "pt AS product_type",
        "cast(295.3 + (k % 92) / 10.0 as decimal(8,2)) AS air_temperature_k",
        "cast(304.3 + (k % 92) / 10.0 + (event_id % 21) / 10.0 as decimal(8,2))"
        " AS process_temperature_k",
        "cast(1168 + (event_id * 37 + k * 13) % 1719 as int) AS rotational_speed_rpm",
        "cast(value as decimal(8,2)) AS torque_nm",
        "cast((event_id * 7 + user_id) % 254 as int) AS tool_wear_min",
        f"CASE WHEN {failing} THEN 1 ELSE 0 END AS machine_failure",
        *[
            f"CASE WHEN event_id % {m} = 0 THEN 1 ELSE 0 END AS {flag}"
            for flag, m in _MODULUS.items()
        ],
        *keep,
    )
