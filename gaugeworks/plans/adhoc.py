"""Previews, column listings and read-only SQL over the registered views."""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeworks.schemas import (
    CHECK_LOG_TABLE,
    EQUIPMENT_TABLE,
    FACT_TABLE,
    FAILURE_MODE_TABLE,
    RAW_TABLE,
    STAGING_TABLE,
)
from gaugeworks.session import literal_rows

FEATURES_VIEW = "analytics.v_sensor_anomaly_features"
ROOT_CAUSE_VIEW = "analytics.v_failure_root_cause_summary"
LEADERBOARD_VIEW = "analytics.v_high_risk_equipment_leaderboard"


@dataclass(frozen=True)
class Layer:
    table: str
    columns: tuple[str, ...]
    newest_first: bool = False
    order: tuple[str, ...] = ()
    rows: int | None = 15


LAYERS = {
    "raw": Layer(
        RAW_TABLE,
        (
            "udi",
            "product_id",
            "air_temperature_k",
            "process_temperature_k",
            "rotational_speed_rpm",
            "torque_nm",
            "tool_wear_min",
            "machine_failure",
            "batch_id",
            "ingested_at",
        ),
        order=("udi",),
    ),
    "staging": Layer(
        STAGING_TABLE,
        (
            "udi",
            "product_id",
            "product_type",
            "product_quality_grade",
            "air_temp_c",
            "process_temp_c",
            "temp_differential_c",
            "rotational_speed_rpm",
            "torque_nm",
            "mechanical_power_kw",
            "tool_wear_min",
            "overstrain_metric",
            "failure_mode",
        ),
        order=("udi",),
    ),
    "warehouse_fact": Layer(
        FACT_TABLE,
        (
            "telemetry_key",
            "udi",
            "equipment_key",
            "failure_mode_key",
            "air_temp_c",
            "temp_differential_c",
            "rotational_speed_rpm",
            "torque_nm",
            "mechanical_power_kw",
            "tool_wear_min",
            "overstrain_metric",
            "is_failure",
        ),
        order=("telemetry_key",),
    ),
    "warehouse_dim_equipment": Layer(
        EQUIPMENT_TABLE,
        (
            "equipment_key",
            "product_id",
            "product_type",
            "quality_grade",
            "created_at",
            "updated_at",
        ),
        order=("equipment_key",),
    ),
    "warehouse_dim_failure_mode": Layer(
        FAILURE_MODE_TABLE,
        (
            "failure_mode_key",
            "failure_mode_name",
            "severity_level",
            "root_cause_category",
        ),
        order=("failure_mode_key",),
        rows=None,
    ),
    "analytics": Layer(
        FEATURES_VIEW,
        (
            "udi",
            "product_id",
            "product_type",
            "rotational_speed_rpm",
            "torque_nm",
            "rolling_avg_torque",
            "rolling_std_torque",
            "torque_step_delta",
            "torque_z_score",
            "is_torque_anomaly",
            "failure_mode_name",
        ),
        order=("udi",),
    ),
    "quality": Layer(
        CHECK_LOG_TABLE,
        (
            "check_id",
            "batch_id",
            "check_name",
            "check_category",
            "table_name",
            "column_name",
            "status",
            "observed_value",
            "threshold_value",
            "severity",
            "details",
            "checked_at",
        ),
        newest_first=True,
        order=("checked_at", "check_id"),
        rows=20,
    ),
}


class UnknownLayerError(KeyError):
    """No layer has that name."""


def layer_of(name: str) -> Layer:
    if name not in LAYERS:
        raise UnknownLayerError(f"no layer {name!r}; valid names: {list(LAYERS)}")
    return LAYERS[name]


def preview(frames: dict[str, DataFrame], name: str, n: int | None = None) -> DataFrame:
    """The first rows of a layer, in its own order and columns.

    ``frames`` maps table and view names to frames. The order and limit become one
    top-k, so no layer is sorted as a whole.
    """
    layer = layer_of(name)
    order = [F.desc(c) if layer.newest_first else F.asc(c) for c in layer.order]
    rows = frames[layer.table].select(*layer.columns).orderBy(*order)
    limit = layer.rows if n is None else n
    return rows if limit is None or layer.rows is None else rows.limit(limit)


def describe(frames: dict[str, DataFrame], name: str) -> DataFrame:
    """Name, type and nullability of a layer's columns, in their order."""
    frame = frames[layer_of(name).table]
    rows = [
        (place, f.name, f.dataType.simpleString(), "YES" if f.nullable else "NO")
        for place, f in enumerate(frame.schema, 1)
    ]
    schema = T.StructType.fromDDL(
        "ordinal_position int, column_name string, data_type string, is_nullable string"
    )
    return literal_rows(frame.sparkSession, rows, schema)


class ReadOnlyViolation(ValueError):
    """The text is not a single read-only query."""


# Rows that a query may return at most, whatever its own LIMIT.
MOST_ROWS = 10_000

# Plans that do something other than read. Statements are commands too once they are
# analysed, but writing ones would run by then, so the parsed plan is what is checked.
_ACTIONS = (
    "org.apache.spark.sql.catalyst.plans.logical.Command",
    "org.apache.spark.sql.catalyst.plans.logical.ParsedStatement",
    "org.apache.spark.sql.catalyst.plans.logical.CompoundPlanStatement",
    "org.apache.spark.sql.catalyst.plans.logical.ScriptTransformation",
)


def check_read_only(spark: SparkSession, sql: str) -> str:
    """The statement without its closing semicolon, if it is one query that only reads.

    Spark's own parser decides, so words in names, strings and comments mean nothing. A
    text it cannot read raises its ``ParseException``.
    """
    statement = sql.strip().rstrip(";").strip()
    if not statement:
        raise ReadOnlyViolation("there is no query")
    plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(statement)
    for node in _nodes(plan):
        if any(_is_a(spark, node, name) for name in _ACTIONS):
            raise ReadOnlyViolation(f"{node.nodeName()} is not permitted in a read-only query")
    return statement


def _nodes(plan):
    """A plan and the plans in it: children, common table expressions and subqueries."""
    waiting = [plan]
    while waiting:
        node = waiting.pop()
        yield node
        for inner in (node.children(), node.innerChildren(), node.subqueries()):
            waiting += [inner.apply(i) for i in range(inner.size())]


def _is_a(spark: SparkSession, node, name: str) -> bool:
    loader = spark._jvm.java.lang.Thread.currentThread().getContextClassLoader()
    try:
        return loader.loadClass(name).isInstance(node)
    except Exception as error:
        if "ClassNotFoundException" in str(error):
            return False
        raise


def readonly_frame(spark: SparkSession, sql: str, limit: int = 100) -> DataFrame:
    """A read-only query as a lazy frame, capped unless it brings its own limit, which may
    not go beyond ``MOST_ROWS``."""
    frame = spark.sql(check_read_only(spark, sql))
    plan = frame._jdf.queryExecution().analyzed()
    while plan.nodeName() == "WithCTE":
        plan = plan.plan()
    return frame.limit(MOST_ROWS if plan.nodeName() == "GlobalLimit" else limit)


def run_readonly_sql(spark: SparkSession, sql: str, limit: int = 100) -> dict:
    """Run a read-only query; an error of the query comes back as a value."""
    started = time.perf_counter()
    try:
        frame = readonly_frame(spark, sql, limit)
        rows = [row.asDict() for row in frame.collect()]
    except ReadOnlyViolation:
        raise
    except Exception as error:
        return {
            "status": "error",
            "error": str(error),
            "execution_time_ms": _millis(started),
            "query": sql,
        }
    return {
        "status": "success",
        "columns": frame.columns,
        "rows": rows,
        "row_count": len(rows),
        "execution_time_ms": _millis(started),
        "query": sql,
    }


def _millis(started: float) -> float:
    return round((time.perf_counter() - started) * 1000, 2)
