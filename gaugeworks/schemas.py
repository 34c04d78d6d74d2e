"""Table schemas, keys and seed rows of the warehouse.

Measures are decimals, so every derived value and every rounding is exact. Ids
and surrogate keys are bigint: at the sizes this library is meant for a 32-bit
id would run out.
"""

from __future__ import annotations

from pyspark.sql import types as T

MEASURE = T.DecimalType(8, 2)
WIDE_MEASURE = T.DecimalType(10, 2)
CHECK_VALUE = T.DecimalType(14, 4)


def _schema(*columns: tuple) -> T.StructType:
    return T.StructType(
        [T.StructField(name, kind, nullable) for name, kind, nullable in columns]
    )


# Source header -> column name (fixed values).
RAW_COLUMN_MAP = {
    "UDI": "udi",
    "Product ID": "product_id",
    "Type": "product_type",
    "Air temperature [K]": "air_temperature_k",
    "Process temperature [K]": "process_temperature_k",
    "Rotational speed [rpm]": "rotational_speed_rpm",
    "Torque [Nm]": "torque_nm",
    "Tool wear [min]": "tool_wear_min",
    "Machine failure": "machine_failure",
    "TWF": "twf",
    "HDF": "hdf",
    "PWF": "pwf",
    "OSF": "osf",
    "RNF": "rnf",
}

READING = _schema(
    ("udi", T.LongType(), False),
    ("product_id", T.StringType(), False),
    ("product_type", T.StringType(), False),
    ("air_temperature_k", MEASURE, True),
    ("process_temperature_k", MEASURE, True),
    ("rotational_speed_rpm", T.IntegerType(), True),
    ("torque_nm", MEASURE, True),
    ("tool_wear_min", T.IntegerType(), True),
    ("machine_failure", T.IntegerType(), True),
    ("twf", T.IntegerType(), True),
    ("hdf", T.IntegerType(), True),
    ("pwf", T.IntegerType(), True),
    ("osf", T.IntegerType(), True),
    ("rnf", T.IntegerType(), True),
)

RAW = T.StructType(
    READING.fields
    + _schema(
        ("source_dataset", T.StringType(), False),
        ("batch_id", T.StringType(), False),
        ("ingested_at", T.TimestampType(), True),
    ).fields
)

# One row per state change of a batch; the latest row is the batch's state.
INGESTION_LOG = _schema(
    ("batch_id", T.StringType(), False),
    ("source_dataset", T.StringType(), False),
    ("row_count", T.LongType(), False),
    ("status", T.StringType(), False),
    ("ingested_at", T.TimestampType(), True),
    ("error_message", T.StringType(), True),
    ("state_seq", T.IntegerType(), False),
)

STAGING = _schema(
    ("udi", T.LongType(), False),
    ("product_id", T.StringType(), False),
    ("product_type", T.StringType(), False),
    ("product_quality_grade", T.StringType(), False),
    ("air_temp_c", MEASURE, False),
    ("process_temp_c", MEASURE, False),
    ("temp_differential_c", MEASURE, False),
    ("rotational_speed_rpm", T.IntegerType(), False),
    ("torque_nm", MEASURE, False),
    ("mechanical_power_kw", MEASURE, False),
    ("tool_wear_min", T.IntegerType(), False),
    ("overstrain_metric", WIDE_MEASURE, False),
    ("machine_failure", T.IntegerType(), False),
    ("failure_mode", T.StringType(), False),
    ("batch_id", T.StringType(), False),
    ("transformed_at", T.TimestampType(), True),
)

DIM_EQUIPMENT = _schema(
    ("equipment_key", T.LongType(), False),
    ("product_id", T.StringType(), False),
    ("product_type", T.StringType(), False),
    ("quality_grade", T.StringType(), False),
    ("created_at", T.TimestampType(), True),
    ("updated_at", T.TimestampType(), True),
)

DIM_FAILURE_MODE = _schema(
    ("failure_mode_key", T.LongType(), False),
    ("failure_mode_name", T.StringType(), False),
    ("severity_level", T.StringType(), False),
    ("root_cause_category", T.StringType(), False),
)

FACT = _schema(
    ("telemetry_key", T.LongType(), False),
    ("udi", T.LongType(), False),
    ("equipment_key", T.LongType(), False),
    ("failure_mode_key", T.LongType(), False),
    ("air_temp_c", MEASURE, False),
    ("process_temp_c", MEASURE, False),
    ("temp_differential_c", MEASURE, False),
    ("rotational_speed_rpm", T.IntegerType(), False),
    ("torque_nm", MEASURE, False),
    ("mechanical_power_kw", MEASURE, False),
    ("tool_wear_min", T.IntegerType(), False),
    ("overstrain_metric", WIDE_MEASURE, False),
    ("is_failure", T.BooleanType(), False),
    ("loaded_at", T.TimestampType(), True),
)

CHECK_LOG = _schema(
    ("check_id", T.LongType(), False),
    ("batch_id", T.StringType(), True),
    ("check_name", T.StringType(), False),
    ("check_category", T.StringType(), False),
    ("table_name", T.StringType(), False),
    ("column_name", T.StringType(), True),
    ("status", T.StringType(), False),
    ("observed_value", CHECK_VALUE, True),
    ("threshold_value", CHECK_VALUE, True),
    ("severity", T.StringType(), False),
    ("details", T.StringType(), True),
    ("checked_at", T.TimestampType(), True),
)

# The anomaly features as they are kept.
FEATURES = _schema(
    ("udi", T.LongType(), False),
    ("product_id", T.StringType(), True),
    ("product_type", T.StringType(), True),
    ("quality_grade", T.StringType(), True),
    ("rotational_speed_rpm", T.IntegerType(), True),
    ("torque_nm", MEASURE, True),
    ("temp_differential_c", MEASURE, True),
    ("mechanical_power_kw", MEASURE, True),
    ("tool_wear_min", T.IntegerType(), True),
    ("overstrain_metric", WIDE_MEASURE, True),
    ("failure_mode_name", T.StringType(), True),
    ("is_failure", T.BooleanType(), True),
    ("rolling_avg_torque", T.DoubleType(), True),
    ("rolling_std_torque", T.DoubleType(), True),
    ("torque_step_delta", T.DecimalType(9, 2), True),
    ("rolling_avg_power_kw", T.DoubleType(), True),
    ("torque_z_score", T.DecimalType(19, 2), True),
    ("is_torque_anomaly", T.BooleanType(), True),
)

# Aggregates of the fact by block, ``block_start`` being the block's first id.
SUM = T.DecimalType(28, 2)
FAILURE_SUMS = _schema(
    ("block_start", T.LongType(), False),
    ("equipment_key", T.LongType(), False),
    ("failure_mode_key", T.LongType(), False),
    ("n", T.LongType(), False),
    ("temp_differential_c", SUM, True),
    ("rotational_speed_rpm", T.LongType(), True),
    ("torque_nm", SUM, True),
    ("mechanical_power_kw", SUM, True),
)
SPEED_COUNTS = _schema(
    ("block_start", T.LongType(), False),
    ("rotational_speed_rpm", T.IntegerType(), False),
    ("n", T.LongType(), False),
    ("failures", T.LongType(), False),
)
BLOCK_COUNTS = _schema(
    ("block_start", T.LongType(), False),
    ("product_type", T.StringType(), True),
    ("n", T.LongType(), False),
    ("failures", T.LongType(), False),
    ("max_overstrain", WIDE_MEASURE, True),
)

# Failure-mode catalogue: name, severity, root cause (fixed values).
FAILURE_MODE_SEED = [
    ("Normal Operation", "None", "Healthy"),
    ("Heat Dissipation Failure", "Critical", "Thermal Dissipation"),
    ("Power Failure", "Critical", "Electrical / Mechanical Power Load"),
    ("Overstrain Failure", "High", "Mechanical Stress / Fatigue"),
    ("Tool Wear Failure", "Medium", "Abrasive Wear"),
    ("Random Failure", "Low", "Stochastic Noise"),
    ("Unclassified Failure", "High", "Unknown"),
]

# Accepted values of the constrained text columns (fixed values).
INGESTION_STATUSES = ["SUCCESS", "FAILED", "IN_PROGRESS"]
CHECK_STATUSES = ["PASSED", "FAILED", "WARNING"]
CHECK_SEVERITIES = ["CRITICAL", "WARNING", "INFO"]

RAW_TABLE = "raw.sensor_telemetry"
REJECTS_TABLE = "raw.sensor_telemetry_rejects"
INGESTION_LOG_TABLE = "raw.ingestion_log"
STAGING_TABLE = "staging.stg_sensor_telemetry"
QUARANTINE_TABLE = "staging.stg_sensor_telemetry_quarantine"
EQUIPMENT_TABLE = "warehouse.dim_equipment"
FAILURE_MODE_TABLE = "warehouse.dim_failure_mode"
FACT_TABLE = "warehouse.fact_sensor_telemetry"
CHECK_LOG_TABLE = "quality.check_log"
FEATURES_TABLE = "analytics.sensor_anomaly_features"
FAILURE_SUMS_TABLE = "analytics.fact_failure_sums"
SPEED_COUNTS_TABLE = "analytics.fact_speed_counts"
BLOCK_COUNTS_TABLE = "analytics.fact_block_counts"

TABLES = {
    RAW_TABLE: RAW,
    INGESTION_LOG_TABLE: INGESTION_LOG,
    STAGING_TABLE: STAGING,
    EQUIPMENT_TABLE: DIM_EQUIPMENT,
    FAILURE_MODE_TABLE: DIM_FAILURE_MODE,
    FACT_TABLE: FACT,
    CHECK_LOG_TABLE: CHECK_LOG,
    FEATURES_TABLE: FEATURES,
    FAILURE_SUMS_TABLE: FAILURE_SUMS,
    SPEED_COUNTS_TABLE: SPEED_COUNTS,
    BLOCK_COUNTS_TABLE: BLOCK_COUNTS,
    REJECTS_TABLE: T.StructType(
        [T.StructField(f.name, T.StringType(), True) for f in READING.fields]
        + _schema(
            ("batch_id", T.StringType(), True),
            ("reason", T.StringType(), True),
        ).fields
    ),
    QUARANTINE_TABLE: T.StructType(
        [T.StructField(f.name, f.dataType, True) for f in STAGING.fields]
    ),
}

# Tables that only ever grow; the others are replaced version by version.
APPEND_ONLY = {
    INGESTION_LOG_TABLE,
    CHECK_LOG_TABLE,
    REJECTS_TABLE,
    QUARANTINE_TABLE,
}

# Tables stored and replaced by block of ids, and the column that has the id.
BLOCKED = {
    RAW_TABLE: "udi",
    STAGING_TABLE: "udi",
    FACT_TABLE: "udi",
    FEATURES_TABLE: "udi",
    FAILURE_SUMS_TABLE: "block_start",
    SPEED_COUNTS_TABLE: "block_start",
    BLOCK_COUNTS_TABLE: "block_start",
}
