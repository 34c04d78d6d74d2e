"""SQL twins of the registered queries, for an engine other than Spark.

Measures are kept in hundredths as integers (names ending in ``_c``), so rounding is
integer arithmetic here and decimal arithmetic there. Windows, ranks and NTILE are the
plain built-in ones.
"""

from __future__ import annotations

SOURCE = "events.parquet"
BATCH = "batch_20240101_000000_aaaaaa"
NEXT_BATCH = "batch_20240102_000000_bbbbbb"
LOADED_AT = "2024-01-01 00:00:00"
RELOADED_AT = "2024-01-02 00:00:00"
FIRST_RUN = "2024-01-01 06:00:00"
SECOND_RUN = "2024-01-01 06:10:00"

_RAW = f"""
base AS (
  SELECT event_id, user_id, value,
         CAST(json_extract_string(props, '$.k') AS INT) AS k,
         CASE WHEN user_id % 10 < 5 THEN 'L' WHEN user_id % 10 < 8 THEN 'M' ELSE 'H'
         END AS pt
  FROM events),
raw AS (
  SELECT CAST(event_id + 1 AS BIGINT) AS udi,
         pt || CAST(user_id AS VARCHAR) AS product_id,
         pt AS product_type,
         CAST(295.3 + (k % 92) / 10.0 AS DECIMAL(8,2)) AS air_temperature_k,
         CAST(304.3 + (k % 92) / 10.0 + (event_id % 21) / 10.0 AS DECIMAL(8,2))
           AS process_temperature_k,
         CAST(1168 + (event_id * 37 + k * 13) % 1719 AS INT) AS rotational_speed_rpm,
         CAST(value AS DECIMAL(8,2)) AS torque_nm,
         CAST((event_id * 7 + user_id) % 254 AS INT) AS tool_wear_min,
         CASE WHEN event_id % 43 = 0 OR event_id % 53 = 0 OR event_id % 61 = 0
                OR event_id % 97 = 0 OR event_id % 211 = 0 THEN 1 ELSE 0 END
           AS machine_failure,
         CASE WHEN event_id % 97 = 0 THEN 1 ELSE 0 END AS twf,
         CASE WHEN event_id % 43 = 0 THEN 1 ELSE 0 END AS hdf,
         CASE WHEN event_id % 53 = 0 THEN 1 ELSE 0 END AS pwf,
         CASE WHEN event_id % 61 = 0 THEN 1 ELSE 0 END AS osf,
         CASE WHEN event_id % 89 = 0 THEN 1 ELSE 0 END AS rnf,
         '{SOURCE}' AS source_dataset,
         '{BATCH}' AS batch_id,
         '{LOADED_AT}' AS ingested_at
  FROM base),
again AS (
  SELECT * REPLACE (udi * 2 - 1 AS udi,
                    CAST(torque_nm + 1 AS DECIMAL(8,2)) AS torque_nm,
                    1 - machine_failure AS machine_failure,
                    1 - hdf AS hdf,
                    '{NEXT_BATCH}' AS batch_id,
                    '{RELOADED_AT}' AS ingested_at)
  FROM raw)"""

_GRADE = """CASE product_type WHEN 'L' THEN 'Low (50% variant)'
           WHEN 'M' THEN 'Medium (30% variant)' WHEN 'H' THEN 'High (20% variant)'
           ELSE 'Unknown' END"""


def _staged(name: str, source: str) -> str:
    return f"""
{name}_cents AS (
  SELECT *, CAST(air_temperature_k * 100 AS BIGINT) - 27315 AS air_c,
         CAST(process_temperature_k * 100 AS BIGINT) - 27315 AS process_c,
         CAST(torque_nm * 100 AS BIGINT) AS torque_c
  FROM {source}),
{name} AS (
  SELECT udi, product_id, product_type, {_GRADE} AS product_quality_grade,
         air_c, process_c, process_c - air_c AS diff_c, rotational_speed_rpm AS rpm,
         torque_c,
         CAST((6283185307::HUGEINT * rotational_speed_rpm * torque_c + 30000000000000)
              // 60000000000000 AS BIGINT) AS power_c,
         tool_wear_min AS wear, tool_wear_min * torque_c AS strain_c, machine_failure,
         machine_failure = 1 AS is_failure,
         CASE WHEN hdf = 1 THEN 'Heat Dissipation Failure'
              WHEN pwf = 1 THEN 'Power Failure'
              WHEN osf = 1 THEN 'Overstrain Failure'
              WHEN twf = 1 THEN 'Tool Wear Failure'
              WHEN rnf = 1 THEN 'Random Failure'
              WHEN machine_failure = 1 THEN 'Unclassified Failure'
              ELSE 'Normal Operation' END AS mode,
         batch_id, torque_nm
  FROM {name}_cents)"""


_STAR = f"""{_RAW},{_staged("s", "raw")},
noted AS (SELECT DISTINCT product_id FROM s WHERE mode = 'Unclassified Failure')"""


def _features_of(star: str, source: str = "s") -> str:
    return f"""{star},
rolled AS (
  SELECT *, avg(torque_nm) OVER w AS mean_t,
         coalesce(stddev_samp(torque_nm) OVER w, 0.01) AS std_t,
         avg(power_c / 100e0) OVER w AS mean_p,
         torque_c - lag(torque_c, 1, torque_c)
           OVER (PARTITION BY product_type ORDER BY udi) AS step_c
  FROM {source}
  WINDOW w AS (PARTITION BY product_type ORDER BY udi
               ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)),
scored AS (
  SELECT *, (CAST(torque_nm AS DOUBLE) - mean_t) / nullif(std_t, 0) AS z FROM rolled),
features AS (
  SELECT *, round(CAST(z AS DECIMAL(18,9)), 2) AS z2,
         coalesce(abs(z) > 2.5, FALSE) AS anomaly FROM scored)"""


_FEATURES = _features_of(_STAR)

_RAW_COLUMNS = """udi, product_id, product_type,
  CAST(air_temperature_k AS DOUBLE) AS air_temperature_k,
  CAST(process_temperature_k AS DOUBLE) AS process_temperature_k,
  CAST(rotational_speed_rpm AS BIGINT) AS rotational_speed_rpm,
  CAST(torque_nm AS DOUBLE) AS torque_nm, CAST(tool_wear_min AS BIGINT) AS tool_wear_min,
  CAST(machine_failure AS BIGINT) AS machine_failure, CAST(twf AS BIGINT) AS twf,
  CAST(hdf AS BIGINT) AS hdf, CAST(pwf AS BIGINT) AS pwf, CAST(osf AS BIGINT) AS osf,
  CAST(rnf AS BIGINT) AS rnf, source_dataset"""

_MEASURES = """air_c / 100e0 AS air_temp_c, process_c / 100e0 AS process_temp_c,
  diff_c / 100e0 AS temp_differential_c, CAST(rpm AS BIGINT) AS rotational_speed_rpm,
  torque_c / 100e0 AS torque_nm, power_c / 100e0 AS mechanical_power_kw,
  CAST(wear AS BIGINT) AS tool_wear_min, strain_c / 100e0 AS overstrain_metric"""

_READING = """CAST(rpm AS BIGINT) AS rotational_speed_rpm, torque_c / 100e0 AS torque_nm,
  diff_c / 100e0 AS temp_differential_c, power_c / 100e0 AS mechanical_power_kw,
  CAST(wear AS BIGINT) AS tool_wear_min"""

_ROLLING = """round(mean_t, 6) AS rolling_avg_torque, round(std_t, 6) AS rolling_std_torque,
  step_c / 100e0 AS torque_step_delta"""

_SCORE = "CAST(z2 AS DOUBLE) AS torque_z_score, anomaly AS is_torque_anomaly"

_FEED = f"""udi, product_id, product_type, product_quality_grade AS quality_grade, {_READING},
  mode AS failure_mode_name, is_failure, {_ROLLING}, {_SCORE}"""


def _q(ctes: str, body: str) -> str:
    return f"WITH {ctes.strip()}\n{body.strip()}"


def _mean(column: str, places: int = 2, count: str = "count(*)") -> str:
    """Half-up rounded mean of a non-negative column held in hundredths, or whole."""
    exact = f"(2 * sum({column}) + {count}) // (2 * {count})"
    return f"CAST({exact} AS DOUBLE)" + (" / 100e0" if places == 2 else "")


def _percent(part: str, whole: str, places: int = 2) -> str:
    scale = 100 * 10**places
    return (
        f"CAST((2 * {scale} * CAST({part} AS HUGEINT) + {whole}) // (2 * {whole})"
        f" AS DOUBLE) / {10**places}e0"
    )


def _failures(extra: str, star: str = _STAR) -> str:
    return f"""{star},
grouped AS (
  SELECT product_type, product_quality_grade AS quality_grade, mode AS failure_mode_name,
         count(*) AS n, {extra}
  FROM s WHERE is_failure GROUP BY 1, 2, 3),
ranked AS (
  SELECT *, dense_rank() OVER (PARTITION BY product_type ORDER BY n DESC) AS place,
         sum(n) OVER (PARTITION BY product_type) AS tier FROM grouped)"""


_ROOT_MEANS = f"""{_mean("diff_c")} AS avg_temp_diff_c, {_mean("rpm", 0)} AS avg_rpm,
         {_mean("torque_c")} AS avg_torque_nm, {_mean("power_c")} AS avg_power_kw"""
_ROOT = _failures(_ROOT_MEANS)
_SHARE = _percent("n", "tier")
_ROOT_BODY = f"""SELECT product_type, quality_grade, failure_mode_name,
  n AS occurrence_count, avg_temp_diff_c, avg_rpm, avg_torque_nm, avg_power_kw,
  CAST(place AS BIGINT) AS failure_rank_in_tier, {_SHARE} AS failure_pct_share
FROM ranked"""


def _leaders(n: int, where: str = "true") -> str:
    return f"""
SELECT udi, product_id, product_quality_grade AS quality_grade,
  strain_c / 100e0 AS overstrain_metric, CAST(wear AS BIGINT) AS tool_wear_min,
  torque_c / 100e0 AS torque_nm, diff_c / 100e0 AS temp_differential_c,
  power_c / 100e0 AS mechanical_power_kw, mode AS failure_mode_name, is_failure,
  CAST(dense_rank() OVER (ORDER BY strain_c DESC) AS BIGINT) AS risk_rank
FROM s WHERE {where} ORDER BY strain_c DESC, udi LIMIT {n}"""


# --- quality: one SELECT per check ---------------------------------------------


def _verdict(
    position, name, category, table, column, observed, threshold, passed, details, source,
    severity="CRITICAL",
) -> str:
    column_sql = f"'{column}'" if column else "CAST(NULL AS VARCHAR)"
    return f"""SELECT CAST({position} AS BIGINT) AS position, '{name}' AS check_name,
  '{category}' AS check_category, '{table}' AS table_name, {column_sql} AS column_name,
  CASE WHEN {passed} THEN 'PASSED' ELSE 'FAILED' END AS status,
  CAST({observed} AS DOUBLE) AS observed_value, CAST({threshold} AS DOUBLE)
  AS threshold_value, '{severity}' AS severity, {details} AS details FROM {source}"""


RAW_T = "raw.sensor_telemetry"
FACT_T = "warehouse.fact_sensor_telemetry"
EQ_T = "warehouse.dim_equipment"
FM_T = "warehouse.dim_failure_mode"
STG_T = "staging.stg_sensor_telemetry"
_EQUIPMENT = "(SELECT DISTINCT product_id FROM s)"


def _row_count(position, table, source, least) -> str:
    return _verdict(
        position, "check_row_count", "Volume", table, None, "n", least, f"n >= {least}",
        f"'Found ' || format('{{:,}}', n) || ' rows (expected >= {least:,})'",
        f"(SELECT count(*) AS n FROM {source})",
    )


def _nulls(position, table, column, source, expression, allowed=0.0) -> str:
    share = "CASE WHEN n = 0 THEN 0e0 ELSE bad / CAST(n AS DOUBLE) * 100e0 END"
    return _verdict(
        position, "check_null_percentage", "Completeness", table, column,
        f"round({share}, 4)", allowed, f"{share} <= {allowed}",
        f"format('{{:,}}', bad) || ' nulls out of ' || format('{{:,}}', n) || ' (' ||"
        f" printf('%.2f', {share}) || '% nulls, threshold <= {allowed}%)'",
        f"(SELECT count(*) AS n, count(*) FILTER (WHERE {expression} IS NULL) AS bad"
        f" FROM {source})",
    )


def _range(position, column, expression, low, high, shown) -> str:
    return _verdict(
        position, "check_numeric_range", "Validity", FACT_T, column, "bad", 0, "bad = 0",
        f"bad || ' out-of-bounds rows found. Allowed {shown}.'",
        f"(SELECT count(*) AS bad FROM s WHERE {expression} < {low}"
        f" OR {expression} > {high})",
    )


def _reference(position, column, dim, known) -> str:
    return _verdict(
        position, "check_referential_integrity", "Referential Integrity", FACT_T, column,
        "bad", 0, "bad = 0",
        f"bad || ' orphan records found in {FACT_T}.{column}"
        f" with no match in {dim}.{column}'",
        f"(SELECT count(*) AS bad FROM s WHERE NOT ({known}))",
    )


def _suite(raw_least: int, fact_least: int, equipment_least: int) -> str:
    return "\nUNION ALL ".join(
        [
            _row_count(1, RAW_T, "raw", raw_least),
            _row_count(2, FACT_T, "s", fact_least),
            _row_count(3, EQ_T, _EQUIPMENT, equipment_least),
            _nulls(4, FACT_T, "equipment_key", "s", "product_id"),
            _nulls(5, FACT_T, "torque_nm", "s", "torque_c"),
            _nulls(6, FACT_T, "rotational_speed_rpm", "s", "rpm"),
            _range(7, "rotational_speed_rpm", "rpm", 1000, 3500, "[1000, 3500]"),
            _range(8, "torque_nm", "torque_c", 100, 10000, "[1.0, 100.0]"),
            _range(9, "air_temp_c", "air_c", 1000, 5000, "[10.0, 50.0]"),
            _range(10, "tool_wear_min", "wear", 0, 300, "[0, 300]"),
            _reference(11, "equipment_key", EQ_T, "product_id IN (SELECT product_id FROM raw)"),
            _reference(12, "failure_mode_key", FM_T, "mode IS NOT NULL"),
        ]
    )


_LOG = f"""{_STAR},
first_run AS ({_suite(1_000, 1_000, 100)}),
second_run AS ({_suite(1_000, 1_000_000_000, 1_000)}),
log AS (
  SELECT position AS check_id, '{BATCH}' AS batch_id, * EXCLUDE (position),
         '{FIRST_RUN}' AS checked_at FROM first_run
  UNION ALL
  SELECT position + 12 AS check_id, '{NEXT_BATCH}' AS batch_id, * EXCLUDE (position),
         '{SECOND_RUN}' AS checked_at FROM second_run)"""

_PASSED = "count(*) FILTER (WHERE status = 'PASSED')"
_FAILED = "count(*) FILTER (WHERE status = 'FAILED')"

_LATEST = f"""{_LOG},
latest AS (SELECT * FROM log WHERE CAST(checked_at AS TIMESTAMP) >=
  (SELECT max(CAST(checked_at AS TIMESTAMP)) FROM log) - INTERVAL 5 MINUTE)"""

_LOG_COLUMNS = """check_id, batch_id, check_name, check_category, table_name, column_name,
  status, observed_value, threshold_value, severity, details, checked_at"""

# What a reload changes, for an id both batches have.
_RELOADED = {
    "air_temperature_k", "process_temperature_k", "rotational_speed_rpm", "torque_nm",
    "tool_wear_min", "machine_failure", "batch_id", "ingested_at",
}
_ALL_RAW = [
    "product_id", "product_type", "air_temperature_k", "process_temperature_k",
    "rotational_speed_rpm", "torque_nm", "tool_wear_min", "machine_failure", "twf", "hdf",
    "pwf", "osf", "rnf", "source_dataset", "batch_id", "ingested_at",
]


def _merged(updates: str, changed: set[str]) -> str:
    """The raw table after an upsert of ``updates``."""
    columns = []
    for c in _ALL_RAW:
        first, other = ("u", "r") if c in changed else ("r", "u")
        columns.append(
            f"CASE WHEN {first}.udi IS NULL THEN {other}.{c} ELSE {first}.{c} END AS {c}"
        )
    return f"""
merged AS (
  SELECT coalesce(r.udi, u.udi) AS udi, {", ".join(columns)}
  FROM raw r FULL OUTER JOIN {updates} u ON r.udi = u.udi)"""


# The star after a second batch.
_GROWN = f"""{_RAW},{_merged("again", _RELOADED)},{_staged("s", "merged")}"""


def _tiled(star: str) -> str:
    return f"""{star},
tiled AS (SELECT *, ntile(5) OVER (ORDER BY rpm, udi) AS tile FROM s)"""


_TILES = f"""SELECT CAST(tile AS BIGINT) AS speed_quintile,
  CAST(min(rpm) AS BIGINT) AS min_rpm, CAST(max(rpm) AS BIGINT) AS max_rpm,
  count(*) AS total_readings, count(*) FILTER (WHERE is_failure) AS failures_count,
  {_percent("count(*) FILTER (WHERE is_failure)", "count(*)")} AS failure_rate_pct
FROM tiled GROUP BY tile ORDER BY tile"""
_QUINTILES = _q(_tiled(_STAR), _TILES)

_STAMPED = f"SELECT {_RAW_COLUMNS}, batch_id, ingested_at FROM"

_PREVIEW_STAGING = f"""udi, product_id, product_type, product_quality_grade, {_MEASURES},
  mode AS failure_mode"""


def all_oracles() -> dict[str, str]:
    return {
        "raw_rename_lineage": _q(_RAW, f"{_STAMPED} raw"),
        "ingest_csv": _q(
            _RAW, f"{_STAMPED} (SELECT * REPLACE ('readings.csv' AS source_dataset) FROM raw)"
        ),
        "stream_ingest": _q(
            _RAW,
            f"SELECT {_RAW_COLUMNS}, ingested_at"
            " FROM (SELECT * REPLACE ('arrivals' AS source_dataset) FROM raw)",
        ),
        "full_load_twice": _q(
            _STAR,
            f"SELECT udi, product_id, mode AS failure_mode_name, {_MEASURES}, is_failure FROM s",
        ),
        "staging_features": _q(
            _STAR,
            f"""SELECT {_PREVIEW_STAGING}, CAST(machine_failure AS BIGINT)
            AS machine_failure, batch_id, '{LOADED_AT}' AS transformed_at FROM s""",
        ),
        "dim_equipment": _q(
            _STAR,
            f"""SELECT DISTINCT product_id, product_type, product_quality_grade
            AS quality_grade, '{LOADED_AT}' AS created_at, '{LOADED_AT}' AS updated_at
            FROM s""",
        ),
        "failure_mode_catalog": _q(
            _STAR,
            """SELECT v.failure_mode_name, v.severity_level, v.root_cause_category,
              count(s.udi) AS readings
            FROM (VALUES
              ('Normal Operation', 'None', 'Healthy'),
              ('Heat Dissipation Failure', 'Critical', 'Thermal Dissipation'),
              ('Power Failure', 'Critical', 'Electrical / Mechanical Power Load'),
              ('Overstrain Failure', 'High', 'Mechanical Stress / Fatigue'),
              ('Tool Wear Failure', 'Medium', 'Abrasive Wear'),
              ('Random Failure', 'Low', 'Stochastic Noise'),
              ('Unclassified Failure', 'High', 'Unknown'))
              AS v(failure_mode_name, severity_level, root_cause_category)
            LEFT JOIN s ON s.mode = v.failure_mode_name GROUP BY 1, 2, 3""",
        ),
        "fact_star": _q(
            _STAR,
            f"SELECT udi, product_id, mode AS failure_mode_name, {_MEASURES}, is_failure FROM s",
        ),
        "surrogate_key_props": _q(
            _STAR,
            """SELECT 'dim_equipment' AS table_name, count(DISTINCT product_id) AS total_keys,
              count(DISTINCT product_id) AS distinct_keys, CAST(1 AS BIGINT) AS least_key,
              count(DISTINCT product_id) AS greatest_key FROM s
            UNION ALL SELECT 'fact_sensor_telemetry', count(*), count(*), 1, count(*) FROM s""",
        ),
        "surrogate_keys_far": _q(
            _STAR,
            """SELECT 'dim_equipment' AS table_name, count(DISTINCT product_id) AS total_keys,
              count(DISTINCT product_id) AS distinct_keys, CAST(1 AS BIGINT) AS least_key,
              count(DISTINCT product_id) AS greatest_key FROM s
            UNION ALL SELECT 'fact_sensor_telemetry', count(*), count(*), 1, count(*) FROM s""",
        ),
        "stream_replay": _q(
            _RAW,
            f"""SELECT {_RAW_COLUMNS}, ingested_at, CAST(1 AS BIGINT) AS versions_written
            FROM (SELECT * REPLACE ('files' AS source_dataset) FROM raw)""",
        ),
        "run_with_summary": _q(
            _STAR,
            f"""SELECT *, raw_rows AS reported_raw_rows, fact_rows AS reported_fact_rows,
              failure_rows AS reported_failure_rows,
              passed_quality_checks AS reported_passed_quality_checks
            FROM (SELECT count(*) AS raw_rows, count(*) AS fact_rows,
              count(*) FILTER (WHERE is_failure) AS failure_rows,
              2 * (SELECT {_PASSED} FROM ({_suite(1, 1, 1)})) AS passed_quality_checks FROM s)""",
        ),
        "transforms_only": _q(_ROOT, _ROOT_BODY),
        "gate_failing": _q(
            f"""{_STAR}, verdicts AS ({_suite(1_000, 1_000_000_000, 1)})""",
            f"""SELECT position AS check_id, '{BATCH}' AS batch_id, * EXCLUDE (position),
              '{FIRST_RUN}' AS checked_at, TRUE AS run_stopped FROM verdicts""",
        ),
        "reload_changes": _q(
            _RAW,
            """SELECT * FROM (VALUES ('raw.sensor_telemetry'), ('staging.stg_sensor_telemetry'),
                ('warehouse.fact_sensor_telemetry')) t(table_name),
              (SELECT count(*) AS all_rows,
                 count(*) FILTER (WHERE u.udi IS NOT NULL AND NOT known_same) AS fresh_rows,
                 count(*) FILTER (WHERE r.udi IS NULL) AS new_rows,
                 count(*) FILTER (WHERE u.udi IS NOT NULL AND r.udi IS NOT NULL AND NOT known_same)
                   AS changed_rows,
                 count(*) FILTER (WHERE known_same) AS unchanged_rows
               FROM (SELECT *, udi % 4 = 3 AS third FROM raw) r FULL OUTER JOIN again u
                 ON r.udi = u.udi,
               LATERAL (SELECT coalesce(u.udi IS NOT NULL AND r.third, FALSE) AS known_same))""",
        ),
        "features_refresh": _q(
            _features_of(_GROWN),
            f"""SELECT {_FEED}, round(mean_p, 6) AS rolling_avg_power_kw FROM features""",
        ),
        "root_cause_partials": _q(_failures(_ROOT_MEANS, _GROWN), _ROOT_BODY),
        "layer_counts_partials": _q(
            _GROWN,
            """SELECT count(*) AS raw_rows, count(*) AS staging_rows, count(*) AS fact_rows,
              count(*) FILTER (WHERE is_failure) AS failure_rows FROM s""",
        ),
        "speed_quintiles_partials": _q(_tiled(_GROWN), _TILES),
        "leaderboard_bounds": _q(_GROWN, _leaders(25)),
        "rolling_far_id": _q(
            _features_of(
                f"""{_STAR}, far AS (
  SELECT * REPLACE (CASE WHEN udi = (SELECT max(udi) FROM s) THEN 1152921504606846976
    ELSE udi END AS udi) FROM s)""",
                "far",
            ),
            f"""SELECT udi, {_ROLLING}, {_SCORE} FROM features""",
        ),
        "upsert_partial": _q(f"{_RAW},{_merged('again', _RELOADED)}", f"{_STAMPED} merged"),
        "upsert_nothing": _q(
            _RAW,
            f"""{_STAMPED} raw UNION ALL
            {_STAMPED} again WHERE udi NOT IN (SELECT udi FROM raw)""",
        ),
        "upsert_last": _q(
            f"""{_RAW},
last_of AS (
  SELECT * EXCLUDE (udi, k), k AS udi FROM (
    SELECT *, (udi - 1) // 4 + 1 AS k,
           row_number() OVER (PARTITION BY (udi - 1) // 4 ORDER BY udi DESC) AS back
    FROM again) WHERE back = 1),{_merged("last_of", set(_ALL_RAW))}""",
            f"{_STAMPED} merged",
        ),
        "equipment_reload": _q(
            _STAR,
            f"""SELECT DISTINCT product_id, product_type, product_quality_grade
            AS quality_grade,
            CASE WHEN product_id IN (FROM noted) THEN '{LOADED_AT}' ELSE '{RELOADED_AT}'
            END AS created_at, '{RELOADED_AT}' AS updated_at,
            product_id IN (FROM noted) AS kept_key,
            product_id NOT IN (FROM noted) AS new_key FROM s""",
        ),
        "fact_reload": _q(
            _RAW,
            f"""SELECT coalesce(r.udi, u.udi) AS udi,
              CAST(coalesce(u.torque_nm, r.torque_nm) AS DOUBLE) AS torque_nm,
              coalesce(u.machine_failure, r.machine_failure) = 1 AS is_failure,
              CASE WHEN u.udi IS NULL THEN '{LOADED_AT}' ELSE '{RELOADED_AT}' END
              AS loaded_at, r.udi IS NOT NULL AS kept_key
            FROM raw r FULL OUTER JOIN again u ON r.udi = u.udi""",
        ),
        "incremental_catch_up": _q(
            _RAW,
            """SELECT coalesce(r.udi, u.udi) AS udi,
              CAST(coalesce(u.torque_nm, r.torque_nm) AS DOUBLE) AS torque_nm,
              coalesce(u.machine_failure, r.machine_failure) = 1 AS is_failure
            FROM raw r FULL OUTER JOIN again u ON r.udi = u.udi""",
        ),
        "anomaly_features": _q(
            _FEATURES,
            f"""SELECT {_FEED}, strain_c / 100e0 AS overstrain_metric,
              round(mean_p, 6) AS rolling_avg_power_kw FROM features""",
        ),
        "rolling_halo": _q(
            _FEATURES,
            f"""SELECT udi, product_type, {_ROLLING},
              round(mean_p, 6) AS rolling_avg_power_kw, {_SCORE} FROM features""",
        ),
        "features_table": _q(
            _FEATURES,
            f"""SELECT udi, product_id, round(mean_t, 6) AS rolling_avg_torque, {_SCORE}
            FROM features""",
        ),
        "anomaly_top_step": _q(
            _FEATURES,
            """SELECT udi, product_id, product_quality_grade AS quality_grade,
              torque_c / 100e0 AS torque_nm,
              CAST(round(CAST(mean_t AS DECIMAL(18,9)), 2) AS DOUBLE) AS rolling_mean,
              step_c / 100e0 AS step_delta, CAST(z2 AS DOUBLE) AS z_score
            FROM features WHERE anomaly ORDER BY abs(step_c) DESC, udi LIMIT 10""",
        ),
        "anomaly_feed": _q(
            _FEATURES,
            f"""SELECT {_FEED} FROM features WHERE anomaly
            ORDER BY abs(z2) DESC, udi LIMIT 50""",
        ),
        "anomaly_feed_all": _q(
            _FEATURES,
            f"""SELECT {_FEED} FROM features
            ORDER BY abs(z2) DESC NULLS FIRST, udi LIMIT 35""",
        ),
        "anomaly_preset": _q(
            _FEATURES,
            f"""SELECT udi, product_id, product_type,
              CAST(rpm AS BIGINT) AS rotational_speed_rpm, torque_c / 100e0 AS torque_nm,
              {_ROLLING}, {_SCORE}, mode AS failure_mode_name
            FROM features WHERE anomaly ORDER BY abs(z2) DESC, udi LIMIT 20""",
        ),
        "root_cause": _q(_ROOT, _ROOT_BODY),
        "failure_feed": _q(
            _ROOT,
            f"{_ROOT_BODY} ORDER BY product_type, failure_rank_in_tier, failure_mode_name",
        ),
        "failure_ranking": _q(
            _ROOT,
            f"""SELECT * EXCLUDE (avg_rpm, avg_torque_nm) FROM ({_ROOT_BODY})
            ORDER BY product_type, failure_rank_in_tier, failure_mode_name""",
        ),
        "tier_failures": _q(
            _failures(
                f"""{_mean("diff_c")} AS avg_thermal_delta_c,
                {_mean("power_c")} AS avg_power_kw"""
            ),
            f"""SELECT product_type, quality_grade, failure_mode_name, n AS failure_count,
              CAST(place AS BIGINT) AS rank_in_tier, {_SHARE} AS pct_of_tier_failures,
              avg_thermal_delta_c, avg_power_kw
            FROM ranked ORDER BY product_type, place, failure_mode_name""",
        ),
        "leaderboard": _q(_STAR, _leaders(25)),
        "leaderboard_gaps": _q(_STAR, _leaders(25, "product_id NOT LIKE '%3'")),
        "leaderboard_short": _q(_STAR, _leaders(15)),
        "stress_top": _q(
            _STAR,
            """SELECT udi, product_id, product_quality_grade AS quality_grade,
              CAST(wear AS BIGINT) AS tool_wear_min, torque_c / 100e0 AS torque_nm,
              strain_c / 100e0 AS overstrain_metric, mode AS failure_mode_name,
              CAST(dense_rank() OVER (ORDER BY strain_c DESC) AS BIGINT)
              AS global_stress_rank
            FROM s ORDER BY strain_c DESC, udi LIMIT 10""",
        ),
        "dense_rank_global": _q(
            _STAR,
            """SELECT udi, strain_c / 100e0 AS overstrain_metric,
              CAST(dense_rank() OVER (ORDER BY strain_c DESC) AS BIGINT) AS risk_rank
            FROM s""",
        ),
        "speed_quintiles": _QUINTILES,
        "speed_quintiles_by_cells": _QUINTILES,
        "ntile_rows": _q(
            _STAR,
            """SELECT udi, CAST(rpm AS BIGINT) AS rotational_speed_rpm,
              CAST(ntile(5) OVER (ORDER BY rpm, udi) AS BIGINT) AS speed_quintile FROM s""",
        ),
        "star_sample": _q(
            _STAR,
            """SELECT udi, product_id, product_type, product_quality_grade AS quality_grade,
              mode AS failure_mode_name,
              CASE mode WHEN 'Normal Operation' THEN 'None'
                WHEN 'Heat Dissipation Failure' THEN 'Critical'
                WHEN 'Power Failure' THEN 'Critical' WHEN 'Tool Wear Failure' THEN 'Medium'
                WHEN 'Random Failure' THEN 'Low' ELSE 'High' END AS severity_level,
              air_c / 100e0 AS air_temp_c, CAST(rpm AS BIGINT) AS rotational_speed_rpm,
              torque_c / 100e0 AS torque_nm, power_c / 100e0 AS mechanical_power_kw,
              is_failure
            FROM s ORDER BY udi LIMIT 25""",
        ),
        "orphans": _q(
            _STAR,
            """SELECT udi FROM s WHERE product_id NOT IN (FROM noted)
            ORDER BY udi LIMIT 10""",
        ),
        "orphan_rows": _q(
            _STAR, "SELECT udi FROM s WHERE product_id NOT IN (FROM noted)"
        ),
        "dq_row_count": _q(
            _STAR,
            _row_count(1, RAW_T, "raw", 1)
            + "\nUNION ALL "
            + _row_count(2, EQ_T, _EQUIPMENT, 10**9),
        ),
        "dq_nulls": _q(
            f"""{_STAR},
known AS (SELECT rpm, CASE WHEN torque_c <= 10000 THEN torque_c END AS torque FROM s)""",
            "\nUNION ALL ".join(
                [
                    _nulls(1, RAW_T, "torque_nm", "known", "torque"),
                    _nulls(2, RAW_T, "torque_nm", "known", "torque", 50.0),
                    _nulls(3, RAW_T, "rotational_speed_rpm", "known", "rpm"),
                ]
            ),
        ),
        "dq_range": _q(
            _STAR,
            _range(1, "rotational_speed_rpm", "rpm", 1000, 3500, "[1000, 3500]")
            + "\nUNION ALL "
            + _range(2, "torque_nm", "torque_c", 100, 10000, "[1.0, 100.0]"),
        ),
        "dq_range_extent": _q(
            _STAR,
            """SELECT count(*) AS out_of_bounds, min(torque_c) / 100e0 AS min_found,
              max(torque_c) / 100e0 AS max_found
            FROM s WHERE torque_c < 100 OR torque_c > 10000""",
        ),
        "dq_ri": _q(
            _STAR,
            _reference(
                1, "equipment_key", "warehouse.noted_equipment", "product_id IN (FROM noted)"
            )
            + "\nUNION ALL "
            + _reference(
                2, "equipment_key", EQ_T, "product_id IN (SELECT product_id FROM raw)"
            ),
        ),
        "dq_suite": _q(_STAR, _suite(1_000, 1_000, 1_000)),
        "dq_unique": _q(
            _STAR,
            "\nUNION ALL ".join(
                _verdict(
                    position, "check_unique", "Uniqueness", table, column, "n", 0, "n = 0",
                    "format('{:,}', n) || ' keys occur more than once'",
                    f"(SELECT count(*) AS n FROM (SELECT {column} FROM {source}"
                    f" GROUP BY 1 HAVING count(*) > 1))",
                )
                for position, (table, column, source) in enumerate(
                    [
                        (RAW_T, "udi", "raw"),
                        (RAW_T, "product_id", "raw"),
                        (EQ_T, "product_id", _EQUIPMENT),
                    ],
                    1,
                )
            ),
        ),
        "dq_not_null": _q(
            _STAR,
            _nulls(1, STG_T, "torque_nm", "s", "torque_c")
            + "\nUNION ALL "
            + _nulls(2, STG_T, "failure_mode", "s", "mode"),
        ),
        "dq_accepted": _q(
            _STAR,
            "\nUNION ALL ".join(
                _verdict(
                    position, "check_accepted_values", "Validity", RAW_T, "product_type",
                    "n", 0, "n = 0",
                    f"format('{{:,}}', n) || ' values outside the list: {', '.join(listed)}'",
                    "(SELECT count(*) AS n FROM raw WHERE product_type NOT IN"
                    f" ({', '.join(repr(v) for v in listed)}))",
                    severity,
                )
                for position, (listed, severity) in enumerate(
                    [(["L", "M", "H"], "CRITICAL"), (["L", "M"], "WARNING")], 1
                )
            ),
        ),
        "dq_fits_type": _q(
            _STAR,
            _verdict(
                1, "check_fits_type", "Validity", RAW_T, "product_id", "n", 0, "n = 0",
                "format('{:,}', n) || ' values do not fit varchar(3)'",
                "(SELECT count(*) AS n FROM raw WHERE length(product_id) > 3)",
            )
            + "\nUNION ALL "
            + _verdict(
                2, "check_fits_type", "Validity", RAW_T, "torque_nm", "n", 0, "n = 0",
                "format('{:,}', n) || ' values do not fit decimal(4,2)'",
                "(SELECT count(*) AS n FROM raw WHERE abs(torque_nm) >= 100)",
            ),
        ),
        "dq_parity": _q(
            _STAR,
            "\nUNION ALL ".join(
                _verdict(
                    position, "check_row_parity", "Volume", RAW_T, None, "abs(n - m)", 0,
                    "n = m", "format('{:,}', n) || ' rows against ' || format('{:,}', m)",
                    f"(SELECT (SELECT count(*) FROM raw) AS n, count(*) AS m FROM {other})",
                )
                for position, other in ((1, "s"), (2, _EQUIPMENT))
            ),
        ),
        "dq_by_category": _q(
            _LOG,
            f"""SELECT check_category, count(*) AS total_assertions_run,
              {_PASSED} AS passed_count, {_FAILED} AS failed_count,
              {_percent(_PASSED, "count(*)")} AS pass_rate_pct
            FROM log GROUP BY 1 ORDER BY pass_rate_pct DESC, check_category""",
        ),
        "dq_by_table": _q(
            _LOG,
            f"""SELECT table_name, count(*) AS total_checks, {_PASSED} AS passed,
              {_FAILED} AS failed, {_percent(_PASSED, "count(*)", 1)} AS pass_rate_pct
            FROM log GROUP BY 1 ORDER BY 1""",
        ),
        "dq_stats": _q(
            _LOG,
            f"""SELECT count(*) AS total_checks, {_PASSED} AS total_passed,
              {_FAILED} AS total_failed FROM log""",
        ),
        "dq_latest_run": _q(
            _LATEST,
            f"""SELECT count(*) AS total, {_PASSED} AS passed, {_FAILED} AS failed
            FROM latest""",
        ),
        "dq_pass_rate": _q(
            _LATEST,
            f"""SELECT CAST({_percent(_PASSED, "count(*)", 0)} AS BIGINT) AS pass_rate_pct
            FROM latest""",
        ),
        "dq_recent": _q(
            _LOG,
            f"""SELECT {_LOG_COLUMNS} FROM log
            ORDER BY checked_at DESC, check_id DESC LIMIT 20""",
        ),
        "layer_counts": _q(
            _STAR,
            """SELECT (SELECT count(*) FROM raw) AS raw, count(*) AS staging,
              count(*) AS fact, count(DISTINCT product_id) AS dim_equipment,
              CAST(7 AS BIGINT) AS dim_failure_mode FROM s""",
        ),
        "run_summary": _q(
            _LOG,
            f"""SELECT (SELECT count(*) FROM raw) AS raw_rows, count(*) AS fact_rows,
              count(*) FILTER (WHERE is_failure) AS failure_rows,
              (SELECT {_PASSED} FROM log) AS passed_quality_checks FROM s""",
        ),
        "warehouse_summary": _q(
            f"{_FEATURES},{_LATEST[len(_STAR) + 1 :]}",
            f"""SELECT (SELECT count(*) FROM raw) AS raw, count(*) AS staging,
              count(*) AS fact, count(DISTINCT product_id) AS dim_equipment,
              CAST(7 AS BIGINT) AS dim_failure_mode,
              (SELECT count(*) FROM features WHERE anomaly) AS anomalies,
              (SELECT count(*) FROM log) AS total_historical_checks,
              (SELECT count(*) FROM latest) AS latest_total,
              (SELECT {_PASSED} FROM latest) AS latest_passed,
              (SELECT {_FAILED} FROM latest) AS latest_failed,
              '{BATCH}' AS last_batch_id, 'SUCCESS' AS last_status,
              count(*) AS last_row_count, '{LOADED_AT}' AS last_ingested_at FROM s""",
        ),
        "last_ingestion": _q(
            _RAW,
            f"""SELECT '{NEXT_BATCH}' AS batch_id, 'SUCCESS' AS status,
              count(*) AS row_count, '{RELOADED_AT}' AS ingested_at FROM raw""",
        ),
        "search_readings": _q(
            _STAR,
            r"""SELECT udi, product_id, product_quality_grade AS quality_grade,
              mode AS failure_mode_name, torque_c / 100e0 AS torque_nm,
              CAST(rpm AS BIGINT) AS rotational_speed_rpm, is_failure
            FROM s
            WHERE contains(lower(concat(udi, product_id, product_quality_grade, mode,
              regexp_replace(CAST(torque_nm AS VARCHAR), '\.?0+$', ''), rpm,
              upper(CAST(is_failure AS VARCHAR)))), 'power failure3')""",
        ),
        "preview_raw": _q(
            _RAW,
            """SELECT udi, product_id, CAST(air_temperature_k AS DOUBLE) AS air_temperature_k,
              CAST(process_temperature_k AS DOUBLE) AS process_temperature_k,
              CAST(rotational_speed_rpm AS BIGINT) AS rotational_speed_rpm,
              CAST(torque_nm AS DOUBLE) AS torque_nm,
              CAST(tool_wear_min AS BIGINT) AS tool_wear_min,
              CAST(machine_failure AS BIGINT) AS machine_failure, batch_id, ingested_at
            FROM raw ORDER BY udi LIMIT 15""",
        ),
        "preview_staging": _q(
            _STAR, f"SELECT {_PREVIEW_STAGING} FROM s ORDER BY udi LIMIT 15"
        ),
        "preview_warehouse_fact": _q(
            _STAR,
            """SELECT row_number() OVER (ORDER BY udi) AS telemetry_key, udi,
              air_c / 100e0 AS air_temp_c, diff_c / 100e0 AS temp_differential_c,
              CAST(rpm AS BIGINT) AS rotational_speed_rpm, torque_c / 100e0 AS torque_nm,
              power_c / 100e0 AS mechanical_power_kw, CAST(wear AS BIGINT) AS tool_wear_min,
              strain_c / 100e0 AS overstrain_metric, is_failure
            FROM s ORDER BY udi LIMIT 15""",
        ),
        "preview_warehouse_dim_equipment": _q(
            _STAR,
            f"""SELECT row_number() OVER (ORDER BY product_id) AS equipment_key, product_id,
              product_type, quality_grade, '{LOADED_AT}' AS created_at,
              '{LOADED_AT}' AS updated_at
            FROM (SELECT DISTINCT product_id, product_type,
                    product_quality_grade AS quality_grade FROM s)
            ORDER BY product_id LIMIT 15""",
        ),
        "preview_analytics": _q(
            _FEATURES,
            f"""SELECT udi, product_id, product_type,
              CAST(rpm AS BIGINT) AS rotational_speed_rpm, torque_c / 100e0 AS torque_nm,
              {_ROLLING}, {_SCORE}, mode AS failure_mode_name
            FROM features ORDER BY udi LIMIT 15""",
        ),
        "preview_quality": _q(
            _LOG,
            f"""SELECT {_LOG_COLUMNS} FROM log
            ORDER BY checked_at DESC, check_id DESC LIMIT 20""",
        ),
        "readonly_sql": _q(
            _STAR,
            """SELECT udi, product_id, torque_c / 100e0 AS torque_nm FROM s
            WHERE is_failure ORDER BY torque_c DESC, udi LIMIT 50""",
        ),
    }
