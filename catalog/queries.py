"""One callable per registered query: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import fixture as fx
from gaugeworks.operators import quality as dq
from gaugeworks.operators.changes import change_counts, with_change
from gaugeworks.operators.ordinal import dense_rank_exact, ntile_exact
from gaugeworks.operators.search import search_rows
from gaugeworks.operators.upsert import upsert
from gaugeworks.plans import adhoc, analytics, summary
from gaugeworks.plans import quality as gate
from gaugeworks.plans.materialized import refresh_features
from gaugeworks.plans.partials import Partials, refresh_partials
from gaugeworks.plans.runner import materialize_features, run_load, run_transforms
from gaugeworks.plans.staging import load_staging, to_staging
from gaugeworks.plans.star import (
    build_dim_equipment,
    build_fact,
    equipment_rows,
    load_star,
    merge_fact,
)
from gaugeworks.schemas import (
    CHECK_LOG_TABLE,
    EQUIPMENT_TABLE,
    FACT_TABLE,
    FAILURE_MODE_TABLE,
    FEATURES_TABLE,
    INGESTION_LOG_TABLE,
    RAW,
    RAW_COLUMN_MAP,
    RAW_TABLE,
    READING,
    STAGING_TABLE,
)
from gaugeworks.session import landed, scratch_path, written
from gaugeworks.sources.events import readings_from_events
from gaugeworks.sources.logs import latest_ingestion
from gaugeworks.sources.readings import (
    FILE_ORDER,
    RELOAD_COLUMNS,
    add_lineage,
    cast_readings,
    compared_columns,
    file_order,
    ingest_batch,
    load_batch,
    load_raw,
    rename_columns,
)
from gaugeworks.sources.tables import Warehouse
from gaugeworks.streaming.ingest import csv_stream, ingest_stream

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}


def _query(function: Query) -> Query:
    """Register a query; its result is cast to types every engine has."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fx.comparable(function(spark, sf_dir))

    _QUERIES[function.__name__] = run
    return function


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


# --- loading ------------------------------------------------------------------


def _as_source_file(readings: DataFrame) -> DataFrame:
    return readings.select(
        *[F.col(c).cast("string").alias(h) for h, c in RAW_COLUMN_MAP.items()]
    )


@_query
def raw_rename_lineage(spark, sf_dir):
    renamed = rename_columns(_as_source_file(fx.readings(spark, sf_dir)), RAW_COLUMN_MAP)
    typed = cast_readings(renamed).filter("reject_reason IS NULL")
    stamped = add_lineage(typed, fx.SOURCE, fx.BATCH, fx.LOADED_AT)
    return stamped.select(*RAW.names)


@_query
def ingest_csv(spark, sf_dir):
    path = scratch_path(spark, "csv") + "/readings.csv"
    source = _as_source_file(fx.readings(spark, sf_dir))
    source.write.option("header", True).csv(path)
    root = scratch_path(spark, "warehouse")
    ingest_batch(spark, path, root, fx.BATCH, fx.LOADED_AT)
    return Warehouse(spark, root).read(RAW_TABLE)


@_query
def stream_ingest(spark, sf_dir):
    # as a pattern, since a stream takes a single file only where a pattern finds it
    arrived = (
        spark.readStream.schema(fx.events(spark, sf_dir).schema)
        .parquet(f"{sf_dir}/event[s].parquet")
        .select("*", file_order().alias(FILE_ORDER))
    )
    source = readings_from_events(arrived, FILE_ORDER)
    warehouse = Warehouse(spark, scratch_path(spark, "warehouse"))
    checkpoint = scratch_path(spark, "stream")
    ingest_stream(source, warehouse, checkpoint, "arrivals", fx.LOADED_AT)
    return warehouse.read(RAW_TABLE).drop("batch_id")


@_query
def stream_replay(spark, sf_dir):
    """Three files in three micro-batches, of which one comes again: one version of raw."""
    path = scratch_path(spark, "csv")
    for part in range(3):
        some = fx.readings(spark, sf_dir).filter(F.col("udi") % 3 == part)
        _as_source_file(some).coalesce(1).write.option("header", True).csv(f"{path}/part={part}")
    warehouse = Warehouse(spark, scratch_path(spark, "warehouse"))
    checkpoint = scratch_path(spark, "stream")
    for _ in range(2):
        source = csv_stream(spark, f"{path}/*", files_per_batch=1)
        ingest_stream(source, warehouse, checkpoint, "files", fx.LOADED_AT)
    version = F.lit(warehouse.next_version(RAW_TABLE) - 1).alias("versions_written")
    return warehouse.read(RAW_TABLE).drop("batch_id").select("*", version)


def _source_csv(spark, sf_dir) -> str:
    path = scratch_path(spark, "csv") + "/readings.csv"
    source = _as_source_file(fx.readings(spark, sf_dir))
    source.write.option("header", True).csv(path)
    return path


def _passing_checks() -> list:
    checks = gate.standard_checks(1, 1, 1)
    # torque leaves its range in this data, which must not stop the load
    checks[7] = dq.check_numeric_range(FACT_TABLE, "torque_nm", 1.0, 100.0, "WARNING")
    return checks


@_query
def run_with_summary(spark, sf_dir):
    """The whole run, twice; the second one's summary."""
    path = _source_csv(spark, sf_dir)
    root = scratch_path(spark, "warehouse")
    for batch, now in ((fx.BATCH, fx.LOADED_AT), (fx.NEXT_BATCH, fx.RELOADED_AT)):
        report = run_load(
            spark, path, root, now, batch, _passing_checks(), incremental=True, summary=True
        )
        if report.status != "success":
            raise RuntimeError(report.error)
    names = ["raw_rows", "fact_rows", "failure_rows", "passed_quality_checks"]
    warehouse = Warehouse(spark, root)
    frame = summary.run_summary(
        warehouse.read(RAW_TABLE), warehouse.read(FACT_TABLE), warehouse.read(CHECK_LOG_TABLE)
    )
    told = [F.lit(report.summary[n]).cast("bigint").alias(f"reported_{n}") for n in names]
    return frame.select(*names, *told)


@_query
def transforms_only(spark, sf_dir):
    """Staging, star and views from a raw table that is there; the views answer."""
    root = scratch_path(spark, "warehouse")
    with landed(fx.raw_batch(spark, sf_dir), "landing") as batch:
        load_raw(Warehouse(spark, root), batch)
    views = run_transforms(spark, root, fx.LOADED_AT)
    return views[adhoc.ROOT_CAUSE_VIEW]


@_query
def gate_failing(spark, sf_dir):
    """A run that its gate stops, and what the log then has about it."""
    path = _source_csv(spark, sf_dir)
    root = scratch_path(spark, "warehouse")
    checks = gate.standard_checks(1_000, 1_000_000_000, 1)
    report = run_load(spark, path, root, fx.FIRST_RUN, fx.BATCH, checks)
    stopped = report.status == "error" and len(report.steps) == 3
    log = Warehouse(spark, root).read(CHECK_LOG_TABLE)
    return log.withColumn("run_stopped", F.lit(stopped))


@_query
def full_load_twice(spark, sf_dir):
    path = _source_csv(spark, sf_dir)
    root = scratch_path(spark, "warehouse")
    checks = _passing_checks()
    for batch, now in ((fx.BATCH, fx.LOADED_AT), (fx.NEXT_BATCH, fx.RELOADED_AT)):
        report = run_load(spark, path, root, now, batch, checks, incremental=True)
        if report.status != "success":
            raise RuntimeError(report.error)
    return _natural_fact(analytics.Star.of(Warehouse(spark, root)))


@_query
def staging_features(spark, sf_dir):
    return to_staging(fx.raw(spark, sf_dir), fx.LOADED_AT)


@_query
def dim_equipment(spark, sf_dir):
    return fx.star(spark, sf_dir).equipment.drop("equipment_key")


@_query
def failure_mode_catalog(spark, sf_dir):
    star = fx.star(spark, sf_dir)
    found = star.fact.groupBy("failure_mode_key").agg(F.count("*").alias("readings"))
    return star.modes.join(F.broadcast(found), "failure_mode_key", "left").select(
        "failure_mode_name",
        "severity_level",
        "root_cause_category",
        F.coalesce("readings", F.lit(0)).alias("readings"),
    )


def _natural_fact(star: analytics.Star) -> DataFrame:
    return star.joined().select(
        "udi",
        "product_id",
        "failure_mode_name",
        "air_temp_c",
        "process_temp_c",
        "temp_differential_c",
        "rotational_speed_rpm",
        "torque_nm",
        "mechanical_power_kw",
        "tool_wear_min",
        "overstrain_metric",
        "is_failure",
    )


@_query
def fact_star(spark, sf_dir):
    return _natural_fact(fx.star(spark, sf_dir))


def _key_props(star: analytics.Star) -> DataFrame:
    parts = []
    for table, frame, key in (
        ("dim_equipment", star.equipment, "equipment_key"),
        ("fact_sensor_telemetry", star.fact, "telemetry_key"),
    ):
        # counting keys in two steps keeps COUNT(DISTINCT) out of one task
        per_key = frame.groupBy(key).agg(F.count("*").alias("n"))
        parts.append(
            per_key.agg(
                F.lit(table).alias("table_name"),
                F.sum("n").alias("total_keys"),
                F.count("*").alias("distinct_keys"),
                F.min(key).alias("least_key"),
                F.max(key).alias("greatest_key"),
            )
        )
    return parts[0].unionByName(parts[1])


@_query
def surrogate_key_props(spark, sf_dir):
    return _key_props(fx.star(spark, sf_dir))


@_query
def surrogate_keys_far(spark, sf_dir):
    """The same from ids a trillion apart, or as far as they stay below the last one, and
    that one at 2 ** 62, in blocks of 700 rows."""
    ids = fx.raw(spark, sf_dir).agg(F.max("udi").alias("last"), F.max(F.abs("udi")).alias("most")).first()
    step = 1 << min(40, 62 - (ids.most or 0).bit_length())
    far = F.when(F.col("udi") == ids.last, F.lit(1 << 62)).otherwise(F.col("udi") * F.lit(step))
    warehouse = Warehouse(spark, scratch_path(spark, "far"), rows=700)
    with landed(fx.raw(spark, sf_dir).withColumn("udi", far), "far") as batch:
        load_raw(warehouse, batch)
    load_staging(warehouse, fx.LOADED_AT)
    load_star(warehouse, fx.LOADED_AT)
    return _key_props(analytics.Star.of(warehouse))


# --- upserts ------------------------------------------------------------------


@_query
def upsert_partial(spark, sf_dir):
    return upsert(
        fx.raw(spark, sf_dir), fx.second_batch(spark, sf_dir), ["udi"], RELOAD_COLUMNS
    )


@_query
def upsert_nothing(spark, sf_dir):
    return upsert(
        fx.raw(spark, sf_dir),
        fx.second_batch(spark, sf_dir),
        ["udi"],
        on_conflict="nothing",
    )


@_query
def upsert_last(spark, sf_dir):
    """Every key comes twice in the batch; the later reading wins."""
    doubled = fx.second_batch(spark, sf_dir).withColumn("_seq", F.col("udi"))
    doubled = doubled.withColumn("udi", F.expr("(udi - 1) div 4 + 1"))
    return upsert(
        fx.raw(spark, sf_dir),
        doubled,
        ["udi"],
        "all",
        duplicates="last",
        order_by="_seq",
    )


@_query
def equipment_reload(spark, sf_dir):
    """Machines with an unclassified failure first, then all machines."""
    staging = fx.warehouse(spark, sf_dir).read(STAGING_TABLE)
    empty = Warehouse(spark, scratch_path(spark, "empty")).read(EQUIPMENT_TABLE)
    noted = staging.filter("failure_mode = 'Unclassified Failure'")
    first = build_dim_equipment(equipment_rows(noted), empty, fx.LOADED_AT)
    first = written(first, "equipment")
    second = build_dim_equipment(equipment_rows(staging), first, fx.RELOADED_AT)
    second = written(second, "equipment")
    old = first.select("product_id", F.col("equipment_key").alias("_old_key"))
    top = first.agg(F.max("equipment_key").alias("top")).scalar()
    return second.join(old, "product_id", "left").select(
        "product_id",
        "product_type",
        "quality_grade",
        "created_at",
        "updated_at",
        F.coalesce(F.col("_old_key") == F.col("equipment_key"), F.lit(False)).alias(
            "kept_key"
        ),
        (F.col("equipment_key") > top).alias("new_key"),
    )


@_query
def fact_reload(spark, sf_dir):
    """A second batch merged into the fact: known rows keep their key."""
    star = fx.star(spark, sf_dir)
    staging = to_staging(fx.second_batch(spark, sf_dir), fx.RELOADED_AT)
    rows = build_fact(staging, star.equipment, star.modes, fx.RELOADED_AT)
    first = fx.warehouse(spark, sf_dir).mark(FACT_TABLE, "leased") + 1
    merged = merge_fact(star.fact, rows, first)
    old = star.fact.select("udi", F.col("telemetry_key").alias("_old_key"))
    return merged.join(old, "udi", "left").select(
        "udi",
        "torque_nm",
        "is_failure",
        "loaded_at",
        F.coalesce(F.col("_old_key") == F.col("telemetry_key"), F.lit(False)).alias(
            "kept_key"
        ),
    )


def _half_known(spark, sf_dir) -> DataFrame:
    """The second batch, of which the readings with ``udi % 4 = 3`` come as they were."""
    again, first = fx.second_batch(spark, sf_dir), fx.raw_batch(spark, sf_dir)
    same = F.col("udi") % 4 == 3
    known = first.select("udi").join(again.select("udi"), "udi", "left_semi")
    restored = first.join(known, "udi", "left_semi").filter(same)
    others = again.join(restored.select("udi"), "udi", "left_anti")
    stamps = {"batch_id": F.lit(fx.NEXT_BATCH), "ingested_at": F.lit(fx.RELOADED_AT).cast("timestamp")}
    return others.unionByName(restored.withColumns(stamps))


@_query
def reload_changes(spark, sf_dir):
    """What a batch does to raw: its rows by kind, and the stamps after loading it without
    the unchanged ones, layer by layer."""
    warehouse = Warehouse(spark, scratch_path(spark, "reload"), rows=1_000)
    with landed(fx.raw_batch(spark, sf_dir), "landing") as batch:
        load_raw(warehouse, batch)
    load_staging(warehouse, fx.LOADED_AT)
    load_star(warehouse, fx.LOADED_AT)
    batch = written(_half_known(spark, sf_dir), "landing")
    compared = compared_columns(RELOAD_COLUMNS)
    told = with_change(batch, warehouse.read(RAW_TABLE), ["udi"], compared)
    counts = written(change_counts(told), "counts")
    load_raw(warehouse, batch, skip_unchanged=True)
    load_staging(warehouse, fx.RELOADED_AT, pending_only=True, skip_unchanged=True)
    load_star(warehouse, fx.RELOADED_AT, pending_only=True, skip_unchanged=True)
    stamped = []
    for table, column in (
        (RAW_TABLE, "ingested_at"),
        (STAGING_TABLE, "transformed_at"),
        (FACT_TABLE, "loaded_at"),
    ):
        fresh = F.count_if(F.col(column) == F.lit(fx.RELOADED_AT)).alias("fresh_rows")
        rows = warehouse.read(table).agg(F.lit(table).alias("table_name"), F.count("*").alias("all_rows"), fresh)
        stamped.append(rows)
    both = stamped[0].unionByName(stamped[1]).unionByName(stamped[2])
    return both.select("*", *[counts.select(c).scalar().alias(c) for c in counts.columns])


def _two_loads(spark, sf_dir) -> Warehouse:
    """A warehouse in small blocks whose fact grew by a second batch; its partial aggregates
    and stored features were made before that and brought up to it."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _followed:
        warehouse = Warehouse(spark, scratch_path(spark, "followed"), rows=1_000)
        for batch, now in (
            (fx.raw_batch(spark, sf_dir), fx.LOADED_AT),
            (fx.second_batch(spark, sf_dir), fx.RELOADED_AT),
        ):
            with landed(batch, "landing") as rows:
                load_raw(warehouse, rows)
            load_staging(warehouse, now, pending_only=True)
            load_star(warehouse, now, pending_only=True)
            refresh_partials(warehouse)
            refresh_features(warehouse)
        _followed[key] = warehouse
    return _followed[key]


_followed: dict[tuple[str, str], Warehouse] = {}


@_query
def features_refresh(spark, sf_dir):
    """Stored features after a second batch: only rows that it reaches were made again."""
    stored = _two_loads(spark, sf_dir).read(FEATURES_TABLE)
    return _six_places(stored).drop("overstrain_metric")


@_query
def root_cause_partials(spark, sf_dir):
    return Partials.of(_two_loads(spark, sf_dir)).root_cause()


@_query
def layer_counts_partials(spark, sf_dir):
    return Partials.of(_two_loads(spark, sf_dir)).counts_row()


@_query
def speed_quintiles_partials(spark, sf_dir):
    return Partials.of(_two_loads(spark, sf_dir)).speed_quintiles()


@_query
def leaderboard_bounds(spark, sf_dir):
    """The leaderboard from the blocks whose maxima reach it."""
    return Partials.of(_two_loads(spark, sf_dir)).leaderboard()


@_query
def incremental_catch_up(spark, sf_dir):
    """A batch that reached raw only, then an incremental load after the next one."""
    warehouse = Warehouse(spark, scratch_path(spark, "catch-up"))
    for batch in (fx.raw_batch(spark, sf_dir), fx.second_batch(spark, sf_dir)):
        load_raw(warehouse, written(batch, "landing"))
    load_staging(warehouse, fx.RELOADED_AT, pending_only=True)
    load_star(warehouse, fx.RELOADED_AT, pending_only=True)
    return warehouse.read(FACT_TABLE).select("udi", "torque_nm", "is_failure")


# --- analytics ----------------------------------------------------------------


def _six_places(df: DataFrame) -> DataFrame:
    """Unrounded view columns at the precision engines agree on."""
    names = ["rolling_avg_torque", "rolling_std_torque", "rolling_avg_power_kw"]
    return df.withColumns({c: F.round(c, 6) for c in names if c in df.columns})


def _features(spark, sf_dir, **options) -> DataFrame:
    return analytics.anomaly_features(fx.star(spark, sf_dir), **options)


@_query
def anomaly_features(spark, sf_dir):
    return _six_places(_features(spark, sf_dir))


@_query
def rolling_halo(spark, sf_dir):
    """The same features from blocks of 64 ids, so that nearly all frames cross one."""
    return _six_places(_features(spark, sf_dir, rows=64)).select(
        "udi",
        "product_type",
        "rolling_avg_torque",
        "rolling_std_torque",
        "torque_step_delta",
        "rolling_avg_power_kw",
        "torque_z_score",
        "is_torque_anomaly",
    )


@_query
def rolling_far_id(spark, sf_dir):
    """The features while the last reading has an id far off all others."""
    star = fx.star(spark, sf_dir)
    last = star.fact.agg(F.max("udi")).scalar()
    far = F.when(F.col("udi") == last, F.lit(1 << 60)).otherwise(F.col("udi"))
    star = replace(star, fact=star.fact.withColumn("udi", far))
    return _six_places(analytics.anomaly_features(star, rows=300)).select(
        "udi",
        "rolling_avg_torque",
        "rolling_std_torque",
        "torque_step_delta",
        "torque_z_score",
        "is_torque_anomaly",
    )


@_query
def features_table(spark, sf_dir):
    """The features written once and read back."""
    path = scratch_path(spark, "features")
    materialize_features(fx.warehouse(spark, sf_dir), path)
    return _six_places(spark.read.parquet(path)).select(
        "udi", "product_id", "rolling_avg_torque", "torque_z_score", "is_torque_anomaly"
    )


@_query
def anomaly_top_step(spark, sf_dir):
    return analytics.top_steps(_features(spark, sf_dir))


@_query
def anomaly_feed(spark, sf_dir):
    return _six_places(analytics.anomaly_feed(_features(spark, sf_dir)))


@_query
def anomaly_feed_all(spark, sf_dir):
    feed = analytics.anomaly_feed(_features(spark, sf_dir), 35, anomaly_only=False)
    return _six_places(feed)


@_query
def anomaly_preset(spark, sf_dir):
    return _six_places(analytics.anomaly_preset(_features(spark, sf_dir)))


@_query
def root_cause(spark, sf_dir):
    return analytics.root_cause(fx.star(spark, sf_dir))


@_query
def failure_feed(spark, sf_dir):
    return analytics.failure_feed(fx.star(spark, sf_dir))


@_query
def failure_ranking(spark, sf_dir):
    return analytics.failure_ranking(fx.star(spark, sf_dir))


@_query
def tier_failures(spark, sf_dir):
    return analytics.tier_failures(fx.star(spark, sf_dir))


@_query
def leaderboard(spark, sf_dir):
    return analytics.leaderboard(fx.star(spark, sf_dir))


@_query
def leaderboard_gaps(spark, sf_dir):
    """The leaderboard while a tenth of the machines have no dimension row."""
    star = fx.star(spark, sf_dir)
    known = star.equipment.filter(~F.col("product_id").endswith("3"))
    return analytics.leaderboard(replace(star, equipment=known))


@_query
def leaderboard_short(spark, sf_dir):
    return analytics.leaderboard(fx.star(spark, sf_dir), 15)


@_query
def stress_top(spark, sf_dir):
    return analytics.stress_top(fx.star(spark, sf_dir))


@_query
def dense_rank_global(spark, sf_dir):
    rows = fx.star(spark, sf_dir).fact.select("udi", "overstrain_metric")
    return dense_rank_exact(rows, "overstrain_metric", "udi", name="risk_rank", scale=2)


@_query
def speed_quintiles(spark, sf_dir):
    return analytics.speed_quintiles(fx.star(spark, sf_dir))


@_query
def speed_quintiles_by_cells(spark, sf_dir):
    """The same report from few cells at a time, so that several levels are opened."""
    return analytics.speed_quintiles(fx.star(spark, sf_dir), max_cells=64)


@_query
def ntile_rows(spark, sf_dir):
    rows = fx.star(spark, sf_dir).fact.select("udi", "rotational_speed_rpm")
    return ntile_exact(rows, 5, "rotational_speed_rpm", "udi", name="speed_quintile")


@_query
def star_sample(spark, sf_dir):
    return analytics.star_sample(fx.star(spark, sf_dir))


def _noted_equipment(star: analytics.Star) -> DataFrame:
    """Only the machines that ever had an unclassified failure."""
    noted = star.modes.filter("failure_mode_name = 'Unclassified Failure'")
    keys = star.fact.join(F.broadcast(noted), "failure_mode_key", "left_semi")
    return keys.select("equipment_key").distinct()


@_query
def orphans(spark, sf_dir):
    star = fx.star(spark, sf_dir)
    found = analytics.orphans(
        star.fact, "equipment_key", _noted_equipment(star), "equipment_key"
    )
    return found.select("udi")


@_query
def orphan_rows(spark, sf_dir):
    star = fx.star(spark, sf_dir)
    found = analytics.orphans(
        star.fact, "equipment_key", _noted_equipment(star), "equipment_key", n=None
    )
    return found.select("udi")


# --- quality ------------------------------------------------------------------


def _verdicts(tables: dict[str, DataFrame], checks: list) -> DataFrame:
    return dq.run_suite(tables, checks)


def _tables(spark, sf_dir) -> dict[str, DataFrame]:
    warehouse = fx.warehouse(spark, sf_dir)
    tables = gate.tables_of(warehouse)
    tables[STAGING_TABLE] = warehouse.read(STAGING_TABLE)
    return tables


@_query
def dq_row_count(spark, sf_dir):
    return _verdicts(
        _tables(spark, sf_dir),
        [dq.check_row_count(RAW_TABLE, 1), dq.check_row_count(EQUIPMENT_TABLE, 10**9)],
    )


@_query
def dq_nulls(spark, sf_dir):
    """Torque beyond the sensor's range is unknown."""
    raw = fx.raw(spark, sf_dir).withColumn(
        "torque_nm", F.when(F.col("torque_nm") <= 100, F.col("torque_nm"))
    )
    return _verdicts(
        {RAW_TABLE: raw},
        [
            dq.check_null_percentage(RAW_TABLE, "torque_nm"),
            dq.check_null_percentage(RAW_TABLE, "torque_nm", 50.0),
            dq.check_null_percentage(RAW_TABLE, "rotational_speed_rpm"),
        ],
    )


@_query
def dq_range(spark, sf_dir):
    return _verdicts(
        _tables(spark, sf_dir),
        [
            dq.check_numeric_range(FACT_TABLE, "rotational_speed_rpm", 1000, 3500),
            dq.check_numeric_range(FACT_TABLE, "torque_nm", 1.0, 100.0),
        ],
    )


@_query
def dq_range_extent(spark, sf_dir):
    fact = fx.star(spark, sf_dir).fact
    return dq.out_of_range(fact, "torque_nm", 1.0, 100.0)


@_query
def dq_ri(spark, sf_dir):
    star = fx.star(spark, sf_dir)
    noted = "warehouse.noted_equipment"
    tables = _tables(spark, sf_dir) | {noted: _noted_equipment(star)}
    return _verdicts(
        tables,
        [
            dq.check_referential_integrity(FACT_TABLE, "equipment_key", noted, "equipment_key"),
            dq.check_referential_integrity(
                FACT_TABLE, "equipment_key", EQUIPMENT_TABLE, "equipment_key"
            ),
        ],
    )


@_query
def dq_suite(spark, sf_dir):
    return _verdicts(_tables(spark, sf_dir), gate.standard_checks(1_000, 1_000, 1_000))


@_query
def dq_unique(spark, sf_dir):
    return _verdicts(
        _tables(spark, sf_dir),
        [
            dq.check_unique(RAW_TABLE, "udi"),
            dq.check_unique(RAW_TABLE, "product_id"),
            dq.check_unique(EQUIPMENT_TABLE, "product_id"),
        ],
    )


@_query
def dq_not_null(spark, sf_dir):
    return _verdicts(
        _tables(spark, sf_dir),
        [
            dq.check_not_null(STAGING_TABLE, "torque_nm"),
            dq.check_not_null(STAGING_TABLE, "failure_mode"),
        ],
    )


@_query
def dq_accepted(spark, sf_dir):
    return _verdicts(
        _tables(spark, sf_dir),
        [
            dq.check_accepted_values(RAW_TABLE, "product_type", ["L", "M", "H"]),
            dq.check_accepted_values(RAW_TABLE, "product_type", ["L", "M"], "WARNING"),
        ],
    )


@_query
def dq_fits_type(spark, sf_dir):
    return _verdicts(
        _tables(spark, sf_dir),
        [
            dq.check_fits_type(RAW_TABLE, "product_id", "varchar(3)"),
            dq.check_fits_type(RAW_TABLE, "torque_nm", "decimal(4,2)"),
        ],
    )


@_query
def dq_parity(spark, sf_dir):
    return _verdicts(
        _tables(spark, sf_dir),
        [
            dq.check_row_parity(RAW_TABLE, FACT_TABLE),
            dq.check_row_parity(RAW_TABLE, EQUIPMENT_TABLE),
        ],
    )


@_query
def dq_by_category(spark, sf_dir):
    return gate.quality_by_category(fx.check_log(spark, sf_dir))


@_query
def dq_by_table(spark, sf_dir):
    return gate.quality_by_table(fx.check_log(spark, sf_dir))


@_query
def dq_stats(spark, sf_dir):
    return gate.quality_stats(fx.check_log(spark, sf_dir))


@_query
def dq_latest_run(spark, sf_dir):
    return gate.latest_run_counts(fx.check_log(spark, sf_dir))


@_query
def dq_pass_rate(spark, sf_dir):
    return gate.pass_rate_pct(gate.latest_run(fx.check_log(spark, sf_dir)))


@_query
def dq_recent(spark, sf_dir):
    return gate.recent_checks(fx.check_log(spark, sf_dir), 20)


# --- summaries, previews, ad-hoc ------------------------------------------------


def _layers(spark, sf_dir) -> dict[str, DataFrame]:
    warehouse = fx.warehouse(spark, sf_dir)
    return {
        "raw": warehouse.read(RAW_TABLE),
        "staging": warehouse.read(STAGING_TABLE),
        "fact": warehouse.read(FACT_TABLE),
        "dim_equipment": warehouse.read(EQUIPMENT_TABLE),
        "dim_failure_mode": warehouse.read(FAILURE_MODE_TABLE),
    }


@_query
def layer_counts(spark, sf_dir):
    return summary.counts_row(_layers(spark, sf_dir))


@_query
def run_summary(spark, sf_dir):
    layers = _layers(spark, sf_dir)
    return summary.run_summary(
        layers["raw"], layers["fact"], fx.check_log(spark, sf_dir)
    )


@_query
def warehouse_summary(spark, sf_dir):
    return summary.warehouse_summary(
        _layers(spark, sf_dir),
        _features(spark, sf_dir),
        fx.check_log(spark, sf_dir),
        fx.warehouse(spark, sf_dir).read(INGESTION_LOG_TABLE),
    )


@_query
def last_ingestion(spark, sf_dir):
    """Two audited loads of all readings, then the log's newest batch."""
    warehouse = Warehouse(spark, scratch_path(spark, "warehouse"))
    text = fx.readings(spark, sf_dir)
    text = text.select(*[F.col(c).cast("string").alias(c) for c in READING.names])
    load_batch(warehouse, text, fx.SOURCE, fx.BATCH, fx.LOADED_AT)
    load_batch(warehouse, text, fx.SOURCE, fx.NEXT_BATCH, fx.RELOADED_AT)
    return latest_ingestion(warehouse.read(INGESTION_LOG_TABLE))


@_query
def search_readings(spark, sf_dir):
    star = fx.star(spark, sf_dir)
    rows = star.joined().select(
        "udi",
        "product_id",
        "quality_grade",
        "failure_mode_name",
        "torque_nm",
        "rotational_speed_rpm",
        "is_failure",
    )
    return search_rows(rows, "POWER failure3")


def _frame(spark, sf_dir, table: str) -> DataFrame:
    if table == adhoc.FEATURES_VIEW:
        return _features(spark, sf_dir)
    if table == CHECK_LOG_TABLE:
        return fx.check_log(spark, sf_dir)
    return fx.warehouse(spark, sf_dir).read(table)


def _preview(layer: str, *drop: str) -> None:
    def run(spark, sf_dir):
        table = adhoc.layer_of(layer).table
        frames = {table: _frame(spark, sf_dir, table)}
        return _six_places(adhoc.preview(frames, layer)).drop(*drop)

    run.__name__ = f"preview_{layer}"
    _query(run)


_preview("raw")
_preview("staging")
# surrogate keys are any unique numbers: compare what they point to elsewhere
_preview("warehouse_fact", "equipment_key", "failure_mode_key")
_preview("warehouse_dim_equipment")
_preview("analytics")
_preview("quality")


@_query
def readonly_sql(spark, sf_dir):
    fx.warehouse(spark, sf_dir).register_views()
    return adhoc.readonly_frame(
        spark,
        """SELECT f.udi, e.product_id, f.torque_nm
           FROM warehouse_fact_sensor_telemetry f
           JOIN warehouse_dim_equipment e ON f.equipment_key = e.equipment_key
           WHERE f.is_failure -- a comment that says DROP
           ORDER BY f.torque_nm DESC, f.udi;""",
        limit=50,
    )
