"""What the physical plans must look like, whatever the data size."""

import re

import pytest
from conftest import NOW, raw_frame, reading
from gaugeworks.operators.quality import orphan_count
from gaugeworks.plans import analytics
from gaugeworks.plans.analytics import Star
from gaugeworks.plans.staging import REQUIRED_INPUTS, incomplete, load_staging, to_staging
from gaugeworks.plans.star import load_star
from gaugeworks.schemas import RAW_TABLE, STAGING
from gaugeworks.sources.readings import load_raw
from gaugeworks.sources.tables import Warehouse
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def warehouse(spark, tmp_path_factory):
    warehouse = Warehouse(spark, str(tmp_path_factory.mktemp("plans")), rows=64)
    readings = [reading(udi=u, machine_failure=u % 2) for u in range(1, 20)]
    load_raw(warehouse, raw_frame(spark, readings))
    load_staging(warehouse, NOW)
    load_star(warehouse, NOW)
    return warehouse


@pytest.fixture
def star(warehouse):
    return Star.of(warehouse)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_top_k_never_sorts_the_table(star):
    for frame in (
        analytics.leaderboard(star),
        analytics.stress_top(star),
        analytics.star_sample(star),
    ):
        text = plan(frame)
        assert "TakeOrderedAndProject" in text
        # the only single-partition exchange ranks the k rows of the top-k
        for part in text.split("Exchange SinglePartition")[1:]:
            assert "TakeOrderedAndProject" in part


def test_quintiles_have_no_window_and_no_row_shuffle(star):
    text = plan(analytics.speed_quintiles(star))
    assert "Window" not in text and "SinglePartition" not in text
    assert "partial_count" in text


def test_features_window_is_partitioned_by_block(star):
    text = plan(analytics.anomaly_features(star))
    assert re.search(r"Exchange hashpartitioning\(product_type#\d+, _block#\d+", text)
    # one exchange, one sort and one window serve all the rolling columns
    main = text.split("Union")[0]
    assert main.count("Exchange hashpartitioning") == 1
    assert "WindowGroupLimit" in text


def test_anti_joins(star):
    frame = analytics.orphans(
        star.fact, "equipment_key", star.equipment, "equipment_key"
    )
    assert "LeftAnti" in plan(frame)
    counted = plan(
        orphan_count(star.fact, "equipment_key", star.equipment, "equipment_key")
    )
    # rows are counted per key before the shuffle
    assert "LeftAnti" in counted and "partial_count" in counted


def test_root_cause_reads_failures_and_few_columns(star):
    text = plan(analytics.tier_failures(star))
    assert re.search(r"PushedFilters: \[[^]]*EqualTo\(is_failure,true\)", text)
    schema = re.search(r"ReadSchema: struct<(equipment_key:bigint,failure_mode_key[^>]*)>", text)
    assert "rotational_speed_rpm" not in schema[1] and "udi" not in schema[1]
    # aggregated by key below the first dimension join
    assert re.search(r"Join.*\n(.*\n)*.*HashAggregate\(keys=\[equipment_key", text)


def test_staging_is_one_narrow_stage(warehouse):
    assert "Exchange" not in plan(to_staging(warehouse.read(RAW_TABLE), NOW))


def test_missing_inputs_are_looked_for_by_the_scan(warehouse):
    text = plan(warehouse.read(RAW_TABLE).filter(incomplete()))
    assert re.search(r"PushedFilters: \[Or\(.*IsNull\(air_temperature_k\)", text)


def test_required_inputs_cover_the_required_columns(warehouse):
    raw = warehouse.read(RAW_TABLE)
    for name in REQUIRED_INPUTS:
        kind = raw.schema[name].dataType
        row = to_staging(raw.withColumn(name, F.lit(None).cast(kind)), NOW).first()
        assert any(row[f.name] is None for f in STAGING if not f.nullable)
    assert all(v is not None for v in to_staging(raw, NOW).first())
