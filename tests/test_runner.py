import pytest
from conftest import LATER, NOW, reading
from gaugeworks.plans import quality as gate
from gaugeworks.plans.runner import (
    check_parity,
    materialize_features,
    run_load,
    run_transforms,
)
from gaugeworks.plans.summary import run_summary, warehouse_summary
from gaugeworks.schemas import (
    CHECK_LOG_TABLE,
    EQUIPMENT_TABLE,
    FACT_TABLE,
    INGESTION_LOG_TABLE,
    RAW_COLUMN_MAP,
    RAW_TABLE,
    STAGING_TABLE,
)


@pytest.fixture
def csv(tmp_path):
    path = tmp_path / "readings.csv"
    lines = [",".join(RAW_COLUMN_MAP)]
    lines += [
        f"{u},M{u % 4},M,298.1,308.6,{1200 + u},{20 + u % 13}.5,{u},{u % 5 == 0:d},0,0,0,0,0"
        for u in range(1, 41)
    ]
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def run(warehouse, csv, batch, now, checks=None, **options):
    checks = gate.standard_checks(40, 40, 4) if checks is None else checks
    return run_load(
        warehouse.spark, csv, warehouse.root, now, batch, checks, rows=16, **options
    )


def state(warehouse):
    fact = warehouse.read(FACT_TABLE).drop("loaded_at")
    dim = warehouse.read(EQUIPMENT_TABLE).drop("updated_at")
    return sorted(fact.collect()), sorted(dim.collect())


@pytest.mark.parametrize("incremental", [False, True])
def test_two_runs_equal_one(warehouse, csv, incremental):
    first = run(warehouse, csv, "b1", NOW, incremental=incremental, summary=True)
    assert first.status == "success" and first.batch_id == "b1"
    assert [s.stage for s in first.steps] == [
        "extract",
        "staging",
        "star",
        "quality",
        "views",
    ]
    assert first.summary == {
        "raw_rows": 40,
        "fact_rows": 40,
        "failure_rows": 8,
        "passed_quality_checks": 12,
    }
    before = state(warehouse)
    again = run(warehouse, csv, "b2", LATER, incremental=incremental, summary=True)
    assert again.status == "success" and state(warehouse) == before
    # the whole history, not this run
    assert again.summary["passed_quality_checks"] == 24
    features = warehouse.spark.table("analytics_v_sensor_anomaly_features")
    assert features.count() == 40


def test_run_stops_at_the_gate(warehouse, csv):
    report = run(warehouse, csv, "b1", NOW, gate.standard_checks(41, 1, 1))
    assert report.status == "error" and report.error.startswith("quality:")
    assert [s.stage for s in report.steps] == ["extract", "staging", "star"]
    assert warehouse.read(CHECK_LOG_TABLE).count() == 12


def test_readings_set_aside_do_not_break_later_runs(warehouse, csv):
    """Two readings without torque stay out of staging; the layers still agree."""
    lines = open(csv).read().splitlines()
    for at in (5, 9):
        cells = lines[at].split(",")
        lines[at] = ",".join([*cells[:6], "", *cells[7:]])
    open(csv, "w").write("\n".join(lines) + "\n")
    checks = gate.standard_checks(40, 38, 4)
    refused = run(warehouse, csv, "b0", NOW, checks)
    assert refused.error.startswith("staging:")
    for batch, incremental in (("b1", False), ("b2", True), ("b3", False)):
        report = run(
            warehouse, csv, batch, LATER, checks, incremental=incremental, on_missing="quarantine"
        )
        assert report.status == "success", report.error
    assert warehouse.read(FACT_TABLE).count() == 38


def test_lost_rows_are_noticed(warehouse, csv):
    run(warehouse, csv, "b1", NOW)
    fact = warehouse.read(FACT_TABLE)
    warehouse.replace(FACT_TABLE, fact.filter("udi <> 7"), starts=warehouse.blocks(FACT_TABLE))
    with pytest.raises(ValueError, match="got lost"):
        check_parity(warehouse)


def test_a_stopped_run_is_in_the_log(warehouse, csv):
    run(warehouse, csv, "b1", NOW)
    report = run(warehouse, csv, "b2", LATER, gate.standard_checks(41, 1, 1))
    assert report.status == "error"
    log = warehouse.read(CHECK_LOG_TABLE)
    rows = {r.check_id: (r.batch_id, r.status) for r in log.collect()}
    assert sorted(rows) == list(range(1, 25))
    assert rows[13] == ("b2", "FAILED") and rows[1] == ("b1", "PASSED")
    assert gate.logged_run(log, 13, 12).filter("batch_id = 'b2'").count() == 12


def test_an_unchanged_file_writes_nothing(warehouse, csv):
    run(warehouse, csv, "b1", NOW)
    versions = {t: warehouse.next_version(t) for t in (RAW_TABLE, STAGING_TABLE, FACT_TABLE, EQUIPMENT_TABLE)}
    report = run(warehouse, csv, "b2", LATER, incremental=True, skip_unchanged=True)
    assert report.status == "success"
    assert {t: warehouse.next_version(t) for t in versions} == versions


def test_run_without_a_file(warehouse, tmp_path):
    report = run(warehouse, str(tmp_path / "none.csv"), "b1", NOW)
    assert report.status == "error" and report.steps == []


def test_transforms_and_materialised_features(warehouse, raw, tmp_path):
    from gaugeworks.sources.readings import load_raw

    load_raw(warehouse, raw([reading(udi=u) for u in range(1, 5)]))
    views = run_transforms(warehouse.spark, warehouse.root, NOW, rows=16)
    assert len(views) == 3
    path = str(tmp_path / "features")
    materialize_features(warehouse, path)
    assert warehouse.spark.read.parquet(path).count() == 4


def test_summaries(warehouse, csv):
    run(warehouse, csv, "b1", NOW)
    layers = {
        "raw": RAW_TABLE,
        "staging": STAGING_TABLE,
        "fact": FACT_TABLE,
        "dim_equipment": EQUIPMENT_TABLE,
    }
    frames = {name: warehouse.read(table) for name, table in layers.items()}
    features = warehouse.spark.table("analytics_v_sensor_anomaly_features")
    log = warehouse.read(CHECK_LOG_TABLE)
    row = warehouse_summary(
        frames, features, log, warehouse.read(INGESTION_LOG_TABLE)
    ).first()
    assert (row.raw, row.staging, row.fact, row.dim_equipment) == (40, 40, 40, 4)
    assert (row.latest_total, row.latest_passed, row.latest_failed) == (12, 12, 0)
    assert row.last_batch_id == "b1" and row.last_status == "SUCCESS"


def test_summary_of_an_empty_warehouse(warehouse):
    row = run_summary(
        warehouse.read(RAW_TABLE),
        warehouse.read(FACT_TABLE),
        warehouse.read(CHECK_LOG_TABLE),
    ).first()
    assert set(row.asDict().values()) == {0}
