import os
from decimal import Decimal

import pytest
from conftest import LATER, NOW
from gaugeworks.operators.upsert import DuplicateKeyError
from gaugeworks.schemas import (
    INGESTION_LOG_TABLE,
    RAW_COLUMN_MAP,
    RAW_TABLE,
    REJECTS_TABLE,
)
from gaugeworks.sources.logs import ingestion_states
from gaugeworks.sources.readings import (
    RejectedRowsError,
    ingest_batch,
    new_batch_id,
    rename_columns,
)
from gaugeworks.streaming.ingest import csv_stream, ingest_stream

HEADER = ",".join(RAW_COLUMN_MAP)
LINE = "{udi},L{udi},L,298.1,308.6,1551,{torque},0,0,0,{hdf},0,0,0"


def line(udi, torque="42.8", hdf=0):
    return LINE.format(udi=udi, torque=torque, hdf=hdf)


@pytest.fixture
def csv(tmp_path):
    def write(*lines, name="readings.csv", header=HEADER):
        path = tmp_path / name
        path.write_text("\n".join([header, *lines]) + "\n")
        return str(path)

    return write


def load(warehouse, path, batch="b1", now=NOW, **options):
    return ingest_batch(
        warehouse.spark, path, warehouse.root, batch, now, rows=16, **options
    )


def states(warehouse):
    log = warehouse.read(INGESTION_LOG_TABLE)
    return {r.batch_id: r for r in ingestion_states(log).collect()}


def test_load_stamps_lineage(warehouse, csv):
    assert load(warehouse, csv(line(1), line(2))) == "b1"
    rows = {r.udi: r for r in warehouse.read(RAW_TABLE).collect()}
    assert rows[2].source_dataset == "readings.csv" and rows[2].batch_id == "b1"
    assert rows[1].ingested_at == NOW and rows[1].torque_nm == Decimal("42.80")
    assert states(warehouse)["b1"].status == "SUCCESS"
    assert states(warehouse)["b1"].row_count == 2


def test_reload_keeps_old_mode_flags(warehouse, csv):
    load(warehouse, csv(line(1, hdf=0), line(2)))
    load(warehouse, csv(line(1, "50.1", hdf=1), name="next.csv"), "b2", LATER)
    rows = {r.udi: r for r in warehouse.read(RAW_TABLE).collect()}
    assert rows[1].torque_nm == Decimal("50.10") and rows[1].hdf == 0
    assert rows[1].batch_id == "b2" and rows[1].source_dataset == "readings.csv"
    assert rows[2].batch_id == "b1"


def test_reload_can_update_everything(warehouse, csv):
    load(warehouse, csv(line(1, hdf=0)))
    load(warehouse, csv(line(1, hdf=1)), "b2", update_cols="all")
    assert warehouse.read(RAW_TABLE).first().hdf == 1


@pytest.mark.parametrize("text", ["", "NaN", "NA", "null", " n/a "])
def test_missing_measures_become_null(warehouse, csv, text):
    load(warehouse, csv(line(1, text)))
    assert warehouse.read(RAW_TABLE).first().torque_nm is None


def test_whole_numbers_with_a_point(warehouse, csv):
    load(warehouse, csv("1,L1,L,298.1,308.6,1551.0,42.8,0.0,0,0,0,0,0,0"))
    assert warehouse.read(RAW_TABLE).first().rotational_speed_rpm == 1551


def test_extra_columns_go_and_order_does_not_matter(warehouse, csv):
    header = "note," + HEADER
    load(warehouse, csv("hello," + line(1), header=header))
    assert warehouse.read(RAW_TABLE).first().udi == 1


def test_missing_column_raises(warehouse, csv, spark):
    with pytest.raises(ValueError, match="RNF"):
        load(warehouse, csv(line(1)[:-2], header=HEADER.replace(",RNF", "")))
    assert states(warehouse)["b1"].status == "FAILED"
    assert states(warehouse)["b1"].row_count == 1
    with pytest.raises(ValueError, match="lacks"):
        rename_columns(spark.range(1), {"nope": "x"})


def test_missing_file_raises(warehouse, tmp_path):
    with pytest.raises(FileNotFoundError):
        load(warehouse, str(tmp_path / "none.csv"))


@pytest.mark.parametrize("bad", [line(9, "heavy"), line(9, "1e9"), line(""), line("x")])
def test_unfit_rows_fail_the_batch_and_are_logged(warehouse, csv, bad):
    load(warehouse, csv(line(1)))
    with pytest.raises(RejectedRowsError):
        load(warehouse, csv(line(2), bad), "b2")
    assert [r.udi for r in warehouse.read(RAW_TABLE).collect()] == [1]
    state = states(warehouse)["b2"]
    assert state.status == "FAILED" and "do not fit" in state.error_message
    assert state.row_count == 2


def test_unfit_rows_can_be_set_aside(warehouse, csv):
    load(warehouse, csv(line(1), line(2, "heavy")), on_reject="quarantine")
    assert [r.udi for r in warehouse.read(RAW_TABLE).collect()] == [1]
    reject = warehouse.read(REJECTS_TABLE).first()
    assert reject.torque_nm == "heavy" and reject.reason.startswith("torque_nm")


def test_duplicates_fail_or_the_last_line_wins(warehouse, csv):
    path = csv(line(1, "10.0"), line(2), line(1, "20.0"))
    with pytest.raises(DuplicateKeyError):
        load(warehouse, path)
    assert states(warehouse)["b1"].status == "FAILED"
    load(warehouse, path, "b2", duplicates="last")
    rows = {r.udi: r.torque_nm for r in warehouse.read(RAW_TABLE).collect()}
    assert rows[1] == Decimal("20.00")


def test_batch_ids():
    assert new_batch_id(NOW).startswith("batch_20240101_000000_")
    assert new_batch_id() != new_batch_id()


def test_stream_takes_what_has_arrived(warehouse, csv, tmp_path, spark):
    folder, checkpoint = str(tmp_path / "in"), str(tmp_path / "checkpoint")
    (tmp_path / "in").mkdir()
    csv(line(1), line(2), name="in/one.csv")
    ingest_stream(csv_stream(spark, folder), warehouse, checkpoint, "arrivals", NOW)
    csv(line(2, "50.0"), line(3), name="in/two.csv")
    ingest_stream(csv_stream(spark, folder), warehouse, checkpoint, "arrivals", LATER)
    rows = {r.udi: r for r in warehouse.read(RAW_TABLE).collect()}
    assert sorted(rows) == [1, 2, 3]
    assert rows[2].torque_nm == Decimal("50.00") and rows[2].batch_id.endswith("1")
    assert {r.status for r in states(warehouse).values()} == {"SUCCESS"}
    assert len(states(warehouse)) == 2
    # nothing new: nothing changes
    before = warehouse.version(RAW_TABLE)
    ingest_stream(csv_stream(spark, folder), warehouse, checkpoint, "arrivals", LATER)
    assert warehouse.version(RAW_TABLE) == before


def test_stream_keeps_the_later_file(warehouse, csv, tmp_path, spark):
    (tmp_path / "in").mkdir()
    for place, torque in enumerate(["10.0", "30.0", "20.0"]):
        path = csv(line(1, torque), name=f"in/{9 - place}.csv")
        os.utime(path, (1_700_000_000 + place, 1_700_000_000 + place))
    stream = csv_stream(spark, str(tmp_path / "in"))
    ingest_stream(stream, warehouse, str(tmp_path / "checkpoint"), "a", NOW)
    assert warehouse.read(RAW_TABLE).first().torque_nm == Decimal("20.00")


def test_folder_of_files(warehouse, csv, tmp_path):
    (tmp_path / "in").mkdir()
    csv(line(1), name="in/a.csv")
    csv(line(2), name="in/b.csv")
    load(warehouse, str(tmp_path / "in"))
    assert sorted(r.udi for r in warehouse.read(RAW_TABLE).collect()) == [1, 2]
    swapped = HEADER.replace("TWF,HDF", "HDF,TWF")
    csv(line(3), name="in/c.csv", header=swapped)
    with pytest.raises(Exception, match="header"):
        load(warehouse, str(tmp_path / "in"), "b2")
    assert warehouse.read(RAW_TABLE).count() == 2
