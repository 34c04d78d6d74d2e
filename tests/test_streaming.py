"""Streams: micro-batches set down, known again, and merged as if in turn."""

from decimal import Decimal

import pytest
from conftest import NOW
from gaugeworks.schemas import INGESTION_LOG_TABLE, RAW_COLUMN_MAP, RAW_TABLE
from gaugeworks.sources.logs import ingestion_states
from gaugeworks.streaming import ingest
from gaugeworks.streaming.ingest import csv_stream, ingest_stream, merge_arrivals

HEADER = ",".join(RAW_COLUMN_MAP)


def line(udi, torque="40.5", twf=0, kind="M"):
    return f"{udi},{kind}1,{kind},298.1,308.6,1500,{torque},10,0,{twf},0,0,0,0"


@pytest.fixture
def folder(tmp_path):
    path = tmp_path / "in"
    path.mkdir()

    def put(name, *lines):
        (path / name).write_text("\n".join([HEADER, *lines]) + "\n")
        return str(path)

    return put


def run(warehouse, path, tmp_path, **options):
    source = csv_stream(warehouse.spark, path, files_per_batch=1)
    ingest_stream(source, warehouse, str(tmp_path / "checkpoint"), "s", NOW, **options)


def rows(warehouse):
    found = warehouse.read(RAW_TABLE).collect()
    return {r.udi: (r.torque_nm, r.twf, r.batch_id) for r in found}


def test_small_batches_make_one_version(warehouse, folder, tmp_path):
    folder("a.csv", line(1), line(2, "41", 1))
    folder("b.csv", line(2, "50", 0), line(3))
    path = folder("c.csv", line(3, "60"), line(3, "61", 1))
    run(warehouse, path, tmp_path)
    assert warehouse.next_version(RAW_TABLE) == 2
    found = rows(warehouse)
    assert sorted(found) == [1, 2, 3]
    order = [name for _, _, name in sorted(found.values(), key=lambda v: v[2])]
    assert order[-1] == "s_000000002"
    states = {r.batch_id: (r.status, r.row_count) for r in ingestion_states(warehouse.read(INGESTION_LOG_TABLE)).collect()}
    assert states == {f"s_{n:09d}": ("SUCCESS", 2) for n in range(3)}
    run(warehouse, path, tmp_path)
    assert warehouse.next_version(RAW_TABLE) == 2
    folder("d.csv", line(4))
    run(warehouse, path, tmp_path)
    assert warehouse.next_version(RAW_TABLE) == 3 and sorted(rows(warehouse)) == [1, 2, 3, 4]


def test_batches_count_in_turn(spark):
    """Flags from the first batch that has a reading, measures from the last."""
    kind = "udi long, arrival int, _row_order int, " + ", ".join(
        f"{f.name} {f.dataType.simpleString()}" for f in ingest.READING if f.name != "udi"
    )

    def row(udi, arrival, order, torque, twf):
        return (udi, arrival, order, "M1", "M", Decimal(1), Decimal(1), 1, Decimal(torque), 1, 0, twf, 0, 0, 0, 0)

    given = [row(1, 0, 0, 10, 1), row(1, 0, 1, 11, 0), row(1, 2, 9, 13, 1), row(1, 1, 5, 12, 1), row(2, 1, 0, 7, 1)]
    frame = spark.createDataFrame(given, kind)
    found = {r.udi: (r.torque_nm, r.twf, r.arrival) for r in ingest.in_turn(frame).collect()}
    assert found == {1: (Decimal("13.00"), 0, 2), 2: (Decimal("7.00"), 1, 1)}


def test_a_batch_that_comes_again_is_known(warehouse, folder, tmp_path, monkeypatch):
    """The driver is lost between the commit and the stream's own note of it."""
    path = folder("a.csv", line(1))
    run(warehouse, path, tmp_path)
    before = rows(warehouse)

    def no_work(*args, **kwargs):
        raise AssertionError("the batch was known")

    monkeypatch.setattr(ingest, "load_raw", no_work)
    # a fresh checkpoint gives the number 0 again
    source = csv_stream(warehouse.spark, path, files_per_batch=1)
    ingest_stream(source, warehouse, str(tmp_path / "again"), "s", NOW)
    assert rows(warehouse) == before and warehouse.next_version(RAW_TABLE) == 2


def test_batches_set_down_before_a_loss_are_merged_later(warehouse, folder, tmp_path, monkeypatch):
    path = folder("a.csv", line(1))
    folder("b.csv", line(2))
    with monkeypatch.context() as patched:
        patched.setattr(ingest, "merge_arrivals", lambda *a: None)
        run(warehouse, path, tmp_path)
    assert warehouse.version(RAW_TABLE) == 0
    assert merge_arrivals(warehouse, "s", NOW) == [0, 1]
    assert sorted(rows(warehouse)) == [1, 2] and merge_arrivals(warehouse, "s", NOW) == []


def test_bad_rows_stop_or_are_set_aside(warehouse, folder, tmp_path):
    path = folder("a.csv", line(1), line(2, "many"))
    with pytest.raises(ValueError):
        run(warehouse, path, tmp_path)
    assert warehouse.version(RAW_TABLE) == 0
    assert merge_arrivals(warehouse, "s", NOW, on_reject="quarantine") == [0]
    assert sorted(rows(warehouse)) == [1]
