import pytest
from conftest import NOW, reading
from gaugeworks.operators.blocks import LEAST_KEY
from gaugeworks.plans.staging import to_staging
from gaugeworks.schemas import (
    CHECK_LOG_TABLE,
    EQUIPMENT_TABLE,
    INGESTION_LOG_TABLE,
    RAW_TABLE,
    STAGING_TABLE,
)
from gaugeworks.sources.logs import ingestion_states, latest_ingestion, log_ingestion
from gaugeworks.sources.readings import load_raw
from gaugeworks.sources.tables import CommitConflict
from pyspark.sql import functions as F


def udis(frame):
    return sorted(r.udi for r in frame.select("udi").collect())


def test_missing_table_is_empty_with_its_schema(warehouse):
    frame = warehouse.read(EQUIPMENT_TABLE)
    assert frame.isEmpty() and "equipment_key" in frame.columns


def test_unpublished_version_is_invisible(warehouse, raw):
    warehouse.replace(RAW_TABLE, raw([reading(udi=1)]))
    staged = warehouse.stage(RAW_TABLE, raw([reading(udi=2)]))
    assert udis(warehouse.read(RAW_TABLE)) == [1]
    warehouse.publish(staged)
    assert udis(warehouse.read(RAW_TABLE)) == [2]


def load(warehouse, raw, udis, batch="b1"):
    load_raw(warehouse, raw([reading(udi=u, batch_id=batch) for u in udis]))


def test_merge_rewrites_only_touched_blocks(warehouse, raw):
    load(warehouse, raw, range(1, 61))
    starts = warehouse.blocks(RAW_TABLE)
    assert starts[0] == LEAST_KEY and 4 <= len(starts) <= 9
    assert max(warehouse.sizes(RAW_TABLE).values()) <= 16
    load(warehouse, raw, [starts[2], starts[2] + 1], "b2")
    assert warehouse.pending_blocks(RAW_TABLE, 1) == [starts[2]]
    rows = {r.udi: r.batch_id for r in warehouse.read(RAW_TABLE).collect()}
    assert sorted(rows) == list(range(1, 61))
    assert {u for u, b in rows.items() if b == "b2"} == {starts[2], starts[2] + 1}
    inside = udis(warehouse.read(RAW_TABLE, blocks=[starts[2]]))
    assert inside == [u for u in rows if starts[2] <= u < starts[3]]


def test_blocks_are_cut_as_they_fill_up(warehouse, raw):
    load(warehouse, raw, [5, 2**40, 2**61])
    assert warehouse.blocks(RAW_TABLE) == [LEAST_KEY]
    load(warehouse, raw, range(100, 160), "b2")
    load(warehouse, raw, [*range(-9, 1), 2**40 + 1], "b3")
    sizes = warehouse.sizes(RAW_TABLE)
    assert sum(sizes.values()) == 74 and max(sizes.values()) <= 32
    assert udis(warehouse.read(RAW_TABLE)) == [*range(-9, 1), 5, *range(100, 160), 2**40, 2**40 + 1, 2**61]


def test_coarser_blocks_of_another_table_are_found(warehouse, raw):
    load(warehouse, raw, range(1, 21))
    warehouse.replace(STAGING_TABLE, to_staging(warehouse.read(RAW_TABLE), NOW), starts=[LEAST_KEY, 15])
    load(warehouse, raw, range(21, 121), "b2")
    starts = warehouse.blocks(RAW_TABLE)
    for block in starts:
        want = [LEAST_KEY] if block < 15 else []
        after = [s for s in starts if s > block]
        if block >= 15 or not after or after[0] > 15:
            want.append(15)
        assert warehouse.overlapping(STAGING_TABLE, RAW_TABLE, [block]) == want


def test_unpublished_partial_version_is_invisible(warehouse, raw):
    load(warehouse, raw, [1, 100])
    lost = raw([reading(udi=1, batch_id="lost")])
    warehouse.stage(RAW_TABLE, lost, replaced=warehouse.blocks(RAW_TABLE))
    assert {r.batch_id for r in warehouse.read(RAW_TABLE).collect()} == {"b1"}
    # the next load takes a fresh number and does not pick up the lost one
    load(warehouse, raw, [100], "b3")
    rows = {r.udi: r.batch_id for r in warehouse.read(RAW_TABLE).collect()}
    assert rows == {1: "b1", 100: "b3"}


def test_a_load_that_dies_shows_in_no_table(warehouse, raw, monkeypatch):
    """All tables of a load hang on one file: it dies before that, or it is done."""
    load(warehouse, raw, [1])
    staged = [
        warehouse.stage(RAW_TABLE, raw([reading(udi=2)])),
        warehouse.stage(STAGING_TABLE, to_staging(raw([reading(udi=2)]), NOW)),
    ]

    def dies(draft, final):
        raise OSError("lost")

    monkeypatch.setattr(warehouse, "_rename", dies)
    with pytest.raises(OSError):
        warehouse.publish(*staged, marks={STAGING_TABLE: {"consumed": 2}})
    monkeypatch.undo()
    assert udis(warehouse.read(RAW_TABLE)) == [1] and warehouse.version(STAGING_TABLE) == 0
    assert warehouse.mark(STAGING_TABLE, "consumed") == 0
    warehouse.publish(*staged, marks={STAGING_TABLE: {"consumed": 2}})
    assert udis(warehouse.read(RAW_TABLE)) == udis(warehouse.read(STAGING_TABLE)) == [2]
    assert warehouse.mark(STAGING_TABLE, "consumed") == 2


def test_two_loads_cannot_both_commit(warehouse, raw, monkeypatch):
    load(warehouse, raw, [1])
    mine = warehouse.stage(RAW_TABLE, raw([reading(udi=2)]))
    load(warehouse, raw, [3])
    with pytest.raises(CommitConflict):
        warehouse.publish(mine)
    # and of two that read the same state, the one that names its file first wins
    state = warehouse._newest()
    monkeypatch.setattr(warehouse, "_newest", lambda: state)
    warehouse.publish(marks={RAW_TABLE: {"x": 1}})
    with pytest.raises(CommitConflict):
        warehouse.publish(marks={RAW_TABLE: {"x": 2}})
    monkeypatch.undo()
    assert warehouse.mark(RAW_TABLE, "x") == 1 and udis(warehouse.read(RAW_TABLE)) == [1, 3]


def test_leases_do_not_overlap(warehouse):
    firsts = [warehouse.lease(CHECK_LOG_TABLE, n) for n in (12, 5, 1)]
    assert firsts == [1, 13, 18]


def test_whole_version_ends_the_chain(warehouse, raw):
    load_raw(warehouse, raw([reading(udi=1), reading(udi=100)]))
    load_raw(warehouse, raw([reading(udi=100)]))
    warehouse.replace(RAW_TABLE, raw([reading(udi=7)]))
    assert udis(warehouse.read(RAW_TABLE)) == [7]


def test_only_logs_are_appended_to(warehouse, raw):
    with pytest.raises(ValueError):
        warehouse.append(RAW_TABLE, raw([reading()]))
    with pytest.raises(ValueError):
        warehouse.stage(EQUIPMENT_TABLE, warehouse.read(EQUIPMENT_TABLE), replaced=[])


def test_log_keeps_the_latest_state(warehouse):
    log_ingestion(warehouse, "b1", "f.csv", 5, "IN_PROGRESS", NOW)
    log_ingestion(warehouse, "b1", "f.csv", 5, "FAILED", NOW, "broken")
    log_ingestion(warehouse, "b2", "g.csv", 6, "IN_PROGRESS", NOW)
    log = warehouse.read(INGESTION_LOG_TABLE)
    states = {r.batch_id: r for r in ingestion_states(log).collect()}
    assert log.count() == 3
    assert states["b1"].status == "FAILED" and states["b1"].error_message == "broken"
    assert states["b2"].status == "IN_PROGRESS"
    assert latest_ingestion(log).first().batch_id == "b2"


def test_log_refuses_unknown_status(warehouse):
    with pytest.raises(ValueError):
        log_ingestion(warehouse, "b1", "f.csv", 5, "DONE", NOW)


def test_views_cover_all_tables(warehouse, raw, spark):
    load_raw(warehouse, raw([reading()]))
    warehouse.register_views({"analytics.v": spark.range(3)})
    assert spark.table("raw_sensor_telemetry").count() == 1
    assert spark.table("analytics_v").agg(F.count("*")).first()[0] == 3
