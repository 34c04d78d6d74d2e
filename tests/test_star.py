from decimal import Decimal

import pytest
from conftest import LATER, NOW, reading
from gaugeworks.operators.changes import change_counts, with_change
from gaugeworks.operators.upsert import DuplicateKeyError
from gaugeworks.plans.analytics import Star
from gaugeworks.plans.staging import MissingValuesError, load_staging, to_staging
from gaugeworks.plans.star import (
    build_dim_equipment,
    equipment_rows,
    load_star,
    seed_failure_modes,
)
from gaugeworks.schemas import (
    EQUIPMENT_TABLE,
    FACT_TABLE,
    FAILURE_MODE_SEED,
    FAILURE_MODE_TABLE,
    QUARANTINE_TABLE,
    RAW_TABLE,
    STAGING_TABLE,
)
from gaugeworks.sources.readings import load_raw


def keys(frame, natural, key):
    return {r[natural]: r[key] for r in frame.collect()}


def test_seed_twice_is_seed_once(spark):
    once = seed_failure_modes(spark)
    twice = seed_failure_modes(spark, once)
    assert sorted(once.collect()) == sorted(twice.collect())
    assert once.count() == len(FAILURE_MODE_SEED) == 7


def test_seed_fills_gaps_above_existing_keys(spark):
    some = seed_failure_modes(spark).filter("failure_mode_key > 2")
    filled = keys(seed_failure_modes(spark, some), "failure_mode_name", "failure_mode_key")
    assert filled["Power Failure"] == 3
    assert sorted(filled.values()) == [3, 4, 5, 6, 7, 8, 9]


def test_new_products_get_larger_keys(loaded, warehouse, raw):
    loaded([reading(udi=1, product_id="L5"), reading(udi=2, product_id="L9")])
    before = keys(warehouse.read(EQUIPMENT_TABLE), "product_id", "equipment_key")
    load_raw(warehouse, raw([reading(udi=3, product_id="L1", batch_id="b2")]))
    load_staging(warehouse, LATER, pending_only=True)
    load_star(warehouse, LATER, pending_only=True)
    after = keys(warehouse.read(EQUIPMENT_TABLE), "product_id", "equipment_key")
    assert sorted(before.values()) == [1, 2]
    assert after == before | {"L1": 3}
    fact = keys(warehouse.read(FACT_TABLE), "udi", "telemetry_key")
    # the one block's three rows lease three keys, of which known rows leave theirs unused
    assert fact == {1: 1, 2: 2, 3: 5}


def test_changed_type_changes_the_grade_only(warehouse, raw):
    staging = equipment_rows(to_staging(raw([reading()]), NOW))
    existing = build_dim_equipment(staging, warehouse.read(EQUIPMENT_TABLE), NOW)
    changed = equipment_rows(to_staging(raw([reading(product_type="H")]), LATER))
    row = build_dim_equipment(changed, existing, LATER).first()
    assert row.product_type == "L" and row.quality_grade == "High (20% variant)"
    assert row.created_at == NOW and row.updated_at == LATER
    assert row.equipment_key == 1


def test_staging_reload_keeps_identity(loaded, warehouse, raw):
    loaded([reading(udi=1)])
    # raw never changes a type, so a changed one is put there by hand
    warehouse.replace(RAW_TABLE, raw([reading(udi=1, product_type="M")]))
    load_staging(warehouse, LATER)
    row = warehouse.read(STAGING_TABLE).first()
    assert row.product_type == "L"
    assert row.product_quality_grade == "Medium (30% variant)"
    assert row.transformed_at == LATER


def test_product_with_two_types_is_refused(warehouse, raw):
    staging = to_staging(raw([reading(udi=1), reading(udi=2, product_type="H")]), NOW)
    staging = equipment_rows(staging)
    with pytest.raises(DuplicateKeyError):
        build_dim_equipment(staging, warehouse.read(EQUIPMENT_TABLE), NOW)


def test_reload_updates_fact_and_keeps_keys(loaded, warehouse, raw):
    loaded([reading(udi=u) for u in (1, 70, 140)])
    before = keys(warehouse.read(FACT_TABLE), "udi", "telemetry_key")
    loaded([reading(udi=70, torque_nm=Decimal("55.00"), machine_failure=1)], LATER)
    fact = {r.udi: r for r in warehouse.read(FACT_TABLE).collect()}
    assert fact[70].torque_nm == Decimal("55.00") and fact[70].is_failure
    assert fact[1].torque_nm == Decimal("40.00") and fact[1].loaded_at == LATER
    assert keys(warehouse.read(FACT_TABLE), "udi", "telemetry_key") == before


def test_incremental_load_equals_full_load(spark, tmp_path, raw):
    from gaugeworks.sources.tables import Warehouse

    first = [reading(udi=u, product_id=f"L{u % 3}") for u in range(1, 90)]
    second = [
        reading(udi=u, product_id=f"L{u % 5}", batch_id="b2", torque_nm=Decimal(u))
        for u in range(80, 200, 3)
    ]
    results = []
    for batch in (None, "b2"):
        wh = Warehouse(spark, str(tmp_path / f"wh-{batch}"), rows=16)
        load_raw(wh, raw(first))
        load_staging(wh, NOW)
        load_star(wh, NOW)
        load_raw(wh, raw(second))
        load_staging(wh, LATER, pending_only=batch is not None)
        load_star(wh, LATER, pending_only=batch is not None)
        results.append(
            sorted(
                Star.of(wh)
                .joined()
                .select("udi", "product_id", "failure_mode_name", "torque_nm")
                .collect()
            )
        )
    assert results[0] == results[1] and len(results[0]) == 89 + 36


def test_missing_measure_stops_staging(warehouse, raw):
    load_raw(warehouse, raw([reading(udi=1), reading(udi=2, torque_nm=None)]))
    with pytest.raises(MissingValuesError):
        load_staging(warehouse, NOW)
    assert warehouse.version(STAGING_TABLE) == 0
    load_staging(warehouse, NOW, on_missing="quarantine")
    assert [r.udi for r in warehouse.read(STAGING_TABLE).collect()] == [1]
    assert [r.udi for r in warehouse.read(QUARANTINE_TABLE).collect()] == [2]


def test_failed_star_load_leaves_everything_as_it_was(loaded, warehouse, raw, monkeypatch):
    loaded([reading(udi=1)])
    load_raw(warehouse, raw([reading(udi=2, product_id="L2", batch_id="b2")]))
    load_staging(warehouse, LATER)

    def broken(*args, **kwargs):
        raise RuntimeError("lost")

    monkeypatch.setattr("gaugeworks.plans.star.merge_fact", broken)
    with pytest.raises(RuntimeError):
        load_star(warehouse, LATER)
    assert warehouse.read(EQUIPMENT_TABLE).count() == 1
    assert warehouse.read(FACT_TABLE).count() == 1


@pytest.mark.parametrize("step", [1, 2**40])
def test_keys_are_leased_by_block_however_far_ids_are_apart(warehouse, raw, step):
    """Three loads, the second and third of which cut and touch several blocks."""
    seen = {}
    for batch, udis in enumerate((range(40), range(30, 100), [5, 55, 500])):
        rows = [reading(udi=1 + u * step, batch_id=f"b{batch}") for u in udis]
        load_raw(warehouse, raw(rows))
        load_staging(warehouse, NOW, pending_only=True)
        load_star(warehouse, NOW, pending_only=True)
        found = keys(warehouse.read(FACT_TABLE), "udi", "telemetry_key")
        assert len(set(found.values())) == len(found)
        assert {u: found[u] for u in seen} == seen
        fresh = [k for u, k in found.items() if u not in seen]
        assert min(fresh) > max(seen.values(), default=0)
        assert max(fresh) <= warehouse.mark(FACT_TABLE, "leased")
        seen = found
    assert len(seen) == 101 and len(warehouse.blocks(FACT_TABLE)) > 3


def test_identical_reload_writes_nothing(loaded, warehouse, raw):
    first = [reading(udi=u, product_id=f"L{u % 3}") for u in range(1, 60)]
    loaded(first)
    tables = (RAW_TABLE, STAGING_TABLE, FACT_TABLE, EQUIPMENT_TABLE, FAILURE_MODE_TABLE)
    before = {t: warehouse.next_version(t) for t in tables}

    def reload(rows):
        load_raw(warehouse, raw(rows), skip_unchanged=True)
        load_staging(warehouse, LATER, pending_only=True, skip_unchanged=True)
        load_star(warehouse, LATER, pending_only=True, skip_unchanged=True)

    reload([r | {"batch_id": "b2", "ingested_at": LATER} for r in first])
    assert {t: warehouse.next_version(t) for t in tables} == before
    # one reading changed: its block is written in each layer, no dimension is
    changed = [r | {"batch_id": "b3"} for r in first]
    changed[20] = changed[20] | {"torque_nm": Decimal("77.00")}
    reload(changed)
    wanted = {RAW_TABLE, STAGING_TABLE, FACT_TABLE}
    assert {t for t in tables if warehouse.next_version(t) > before[t]} == wanted
    assert len(warehouse.pending_blocks(FACT_TABLE, 1)) == 1
    stamped = {r.udi for r in warehouse.read(FACT_TABLE).collect() if r.loaded_at == LATER}
    assert stamped == {21}


def test_nulls_count_as_changes(spark):
    kind = "k int, a int, b int"
    target = spark.createDataFrame([(1, None, 5), (2, 7, None), (3, None, None)], kind)
    batch = spark.createDataFrame([(1, 5, None), (2, 7, None), (3, None, 0), (4, 1, 1)], kind)
    told = {r.k: r.change for r in with_change(batch, target, ["k"], ["a", "b"]).collect()}
    assert told == {1: "changed", 2: "unchanged", 3: "changed", 4: "new"}
    counts = change_counts(with_change(batch, target, ["k"], ["a", "b"])).first()
    assert tuple(counts) == (1, 2, 1)
