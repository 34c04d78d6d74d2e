"""Partial aggregates and stored features against the full computation."""

import random
from decimal import Decimal

import pytest
from conftest import LATER, NOW, reading
from gaugeworks.plans import analytics
from gaugeworks.plans.analytics import Star, anomaly_features
from gaugeworks.plans.materialized import refresh_features, store_features
from gaugeworks.plans.partials import Partials, refresh_partials
from gaugeworks.plans.staging import load_staging
from gaugeworks.plans.star import load_star
from gaugeworks.schemas import FACT_TABLE, FEATURES_TABLE
from gaugeworks.sources.readings import load_raw


def some_readings(udis, seed, batch="b1"):
    """Three types of very different density; a third of the readings share one speed."""
    pick = random.Random(seed)
    rows = []
    for u in udis:
        # a machine keeps its type
        kind = "LLLLLLLMMH"[u % 10] if u < 10_000 else "H"
        rows.append(
            reading(
                udi=u,
                product_id=f"{kind}{u % 4}",
                product_type=kind,
                batch_id=batch,
                torque_nm=Decimal(pick.randrange(2000, 6000)) / 100,
                rotational_speed_rpm=1500 if pick.random() < 0.35 else pick.randrange(1200, 1300),
                tool_wear_min=pick.randrange(250),
                machine_failure=int(pick.random() < 0.3),
                osf=int(pick.random() < 0.2),
            )
        )
    return rows


def grow(warehouse, raw, rows, now=LATER):
    load_raw(warehouse, raw(rows))
    load_staging(warehouse, now, pending_only=True, skip_unchanged=True)
    load_star(warehouse, now, pending_only=True, skip_unchanged=True)


def same(left, right):
    order = lambda frame: sorted(map(tuple, frame.collect()), key=str)
    return order(left) == order(right)


BATCHES = [
    some_readings(range(1, 260), 1),
    some_readings([40, 41, 200], 2, "b2"),
    some_readings(range(250, 330), 3, "b3"),
    some_readings([-5, 12_000, 2**50], 4, "b4"),
]


def test_reports_from_partials_follow_the_fact(warehouse, raw):
    for rows in BATCHES:
        grow(warehouse, raw, rows)
        with pytest.raises(ValueError, match="behind"):
            Partials.of(warehouse)
        read = refresh_partials(warehouse)
        assert refresh_partials(warehouse) == []
        partials, star = Partials.of(warehouse), Star.of(warehouse)
        assert same(partials.root_cause(), analytics.root_cause(star))
        assert same(partials.tier_failures(), analytics.tier_failures(star))
        assert same(partials.speed_quintiles(5), analytics.speed_quintiles(star, 5))
        assert same(partials.leaderboard(9), analytics.leaderboard(star, 9))
        total = star.fact.count()
        failures = star.fact.filter("is_failure").count()
        assert tuple(partials.counts_row().first()) == (total, total, total, failures)
        if rows is BATCHES[1]:
            # the blocks that have the three changed readings, of some twenty
            assert len(read) <= 3 < len(warehouse.blocks(FACT_TABLE)) / 4


def test_reports_from_partials_open_no_fact_files(warehouse, raw):
    grow(warehouse, raw, BATCHES[0])
    refresh_partials(warehouse)
    partials = Partials.of(warehouse)
    for frame in (partials.root_cause(), partials.tier_failures(), partials.counts_row()):
        assert frame.inputFiles() and not any("fact_sensor" in f for f in frame.inputFiles())


def test_leaderboard_opens_few_blocks(warehouse, raw):
    rows = some_readings(range(1, 400), 7)
    rows[100] |= {"tool_wear_min": 290, "torque_nm": Decimal("90.00")}
    rows[101] |= {"tool_wear_min": 289, "torque_nm": Decimal("90.00")}
    grow(warehouse, raw, rows)
    refresh_partials(warehouse)
    partials = Partials.of(warehouse)
    assert len(partials.top_blocks(2)) <= 2 < len(warehouse.blocks(FACT_TABLE)) / 5
    assert same(partials.leaderboard(2), analytics.leaderboard(Star.of(warehouse), 2))


def test_equal_maxima_are_all_opened(warehouse, raw):
    """Ids decide between equal readings, so no block with such a one may be left out."""
    equal = {"tool_wear_min": 100, "torque_nm": Decimal("50.00")}
    grow(warehouse, raw, [r | equal for r in some_readings(range(1, 200), 8)])
    refresh_partials(warehouse)
    partials = Partials.of(warehouse)
    top = [r.udi for r in partials.leaderboard(4).collect()]
    assert top == [1, 2, 3, 4]


def test_stored_features_follow_the_fact(warehouse, raw):
    for rows in BATCHES:
        grow(warehouse, raw, rows)
        replaced = refresh_features(warehouse)
        assert refresh_features(warehouse) == 0
        stored = warehouse.read(FEATURES_TABLE)
        fresh = anomaly_features(Star.of(warehouse), rows=50)
        assert stored.columns == fresh.columns
        assert same(stored, fresh.select(*stored.columns))
        if rows is BATCHES[1]:
            # each changed reading and the nine behind it in its type, less what overlaps
            assert 3 < replaced <= 30


def test_a_change_reaches_the_next_nine_of_its_type_only(warehouse, raw):
    rows = some_readings(range(1, 260), 5)
    grow(warehouse, raw, rows)
    store_features(warehouse)
    before = {r.udi: r for r in warehouse.read(FEATURES_TABLE).collect()}
    # a rare type, so that its next readings lie blocks away
    at = next(u for u in range(60, 260) if u % 10 == 9)
    changed = rows[at - 1] | {"torque_nm": Decimal("99.00")}
    grow(warehouse, raw, [changed])
    assert refresh_features(warehouse) == 10
    after = {r.udi: r for r in warehouse.read(FEATURES_TABLE).collect()}
    assert {u for u in after if after[u] != before[u]} == {at + 10 * k for k in range(10)}
    assert len(warehouse.pending_blocks(FACT_TABLE, 1)) == 1


def test_features_refresh_reads_reached_blocks_only(warehouse, raw, monkeypatch):
    grow(warehouse, raw, some_readings(range(1, 400), 6))
    store_features(warehouse)
    refresh_partials(warehouse)
    grow(warehouse, raw, some_readings([200], 9, "b2"))
    asked = []
    real = type(warehouse).read

    def read(self, table, blocks=None, block_column=None):
        if table in (FACT_TABLE, FEATURES_TABLE):
            asked.append(None if blocks is None else len(list(blocks)))
        return real(self, table, blocks, block_column)

    monkeypatch.setattr(type(warehouse), "read", read)
    refresh_features(warehouse)
    monkeypatch.undo()
    # Star.of names the whole table, lazily; what is worked on are blocks
    few = [n for n in asked if n is not None]
    assert max(few) < len(warehouse.blocks(FACT_TABLE)) / 3
    assert same(warehouse.read(FEATURES_TABLE), anomaly_features(Star.of(warehouse)))


def test_first_load_is_stored_whole(warehouse, raw):
    grow(warehouse, raw, some_readings(range(1, 30), 1), NOW)
    assert refresh_features(warehouse) == 29
