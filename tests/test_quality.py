from datetime import timedelta
from decimal import Decimal

import pytest
from conftest import NOW, reading
from gaugeworks.operators import quality as dq
from gaugeworks.plans import quality as gate
from gaugeworks.schemas import CHECK_LOG, CHECK_LOG_TABLE, CHECK_STATUSES
from gaugeworks.session import literal_rows


@pytest.fixture
def verdicts(spark):
    def run(rows, *checks, schema="v double, s string"):
        frame = spark.createDataFrame(rows, schema)
        dim = spark.createDataFrame([(1,), (2,)], "pk long")
        found = dq.run_suite({"t": frame, "dim": dim}, list(checks)).collect()
        return sorted(found, key=lambda r: r.position)

    return run


def test_empty_table(verdicts):
    nulls, count, inside = verdicts(
        [],
        dq.check_null_percentage("t", "v"),
        dq.check_row_count("t", 1),
        dq.check_numeric_range("t", "v", 0, 1),
    )
    assert (nulls.status, nulls.observed_value) == ("PASSED", 0)
    assert count.status == "FAILED"
    assert count.details == "Found 0 rows (expected >= 1)"
    assert inside.status == "PASSED"


def test_null_is_not_out_of_range_but_is_counted(verdicts):
    inside, nulls = verdicts(
        [(1.0, "a"), (None, "b"), (100.0, "c")],
        dq.check_numeric_range("t", "v", 1.0, 100.0),
        dq.check_null_percentage("t", "v"),
    )
    assert inside.status == "PASSED"
    assert inside.details == "0 out-of-bounds rows found. Allowed [1.0, 100.0]."
    assert nulls.status == "FAILED" and nulls.observed_value == Decimal("33.3333")
    assert nulls.details == "1 nulls out of 3 (33.33% nulls, threshold <= 0.0%)"


def test_thousands_are_separated(spark):
    found = dq.run_suite({"t": spark.range(12345)}, [dq.check_row_count("t", 10000)])
    assert found.first().details == "Found 12,345 rows (expected >= 10,000)"


def test_bounds_belong_to_the_range(verdicts):
    row = verdicts(
        [(0.99, "a"), (1.0, "b"), (2.0, "c"), (2.01, "d")],
        dq.check_numeric_range("t", "v", 1, 2),
    )[0]
    assert row.observed_value == 2
    assert row.details == "2 out-of-bounds rows found. Allowed [1, 2]."


def test_orphans_count_rows_and_nulls(verdicts):
    row = verdicts(
        [(1,), (9,), (9,), (None,)],
        dq.check_referential_integrity("t", "fk", "dim", "pk"),
        schema="fk long",
    )[0]
    assert row.observed_value == 3
    assert row.details == "3 orphan records found in t.fk with no match in dim.pk"


def test_unique_accepted_fits_parity(verdicts):
    unique, accepted, fits, varchar, parity = verdicts(
        [(1.0, "a"), (2.0, "a"), (99.0, "long"), (None, None), (None, None)],
        dq.check_unique("t", "s"),
        dq.check_accepted_values("t", "s", ["a", "b"]),
        dq.check_fits_type("t", "v", "decimal(3,2)"),
        dq.check_fits_type("t", "s", "varchar(3)"),
        dq.check_row_parity("t", "dim"),
    )
    assert unique.observed_value == 1
    assert accepted.observed_value == 1
    assert fits.observed_value == 1
    assert varchar.observed_value == 1
    assert parity.observed_value == 3


def test_log_statuses_are_accepted(spark, loaded, warehouse):
    loaded([reading()])
    gate.run_gate(warehouse, NOW, "b1", gate.standard_checks(1, 1, 1))
    log = {"log": warehouse.read(CHECK_LOG_TABLE)}
    check = dq.check_accepted_values("log", "status", CHECK_STATUSES)
    assert dq.run_suite(log, [check]).first().status == "PASSED"


def test_suite_has_twelve_checks_in_order(loaded, warehouse):
    loaded([reading()])
    rows = gate.run_gate(warehouse, NOW, "b1", gate.standard_checks(1, 1, 1))
    assert [r.check_id for r in rows] == list(range(1, 13))
    assert [r.check_category for r in rows] == (
        ["Volume"] * 3
        + ["Completeness"] * 3
        + ["Validity"] * 4
        + ["Referential Integrity"] * 2
    )
    assert {r.batch_id for r in rows} == {"b1"}


def test_failures_are_logged_before_they_raise(loaded, warehouse):
    loaded([reading()])
    with pytest.raises(dq.DataQualityException, match="check_row_count on raw"):
        gate.run_gate(warehouse, NOW, "b1", gate.standard_checks(2, 1, 1))
    log = warehouse.read(CHECK_LOG_TABLE)
    assert log.count() == 12 and log.filter("status = 'FAILED'").count() == 1
    gate.run_gate(warehouse, NOW, "b2", gate.standard_checks(1, 1, 1))
    assert warehouse.read(CHECK_LOG_TABLE).agg({"check_id": "max"}).first()[0] == 24


def test_warning_does_not_raise(verdicts):
    rows = verdicts([], dq.check_row_count("t", 1, "WARNING"))
    assert rows[0].status == "FAILED" and dq.enforce(rows) is True


def log_frame(spark, entries):
    rows = [
        (i, "b", "check", category, table, None, status, 0, 0, "CRITICAL", "", at)
        for i, (category, table, status, at) in enumerate(entries, 1)
    ]
    return literal_rows(spark, rows, CHECK_LOG)


def test_reports_over_the_log(spark):
    later = NOW + timedelta(minutes=10)
    log = log_frame(
        spark,
        [
            ("Volume", "t", "PASSED", NOW),
            ("Volume", "t", "FAILED", NOW),
            ("Validity", "u", "PASSED", later - timedelta(minutes=5)),
            ("Volume", "t", "PASSED", later),
        ],
    )
    assert gate.latest_run(log).count() == 2
    counts = gate.latest_run_counts(log).first()
    assert (counts.total, counts.passed, counts.failed) == (2, 2, 0)
    categories = gate.quality_by_category(log).collect()
    assert [(r.check_category, r.pass_rate_pct) for r in categories] == [
        ("Validity", 100),
        ("Volume", Decimal("66.67")),
    ]
    tables = gate.quality_by_table(log).collect()
    assert [(r.table_name, r.pass_rate_pct) for r in tables] == [
        ("t", Decimal("66.7")),
        ("u", 100),
    ]
    assert gate.pass_rate_pct(log).first().pass_rate_pct == 75
    assert [r.check_id for r in gate.recent_checks(log, 2).collect()] == [4, 3]


def test_reports_over_an_empty_log(warehouse):
    log = warehouse.read(CHECK_LOG_TABLE)
    assert gate.pass_rate_pct(log).first().pass_rate_pct is None
    assert gate.latest_run_counts(log).first().total == 0
    assert gate.quality_stats(log).first().total_checks == 0


def test_out_of_range_extent(spark):
    frame = spark.createDataFrame([(0,), (5,), (50,)], "v int")
    row = dq.out_of_range(frame, "v", 1, 10).first()
    assert (row.out_of_bounds, row.min_found, row.max_found) == (2, 0, 50)


def test_a_suite_needs_checks():
    with pytest.raises(ValueError):
        dq.run_suite({}, [])
