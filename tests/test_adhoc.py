from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.errors import ParseException
from conftest import reading
from gaugeworks.operators.search import search_rows
from gaugeworks.plans import adhoc
from gaugeworks.schemas import EQUIPMENT_TABLE, FAILURE_MODE_TABLE, RAW_TABLE


def test_preview(loaded, warehouse):
    loaded([reading(udi=u) for u in range(30, 0, -1)])
    frames = {t: warehouse.read(t) for t in (RAW_TABLE, FAILURE_MODE_TABLE)}
    assert [r.udi for r in adhoc.preview(frames, "raw").collect()] == list(range(1, 16))
    assert adhoc.preview(frames, "raw", 3).count() == 3
    assert adhoc.preview(frames, "warehouse_dim_failure_mode", 3).count() == 7


def test_unknown_layer_lists_the_valid_ones():
    with pytest.raises(adhoc.UnknownLayerError, match="warehouse_fact"):
        adhoc.preview({}, "silver")


def test_describe(warehouse):
    rows = adhoc.describe(
        {EQUIPMENT_TABLE: warehouse.read(EQUIPMENT_TABLE)}, "warehouse_dim_equipment"
    ).collect()
    assert [r.column_name for r in rows][:2] == ["equipment_key", "product_id"]
    assert [r.ordinal_position for r in rows] == list(range(1, 7))
    assert rows[0].data_type == "bigint"


@pytest.mark.parametrize(
    "sql",
    [
        "DROP TABLE t",
        "drop\ntable t",
        "CREATE TABLE t (a int)",
        "INSERT INTO t VALUES (1)",
        "FROM t INSERT INTO u SELECT *",
        "WITH x AS (SELECT 1) INSERT INTO t SELECT * FROM x",
        "SELECT 1; DROP TABLE t",
        "/* SELECT */ TRUNCATE TABLE t",
        "SET spark.sql.ansi.enabled=false",
        "MERGE INTO t USING u ON t.a = u.a WHEN MATCHED THEN DELETE",
        "UPDATE t SET a = 1",
        "DELETE FROM t",
        "CACHE TABLE t",
        "EXPLAIN SELECT 1",
        "SELECT TRANSFORM(a) USING 'cat' FROM t",
        "",
    ],
)
def test_writes_are_refused(spark, sql):
    with pytest.raises((adhoc.ReadOnlyViolation, ParseException)):
        adhoc.check_read_only(spark, sql)


def test_a_refused_statement_has_not_run(spark):
    with pytest.raises(adhoc.ReadOnlyViolation):
        adhoc.readonly_frame(spark, "CREATE TEMPORARY VIEW made_by_refused AS SELECT 1")
    assert not spark.catalog.tableExists("made_by_refused")


@pytest.mark.parametrize(
    "sql",
    [
        "SELECT 'drop; delete' AS note -- insert",
        "  select replace('a', 'a', 'b') ; ",
        "WITH q AS (SELECT 1 a) SELECT * FROM q",
        "VALUES (1), (2)",
        "SELECT `update` FROM (SELECT 1 AS `update`)",
        "SELECT update, merge, load FROM (SELECT 1 AS update, 2 AS merge, 3 AS load)",
        "FROM range(3) SELECT id",
        "(SELECT 1 AS a) UNION ALL (SELECT 2)",
    ],
)
def test_reads_are_allowed(spark, sql):
    assert adhoc.run_readonly_sql(spark, sql)["status"] == "success"


def test_row_cap(spark):
    run = adhoc.run_readonly_sql
    assert run(spark, "SELECT * FROM range(500)")["row_count"] == 100
    assert run(spark, "SELECT * FROM range(500) LIMIT 200")["row_count"] == 200
    inner = "SELECT * FROM range(500) WHERE id NOT IN (SELECT 3 LIMIT 1)"
    assert run(spark, inner, limit=7)["row_count"] == 7
    unbounded = "SELECT * FROM range(30000) LIMIT 1000000000"
    assert adhoc.readonly_frame(spark, unbounded).count() == adhoc.MOST_ROWS
    cte = "WITH q AS (SELECT * FROM range(9)) SELECT * FROM q ORDER BY id LIMIT 8"
    assert run(spark, cte, limit=2)["row_count"] == 8


def test_query_errors_are_values(spark):
    outcome = adhoc.run_readonly_sql(spark, "SELECT nope FROM nowhere")
    assert outcome["status"] == "error" and "nowhere" in outcome["error"]
    assert outcome["execution_time_ms"] >= 0


@pytest.fixture
def mixed(spark):
    return spark.createDataFrame(
        [
            (1, "Power Failure", Decimal("40.00"), True, datetime(2024, 1, 1, 5)),
            (2, None, Decimal("4.20"), False, None),
        ],
        "id int, mode string, torque decimal(8,2), failed boolean, at timestamp",
    )


@pytest.mark.parametrize(
    "term, ids",
    [
        ("power", [1]),
        ("POWER FAILURE40TRUE", [1]),  # cells follow each other without a gap
        ("4.2f", [2]),
        ("4.20", []),
        ("null", [2]),
        ("2024-01-01t05:00:00+00:00", [1]),
        ("", [1, 2]),
        ("%", []),
    ],
)
def test_search(mixed, term, ids):
    assert [r.id for r in search_rows(mixed, term).orderBy("id").collect()] == ids
