import sys
from datetime import datetime
from decimal import Decimal
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from gaugeworks.schemas import RAW  # noqa: E402
from gaugeworks.session import literal_rows, local_session  # noqa: E402
from gaugeworks.sources.tables import Warehouse  # noqa: E402

NOW = datetime(2024, 1, 1)
LATER = datetime(2024, 1, 2)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    session = local_session(
        4,
        **{
            "spark.checkpoint.dir": str(shared),
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
        },
    )
    yield session
    session.stop()


@pytest.fixture
def warehouse(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "warehouse"), rows=16)


DEFAULTS = {
    "udi": 1,
    "product_id": "L1",
    "product_type": "L",
    "air_temperature_k": Decimal("298.10"),
    "process_temperature_k": Decimal("308.60"),
    "rotational_speed_rpm": 1500,
    "torque_nm": Decimal("40.00"),
    "tool_wear_min": 10,
    "machine_failure": 0,
    "twf": 0,
    "hdf": 0,
    "pwf": 0,
    "osf": 0,
    "rnf": 0,
    "source_dataset": "test.csv",
    "batch_id": "b1",
    "ingested_at": NOW,
}


def reading(**changes) -> dict:
    return DEFAULTS | changes


def raw_frame(spark, readings):
    rows = [tuple(r[name] for name in RAW.names) for r in readings]
    if len(rows) > 50:
        return spark.createDataFrame(rows, RAW.simpleString())
    return literal_rows(spark, rows, RAW)


@pytest.fixture
def raw(spark):
    return lambda readings: raw_frame(spark, readings)


@pytest.fixture
def loaded(warehouse, raw):
    """Load readings through raw, staging and star and return the warehouse."""
    from gaugeworks.plans.staging import load_staging
    from gaugeworks.plans.star import load_star
    from gaugeworks.sources.readings import load_raw

    def load(readings, now=NOW):
        load_raw(warehouse, raw(readings))
        load_staging(warehouse, now)
        load_star(warehouse, now)
        return warehouse

    return load
