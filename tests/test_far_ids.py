"""Blocks that share folders, and ids whose distant forms would meet."""

from catalog.queries import all_queries
from conftest import reading
from gaugeworks.operators.blocks import LEAST_KEY
from gaugeworks.schemas import RAW_TABLE
from gaugeworks.sources import tables
from gaugeworks.sources.readings import load_raw
from pyspark.sql import functions as F


def test_far_ids_do_not_meet_the_last_one(spark, tmp_path):
    """Id 2 ** 22, a trillion times, would be the 2 ** 62 that the last id gets."""
    ids = [*range(20), *range((1 << 22) - 5, (1 << 22) + 6)]
    rows = [(k, None, k % 7, "click", 40.0 + k % 9, '{"k": 5}') for k in ids]
    frame = spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long, event_type string, value double, props string")
    frame.coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    out = {r.table_name: r for r in all_queries()["surrogate_keys_far"](spark, str(tmp_path)).collect()}
    fact = out["fact_sensor_telemetry"]
    assert (fact.total_keys, fact.distinct_keys, fact.least_key, fact.greatest_key) == (31, 31, 1, 31)


def stored(warehouse, raw, udis, batch):
    load_raw(warehouse, raw([reading(udi=u, batch_id=batch) for u in udis]))


def test_small_blocks_share_folders(warehouse, raw, monkeypatch):
    stored(warehouse, raw, range(1, 401), "b1")
    blocks = warehouse.blocks(RAW_TABLE)
    files = warehouse.read(RAW_TABLE).inputFiles()
    assert len(blocks) > 20 and len(files) < len(blocks) / 5
    # with folders of some blocks and few ranges, each row is read from its block's version
    monkeypatch.setattr(tables, "FOLDER_ROWS", 64)
    for turn, most in enumerate((32, 1)):
        monkeypatch.setattr(tables, "MOST_RANGES", most)
        own = [b + 1 for b in blocks[1 + turn :: 3]]
        stored(warehouse, raw, own, f"again{turn}")
        rows = {r.udi: r.batch_id for r in warehouse.read(RAW_TABLE).collect()}
        assert sorted(rows) == list(range(1, 401))
        assert {u for u, b in rows.items() if b == f"again{turn}"} == set(own)
        for block, after in zip(blocks[1::5], blocks[2::5], strict=False):
            some = warehouse.read(RAW_TABLE, [block], block_column="start")
            assert {r.udi for r in some.collect()} == set(range(block, after))
            assert some.filter(F.col("start") != block).isEmpty()
    assert blocks[0] == LEAST_KEY
