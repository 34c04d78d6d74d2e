from types import SimpleNamespace

import pytest
from gaugeworks.session import landed, scratch_path, shared_dir, written
from pyspark.sql import functions as F


def fake_session(master, configured=None):
    state = {"dir": None}
    context = SimpleNamespace(
        master=master,
        getCheckpointDir=lambda: state["dir"],
        setCheckpointDir=lambda path: state.update(dir=path),
    )
    conf = SimpleNamespace(get=lambda key, default: configured or default)
    return SimpleNamespace(conf=conf, sparkContext=context)


def test_configured_folder_is_used():
    assert shared_dir(fake_session("yarn", "hdfs://shared/")) == "hdfs://shared"


def test_local_session_may_use_its_own_folder():
    session = fake_session("local[4]")
    assert shared_dir(session) == shared_dir(session) != ""


def test_cluster_needs_a_shared_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(fake_session("spark://host:7077"))


def test_written_tables_stay_and_landed_ones_go(spark, tmp_path):
    frame = spark.range(5).withColumn("x", F.rand())
    kept = written(frame, "test")
    assert sorted(kept.collect()) == sorted(kept.collect())
    with landed(frame, "test") as rows:
        path = rows.inputFiles()[0]
        assert rows.count() == 5
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    assert not files.exists(folder)
    assert scratch_path(spark, "test") != scratch_path(spark, "test")


def _shuffle_files(spark):
    files = spark._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
    return {n for n in (files.apply(k).getName() for k in range(files.size())) if n.startswith("shuffle_")}


def test_written_keeps_no_shuffle_files(spark):
    before = _shuffle_files(spark)
    grouped = spark.range(0, 5000, 1, 4).groupBy((F.col("id") % 700).alias("k")).count()
    kept = written(grouped.repartition(3, "k"), "kept")
    assert not _shuffle_files(spark) - before
    assert kept.count() == 700
