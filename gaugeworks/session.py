"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Whether shuffle files go when the query that made them ends (Spark 4.1 and later).
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(cpus: int | str = "*", **overrides) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    parallelism = "8" if cpus == "*" else str(cpus)
    settings = {
        "spark.ui.enabled": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.shuffle.partitions": parallelism,
        "spark.sql.adaptive.enabled": "true",
        "spark.driver.memory": "8g",
        **overrides,
    }
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("gaugeworks")
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise RuntimeError(
                "set spark.checkpoint.dir to a folder shared by all executors"
            )
        context.setCheckpointDir(tempfile.mkdtemp(prefix="gaugeworks-"))
    return context.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/gaugeworks/{label}-{uuid.uuid4().hex}"


#: Per ``scratch`` that is open, the tables written in it.
_SCRATCH: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables that are ``written`` here without a path of their own are dropped at the end:
    for steps whose result is written by itself."""
    _SCRATCH.append([])
    try:
        yield
    finally:
        for path in _SCRATCH.pop():
            remove_folder(spark, path)


def written(df: DataFrame, label: str, path: str | None = None) -> DataFrame:
    """Cut the lineage of ``df`` with a Parquet table in the shared folder.

    Later readers get column pruning and survive the loss of any executor. What the write
    has shuffled is of no use to them and is dropped at its end, so the disk holds the
    shuffles of one step, not of all.
    """
    spark = df.sparkSession
    if path is None:
        path = scratch_path(spark, label)
        if _SCRATCH:
            _SCRATCH[-1].append(path)
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def landed(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """``written`` for the length of a load; its table is dropped afterwards."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    try:
        yield written(df, label, path)
    finally:
        remove_folder(spark, path)


def remove_folder(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def literal_rows(
    spark: SparkSession, rows: Sequence[Sequence], schema: T.StructType
) -> DataFrame:
    """A few rows from the driver as a one-partition frame, without Python workers."""
    if not rows:
        nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema]
        return spark.range(0, 0, 1, 1).select(*nothing)
    structs = [
        F.struct(
            *[
                F.lit(value).cast(f.dataType).alias(f.name)
                for value, f in zip(row, schema, strict=True)
            ]
        )
        for row in rows
    ]
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*structs)))
