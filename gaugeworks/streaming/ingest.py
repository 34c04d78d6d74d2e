"""Files that arrive over time, loaded as they come."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeworks.operators.upsert import resolve_duplicates
from gaugeworks.schemas import RAW, RAW_COLUMN_MAP, RAW_TABLE, READING
from gaugeworks.session import landed, remove_folder
from gaugeworks.sources.logs import log_ingestion
from gaugeworks.sources.readings import (
    FILE_ORDER,
    RELOAD_COLUMNS,
    ROW_ORDER,
    add_lineage,
    cast_readings,
    file_order,
    load_raw,
    rename_columns,
    row_order,
    without_rejects,
)
from gaugeworks.sources.tables import Warehouse

# The micro-batch of a row that has arrived.
NUMBER = "arrival"
_ROW_ORDER = T.StructType(
    [
        T.StructField(
            "file",
            T.StructType(
                [
                    T.StructField("file_modification_time", T.TimestampType()),
                    T.StructField("file_path", T.StringType()),
                    T.StructField("file_block_start", T.LongType()),
                ]
            ),
        ),
        T.StructField("place", T.LongType()),
    ]
)

CSV_SCHEMA = T.StructType(
    [T.StructField(name, T.StringType(), True) for name in RAW_COLUMN_MAP]
)


def csv_stream(spark: SparkSession, folder: str, files_per_batch: int = 100) -> DataFrame:
    """New sensor CSV files of a folder, as text columns in arrival order."""
    text = (
        spark.readStream.schema(CSV_SCHEMA)
        .option("header", True)
        .option("enforceSchema", False)
        .option("maxFilesPerTrigger", files_per_batch)
        .csv(folder)
    )
    text = text.select("*", file_order().alias(FILE_ORDER))
    return rename_columns(text, RAW_COLUMN_MAP | {FILE_ORDER: FILE_ORDER})


def ingest_stream(
    source: DataFrame,
    warehouse: Warehouse,
    checkpoint: str,
    label: str,
    now: datetime,
    on_reject: str = "raise",
    duplicates: str = "last",
) -> None:
    """Load everything that has arrived as one version of raw, then stop.

    ``source`` is a stream of reading columns, as text or typed, with the file order that
    ``csv_stream`` adds. A micro-batch is set down beside the tables, under its number; when
    the stream has caught up, all micro-batches that raw does not have yet are merged
    together. The number of the last one is committed with the rows. So a micro-batch that
    comes again after a lost driver is known before any work is done on it, and many small
    ones make one version. ``label`` names the stream: a new checkpoint needs a new label.
    """

    def arrive(batch: DataFrame, number: int) -> None:
        if number <= warehouse.mark(RAW_TABLE, _ledger(label), -1):
            return
        text = batch.select(
            *[F.col(f.name).cast("string").alias(f.name) for f in READING], FILE_ORDER
        )
        placed = text.withColumn(ROW_ORDER, row_order()).drop(FILE_ORDER)
        placed.write.mode("overwrite").parquet(f"{_arrivals(warehouse, label)}/{NUMBER}={number}")

    query = (
        source.writeStream.foreachBatch(arrive)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    merge_arrivals(warehouse, label, now, on_reject, duplicates)


def merge_arrivals(
    warehouse: Warehouse,
    label: str,
    now: datetime,
    on_reject: str = "raise",
    duplicates: str = "last",
) -> list[int]:
    """Merge the micro-batches that have arrived and that raw does not have yet, as if one
    after the other; returns their numbers. Each is an audited batch of its own."""
    folder = _arrivals(warehouse, label)
    done = warehouse.mark(RAW_TABLE, _ledger(label), -1)
    numbers = [n for n in warehouse.numbered(folder, NUMBER) if n > done]
    if not numbers:
        return []
    kept = [f"{folder}/{NUMBER}={n}" for n in numbers]
    schema = T.StructType([T.StructField(f.name, T.StringType()) for f in READING])
    schema.add(ROW_ORDER, _ROW_ORDER).add(NUMBER, T.IntegerType())
    reader = warehouse.spark.read.schema(schema).option("basePath", folder)
    with landed(cast_readings(reader.parquet(*kept)), "arrivals") as typed:
        counts = dict(typed.groupBy(NUMBER).count().collect())

        def log(status: str, error: str | None = None) -> None:
            for n in numbers:
                name = _batch_id(label, n)
                log_ingestion(warehouse, name, label, counts.get(n, 0), status, now, error)

        log("IN_PROGRESS")
        try:
            fitting = without_rejects(warehouse, typed, _batch_id(label, numbers[-1]), on_reject)
            merged = in_turn(fitting, duplicates)
            stamped = add_lineage(merged, label, "", now)
            named = F.format_string(f"{label}_%09d", NUMBER)
            stamped = stamped.withColumn("batch_id", named).select(*RAW.names)
            marks = {_ledger(label): numbers[-1]}
            load_raw(warehouse, stamped, duplicates="unique", marks=marks)
        except Exception as error:
            log("FAILED", str(error))
            raise
        log("SUCCESS")
    for path in kept:
        remove_folder(warehouse.spark, path)
    return numbers


def in_turn(rows: DataFrame, duplicates: str = "last") -> DataFrame:
    """One row per reading from several numbered batches, as loading them in turn leaves it:
    what a reload changes from the last batch that has it, the rest from the first. Of a
    reading that comes twice in one batch the later row counts, or it is refused."""
    names = [f.name for f in READING if f.name != "udi"]
    if duplicates == "error":
        resolve_duplicates(rows, ["udi", NUMBER], "error")
    per_batch = rows.groupBy("udi", NUMBER).agg(F.max_by(F.struct(*names), ROW_ORDER).alias("row"))
    folded = per_batch.groupBy("udi").agg(
        F.min_by("row", NUMBER).alias("first"),
        F.max_by("row", NUMBER).alias("last"),
        F.max(NUMBER).alias(NUMBER),
    )
    return folded.select(
        "udi",
        *[F.col(f"{'last' if c in RELOAD_COLUMNS else 'first'}.{c}").alias(c) for c in names],
        NUMBER,
    )


def _ledger(label: str) -> str:
    return f"stream:{label}"


def _arrivals(warehouse: Warehouse, label: str) -> str:
    return f"{warehouse.root}/_arrivals/{label}"


def _batch_id(label: str, number: int) -> str:
    return f"{label}_{number:09d}"
