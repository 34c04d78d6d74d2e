"""Sensor CSV files: scan, rename, cast, lineage and the audited batch load."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeworks.operators.changes import effective
from gaugeworks.operators.upsert import resolve_duplicates, upsert
from gaugeworks.schemas import (
    RAW,
    RAW_COLUMN_MAP,
    RAW_TABLE,
    READING,
    REJECTS_TABLE,
)
from gaugeworks.session import landed
from gaugeworks.sources.logs import log_ingestion
from gaugeworks.sources.tables import STORED_ROWS, Warehouse

# Cell texts that mean "no value" (fixed values).
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# What a reload changes on a known id. Identity, source and the five mode flags keep
# their first values.
RELOAD_COLUMNS = [
    "air_temperature_k",
    "process_temperature_k",
    "rotational_speed_rpm",
    "torque_nm",
    "tool_wear_min",
    "machine_failure",
    "batch_id",
    "ingested_at",
]

# Where a row came from and when, which says nothing about the reading.
STAMPS = ["source_dataset", "batch_id", "ingested_at"]

FILE_ORDER = "_file_order"
ROW_ORDER = "_row_order"


class RejectedRowsError(ValueError):
    """A batch holds rows that do not fit the reading schema."""


def read_sensor_csv(spark: SparkSession, path: str) -> DataFrame:
    """The file's columns as text, named by its header.

    Of a folder of files, all must have the same header.
    """
    return spark.read.csv(path, header=True, enforceSchema=False)


def rename_columns(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """The mapped columns under their new names; others go, a missing one raises."""
    missing = [source for source in mapping if source not in df.columns]
    if missing:
        raise ValueError(f"source lacks columns {missing}")
    return df.select(*[F.col(f"`{old}`").alias(new) for old, new in mapping.items()])


def _present(text: Column) -> Column:
    return F.when(~F.trim(text).isin(NULL_TOKENS), F.trim(text))


def _parsed(text: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StringType):
        return text
    if isinstance(kind, T.DecimalType):
        return text.try_cast(kind)
    # "1200.0" is a whole number too
    return F.round(text.try_cast("decimal(28,8)"), 0).try_cast(kind)


def cast_readings(text: DataFrame) -> DataFrame:
    """Typed readings, with ``reject_reason`` and the ``source_row`` where one is set.

    Three projections, so that each cell is cleaned once and parsed once.
    """
    names = READING.names
    extra = [c for c in text.columns if c not in names]
    cells = text.select(
        *[F.col(c).alias(f"_text_{c}") for c in names],
        *[_present(F.col(c)).alias(f"_cell_{c}") for c in names],
        *extra,
    )
    typed = cells.select(
        "*", *[_parsed(F.col(f"_cell_{f.name}"), f.dataType).alias(f.name) for f in READING]
    )
    problems = []
    for field in READING:
        cell = F.col(f"_cell_{field.name}")
        unreadable = cell.isNotNull() & F.col(field.name).isNull()
        kind = field.dataType.simpleString()
        problems.append(F.when(unreadable, F.lit(f"{field.name}: not a {kind}")))
        if not field.nullable:
            missing = F.lit(f"{field.name}: required but missing")
            problems.append(F.when(cell.isNull(), missing))
    reason = F.nullif(F.concat_ws("; ", *problems), F.lit(""))
    source = F.struct(*[F.col(f"_text_{c}").alias(c) for c in names])
    return typed.withColumn("reject_reason", reason).select(
        *names,
        *extra,
        "reject_reason",
        F.when(F.col("reject_reason").isNotNull(), source).alias("source_row"),
    )


def add_lineage(
    df: DataFrame, source: str, batch_id: str, now: datetime | Column
) -> DataFrame:
    """Stamp the batch: file name, batch id and one instant for all rows."""
    instant = now if isinstance(now, Column) else F.lit(now)
    return df.withColumns(
        {
            "source_dataset": F.lit(source),
            "batch_id": F.lit(batch_id),
            "ingested_at": instant.cast("timestamp"),
        }
    )


def new_batch_id(now: datetime | None = None) -> str:
    now = now or datetime.now(UTC)
    return f"batch_{now:%Y%m%d_%H%M%S}_{uuid.uuid4().hex[:6]}"


def load_raw(
    warehouse: Warehouse,
    batch: DataFrame,
    update_cols=RELOAD_COLUMNS,
    duplicates: str = "error",
    order_by: str | None = None,
    skip_unchanged: bool = False,
    marks: Mapping[str, int] | None = None,
) -> None:
    """Merge stamped readings into the raw table by ``udi``.

    With ``skip_unchanged`` readings that are in the table as they come, but for their
    stamps, keep their old stamps; a batch of such readings writes nothing. ``marks`` become
    current together with the rows.
    """
    batch = resolve_duplicates(batch, ["udi"], duplicates, order_by)
    if skip_unchanged and warehouse.version(RAW_TABLE):
        known = warehouse.read(RAW_TABLE, warehouse.touched(RAW_TABLE, batch))
        with landed(effective(batch, known, ["udi"], compared_columns(update_cols)), "raw-changes") as news:
            if news.isEmpty():
                warehouse.publish(marks={RAW_TABLE: marks or {}})
            else:
                _merge_raw(warehouse, news, update_cols, marks)
        return
    _merge_raw(warehouse, batch, update_cols, marks)


def compared_columns(update_cols) -> list[str]:
    """The columns in which a reload may change a known reading, but for its stamps."""
    chosen = [c for c in RAW.names if c != "udi"] if update_cols == "all" else update_cols
    return [c for c in chosen if c not in STAMPS]


def _merge_raw(warehouse: Warehouse, batch: DataFrame, update_cols, marks) -> None:
    starts, touched = warehouse.cut(RAW_TABLE, batch)
    if warehouse.version(RAW_TABLE) == 0:
        warehouse.replace(RAW_TABLE, batch, marks, starts=starts)
        return
    merged = upsert(
        warehouse.read(RAW_TABLE, touched),
        batch,
        ["udi"],
        update_cols,
        duplicates="unique",
        large=warehouse.is_large(RAW_TABLE, touched, sum(touched.values())),
    )
    warehouse.replace(RAW_TABLE, merged, marks, starts=starts, replaced=touched)


def load_batch(
    warehouse: Warehouse,
    text: DataFrame,
    source: str,
    batch_id: str,
    now: datetime,
    on_reject: str = "raise",
    duplicates: str = "error",
    order_by: str | None = None,
    update_cols=RELOAD_COLUMNS,
    skip_unchanged: bool = False,
) -> None:
    """Load text columns named as readings, as one audited batch.

    The text is parsed once, into a Parquet table in the shared folder; counting,
    checking and merging read that. A failing load leaves the raw table as it was and
    is logged with its message. ``on_reject="quarantine"`` sets rows aside that do not
    fit the schema instead of failing the batch.
    """
    with landed(cast_readings(text), "landing") as typed:
        rows = typed.count()
        log_ingestion(warehouse, batch_id, source, rows, "IN_PROGRESS", now)
        try:
            fitting = without_rejects(warehouse, typed, batch_id, on_reject)
            stamped = add_lineage(fitting, source, batch_id, now)
            load_raw(warehouse, stamped, update_cols, duplicates, order_by, skip_unchanged)
        except Exception as error:
            log_ingestion(warehouse, batch_id, source, rows, "FAILED", now, str(error))
            raise
        log_ingestion(warehouse, batch_id, source, rows, "SUCCESS", now)


def ingest_batch(
    spark: SparkSession,
    path: str,
    root: str,
    batch_id: str | None = None,
    now: datetime | None = None,
    rows: int = STORED_ROWS,
    **options,
) -> str:
    """Load one CSV file, or a folder of them, as a batch and return its id.

    ``options`` are those of ``load_batch``. Where ``duplicates="last"`` is chosen, the
    line further down wins.
    """
    warehouse = Warehouse(spark, root, rows)
    if not warehouse.exists(path):
        raise FileNotFoundError(f"no source file at {path}")
    now = now or datetime.now(UTC)
    batch_id = batch_id or new_batch_id(now)
    source = path.rstrip("/").rsplit("/", 1)[-1]
    text = read_sensor_csv(spark, path).select("*", file_order().alias(FILE_ORDER))
    try:
        renamed = rename_columns(text, RAW_COLUMN_MAP | {FILE_ORDER: FILE_ORDER})
    except ValueError as error:
        found = text.count()
        log_ingestion(warehouse, batch_id, source, found, "IN_PROGRESS", now)
        log_ingestion(warehouse, batch_id, source, found, "FAILED", now, str(error))
        raise
    placed = renamed.withColumn(ROW_ORDER, row_order())
    load_batch(
        warehouse, placed, source, batch_id, now, order_by=ROW_ORDER, **options
    )
    return batch_id


def file_order() -> Column:
    """Where a row's file part stands among all file parts."""
    return F.struct(
        "_metadata.file_modification_time",
        "_metadata.file_path",
        "_metadata.file_block_start",
    )


def row_order() -> Column:
    """Where a row stands in arrival order; needs ``file_order`` in its column."""
    place = F.monotonically_increasing_id().alias("place")
    return F.struct(F.col(FILE_ORDER).alias("file"), place)


def without_rejects(
    warehouse: Warehouse, typed: DataFrame, batch_id: str, on_reject: str
) -> DataFrame:
    rejected = typed.filter(F.col("reject_reason").isNotNull())
    if on_reject == "raise":
        shown = [row.reject_reason for row in rejected.select("reject_reason").take(3)]
        if shown:
            raise RejectedRowsError("rows do not fit the schema: " + " | ".join(shown))
    elif on_reject == "quarantine":
        warehouse.append(
            REJECTS_TABLE,
            rejected.select(
                "source_row.*",
                F.lit(batch_id).alias("batch_id"),
                F.col("reject_reason").alias("reason"),
            ),
        )
    else:
        raise ValueError(f"on_reject must be raise or quarantine, not {on_reject!r}")
    return typed.filter(F.col("reject_reason").isNull()).drop(
        "reject_reason", "source_row"
    )
