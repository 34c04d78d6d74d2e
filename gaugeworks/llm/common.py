"""Shared pieces of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A key is hot if it holds more than one in this many rows, so there are fewer hot keys.
HOT_SHARE = 1000


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents_of(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The two columns an operator reads, as ``doc_id`` long and ``text`` (null: empty)."""
    return docs.select(
        docs[id_col].cast("long").alias("doc_id"),
        F.coalesce(docs[text_col], F.lit("")).alias("text"),
    )


def rows_like(
    fields: str, rows: Callable[[Iterator[dict]], Iterator[tuple]], at_once: int = 256
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function for ``mapInArrow`` from one over column lists of up to ``at_once`` rows."""
    schema = pa.schema([(n, _ARROW[t]) for n, t in map(str.split, fields.split(","))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pieces():
            for batch in batches:
                for at in range(0, batch.num_rows, at_once):
                    yield batch.slice(at, at_once).to_pydict()

        for columns in rows(pieces()):
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)],
                schema=schema,
            )

    return run


_ARROW = {
    "long": pa.int64(),
    "int": pa.int32(),
    "double": pa.float64(),
    "boolean": pa.bool_(),
    "string": pa.string(),
    "binary": pa.binary(),
    "array<long>": pa.list_(pa.int64()),
    "array<int>": pa.list_(pa.int32()),
    "array<double>": pa.list_(pa.float64()),
    "array<float>": pa.list_(pa.float32()),
    "array<string>": pa.list_(pa.string()),
}


def hot_of(groups: DataFrame, count: str = "n_rows") -> DataFrame:
    """Groups with more than one in HOT_SHARE of all counted rows: under HOT_SHARE groups."""
    total = groups.agg(F.sum(count)).first()[0] or 0
    return groups.filter(F.col(count) * HOT_SHARE > F.lit(total))


def attach(
    rows: DataFrame, groups: DataFrame, key: str, count: str = "n_rows"
) -> DataFrame:
    """Join each row with its group's one row. Rows of hot groups meet theirs by
    broadcast, under HOT_SHARE small rows; so no shuffled key holds many rows."""
    hot = F.broadcast(hot_of(groups, count))
    cold = rows.join(F.broadcast(hot.select(key)), key, "left_anti")
    return cold.join(groups, key).unionByName(rows.join(hot, key))


#: Tasks that a hot group's rows are dealt to.
HOT_PARTS = 64


def attach_once(rows: DataFrame, groups: DataFrame, key: str, count: str = "n_rows") -> DataFrame:
    """As ``attach``, for rows that take much to make: they are made once. A hot group's one
    row is copied HOT_PARTS times, and its rows are dealt to the copies."""
    hot, part = "__attach_hot", "__attach_part"
    known = F.broadcast(hot_of(groups, count).select(key, F.lit(True).alias(hot)))
    dealt = F.when(F.col(hot), spread(F.struct(*rows.columns), HOT_PARTS)).otherwise(0)
    copies = F.when(F.col(hot), F.sequence(F.lit(0), F.lit(HOT_PARTS - 1))).otherwise(F.array(F.lit(0)))
    left = rows.join(known, key, "left").withColumn(part, dealt).drop(hot)
    right = groups.join(known, key, "left").withColumn(part, F.explode(copies)).drop(hot)
    return left.join(right, [key, part]).drop(part)


def spread(column: Column, parts: int) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(parts)).cast("int")
