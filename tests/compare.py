"""Run a registered query next to its SQL twin and compare rows and types."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def oracle_connection(sf_dir: str):
    connection = duckdb.connect()
    for table in TABLES:
        path = Path(sf_dir) / f"{table}.parquet"
        if path.exists():
            connection.execute(
                f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}')"
            )
    return connection


_SAME_TYPE = {
    "BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean",
}


def _sorted_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    picked = [tuple(row[i] for i in order) for row in rows]
    return sorted(picked, key=lambda r: tuple((v is None, str(type(v)), v) for v in r))


def differences(spark_frame, connection, sql: str) -> list[str]:
    """What differs between a Spark frame and a SQL result, as messages."""
    oracle = connection.execute(sql)
    names = [d[0] for d in oracle.description]
    types = {d[0]: _SAME_TYPE.get(str(d[1]), str(d[1])) for d in oracle.description}
    expected = _sorted_rows(names, oracle.fetchall())
    spark_types = dict(spark_frame.dtypes)
    if spark_types != types:
        return [f"types differ: {sorted(set(spark_types.items()) ^ set(types.items()))}"]
    found = _sorted_rows(spark_frame.columns, [tuple(r) for r in spark_frame.collect()])
    if len(found) != len(expected):
        return [f"{len(found)} rows, expected {len(expected)}"]
    bad = [
        f"{sorted(names)}: {f} is not {e}"
        for f, e in zip(found, expected, strict=True)
        if not _same(f, e)
    ]
    return bad[:5] + ([f"{len(bad)} rows differ"] if bad else [])


def _same(left, right) -> bool:
    return all(
        a == b or (isinstance(a, float) and isinstance(b, float) and math.isnan(a) and math.isnan(b))
        for a, b in zip(left, right, strict=True)
    )
