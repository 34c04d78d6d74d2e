"""Data-quality checks, evaluated together.

A check is a small description. All checks that aggregate one table share a single
scan of it; reference checks compare key counts, not rows. The verdicts come back as
one frame with a row per check, in the order the checks were given.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeworks.schemas import CHECK_VALUE

RESULT_COLUMNS = [
    "position",
    "check_name",
    "check_category",
    "table_name",
    "column_name",
    "status",
    "observed_value",
    "threshold_value",
    "severity",
    "details",
]


class DataQualityException(Exception):
    """A critical check failed."""


@dataclass(frozen=True)
class Check:
    """What to verify about one table.

    ``measure`` maps to aggregate expressions over the table; ``observed``,
    ``passed`` and ``details`` read their results.
    """

    name: str
    category: str
    table: str
    column: str | None
    threshold: float
    severity: str
    measures: Mapping[str, Column] = field(repr=False)
    verdict: object = field(repr=False)

    def result(self, prefix: str, position: int) -> Column:
        measured = {name: F.col(prefix + name) for name in self.measures}
        observed, passed, details = self.verdict(measured)
        return _row(self, position, observed, passed, details)


@dataclass(frozen=True)
class ReferenceCheck:
    """Every foreign key of a table has its row in a dimension."""

    table: str
    column: str
    dim_table: str
    dim_column: str
    severity: str = "CRITICAL"
    name: str = "check_referential_integrity"
    category: str = "Referential Integrity"
    threshold: float = 0.0

    def result(self, tables: Mapping[str, DataFrame], position: int) -> DataFrame:
        count = orphan_count(
            tables[self.table], self.column, tables[self.dim_table], self.dim_column
        )
        found = F.col("orphans")
        details = F.concat(
            found.cast("string"),
            F.lit(
                f" orphan records found in {self.table}.{self.column}"
                f" with no match in {self.dim_table}.{self.dim_column}"
            ),
        )
        return count.select(_row(self, position, found, found == 0, details).alias("r"))


@dataclass(frozen=True)
class UniqueCheck:
    """No key occurs twice; a missing key repeats nothing."""

    table: str
    column: str
    severity: str = "CRITICAL"
    name: str = "check_unique"
    category: str = "Uniqueness"
    threshold: float = 0.0

    def result(self, tables: Mapping[str, DataFrame], position: int) -> DataFrame:
        repeated = (
            tables[self.table]
            .filter(F.col(self.column).isNotNull())
            .groupBy(self.column)
            .agg(F.count("*").alias("n"))
            .filter("n > 1")
            .agg(F.count("*").alias("repeated"))
        )
        found = F.col("repeated")
        details = F.concat(_thousands(found), F.lit(" keys occur more than once"))
        return repeated.select(
            _row(self, position, found, found == 0, details).alias("r")
        )


@dataclass(frozen=True)
class ParityCheck:
    """Two tables have equally many rows."""

    table: str
    other: str
    severity: str = "CRITICAL"
    name: str = "check_row_parity"
    category: str = "Volume"
    column: str | None = None
    threshold: float = 0.0

    def result(self, tables: Mapping[str, DataFrame], position: int) -> DataFrame:
        one = tables[self.table].agg(F.count("*").alias("n"), F.lit(0).alias("m"))
        two = tables[self.other].agg(F.lit(0).alias("n"), F.count("*").alias("m"))
        both = one.unionByName(two).agg(F.sum("n").alias("n"), F.sum("m").alias("m"))
        gap = F.abs(F.col("n") - F.col("m"))
        details = F.concat(
            _thousands(F.col("n")), F.lit(" rows against "), _thousands(F.col("m"))
        )
        return both.select(_row(self, position, gap, gap == 0, details).alias("r"))


def check_row_count(
    table: str, min_expected: int, severity: str = "CRITICAL"
) -> Check:
    def verdict(m):
        details = F.concat(
            F.lit("Found "),
            _thousands(m["rows"]),
            F.lit(f" rows (expected >= {min_expected:,})"),
        )
        return m["rows"], m["rows"] >= min_expected, details

    return Check(
        "check_row_count",
        "Volume",
        table,
        None,
        min_expected,
        severity,
        {"rows": F.count("*")},
        verdict,
    )


def check_null_percentage(
    table: str, column: str, max_allowed_pct: float = 0.0, severity: str = "CRITICAL"
) -> Check:
    """Share of NULLs; an empty table has none."""

    def verdict(m):
        total = m["rows"].cast("double")
        share = F.when(m["rows"] == 0, F.lit(0.0)).otherwise(
            m["nulls"] / F.nullif(total, F.lit(0.0)) * 100.0
        )
        details = F.concat(
            _thousands(m["nulls"]),
            F.lit(" nulls out of "),
            _thousands(m["rows"]),
            F.lit(" ("),
            F.format_number(share, 2),
            F.lit(f"% nulls, threshold <= {max_allowed_pct}%)"),
        )
        return F.round(share, 4), share <= max_allowed_pct, details

    return Check(
        "check_null_percentage",
        "Completeness",
        table,
        column,
        max_allowed_pct,
        severity,
        {"rows": F.count("*"), "nulls": F.count_if(F.col(column).isNull())},
        verdict,
    )


def check_not_null(table: str, column: str, severity: str = "CRITICAL") -> Check:
    """A required column; the share of NULLs must be zero."""
    return check_null_percentage(table, column, 0.0, severity)


def check_numeric_range(
    table: str, column: str, low: float, high: float, severity: str = "CRITICAL"
) -> Check:
    """Values outside [low, high]; a NULL is not outside."""
    value = F.col(column)
    outside = (value < low) | (value > high)

    def verdict(m):
        details = F.concat(
            m["bad"].cast("string"),
            F.lit(f" out-of-bounds rows found. Allowed [{low}, {high}]."),
        )
        return m["bad"], m["bad"] == 0, details

    return Check(
        "check_numeric_range",
        "Validity",
        table,
        column,
        0.0,
        severity,
        {
            "bad": F.count_if(outside),
            "least": F.min(F.when(outside, value)),
            "greatest": F.max(F.when(outside, value)),
        },
        verdict,
    )


def check_referential_integrity(
    table: str,
    column: str,
    dim_table: str,
    dim_column: str,
    severity: str = "CRITICAL",
) -> ReferenceCheck:
    """Rows whose key has no dimension row; a NULL key has none."""
    return ReferenceCheck(table, column, dim_table, dim_column, severity)


def check_unique(table: str, column: str, severity: str = "CRITICAL") -> UniqueCheck:
    return UniqueCheck(table, column, severity)


def check_row_parity(table: str, other: str, severity: str = "CRITICAL") -> ParityCheck:
    return ParityCheck(table, other, severity)


def check_accepted_values(
    table: str, column: str, accepted: Sequence[str], severity: str = "CRITICAL"
) -> Check:
    """Values that are not on the list; a NULL is not checked."""

    def verdict(m):
        listed = ", ".join(str(v) for v in accepted)
        details = F.concat(
            _thousands(m["bad"]), F.lit(f" values outside the list: {listed}")
        )
        return m["bad"], m["bad"] == 0, details

    return Check(
        "check_accepted_values",
        "Validity",
        table,
        column,
        0.0,
        severity,
        {"bad": F.count_if(~F.col(column).isin(list(accepted)))},
        verdict,
    )


def check_fits_type(
    table: str, column: str, kind: str, severity: str = "CRITICAL"
) -> Check:
    """Values that a type such as ``decimal(8,2)`` or ``varchar(50)`` cannot hold."""
    value = F.col(column)
    if kind.lower().startswith(("varchar(", "char(")):
        length = int(kind[kind.index("(") + 1 : -1])
        bad = F.length(value) > length
    else:
        bad = value.isNotNull() & value.try_cast(kind).isNull()

    def verdict(m):
        details = F.concat(_thousands(m["bad"]), F.lit(f" values do not fit {kind}"))
        return m["bad"], m["bad"] == 0, details

    return Check(
        "check_fits_type",
        "Validity",
        table,
        column,
        0.0,
        severity,
        {"bad": F.count_if(bad)},
        verdict,
    )


def orphan_count(
    fact: DataFrame, foreign_key: str, dim: DataFrame, key: str
) -> DataFrame:
    """Number of fact rows without a dimension row, as one row ``orphans``.

    Rows are counted per key before they are shuffled, so a key that a third of the
    facts share arrives as one row per task.
    """
    per_key = fact.groupBy(F.col(foreign_key).alias("_fk")).agg(F.count("*").alias("_n"))
    known = dim.select(F.col(key).alias("_pk"))
    unmatched = per_key.join(known, F.col("_fk") == F.col("_pk"), "left_anti")
    return unmatched.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("orphans"))


def out_of_range(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    """Number, least and greatest of the values outside [low, high]."""
    value = F.col(column)
    return df.filter((value < low) | (value > high)).agg(
        F.count("*").alias("out_of_bounds"),
        F.min(column).alias("min_found"),
        F.max(column).alias("max_found"),
    )


def run_suite(
    tables: Mapping[str, DataFrame],
    checks: Sequence[Check | ReferenceCheck | UniqueCheck | ParityCheck],
) -> DataFrame:
    """All verdicts: one aggregate per table, one small join per reference check."""
    parts = []
    by_table: dict[str, list[tuple[int, Check]]] = {}
    for position, check in enumerate(checks, 1):
        if isinstance(check, Check):
            by_table.setdefault(check.table, []).append((position, check))
        else:
            parts.append(check.result(tables, position))
    for table, members in by_table.items():
        aggregates = [
            expression.alias(f"c{position}_{name}")
            for position, check in members
            for name, expression in check.measures.items()
        ]
        results = [check.result(f"c{position}_", position) for position, check in members]
        parts.append(
            tables[table]
            .agg(*aggregates)
            .select(F.explode(F.array(*results)).alias("r"))
        )
    if not parts:
        raise ValueError("a suite needs at least one check")
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part)
    return stacked.select("r.*")


def enforce(results) -> bool:
    """Raise if a critical check failed; ``results`` are the collected verdicts."""
    failed = [r for r in results if r.status == "FAILED" and r.severity == "CRITICAL"]
    if failed:
        listed = "; ".join(f"{r.check_name} on {r.table_name}" for r in failed)
        raise DataQualityException(
            f"{len(failed)} critical quality check(s) failed: {listed}"
        )
    return True


def _thousands(number: Column) -> Column:
    return F.format_number(number, 0)


def _row(check, position: int, observed: Column, passed: Column, details: Column):
    values = [
        F.lit(position),
        F.lit(check.name),
        F.lit(check.category),
        F.lit(check.table),
        F.lit(check.column).cast(T.StringType()),
        F.when(passed, F.lit("PASSED")).otherwise(F.lit("FAILED")),
        observed.cast(CHECK_VALUE),
        F.lit(float(check.threshold)).cast(CHECK_VALUE),
        F.lit(check.severity),
        details,
    ]
    return F.struct(*[v.alias(c) for v, c in zip(values, RESULT_COLUMNS, strict=True)])
