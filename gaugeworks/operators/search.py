"""Free-text search over whole rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def rendered(field: T.StructField) -> Column:
    """A cell as a reader sees it: NULL, TRUE/FALSE, numbers without idle zeros."""
    value = F.col(f"`{field.name}`")
    kind = field.dataType
    if isinstance(kind, T.BooleanType):
        text = F.upper(value.cast("string"))
    elif isinstance(kind, T.DecimalType) and kind.scale > 0:
        text = F.regexp_replace(value.cast("string"), r"\.?0+$", "")
    elif isinstance(kind, (T.DoubleType, T.FloatType)):
        text = F.regexp_replace(value.cast("string"), r"\.0$", "")
    elif isinstance(kind, T.TimestampType):
        text = F.concat(
            F.date_format(F.to_utc_timestamp(value, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss"),
            F.lit("+00:00"),
        )
    else:
        text = value.cast("string")
    return F.coalesce(text, F.lit("NULL"))


def search_rows(df: DataFrame, term: str) -> DataFrame:
    """Rows whose cells, read one after another, contain ``term`` in any case."""
    text = F.lower(F.concat(*[rendered(field) for field in df.schema]))
    return df.filter(F.contains(text, F.lit(term.lower())))
