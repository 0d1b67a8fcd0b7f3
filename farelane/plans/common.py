"""Shared helpers for registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farelane.functions.columns import ntz_string


def comparable(df: DataFrame, digits: int = 6) -> DataFrame:
    """Normalise output types for engine-independent comparison: floating
    columns -> rounded double, integral -> bigint, timestamps -> 'yyyy-MM-dd HH:mm:ss.ffffff' strings."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        t = f.dataType
        if isinstance(t, (T.FloatType, T.DoubleType, T.DecimalType)):
            c = F.round(c.cast("double"), digits)
        elif isinstance(t, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("long")
        elif isinstance(t, T.TimestampNTZType):
            c = ntz_string(f.name)
        elif isinstance(t, T.TimestampType):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        cols.append(c.alias(f.name))
    return df.select(*cols)
