"""Presentation of results: stable column types shared with the SQL oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def present(df: DataFrame) -> DataFrame:
    """Timestamps → timestamp_ntz, exact decimals → double (correctly rounded, no further rounding)."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        elif isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        cols.append(c.alias(f.name))
    return df.select(*cols)
