"""Project a result onto types both Spark and DuckDB produce identically.

Instants become zone-less UTC timestamps, decimals and floats become doubles.
Used only at the very end of a registered query, so the library's own tables
keep their declared types.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def to_portable(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        elif isinstance(f.dataType, (T.DecimalType, T.FloatType)):
            c = c.cast("double")
        elif isinstance(f.dataType, (T.ShortType, T.ByteType)):
            c = c.cast("int")
        cols.append(c.alias(f.name))
    return df.select(*cols)
