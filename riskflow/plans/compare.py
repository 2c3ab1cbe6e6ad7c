"""Final projection used by the checked queries.

Engines render timestamps differently (session zone, precision), so checked
outputs carry event time as epoch seconds (bigint) and the nested ``window``
as ``window_start`` / ``window_end`` seconds.  This is presentation only and
runs after all operator work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def comparable(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.StructType) and f.name == "window":
            cols.append(F.unix_seconds(c["start"]).alias("window_start"))
            cols.append(F.unix_seconds(c["end"]).alias("window_end"))
        elif isinstance(f.dataType, T.TimestampType):
            cols.append(F.unix_seconds(c).alias(f.name))
        else:
            cols.append(c)
    return df.select(*cols)


# Columns that are integers or booleans *and* hold nulls in the mixed-shape
# outputs.  pandas renders such columns differently per engine (float64 vs a
# nullable Int64, object vs a nullable boolean), so the checked outputs carry
# them as DOUBLE (exact here: epoch seconds, counts) and as 'true'/'false' text.
NULLABLE_INTS = ["timestamp", "window_start", "window_end", "window_count"]
NULLABLE_BOOLS = ["is_fraud"]


def null_safe(df: DataFrame) -> DataFrame:
    cols = []
    for c in df.columns:
        if c in NULLABLE_INTS:
            cols.append(F.col(c).cast("double").alias(c))
        elif c in NULLABLE_BOOLS:
            cols.append(F.col(c).cast("string").alias(c))
        else:
            cols.append(F.col(c))
    return df.select(*cols)
