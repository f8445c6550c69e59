"""Result boundary used by registered queries.

Cross-engine comparison needs (a) zone-free timestamps — TIMESTAMP is
cast to TIMESTAMP_NTZ, which holds the same UTC wall-clock value — and
(b) doubles rounded to a fixed number of decimals, because float sums
depend on summation order. Library functions return full precision;
only the registered query results pass through here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DECIMALS = 6


def stable(df: DataFrame, decimals: int = DECIMALS) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.round(c, decimals) + F.lit(0.0)  # never -0.0
        cols.append(c.alias(f.name))
    return df.select(*cols)
