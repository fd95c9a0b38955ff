"""Date helpers (H7-H10): typed conversion that never raises under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def as_timestamp(df: DataFrame, name: str) -> Column:
    """Timestamp (no zone) from a timestamp, date or ISO text column; bad text -> NULL."""
    dt = df.schema[name].dataType
    c = F.col(name)
    if isinstance(dt, T.TimestampNTZType):
        return c
    if isinstance(dt, (T.TimestampType, T.DateType)):
        return c.cast("timestamp_ntz")
    if isinstance(dt, T.StringType):
        return F.try_to_timestamp(c).cast("timestamp_ntz")
    return F.lit(None).cast("timestamp_ntz")


def vocab_date(c) -> Column:
    """Vocabulary validity text: ``yyyyMMdd`` first, then ISO ``yyyy-MM-dd``."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.try_to_date(c, "yyyyMMdd"), F.try_to_date(c, "yyyy-MM-dd"))


def birth_parts(c) -> list[Column]:
    """H7: year, month, day of a datetime."""
    c = F.col(c) if isinstance(c, str) else c
    return [F.year(c).alias("year_of_birth"), F.month(c).alias("month_of_birth"),
            F.dayofmonth(c).alias("day_of_birth")]
