"""Gap-and-islands sessioniser (observation periods).

lag(end) -> new-island flag -> running sum -> min/max per island.  All window steps use
the same partitioning and order, so Catalyst plans one hash exchange and one sort for
them.  With ``hot_rows`` (the default) the windows partition by (person, chunk): a
person with more than ``hot_rows`` encounters is cut into ordered chunks and the
chunk boundaries are repaired exactly (see ``segmented``), so one person holding a
third of all rows does not become one task.  ``hot_rows=None`` gives the plain windows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import ISLAND_GAP_DAYS
from . import segmented as seg

HOT_ROWS = seg.HOT_ROWS


def _window(person: str, start: str, end: str):
    return Window.partitionBy(person).orderBy(F.col(start), F.col(end))


def with_prev_end(df: DataFrame, person="person_id", start="start_date", end="end_date",
                  overlap_aware: bool = False, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Previous encounter's end (or the running max end when ``overlap_aware``).
    Adds ``_chunk`` when some person has more than ``hot_rows`` encounters."""
    order = [F.col(start), F.col(end)]
    bounds = seg.hot_bounds(df, person, start, hot_rows) if hot_rows is not None else None
    if bounds is not None:
        x = seg.with_chunks(df, person, start, bounds)
        fn = seg.segmented_prev_max if overlap_aware else seg.segmented_lag
        return fn(x, person, order, end, "prev_end_date")
    w = _window(person, start, end)
    if overlap_aware:
        prev = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    else:
        prev = F.lag(end).over(w)
    return df.withColumn("prev_end_date", prev)


def with_new_period_flag(df: DataFrame, start="start_date", gap_days: int = ISLAND_GAP_DAYS) -> DataFrame:
    """1 when there is no previous encounter or the gap exceeds ``gap_days``."""
    flag = (F.when(F.col("prev_end_date").isNull(), 1)
            .when(F.datediff(F.to_date(start), F.to_date("prev_end_date")) > gap_days, 1)
            .otherwise(0))
    return df.withColumn("new_period_flag", flag.cast("int"))


def with_period_group(df: DataFrame, person="person_id", start="start_date", end="end_date") -> DataFrame:
    """Running sum of the flag = island number within the person."""
    order = [F.col(start), F.col(end)]
    if "_chunk" in df.columns:
        x = seg.segmented_running_sum(df, person, order, "new_period_flag", "period_group")
        return x.withColumn("period_group", F.col("period_group").cast("int"))
    w = _window(person, start, end).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn("period_group", F.sum("new_period_flag").over(w).cast("int"))


def islands(df: DataFrame, person="person_id", start="start_date", end="end_date",
            gap_days: int = ISLAND_GAP_DAYS, overlap_aware: bool = False,
            hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """One row per (person, island) with the island's first start and last end."""
    x = with_prev_end(df, person, start, end, overlap_aware, hot_rows)
    x = with_new_period_flag(x, start, gap_days)
    x = with_period_group(x, person, start, end)
    return (x.groupBy(person, "period_group")
             .agg(F.min(start).alias("observation_period_start_date"),
                  F.max(end).alias("observation_period_end_date")))
