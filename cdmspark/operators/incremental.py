"""Incremental append by key: anti-joins against what is already loaded.

One ``left_anti`` replaces the NOT IN list / NOT EXISTS switch; Spark picks broadcast
or sort-merge from statistics (AQE re-plans at run time).  Null keys are removed by the
jobs' not-null filters first, so NOT IN and anti-join agree.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import segmented as seg


def new_rows(df: DataFrame, existing: DataFrame | None, keys: list[str]) -> DataFrame:
    """Rows of ``df`` whose key is not in ``existing`` (C6, C7, C8; G2)."""
    if existing is None:
        return df
    return df.join(existing.select(*keys), on=keys, how="left_anti")


def with_preceding(df: DataFrame, person: str = "person_id", visit: str = "visit_occurrence_id",
                   order_by: str | None = None, existing: DataFrame | None = None,
                   out: str = "preceding_visit_occurrence_id", hot_rows: int | None = seg.HOT_ROWS) -> DataFrame:
    """E5: previous visit of the same person, in visit-id order (or ``order_by``).

    With ``existing`` (visits already in the target) the previous visit is looked up
    over existing + new, so loading A then B gives what one load of A+B gives.  Of the
    target only the visits of persons in ``df`` are read on (a semi-join).
    """
    order = [F.col(order_by), F.col(visit)] if order_by else [F.col(visit)]
    lead = order_by or visit
    if existing is not None:
        cols = [person, visit] + ([order_by] if order_by and order_by != visit else [])
        # only visits of the persons at hand: the rest of the target stays out of the window
        here = df.select(person).distinct()
        seed = existing.select(*cols).join(here, person, "left_semi").withColumn("_new", F.lit(False))
        df = df.withColumn("_new", F.lit(True)).unionByName(seed, allowMissingColumns=True)
    bounds = seg.hot_bounds(df, person, lead, hot_rows) if hot_rows is not None else None
    if bounds is None:
        x = df.withColumn(out, F.lag(visit).over(Window.partitionBy(person).orderBy(*order)))
    else:
        # skew-safe: a person with more than hot_rows visits is split into ordered chunks
        x = seg.segmented_lag(seg.with_chunks(df, person, lead, bounds), person, order, visit, out).drop("_chunk")
    if existing is not None:
        x = x.where("_new").drop("_new")
    return x
