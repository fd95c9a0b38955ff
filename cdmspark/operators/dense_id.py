"""Dense 1..n ids in a stated order without a single-partition window.

A global ``row_number()`` moves every row into one task.  Instead rows are cut into even
ranges at quantiles of the leading key, each range is counted, the (small: one row per range)
count table gets cumulative offsets, and ``row_number()`` runs inside each range in parallel.
Quantiles follow the rows, so clustered or far-out keys give ranges of about the same size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import persist_reliably

RANGE_ROWS, MAX_RANGES = 200_000, 10_000


def quantile_bounds(df: DataFrame, col: str, range_rows: int = RANGE_ROWS) -> list:
    """Rising bounds that cut ``col`` into ranges of about ``range_rows`` rows (at most
    ``MAX_RANGES``, so the list is bounded by a parameter)."""
    n = min(MAX_RANGES, -(-df.count() // range_rows))
    if n < 2:
        return []
    got = df.agg(F.percentile_approx(col, [i / n for i in range(1, n)], 100 * n).alias("b")).first()["b"]
    return sorted(set(got))


def range_of(col: str, bounds: list) -> Column:
    """A number that rises with the bounds below ``col``, found in two steps of about the bounds'
    square root."""
    if not bounds:
        return F.lit(0)
    step = max(1, int(len(bounds) ** 0.5))
    fine = [bounds[i:i + step] for i in range(0, len(bounds), step)]
    below = lambda v: F.size(F.filter(v, lambda x: x < F.col(col)))
    coarse = below(F.array(*[F.lit(f[-1]) for f in fine]))
    inner = F.get(F.array(*[F.array(*[F.lit(x) for x in f]) for f in fine]), coarse)
    return (coarse * step + F.when(inner.isNull(), 0).otherwise(below(inner))).cast("int")


def dense_ids(df: DataFrame, order_cols: list[str], id_col: str = "row_id",
              bucket_col: str | None = None, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Attach ``id_col`` = 1..n following ``order_cols`` (ties must not exist in them).

    ``bucket_col`` must be a numeric column whose order agrees with the first order
    column (it is normally that column).
    """
    lead = bucket_col or order_cols[0]
    # Materialise once (shared checkpoint folder): the bounds, the counts and the
    # numbering all read the written rows instead of re-running the input's plan.
    df = persist_reliably(df)
    ranged = df.withColumn("_range", range_of(lead, quantile_bounds(df, lead, range_rows)))
    counts = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select("_range", F.coalesce(F.sum("_n").over(
        Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_offset"))
    w = Window.partitionBy("_range").orderBy(*[F.col(c) for c in order_cols])
    return (ranged.join(F.broadcast(offsets), "_range")     # MAX_RANGES rows at most
            .withColumn(id_col, (F.col("_offset") + F.row_number().over(w)).cast("long"))
            .drop("_range", "_offset"))
