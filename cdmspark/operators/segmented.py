"""Skew-safe ordered windows: lag and running sum that split hot keys into chunks.

A window partitioned by ``key`` runs each key in one task, and AQE cannot split a
window partition.  When one key holds a large share of all rows (one person with a
third of the visits), that task is the job.  These operators give the same results as
``lag`` / running ``sum`` over ``partitionBy(key).orderBy(order)`` but partition by
``(key, chunk)``:

1. rows per key are counted (partial aggregation, one small row per key and task);
   when no key has more than ``hot_rows`` rows the callers use the plain window;
2. keys above ``hot_rows`` get ``n_chunks - 1`` boundaries at approximate quantiles of
   the first order column (a small table, materialised once); a row's chunk is the
   number of boundaries <= its value, so rows with equal values stay in one chunk and
   chunk order follows value order;
3. the window runs per (key, chunk);
4. a per-(key, chunk) table (a few rows per hot key, one per ordinary key) carries each
   chunk's last value / total to the next chunk: the first row of a chunk takes the
   previous non-empty chunk's last value, running sums add the previous chunks' totals.

Ordinary keys are one chunk (0), so for them this is the plain window plus one join on
the same partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HOT_ROWS = 2_000_000
N_CHUNKS = 64


def hot_bounds(df: DataFrame, key: str, order_col: str, hot_rows: int = HOT_ROWS,
               n_chunks: int = N_CHUNKS) -> DataFrame | None:
    """Chunk boundaries of the hot keys, materialised once (one row per hot key, so at
    most rows / hot_rows rows); ``None`` when no key is hot."""
    from ..session import persist_reliably
    pcts = [i / n_chunks for i in range(1, n_chunks)]
    hot = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot_rows).select(key)
    if hot.isEmpty():                       # the usual case: one narrow aggregation, no more work
        return None
    return persist_reliably(df.join(hot, key, "left_semi").groupBy(key)
                            .agg(F.percentile_approx(order_col, pcts, 10_000).alias("_bounds")))


def with_chunks(df: DataFrame, key: str, order_col: str, bounds: DataFrame,
                chunk_col: str = "_chunk") -> DataFrame:
    """Add ``chunk_col``: 0 for ordinary keys, 0..n_chunks-1 by value range for hot keys."""
    x = df.join(bounds, key, "left")
    chunk = F.when(F.col("_bounds").isNull(), F.lit(0)).otherwise(
        F.size(F.filter("_bounds", lambda b: b <= F.col(order_col))))
    return x.withColumn(chunk_col, chunk.cast("int")).drop("_bounds")


def _w(key, chunk_col, order: list[Column]):
    return Window.partitionBy(key, chunk_col).orderBy(*order)


def segmented_lag(df: DataFrame, key: str, order: list[Column], value_col: str, out: str,
                  chunk_col: str = "_chunk") -> DataFrame:
    """``lag(value_col)`` over ``partitionBy(key).orderBy(order)``, computed per chunk.
    The per-chunk carry rows come from the same windowed frame (same exchange)."""
    w = _w(key, chunk_col, order)
    whole = Window.partitionBy(key, chunk_col)
    x = (df.withColumn(out, F.lag(value_col).over(w))
           .withColumn("_pos", F.row_number().over(w))
           .withColumn("_cnt", F.count(F.lit(1)).over(whole)))
    last = (x.where(F.col("_pos") == F.col("_cnt")).select(key, chunk_col, F.col(value_col).alias("_last"))
             .withColumn("_carry", F.lag("_last").over(Window.partitionBy(key).orderBy(chunk_col)))
             .select(key, chunk_col, "_carry"))
    return (x.join(last, [key, chunk_col], "left")
             .withColumn(out, F.when(F.col("_pos") == 1, F.col("_carry")).otherwise(F.col(out)))
             .drop("_pos", "_cnt", "_carry"))


def segmented_running_sum(df: DataFrame, key: str, order: list[Column], value_col: str, out: str,
                          chunk_col: str = "_chunk") -> DataFrame:
    """Running ``sum(value_col)`` (rows unbounded preceding .. current), per chunk."""
    w = _w(key, chunk_col, order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    x = df.withColumn(out, F.sum(value_col).over(w))
    tot = (x.groupBy(key, chunk_col).agg(F.sum(value_col).alias("_tot"))
             .withColumn("_off", F.coalesce(F.sum("_tot").over(
                 Window.partitionBy(key).orderBy(chunk_col).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
             .select(key, chunk_col, "_off"))
    return (x.join(tot, [key, chunk_col], "left")
             .withColumn(out, F.col(out) + F.coalesce(F.col("_off"), F.lit(0)))
             .drop("_off"))


def segmented_prev_max(df: DataFrame, key: str, order: list[Column], value_col: str, out: str,
                       chunk_col: str = "_chunk") -> DataFrame:
    """``max(value_col)`` over all earlier rows of the key (rows unbounded .. -1), per chunk."""
    w = _w(key, chunk_col, order).rowsBetween(Window.unboundedPreceding, -1)
    x = df.withColumn(out, F.max(value_col).over(w))
    mx = (x.groupBy(key, chunk_col).agg(F.max(value_col).alias("_mx"))
            .withColumn("_carry", F.max("_mx").over(
                Window.partitionBy(key).orderBy(chunk_col).rowsBetween(Window.unboundedPreceding, -1)))
            .select(key, chunk_col, "_carry"))
    both = F.when(F.col(out).isNull(), F.col("_carry")).when(F.col("_carry").isNull(), F.col(out)) \
        .otherwise(F.greatest(F.col(out), F.col("_carry")))
    return x.join(mx, [key, chunk_col], "left").withColumn(out, both).drop("_carry")
