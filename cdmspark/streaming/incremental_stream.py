"""Incremental visit load as a Structured Streaming job (L1).

A file source delivers new source files; each micro-batch runs the visit job (J3)
with a ``left_anti`` against the target as it stands when the batch starts, and
appends.  Properties:

* exactly-once per key: a batch re-run after a failure finds its own rows already in
  the target and skips them, so replays do not duplicate;
* the job itself keeps one row per key of a batch, in a stated order;
* the preceding-visit window is seeded from the target, so a person's first visit in
  a batch points at their last visit from earlier batches;
* ``Trigger.AvailableNow`` drains what is there and stops (batch-style scheduling
  with streaming bookkeeping); a processing-time trigger keeps it running.

The checkpoint and the target live under the shared ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..plans import jobs
from ..session import path_exists, scratch_path

#: Delivered files have small row groups, so that a micro-batch of one large file is read by many tasks.
ROW_GROUPS = ("parquet.block.size", 2 << 20)


def write_snapshot(df: DataFrame, path: str) -> DataFrame:
    """Cut lineage: write once to shared storage and read back."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def ensure_target(spark: SparkSession, path: str) -> None:
    """Create an empty target with the contract, only where the path is proven absent.  What
    is there is never written over: a read that fails later fails the batch, not the data."""
    if not path_exists(spark, path):
        spark.createDataFrame([], S.VISIT_OCCURRENCE).write.mode("errorifexists").parquet(path)


def stream_visits(spark: SparkSession, source_stream: DataFrame, persons: DataFrame, target_path: str,
                  checkpoint_path: str, available_now: bool = True, timeout_s: float | None = None):
    """Run the incremental visit load over ``source_stream`` (visit-source columns)."""
    ensure_target(spark, target_path)

    def process(batch: DataFrame, epoch_id: int) -> None:
        existing = spark.read.schema(S.VISIT_OCCURRENCE).parquet(target_path) \
            .select("person_id", "visit_occurrence_id")
        new = jobs.load_visit(batch, persons, existing=existing)
        new.write.mode("append").parquet(target_path)

    writer = (source_stream.writeStream.foreachBatch(process)
              .option("checkpointLocation", checkpoint_path)
              .queryName(f"stream_visit_{uuid.uuid4().hex[:8]}"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    q = writer.start()
    if available_now:
        q.awaitTermination(timeout_s)
    return q


def stream_visit_query(spark: SparkSession, sf_dir: str, visit_exprs: list[str], persons: DataFrame,
                       batches: int = 3) -> DataFrame:
    """Stream the orders as visit source, delivered in ``batches`` files of rising ids (one
    micro-batch each); return the loaded target."""
    run = uuid.uuid4().hex
    base = scratch_path(spark, f"stream_visit/{run}")
    orders = spark.read.parquet(f"{sf_dir.rstrip('/')}/orders.parquet")
    cuts = orders.agg(F.percentile_approx("o_orderkey", [i / batches for i in range(1, batches)]).alias("c")).first()["c"]
    part = reduce(lambda n, c: n + F.when(F.col("o_orderkey") > c, 1).otherwise(0), cuts or [], F.lit(0))
    for i in range(batches):
        # written one after the other: the file source takes files oldest first
        orders.where(part == i).coalesce(1).write.mode("append").option(*ROW_GROUPS).parquet(f"{base}/delivered")
    src = (spark.readStream.schema(orders.schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/delivered")
           .selectExpr(*visit_exprs))
    persons_snap = write_snapshot(persons.select("person_id"), f"{base}/persons")
    stream_visits(spark, src, persons_snap, f"{base}/visit_occurrence", f"{base}/checkpoint")
    return spark.read.schema(S.VISIT_OCCURRENCE).parquet(f"{base}/visit_occurrence")
