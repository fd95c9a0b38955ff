"""Targets in buckets, so that looking keys up in a very large target never shuffles it.

A target is written as a table whose files are dealt by the hash of a key and sorted by it.  A
join on that key then reads the target bucket by bucket where it lies; only the new rows, which
are few beside it, are dealt to its buckets.  A target that is joined on two keys (the id for the
anti-join, the person for the preceding visit) has its key columns written once by each.

Spark keeps a side's buckets only if they are no fewer than ``spark.sql.shuffle.partitions``.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_path

ROWS_PER_BUCKET = 5_000_000


def bucket_count(spark: SparkSession, rows: int, rows_per_bucket: int = ROWS_PER_BUCKET) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // rows_per_bucket))


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int, path: str, mode: str = "errorifexists") -> DataFrame:
    """Write ``df`` as ``table`` under ``path`` in ``buckets`` buckets by ``key``; rows are dealt
    before the write, so that a bucket is one file and not one per task."""
    (df.repartition(buckets, key).sortWithinPartitions(key).write.mode(mode).bucketBy(buckets, key).sortBy(key)
     .option("path", path).saveAsTable(table))
    return df.sparkSession.table(table)


@contextmanager
def bucketed_keys(existing: DataFrame, keys: list[str], rows: int) -> Iterator[dict[str, DataFrame]]:
    """``existing`` written in buckets by each of ``keys``, as tables that go when the block ends
    (their files stay in the scratch folder until that goes)."""
    spark, made = existing.sparkSession, {}
    try:
        for key in keys:
            name = f"bucketed_{uuid.uuid4().hex}"
            made[key] = (name, write_bucketed(existing, name, key, bucket_count(spark, rows), scratch_path(spark, f"bucketed/{name}")))
        yield {key: df for key, (_, df) in made.items()}
    finally:
        for name, _ in made.values():
            spark.sql(f"DROP TABLE IF EXISTS {name}")
