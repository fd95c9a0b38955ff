"""Tables in files of key ranges, and reads that open only the files they need (F2).

Rows are dealt to files by range of the cluster columns and sorted within, so that a file holds
one range; several columns split a key that holds many rows over files.  A list of the files
with the least and greatest key of each stands beside them.  A reader picks files from the list
and hands Spark only those; sorted row groups let Parquet skip more.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROWS_PER_FILE = 5_000_000


def write_clustered(df: DataFrame, path: str, columns: list[str], rows: int, rows_per_file: int = ROWS_PER_FILE) -> int:
    """Write ``df`` (of about ``rows`` rows) under ``path`` in files by range of ``columns``; the
    first column is the key of the file list.  Returns the number of files."""
    files = max(1, math.ceil(rows / rows_per_file))
    spark, base = df.sparkSession, path.rstrip("/")
    df.repartitionByRange(files, *columns).sortWithinPartitions(*columns).write.mode("overwrite").parquet(f"{base}/data")
    key = F.col(columns[0])
    listed = (spark.read.schema(df.schema).parquet(f"{base}/data").groupBy(F.input_file_name().alias("file"))
              .agg(F.min(key).alias("least"), F.max(key).alias("greatest"), F.count(F.lit(1)).alias("n"),
                   F.count_if(key.isNull()).alias("nulls")))
    listed.coalesce(1).write.mode("overwrite").parquet(f"{base}/files")
    return spark.read.parquet(f"{base}/files").count()


def files_between(spark: SparkSession, path: str, low, high) -> list[str]:
    """Files that may hold keys from ``low`` to ``high`` (None: no bound)."""
    listed = spark.read.parquet(f"{path.rstrip('/')}/files")
    if low is not None:
        listed = listed.where(F.col("greatest") >= F.lit(low))
    if high is not None:
        listed = listed.where(F.col("least") <= F.lit(high))
    return [r["file"] for r in listed.select("file").collect()]


def read_clustered(spark: SparkSession, path: str, key: str, low=None, high=None) -> DataFrame:
    """Rows with ``low <= key <= high``, from the files that may hold them; all rows without bounds."""
    base = path.rstrip("/")
    whole = spark.read.parquet(f"{base}/data")
    if low is None and high is None:
        return whole
    files = files_between(spark, path, low, high)
    got = spark.read.schema(whole.schema).parquet(*files) if files else whole.limit(0)
    if low is not None:
        got = got.where(F.col(key) >= F.lit(low))
    return got.where(F.col(key) <= F.lit(high)) if high is not None else got
