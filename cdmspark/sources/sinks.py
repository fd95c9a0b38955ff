"""Sinks: create-if-absent, drop, append with counts, and contract rejects.

Appends go through ``DataFrameWriter`` in one job; the inserted count comes from an
``observe`` metric on the same pass, so the data is not read twice.  Row-level
failures are not discovered by retrying inserts: each row is checked against the
contract (types, NOT NULL, text length) first and split into ``good`` / ``rejects``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def create_if_absent(spark: SparkSession, table: str, schema: T.StructType, path: str | None = None,
                     partition_by: list[str] | None = None) -> None:
    """Create an empty parquet table with the contract schema unless it exists."""
    if spark.catalog.tableExists(table):
        return
    empty = spark.createDataFrame([], schema)
    w = empty.write.format("parquet")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if path:
        w = w.option("path", path)
    w.saveAsTable(table)


def drop_if_exists(spark: SparkSession, table: str) -> None:
    """A8."""
    spark.sql(f"DROP TABLE IF EXISTS {table}")


def append(df: DataFrame, table: str, name: str = "append") -> int:
    """One append job; returns the number of rows written (observed, not recounted)."""
    obs = Observation(name)
    df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("append").insertInto(table)
    return int(obs.get.get("rows", 0))


def contract_violations(df: DataFrame, schema: T.StructType, max_lengths: dict[str, int] | None = None):
    """Column expressions naming why a row breaks the contract (NULL when it does not)."""
    checks = []
    for f in schema.fields:
        if f.name not in df.columns:
            continue
        c = F.col(f.name)
        if not f.nullable:
            checks.append(F.when(c.isNull(), F.lit(f"{f.name} is null")))
        if max_lengths and f.name in max_lengths:
            checks.append(F.when(F.length(c) > max_lengths[f.name], F.lit(f"{f.name} too long")))
    return checks


def split_rejects(df: DataFrame, schema: T.StructType, max_lengths: dict[str, int] | None = None,
                  reason_col: str = "reject_reason") -> DataFrame:
    """A10 + B9 + H13: normalise blanks, cast to the contract with ``try_cast`` and tag
    each row with the first contract violation (NULL = good row).

    Callers write ``where(reason IS NULL)`` to the target and the rest to a rejects
    table; both come from this one frame, so the source is read once when persisted.
    """
    cast_cols, cast_fail = [], []
    for f in schema.fields:
        if f.name not in df.columns:
            cast_cols.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        c = F.col(f.name)
        if isinstance(df.schema[f.name].dataType, T.StringType):
            c = F.when(F.trim(c) == "", None).otherwise(c)  # B9: blank -> NULL
        if df.schema[f.name].dataType == f.dataType:
            cast_cols.append(c.alias(f.name))
        else:
            tc = c.try_cast(f.dataType)
            cast_cols.append(tc.alias(f.name))
            cast_fail.append(F.when(c.isNotNull() & tc.isNull(), F.lit(f"{f.name} bad value")))
    failed = F.coalesce(*cast_fail) if cast_fail else F.lit(None).cast("string")
    x = df.select(*cast_cols, failed.alias("_cast_fail"))
    checks = contract_violations(x, schema, max_lengths)
    reason = F.coalesce(F.col("_cast_fail"), *checks) if checks else F.col("_cast_fail")
    return x.withColumn(reason_col, reason).drop("_cast_fail")


def good_rows(tagged: DataFrame, reason_col: str = "reject_reason") -> DataFrame:
    return tagged.where(F.col(reason_col).isNull()).drop(reason_col)


def rejected_rows(tagged: DataFrame, reason_col: str = "reject_reason") -> DataFrame:
    return tagged.where(F.col(reason_col).isNotNull())


