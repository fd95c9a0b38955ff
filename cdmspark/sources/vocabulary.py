"""Vocabulary files (tab-separated, header) and their typing.

Files are read with an all-text schema, no quoting and only the empty string as NULL
(so a concept named ``NA`` stays a name and a double quote stays a character).  Typing
is one projection with ``try_cast`` / ``try_to_date``: a bad value becomes NULL and
the row goes to rejects instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S
from ..functions.dates import vocab_date


def read_vocab_file(spark: SparkSession, path: str, raw_schema: T.StructType) -> DataFrame:
    """A1 / A2: tab-separated text with a header; every column read as text and taken by its
    header name (any case), whatever the file's column order; a missing column is an error."""
    raw = (spark.read.option("sep", "\t").option("header", "true").option("inferSchema", "false")
           .option("quote", "").option("escape", "")
           .option("nullValue", "").option("emptyValue", "")
           .option("mode", "PERMISSIVE")
           .csv(path))
    by_name = {c.strip().lower(): c for c in raw.columns}
    missing = [n for n in raw_schema.names if n.lower() not in by_name]
    if missing:
        raise ValueError(f"{path}: no column {', '.join(missing)} in the header")
    return raw.select(*[F.col(f"`{by_name[n.lower()]}`").cast("string").alias(n) for n in raw_schema.names])


def write_by_domain(concepts: DataFrame, path: str) -> None:
    """The concept table partitioned by domain, so a domain's load reads its folder only."""
    concepts.hint("rebalance", "domain_id").write.mode("errorifexists").partitionBy("domain_id").parquet(path)


def read_by_domain(spark: SparkSession, path: str, domain: str | None = "ALL") -> DataFrame:
    """The partitioned concept table, or one domain of it, with the contract's columns."""
    df = spark.read.schema(S.CONCEPT).parquet(path)
    return domain_filter(df, domain).select(*S.CONCEPT.names)


def read_concept(spark: SparkSession, path: str) -> DataFrame:
    return read_vocab_file(spark, path, S.CONCEPT_RAW)


def read_concept_relationship(spark: SparkSession, path: str) -> DataFrame:
    return read_vocab_file(spark, path, S.CONCEPT_RELATIONSHIP_RAW)


def typed(raw: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast each text column to the contract's type; dates accept yyyyMMdd or ISO."""
    cols: list[Column] = []
    for f in schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.DateType):
            cols.append(vocab_date(c).alias(f.name))
        elif isinstance(f.dataType, T.StringType):
            cols.append(c.alias(f.name))
        else:
            cols.append(c.try_cast(f.dataType).alias(f.name))
    return raw.select(*cols)


def domain_filter(df: DataFrame, domain: str | None) -> DataFrame:
    """Case-insensitive domain; ``ALL`` (any case) or None keeps everything."""
    if domain is None or domain.upper() == "ALL":
        return df
    return df.where(F.upper(F.col("domain_id")) == F.lit(domain.upper()))
