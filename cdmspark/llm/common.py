"""Helpers shared by the corpus operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdmspark.session import ensure_checkpoint_dir

#: ASCII white space, U+0020 and U+0009 to U+000D; words are runs of anything else.
WS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back, so that
    a lost executor costs a re-read and no branch computes the plan twice."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def or_null(df: DataFrame, name: str, kind: str) -> Column:
    """Column ``name`` of ``df`` cast to ``kind``, or a typed null where it is absent."""
    return (F.col(f"`{name}`") if name in df.columns else F.lit(None)).cast(kind)


def crc_remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo; a null id counts as the empty text (remainder 0)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % F.lit(modulus)


def words_of(text: Column) -> Column:
    """Array of the words of a text, JVM side; null and blank texts give an empty array."""
    plain = F.coalesce(text, F.lit(""))
    for c in WS[1:]:  # byte searches; translate() makes an object of every character
        plain = F.replace(plain, F.lit(c), F.lit(" "))
    return F.array_remove(F.split(plain, " "), "")


def byte_words(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z only) words as UTF-8. ``bytes`` methods know ASCII only, so
    ``lower`` and ``split`` keep exactly to the contract's case and white space."""
    return [] if text is None else text.encode("utf-8", "surrogatepass").lower().split()


def struct_of(**kinds: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in kinds.items()])
