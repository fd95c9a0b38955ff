"""Row contracts of the source frames: safe casts, reject reasons, one row per key.

A bad value never fails a job and never vanishes: ``checked`` casts with ``try_cast`` and
names the first violation, the jobs load rows without one, and ``rejects`` returns the rest,
so that loaded rows and rejected rows add up to the input.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import as_timestamp

REASON, SOURCE_KEY = "reject_reason", "source_key"


def checked(src: DataFrame, key: str, kinds: dict[str, str], required: list[str]) -> DataFrame:
    """``src`` with the columns of ``kinds`` cast (``timestamp`` or a SQL type), the key as it
    came in ``source_key``, and ``reject_reason`` (NULL for a good row)."""
    bad, missing, typed = [], [], {}
    for name, kind in kinds.items():
        raw = F.col(name)
        if isinstance(src.schema[name].dataType, T.StringType):
            given = F.trim(raw) != ""
        else:
            given = raw.isNotNull()
        value = as_timestamp(src, name) if kind == "timestamp" else raw.try_cast(kind)
        typed[name] = value
        bad.append(F.when(given & value.isNull(), F.lit(f"{name} bad value")))
        if name in required:
            missing.append(F.when(value.isNull(), F.lit(f"{name} is null")))
    reason = F.coalesce(*bad, *missing, F.lit(None).cast("string"))
    return src.withColumns({REASON: reason, SOURCE_KEY: F.col(key).cast("string")} | typed)


def good(tagged: DataFrame) -> DataFrame:
    return tagged.where(F.col(REASON).isNull()).drop(REASON, SOURCE_KEY)


def one_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key: the least by ``order``, then by the other columns.  An aggregate, so
    repeats of a hot key meet map-side and no window holds them."""
    rest = [c for c in df.columns if c not in keys]
    first = [o.alias(f"_o{i}") for i, o in enumerate(order)]
    least = df.groupBy(*keys).agg(F.min(F.struct(*first, *rest)).alias("_r"))
    return least.select(*[F.col(c) if c in keys else F.col(f"_r.{c}").alias(c) for c in df.columns])


def rejects(tagged: DataFrame, key: str, parent: DataFrame | None = None, parent_key: str = "person_id",
            orphan: str = "unknown person") -> DataFrame:
    """(source_key, reject_reason, n_rows): contract violations and rows without a parent one
    by one, repeats of a key as one row with their number."""
    one = F.lit(1).cast("long").alias("n_rows")
    parts = [tagged.where(F.col(REASON).isNotNull()).select(SOURCE_KEY, REASON, one)]
    ok = tagged.where(F.col(REASON).isNull())
    if parent is not None:
        ids = parent.select(parent_key)
        parts.append(ok.join(ids, parent_key, "left_anti").select(SOURCE_KEY, F.lit(orphan).alias(REASON), one))
        ok = ok.join(ids, parent_key, "left_semi")
    again = ok.groupBy(key).agg((F.count(F.lit(1)) - 1).alias("n_rows")).where("n_rows > 0")
    parts.append(again.select(F.col(key).cast("string").alias(SOURCE_KEY), F.lit("repeated key").alias(REASON), "n_rows"))
    return reduce(DataFrame.unionByName, parts)
