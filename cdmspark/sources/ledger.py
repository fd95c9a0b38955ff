"""Loads that write target rows and rejects in one job and commit both by a marker.

A load has an id and a folder of its own.  ``split_once`` evaluates the checked source once and
keeps the result: one row per key for the target, and what is left over with reasons and counts.
``load_once`` writes both in one job, side by side, and then a marker with the counts.  Readers
see loads that have a marker only.  So a run that dies leaves nothing visible: the next run of
the same id writes its folder anew, and a run of an id that has its marker changes nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.contract import REASON, SOURCE_KEY
from ..session import path_exists, persist_reliably

REJECTS = T.StructType([T.StructField(SOURCE_KEY, T.StringType()), T.StructField(REASON, T.StringType()),
                        T.StructField("n_rows", T.LongType())])
_MARKER = "load string, loaded bigint, rejected bigint"


def split_once(tagged: DataFrame, key: str, order: list[Column], parent: DataFrame | None = None,
               parent_key: str = "person_id", orphan: str = "unknown person") -> tuple[DataFrame, DataFrame]:
    """(target rows, rejects) of a frame from ``contract.checked``, from one evaluation.

    One aggregate does both: good rows meet by key (the least by ``order``, then by the other
    columns, stays; the others are repeats), rejected ones by (source key, reason).  Repeats of
    a hot key are added up in each task before the shuffle.  Target rows and ``n_rows`` of the
    rejects add up to the rows of ``tagged``."""
    columns = [c for c in tagged.columns if c not in (REASON, SOURCE_KEY)]
    if parent is not None:
        known = parent.select(F.col(parent_key).alias("_parent")).distinct()
        tagged = tagged.join(known, F.col(parent_key) == F.col("_parent"), "left").withColumn(
            REASON, F.coalesce(REASON, F.when(F.col("_parent").isNull(), F.lit(orphan)))).drop("_parent")
    bad = F.col(REASON).isNotNull()
    first = [o.alias(f"_o{i}") for i, o in enumerate(order)]
    once = persist_reliably(
        tagged.groupBy(F.when(~bad, F.col(key)).alias("_key"), F.when(bad, F.col(SOURCE_KEY)).alias("_source"), F.col(REASON))
        .agg(F.count(F.lit(1)).alias("n"), F.min(F.when(~bad, F.struct(*first, *[c for c in columns if c != key]))).alias("_r")))
    rows = once.where(F.col(REASON).isNull()).select(*[F.col("_key").alias(c) if c == key else F.col(f"_r.{c}").alias(c) for c in columns])
    left = F.when(F.col(REASON).isNull(), F.col("n") - 1).otherwise(F.col("n"))
    rejects = once.select(F.coalesce("_source", F.col("_key").cast("string")).alias(SOURCE_KEY),
                          F.coalesce(F.col(REASON), F.lit("repeated key")).alias(REASON), left.alias("n_rows")).where("n_rows > 0")
    return rows, rejects


def _data(root: str) -> str:
    return f"{root.rstrip('/')}/data"


def _commits(root: str) -> str:
    return f"{root.rstrip('/')}/commits"


def committed(spark: SparkSession, root: str) -> dict[str, dict]:
    """Load id -> counts, of the loads that have their marker."""
    if not path_exists(spark, _commits(root)):
        return {}
    return {r["load"]: {"inserted": r["loaded"], "rejected": r["rejected"]}
            for r in spark.read.schema(_MARKER).parquet(_commits(root)).collect()}     # a row per load


def load_once(spark: SparkSession, root: str, load: str, rows: DataFrame, rejects: DataFrame) -> dict:
    """Write ``rows`` and ``rejects`` (``REJECTS``) as load ``load`` under ``root``, if it isn't there yet."""
    if not load or "/" in load or "=" in load:
        raise ValueError(f"not a load id: {load!r}")
    done = committed(spark, root).get(load)
    if done:
        return done | {"already": True}
    names = [f"{REASON}", SOURCE_KEY, "n_rows"]
    if set(names) & set(rows.columns):
        raise ValueError("target columns clash with those of the rejects")
    both = rows.withColumn("part", F.lit("rows")).unionByName(
        rejects.select(*names).withColumn("part", F.lit("rejects")), allowMissingColumns=True)
    seen = Observation()
    kept = F.col("part") == "rows"
    both = both.observe(seen, F.count_if(kept).alias("loaded"),
                        F.coalesce(F.sum(F.when(~kept, F.col("n_rows"))), F.lit(0)).alias("rejected"))
    both.write.mode("overwrite").partitionBy("part").parquet(f"{_data(root)}/load={load}")
    n = seen.get
    marker = spark.createDataFrame([(load, int(n["loaded"]), int(n["rejected"]))], _MARKER)
    # written elsewhere and moved whole: half a marker is never seen
    made, jvm = f"{root.rstrip('/')}/making/{load}", spark.sparkContext._jvm
    marker.coalesce(1).write.mode("overwrite").parquet(made)
    path = jvm.org.apache.hadoop.fs.Path
    fs = path(made).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(path(_commits(root)))
    part = next(f.getPath() for f in fs.listStatus(path(made)) if f.getPath().getName().startswith("part-"))
    if not fs.rename(part, path(f"{_commits(root)}/{load}.parquet")):
        raise RuntimeError(f"the marker of load {load} could not be moved into place")
    return {"inserted": int(n["loaded"]), "rejected": int(n["rejected"]), "already": False}


def _read(spark: SparkSession, root: str, schema: T.StructType, part: str) -> DataFrame:
    loads = sorted(committed(spark, root))
    if not loads:
        return spark.createDataFrame([], T.StructType([*schema.fields, T.StructField("load", T.StringType())]))
    full = T.StructType([*schema.fields, T.StructField("load", T.StringType()), T.StructField("part", T.StringType())])
    return (spark.read.schema(full).option("basePath", _data(root)).parquet(*[f"{_data(root)}/load={x}" for x in loads])
            .where(F.col("part") == part).drop("part"))


def loaded_rows(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """Target rows of all committed loads, and their load."""
    return _read(spark, root, schema, "rows")


def loaded_rejects(spark: SparkSession, root: str) -> DataFrame:
    return _read(spark, root, REJECTS, "rejects")
