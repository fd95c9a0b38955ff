"""SparkSession helpers: one place for the settings every job relies on."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile

from pyspark.sql import SparkSession


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "cdmspark") -> SparkSession:
    """Build (or reuse) a session with AQE, UTC and Arrow turned on and the UI off.

    On a cluster ``master`` stays None and spark-submit decides, also over memory and the
    number of shuffle partitions; only a local master gets values for one machine here.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            # Python workers import this package from where it lies, whatever the folder
            home = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
            path = os.environ.get("PYTHONPATH", "")
            if home not in path.split(os.pathsep):
                os.environ["PYTHONPATH"] = home + (os.pathsep + path if path else "")
            builder = builder.config("spark.driver.memory", "16g")
            shuffle_partitions = shuffle_partitions or os.cpu_count() or 8
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = (
        builder
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster must name it: with any but a one-machine master, an unset folder is an error,
    since a folder of this machine would be out of the executors' reach. A local session gets
    a temporary one, removed when the process ends.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        current = tempfile.mkdtemp(prefix="cdmspark-ckpt-")
        atexit.register(shutil.rmtree, current, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", current)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return sc.getCheckpointDir() or current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for written intermediate tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists, asked of the file system it names; any error but absence is raised."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p))


def _nullable(kind):
    """The type with nulls allowed everywhere (a null struct may have fields that never are)."""
    from pyspark.sql import types as T
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _nullable(f.dataType), True) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_nullable(kind.elementType), True)
    if isinstance(kind, T.MapType):
        return T.MapType(_nullable(kind.keyType), _nullable(kind.valueType), True)
    return kind


#: Rows up to which a kept table is a local relation instead of files.
SMALL_ROWS = 4000


def persist_reliably(df):
    """Evaluate ``df`` once and cut its lineage: a table of more than ``SMALL_ROWS`` rows is
    checkpointed in the shared folder (a lost executor re-reads the files instead of
    recomputing the plan); a smaller one comes to the driver, never more than that many rows
    and one, and goes on as a local relation, whose known size lets Spark plan without shuffles."""
    from pyspark import StorageLevel
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    # the rows looked at and the checkpoint (which runs the plan to count and to write) read
    # the cached blocks
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        kinds = _nullable(df.schema)
        head = df.limit(SMALL_ROWS + 1).select(*[df[f"`{f.name}`"].cast(f.dataType) for f in kinds.fields]).toArrow()
        if head.num_rows <= SMALL_ROWS:
            return spark.createDataFrame(head, schema=kinds)
        return df.checkpoint(eager=True)
    finally:
        df.unpersist()
