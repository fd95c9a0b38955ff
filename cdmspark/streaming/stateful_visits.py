"""Visit load as a stream that remembers by itself what it has loaded (L1).

``incremental_stream`` reads the target in every micro-batch.  Here two state stores take its
place: the visit ids seen, one entry each, dealt by id; and the last visit id of each person,
sixteen bytes with the person's, in ``BUCKETS`` entries dealt by a hash of the person.  A
micro-batch chains all rows of a bucket in one call, reads and writes the entries of the
buckets that it has rows of, and never looks at the target.  The file sink commits each micro-batch in its log, state and log from the same
checkpoint, so a restart neither repeats nor loses rows.

Of rows that repeat an id the first to arrive stays (of one micro-batch's, any: repeats are
expected to be copies).  A visit's predecessor is the person's next lower id in its micro-batch,
else the greatest id of earlier ones where that is lower, so delivery by rising ids gives what
one batch load gives.  With ``within`` (an interval, and the start as event time) ids are
forgotten once the watermark has passed, which bounds their state.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from .. import schemas as S
from ..operators.contract import good
from ..plans import jobs
from ..session import scratch_path
from .incremental_stream import ROW_GROUPS, write_snapshot

_KEPT = ["visit_occurrence_id", "person_id", "visit_start_datetime", "visit_end_datetime", "care_site_id",
         "visit_source_value", "admitted_from", "discharged_to"]
_BEFORE = "preceding_visit_occurrence_id"
#: Entries of the persons' state: each holds a share of the persons, so that calls do not grow with their number.
BUCKETS = 4096


def _chain(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Rows of one bucket's persons with their predecessors; the state holds persons, ascending, and their last ids."""
    rows = pd.concat(list(frames), ignore_index=True).sort_values(["person_id", "visit_occurrence_id"], kind="stable")
    people, ids = (rows[c].to_numpy(np.int64) for c in ("person_id", "visit_occurrence_id"))
    known, last = (np.frombuffer(b, np.int64) for b in (state.get if state.exists else (b"", b"")))
    first = np.append(True, people[1:] != people[:-1])
    start = np.flatnonzero(first)
    who, nth = people[start], np.cumsum(first) - 1
    at = np.searchsorted(known, who)
    there = np.append(known, 0)[at] == who
    there &= at < len(known)
    seen = np.where(there, np.append(last, 0)[at], 0)
    before = np.append(0, ids[:-1])
    later = there[nth] & (ids > seen[nth]) & (first | (before <= seen[nth]))
    before = pd.array(np.where(later, seen[nth], before), dtype="Int64")
    before[first & ~later] = pd.NA
    top = ids[np.append(start[1:], len(ids)) - 1]
    top = np.where(there, np.maximum(top, seen), top)
    known, last = np.append(known, who[~there]), np.append(last, top[~there])
    last[at[there]] = top[there]
    order = np.argsort(known, kind="stable")
    state.update((known[order].tobytes(), last[order].tobytes()))
    yield rows[_KEPT].assign(**{_BEFORE: before})


def stateful_visits(source: DataFrame, persons: DataFrame, within: str | None = None) -> DataFrame:
    """Target rows of a stream of visit-source rows; ``persons`` is a table."""
    x = good(jobs.check_visit(source)).withColumn("care_site_id", F.col("care_site_id").cast("string"))
    x = x.join(persons.select("person_id"), "person_id", "left_semi").select(*_KEPT)
    if within:
        # event time has to be a timestamp with a zone; the session's zone is UTC
        x = (x.withColumn("_at", F.col("visit_start_datetime").cast("timestamp")).withWatermark("_at", within)
             .dropDuplicatesWithinWatermark(["visit_occurrence_id"]).drop("_at"))
    else:
        x = x.dropDuplicates(["visit_occurrence_id"])
    x = x.select(*_KEPT)
    out = T.StructType([*x.schema.fields, T.StructField(_BEFORE, T.LongType())])
    kept = T.StructType([T.StructField("people", T.BinaryType()), T.StructField("last", T.BinaryType())])
    chained = x.withColumn("_bucket", F.pmod(F.xxhash64("person_id"), F.lit(BUCKETS))).groupBy("_bucket").applyInPandasWithState(
        _chain, out, kept, "append", GroupStateTimeout.NoTimeout)
    return jobs.visit_rows(chained)


def run_stateful(source: DataFrame, persons: DataFrame, target: str, checkpoint: str, within: str | None = None) -> None:
    """Drain what there is into ``target`` and stop."""
    (stateful_visits(source, persons, within).writeStream.format("parquet").outputMode("append")
     .option("path", target).option("checkpointLocation", checkpoint)
     .queryName(f"stateful_visits_{uuid.uuid4().hex[:8]}").trigger(availableNow=True).start().awaitTermination())


def stream_visit_state_query(spark: SparkSession, sf_dir: str, visit_exprs: list[str], persons: DataFrame,
                             batches: int = 3) -> DataFrame:
    """Orders as visit source in ``batches`` deliveries of rising ids; each but the first also
    repeats rows of earlier ones. The stream is stopped and started again before the last."""
    base = scratch_path(spark, f"stream_state/{uuid.uuid4().hex}")
    orders = spark.read.parquet(f"{sf_dir.rstrip('/')}/orders.parquet")
    cuts = orders.agg(F.percentile_approx("o_orderkey", [i / batches for i in range(1, batches)]).alias("c")).first()["c"] or []
    part = sum((F.when(F.col("o_orderkey") > c, 1).otherwise(0) for c in cuts), F.lit(0))
    people = write_snapshot(persons.select("person_id"), f"{base}/persons")
    for i in range(batches):
        again = (part < i) & (F.col("o_orderkey") % 10 == 3)
        orders.where((part == i) | again).coalesce(1).write.mode("append").option(*ROW_GROUPS).parquet(f"{base}/delivered")
        if i + 2 >= batches:
            src = (spark.readStream.schema(orders.schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/delivered")
                   .selectExpr(*visit_exprs))
            run_stateful(src, people, f"{base}/visit_occurrence", f"{base}/checkpoint")
    return spark.read.schema(S.VISIT_OCCURRENCE).parquet(f"{base}/visit_occurrence")
