"""Stateful visit stream: equal to one batch load over batches with repeats and a restart."""
import os

import pandas as pd

from pyspark.sql import functions as F

from cdmspark.plans import jobs
from cdmspark.streaming import stateful_visits as V
from cdmspark.streaming.stateful_visits import run_stateful

SRC = ("visit_occurrence_id string, person_id string, visit_start_datetime string, visit_end_datetime string, care_site_id string, "
       "visit_source_value string, admitted_from string, discharged_to string")


def visit(i, person, day):
    return (str(i), str(person), f"2020-01-{day:02d} 08:00:00", f"2020-01-{day:02d} 09:00:00", "", "Inpatient", None, "Home")


def drain(spark, base, rows, people, within=None):
    spark.createDataFrame(rows, SRC).coalesce(1).write.mode("append").json(f"{base}/in")
    src = spark.readStream.schema(SRC).option("maxFilesPerTrigger", 1).json(f"{base}/in")
    run_stateful(src, people, f"{base}/out", f"{base}/ckpt", within)
    return {r.visit_occurrence_id: (r.person_id, r.preceding_visit_occurrence_id) for r in spark.read.parquet(f"{base}/out").collect()}


def test_equals_the_batch_load(spark, tmp_dir):
    people = spark.createDataFrame([(1,), (2,)], "person_id long")
    a = [visit(10, 1, 1), visit(11, 2, 1), visit(12, 1, 2), visit(12, 1, 2), visit(13, 9, 2), ("x", *visit(1, 1, 1)[1:])]
    b = [visit(10, 1, 1), visit(14, 1, 3), visit(15, 2, 3), visit(16, 1, 3)]
    c = [visit(12, 1, 2), visit(16, 1, 3), visit(17, 1, 4)]
    drain(spark, tmp_dir, a, people)
    drain(spark, tmp_dir, b, people)                        # each run is a restart from the checkpoint
    got = drain(spark, tmp_dir, c, people)
    batch = jobs.load_visit(spark.createDataFrame(a + b + c, SRC), people)
    assert got == {r.visit_occurrence_id: (r.person_id, r.preceding_visit_occurrence_id) for r in batch.collect()}
    assert spark.read.parquet(os.path.join(tmp_dir, "out")).count() == len(got) == 7


def test_a_late_lower_id(spark, tmp_dir):
    people = spark.createDataFrame([(1,)], "person_id long")
    drain(spark, tmp_dir, [visit(10, 1, 5)], people)
    got = drain(spark, tmp_dir, [visit(5, 1, 1), visit(7, 1, 2), visit(11, 1, 6), visit(12, 1, 7)], people)
    assert got == {10: (1, None), 5: (1, None), 7: (1, 5), 11: (1, 10), 12: (1, 11)}


def test_ids_are_forgotten_behind_the_watermark(spark, tmp_dir):
    people = spark.createDataFrame([(1,)], "person_id long")
    assert set(drain(spark, tmp_dir, [visit(1, 1, 1), visit(1, 1, 1)], people, "2 days")) == {1}
    got = drain(spark, tmp_dir, [visit(2, 1, 20), visit(1, 1, 1)], people, "2 days")
    assert set(got) == {1, 2} and spark.read.parquet(os.path.join(tmp_dir, "out")).count() == 2


class _State:
    exists = False

    def update(self, value):
        self.exists, self.get = True, value


def test_persons_of_a_bucket_are_chained_in_one_call():
    """calls grow with buckets, not persons; each person has a predecessor of their own."""
    def call(state, *rows):
        frames = [pd.DataFrame([dict.fromkeys(V._KEPT) | {"visit_occurrence_id": i, "person_id": p}]) for i, p in rows]
        out = pd.concat(V._chain((0,), iter(frames), state))
        return {i: None if pd.isna(b) else b for i, b in zip(out["visit_occurrence_id"], out[V._BEFORE], strict=True)}
    state = _State()
    assert call(state, (12, 1), (10, 1), (11, 2)) == {10: None, 12: 10, 11: None}
    assert call(state, (5, 1), (20, 1), (13, 2), (14, 3), (13 << 40, 3)) == {5: None, 20: 12, 13: 11, 14: None, 13 << 40: 14}
    assert call(state, (30, 0), (31, 3), (14 << 40, 3), (21, 1)) == {30: None, 31: None, 14 << 40: 13 << 40, 21: 20}
