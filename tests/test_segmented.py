"""Skew-safe windows equal the plain windows, also when a key is split into chunks."""
import datetime as dt
import random

from pyspark.sql import functions as F

from cdmspark.operators import islands as isl
from cdmspark.operators.incremental import with_preceding


def _enc(spark):
    rnd = random.Random(3)
    rows = []
    for i in range(600):
        p = 1 if i < 400 else rnd.randint(2, 20)          # person 1 holds two thirds of the rows
        s = dt.date(2000, 1, 1) + dt.timedelta(days=rnd.randint(0, 3000))
        rows.append((p, s, s + dt.timedelta(days=rnd.choice([0, 0, 1, 5, 400]))))
    rows += [(1, dt.date(2001, 1, 1), dt.date(2001, 1, 1))] * 5   # exact ties
    return spark.createDataFrame(rows, "person_id long, start_date date, end_date date")


def _sorted(df, cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_islands_chunked_equals_plain(spark):
    enc = _enc(spark)
    for aware in (False, True):
        a = isl.islands(enc, gap_days=30, overlap_aware=aware, hot_rows=None)
        b = isl.islands(enc, gap_days=30, overlap_aware=aware, hot_rows=10)
        cols = ["person_id", "period_group", "observation_period_start_date", "observation_period_end_date"]
        assert _sorted(a, cols) == _sorted(b, cols)


def test_chunks_are_really_used(spark):
    from cdmspark.operators.segmented import hot_bounds, with_chunks
    enc = _enc(spark)
    assert hot_bounds(enc, "person_id", "start_date", hot_rows=10_000) is None      # nothing hot: plain path
    x = with_chunks(enc, "person_id", "start_date", hot_bounds(enc, "person_id", "start_date", 50, 8))
    assert x.where("person_id = 1").select("_chunk").distinct().count() > 4
    assert x.where("person_id <> 1").select("_chunk").distinct().count() == 1


def test_preceding_chunked_equals_plain(spark):
    rows = [(i, 1 if i % 3 else (i % 7)) for i in range(500)]
    df = spark.createDataFrame(rows, "visit_occurrence_id long, person_id long")
    a = with_preceding(df, hot_rows=None)
    b = with_preceding(df, hot_rows=20)
    cols = ["visit_occurrence_id", "person_id", "preceding_visit_occurrence_id"]
    assert _sorted(a, cols) == _sorted(b, cols)
    existing = df.where("visit_occurrence_id < 250")
    new = df.where("visit_occurrence_id >= 250")
    c = with_preceding(new, existing=existing, hot_rows=20)
    assert _sorted(c, cols) == [r for r in _sorted(a, cols) if r[0] >= 250]
