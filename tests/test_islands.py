"""Observation periods: island edges and dense ids."""
import datetime as dt

from pyspark.sql import functions as F

from cdmspark.operators.dense_id import dense_ids
from cdmspark.plans import jobs

D = dt.date


def _periods(spark, rows, gap=7300, persons=None, **kw):
    src = spark.createDataFrame(rows, "person_id long, observation_period_start_date date, "
                                      "observation_period_end_date date")
    persons = persons or spark.createDataFrame([(p,) for p in {r[0] for r in rows if r[0] is not None}],
                                               "person_id long")
    out = jobs.observation_period(src, persons, gap_days=gap, **kw)
    return sorted((r.person_id, r.observation_period_start_date, r.observation_period_end_date,
                   r.observation_period_id) for r in out.collect())


def test_gap_exactly_7300_joins_7301_splits(spark):
    start = D(1980, 1, 1)
    rows = [(1, start, start), (1, start + dt.timedelta(days=7300), start + dt.timedelta(days=7300)),
            (2, start, start), (2, start + dt.timedelta(days=7301), start + dt.timedelta(days=7301))]
    got = _periods(spark, rows)
    assert [(p, s) for p, s, _, _ in got] == [(1, start), (2, start), (2, start + dt.timedelta(days=7301))]
    assert [i for *_, i in got] == [1, 2, 3]


def test_tied_starts_contained_single_and_null_end(spark):
    rows = [(1, D(2000, 1, 1), D(2000, 1, 5)), (1, D(2000, 1, 1), D(2000, 3, 1)),   # tied starts
            (1, D(2000, 1, 10), D(2000, 1, 12)),                                    # contained
            (2, D(2001, 1, 1), D(2001, 1, 2)),                                      # single
            (3, D(2001, 1, 1), None)]                                               # null end: dropped
    got = _periods(spark, rows, gap=30)
    assert got == [(1, D(2000, 1, 1), D(2000, 3, 1), 1), (2, D(2001, 1, 1), D(2001, 1, 2), 2)]


def test_previous_end_rule_vs_overlap_aware(spark):
    # long encounter, then a short one inside it, then one 40 days after the short one ends
    rows = [(1, D(2000, 1, 1), D(2000, 12, 31)), (1, D(2000, 2, 1), D(2000, 2, 2)), (1, D(2000, 3, 15), D(2000, 3, 16))]
    plain = _periods(spark, rows, gap=30)
    aware = _periods(spark, rows, gap=30, overlap_aware=True)
    assert len(plain) == 2 and len(aware) == 1


def test_date_floor(spark):
    rows = [(1, D(1929, 1, 1), D(1929, 1, 2)), (1, D(1930, 1, 1), D(1930, 1, 3)), (1, D(1931, 1, 1), D(1931, 1, 2))]
    got = _periods(spark, rows, gap=7300, date_floor="1930-01-01")
    assert [(s, e) for _, s, e, _ in got] == [(D(1931, 1, 1), D(1931, 1, 2))]


def test_dense_ids_equal_global_row_number(spark):
    from pyspark.sql import Window
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 1013).alias("person_id"),
                                     (F.col("id") % 97).alias("k")).dropDuplicates()
    got = dense_ids(df, ["person_id", "k"], "rid", range_rows=16)
    ref = df.withColumn("ref", F.row_number().over(Window.orderBy("person_id", "k")))
    bad = got.join(ref, ["person_id", "k"]).where(F.col("rid") != F.col("ref")).count()
    assert bad == 0 and got.count() == df.count()


def test_dense_ids_edge_inputs(spark):
    empty = spark.createDataFrame([], "person_id long, k long")
    assert dense_ids(empty, ["person_id", "k"], "rid").count() == 0
    one = spark.range(0, 300).select(F.lit(7).cast("long").alias("person_id"), (299 - F.col("id")).alias("k"))
    got = sorted((r.k, r.rid) for r in dense_ids(one, ["person_id", "k"], "rid").collect())
    assert got == [(k, k + 1) for k in range(300)]
