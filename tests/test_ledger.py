"""Loads with rejects: one evaluation, both sides add up, dead and repeated runs."""
import os

import pytest
from pyspark.sql import functions as F

from cdmspark import schemas as S
from cdmspark.operators.contract import checked, rejects
from cdmspark.plans import jobs
from cdmspark.plans.catalog import P
from cdmspark.plans.run import load_table
from cdmspark.sources import ledger as L
from conftest import SF001

ROWS = [("1", "7", "2020-01-02", "b"), ("1", "7", "2020-01-01", "a"), ("1", "7", "2020-01-01", "a"), ("x", "7", "2020-01-01", "c"),
        ("x", "7", "2020-01-01", "d"), (None, "7", "2020-01-01", "e"), ("2", "99", "2020-01-01", "f"), ("3", None, "2020-01-01", "g"),
        ("4", "7", "never", "h"), ("5", "8", "2020-05-05", None)]


def tagged(spark):
    src = spark.createDataFrame(ROWS, "id string, person_id string, start string, note string")
    return checked(src, "id", {"id": "bigint", "person_id": "bigint", "start": "timestamp"}, ["id", "start"])


def people(spark):
    return spark.createDataFrame([(7,), (7,), (8,)], "person_id long")


def test_split_once(spark):
    rows, lost = L.split_once(tagged(spark), "id", [F.col("start")], people(spark))
    assert sorted((r.id, r.person_id, r.note) for r in rows.collect()) == [(1, 7, "a"), (5, 8, None)]
    got = {(r.source_key, r.reject_reason): r.n_rows for r in lost.collect()}
    assert got == {("1", "repeated key"): 2, ("x", "id bad value"): 2, (None, "id is null"): 1, ("2", "unknown person"): 1,
                   ("3", "unknown person"): 1, ("4", "start bad value"): 1}
    assert rows.count() + sum(got.values()) == len(ROWS)
    plan = rows.unionByName(lost, allowMissingColumns=True)._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan and "Join" not in plan      # both sides read what was kept, not the source


def test_same_as_the_separate_rejects(spark):
    p = P(spark, SF001)
    rows, lost = jobs.load_visit_split(p.t.dirty_visit_src(), p.persons())
    key = lambda r: (r.source_key or "", r.reject_reason)
    apart = rejects(jobs.check_visit(p.t.dirty_visit_src()), "visit_occurrence_id", p.persons()).groupBy(
        "source_key", "reject_reason").agg(F.sum("n_rows").alias("n_rows")).collect()
    assert sorted((*key(r), r.n_rows) for r in lost.collect()) == sorted((*key(r), r.n_rows) for r in apart)
    assert sorted(rows.collect()) == sorted(jobs.load_visit(p.t.dirty_visit_src(), p.persons()).collect())


def test_dead_and_repeated_runs(spark, tmp_dir, monkeypatch):
    root, contract = os.path.join(tmp_dir, "ledger"), S.PERSON_IDS
    one = spark.range(5).select(F.col("id").alias("person_id"))
    lost = spark.createDataFrame([("a", "bad", 3)], L.REJECTS)
    assert L.loaded_rows(spark, root, contract).count() == 0 == L.loaded_rejects(spark, root).count()
    # dies after the rows are written and before the marker
    with monkeypatch.context() as m:
        m.setattr(spark, "createDataFrame", lambda *a, **k: (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            L.load_once(spark, root, "a", one, lost)
    assert os.path.isdir(f"{root}/data/load=a") and L.committed(spark, root) == {}
    assert L.loaded_rows(spark, root, contract).count() == 0
    # a half-written folder of another attempt
    spark.range(99).write.mode("append").parquet(f"{root}/data/load=a/part=rows")
    first = L.load_once(spark, root, "a", one, lost)
    assert (first["inserted"], first["rejected"], first["already"]) == (5, 3, False)
    again = L.load_once(spark, root, "a", one.union(one), lost)
    assert (again["inserted"], again["rejected"], again["already"]) == (5, 3, True)
    L.load_once(spark, root, "b", spark.range(2).select((F.col("id") + 10).alias("person_id")), lost.limit(0))
    assert sorted(r.person_id for r in L.loaded_rows(spark, root, contract).collect()) == [0, 1, 2, 3, 4, 10, 11]
    assert [(r.load, r.n_rows) for r in L.loaded_rejects(spark, root).collect()] == [("a", 3)]
    assert L.load_once(spark, root, "none", one.limit(0), lost.limit(0))["inserted"] == 0
    with pytest.raises(ValueError):
        L.load_once(spark, root, "x/y", one, lost)
    with pytest.raises(ValueError):
        L.load_once(spark, root, "clash", one.withColumn("n_rows", F.lit(1)), lost)


def test_load_table_with_rejects(spark, tmp_dir):
    p = P(spark, SF001)
    src, path = p.t.dirty_visit_src(), os.path.join(tmp_dir, "visits")
    for already in (False, True):
        rows, lost = jobs.load_visit_split(src, p.persons())
        stats = load_table(spark, rows, "ledger_visits", "visit_occurrence", path=path, rejects=lost, load="day1")
        assert stats["already"] is already and stats["inserted"] + stats["rejected"] == src.count()
    assert spark.table("ledger_visits").count() == stats["inserted"]
    assert spark.table("ledger_visits_rejects").agg(F.sum("n_rows")).first()[0] == stats["rejected"]
    with pytest.raises(ValueError):
        load_table(spark, rows, "ledger_visits", "visit_occurrence", rejects=lost)
