"""Sink layer: create-if-absent, counted append, drop; rejects partition the input."""
import os

from pyspark.sql import functions as F

from cdmspark import schemas as S
from cdmspark.sources.sinks import (append, create_if_absent, drop_if_exists, good_rows, rejected_rows,
                                    split_rejects)


def test_create_append_drop(spark, tmp_dir):
    name = "cdm_test_person_ids"
    drop_if_exists(spark, name)
    create_if_absent(spark, name, S.PERSON_IDS, path=os.path.join(tmp_dir, "person_ids"))
    create_if_absent(spark, name, S.PERSON_IDS, path=os.path.join(tmp_dir, "person_ids"))   # no-op
    n = append(spark.range(0, 25).select(F.col("id").alias("person_id")), name)
    assert n == 25 and spark.table(name).count() == 25
    drop_if_exists(spark, name)
    assert not spark.catalog.tableExists(name)


def test_rejects_partition_the_input(spark):
    rows = [("1", "a", "X", "V", "C", "S", "c1", "1970-01-01", "2099-12-31", None),
            ("x", "b", "X", "V", "C", "S", "c2", "1970-01-01", "2099-12-31", None),   # bad id
            ("3", " ", "X", "V", "C", "S", "c3", "1970-01-01", "2099-12-31", None),   # blank name
            ("4", "d", "X" * 21, "V", "C", "S", "c4", "1970-01-01", "2099-12-31", None),  # too long
            ("5", "e", "X", "V", "C", "SS", "c5", "1970-01-01", "2099-12-31", None)]  # too long
    raw = spark.createDataFrame(rows, S.CONCEPT_RAW)
    tagged = split_rejects(raw, S.CONCEPT, S.MAX_LENGTHS["concept"]).cache()
    reasons = {r.concept_id: r.reject_reason for r in tagged.collect()}
    assert good_rows(tagged).count() + rejected_rows(tagged).count() == raw.count()
    assert [r.concept_id for r in good_rows(tagged).collect()] == [1]
    assert reasons[None] == "concept_id bad value"
    assert reasons[3] == "concept_name is null" and reasons[4] == "domain_id too long"
    assert reasons[5] == "standard_concept too long"


def test_load_table_reports_and_second_run_adds_nothing(spark, tmp_dir):
    from cdmspark.plans import jobs
    from cdmspark.plans.catalog import P
    from cdmspark.plans.run import load_table
    from conftest import SF001
    name = "cdm_test_visit"
    drop_if_exists(spark, name)
    p = P(spark, SF001)
    first = load_table(spark, p.visits(), name, "visit_occurrence", path=os.path.join(tmp_dir, "visit"))
    assert first["inserted"] == p.visits().count() and first["rows_per_s"] > 0
    again = jobs.load_visit(p.t.visit_src(), p.persons(), existing=spark.table(name))
    second = load_table(spark, again, name, "visit_occurrence")
    assert second["inserted"] == 0 and spark.table(name).count() == first["inserted"]
    drop_if_exists(spark, name)
