"""Safe loads: bad values, repeats and orphans become rejects; nothing fails, nothing vanishes."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from cdmspark.operators.contract import one_per_key
from cdmspark.plans import jobs

VISIT = ("visit_occurrence_id string, person_id string, visit_start_datetime string, visit_end_datetime string, "
         "visit_source_value string, care_site_id string, admitted_from string, discharged_to string")


def visits(spark, rows):
    return spark.createDataFrame([(*r, "Inpatient", None, None, None)[:8] for r in rows], VISIT)


@pytest.fixture()
def persons(spark):
    return spark.createDataFrame([(1,), (2,)], "person_id long")


def test_visit_rejects_and_good_rows_add_up(spark, persons):
    src = visits(spark, [("10", "1", "2020-01-01", "2020-01-02"), ("10", "1", "2020-01-05", "2020-01-06"),
                         ("10", "1", "2019-12-31", "2020-01-02"), ("abc", "1", "2020-01-01", "2020-01-02"),
                         ("11", "2", "no date", "2020-01-02"), ("12", "2", None, "2020-01-02"), (None, "2", "2020-01-01", "2020-01-01"),
                         ("13", "9", "2020-01-01", "2020-01-02"), ("14", "x", "2020-01-01", "2020-01-02"), (" ", "1", "2020-01-01", "2020-01-01"),
                         ("15", "1", "2020-02-01", "2020-02-02")])
    got = {(r.visit_occurrence_id, r.visit_start_date, r.preceding_visit_occurrence_id)
           for r in jobs.load_visit(src, persons).collect()}
    assert got == {(10, dt.date(2019, 12, 31), None), (15, dt.date(2020, 2, 1), 10)}
    lost = sorted(((r.source_key, r.reject_reason, r.n_rows) for r in jobs.visit_rejects(src, persons).collect()), key=str)
    assert lost == sorted([("abc", "visit_occurrence_id bad value", 1), ("11", "visit_start_datetime bad value", 1),
                           ("12", "visit_start_datetime is null", 1), (None, "visit_occurrence_id is null", 1),
                           ("14", "person_id bad value", 1), (" ", "visit_occurrence_id is null", 1),
                           ("13", "unknown person", 1), ("10", "repeated key", 2)], key=str)
    assert len(got) + sum(x[2] for x in lost) == src.count()


def test_person_repeats_and_text_ids(spark):
    cols = "person_id string, gender string, race string, ethnicity string, birth_datetime string"
    src = spark.createDataFrame([("1", "F", None, None, "1990-05-05"), ("1", "male", None, None, "1990-05-04"),
                                 ("abc", "F", None, None, "1990-05-05"), ("2", None, None, None, "bad")], cols)
    ids = jobs.load_person_ids(src)
    assert sorted(r.person_id for r in ids.collect()) == [1, 2]
    got = jobs.load_person(src, ids).collect()
    assert [(r.person_id, r.day_of_birth, r.gender_concept_id) for r in got] == [(1, 4, 8507)]
    lost = {(r.source_key, r.reject_reason) for r in jobs.person_rejects(src, ids).collect()}
    assert lost == {("abc", "person_id bad value"), ("2", "birth_datetime bad value"), ("1", "repeated key")}


def test_procedures_of_a_repeated_visit_load_once(spark, persons):
    v = jobs.load_visit(visits(spark, [("10", "1", "2020-01-01", "2020-01-02")] * 2), persons)
    src = spark.createDataFrame([("7", "2020-01-01", "10", "x"), ("7", "2020-01-03", "10", "y"), ("8", "1900-01-01", "10", "z"),
                                 ("9", "2020-01-01", "99", "w")],
                                "procedure_occurrence_id string, procedure_date string, visit_occurrence_id string, "
                                "procedure_source_value string")
    got = jobs.load_procedure(src, v).collect()
    assert [(r.procedure_occurrence_id, r.procedure_source_value) for r in got] == [(7, "x")]
    lost = {(r.source_key, r.reject_reason, r.n_rows) for r in jobs.procedure_rejects(src, v).collect()}
    assert lost == {("7", "repeated key", 1), ("8", "procedure_date before floor", 1), ("9", "unknown visit", 1)}


def test_one_per_key_is_ordered_and_whole(spark):
    df = spark.createDataFrame([(1, 3, "a"), (1, 2, "c"), (1, 2, "b"), (2, None, "d"), (None, 1, "e"), (None, 0, "f")],
                               "k long, o long, v string")
    got = {(r.k, r.o, r.v) for r in one_per_key(df, ["k"], [F.col("o")]).collect()}
    assert got == {(1, 2, "b"), (2, None, "d"), (None, 0, "f")}


def test_first_visits_equal_the_load_cut_off(spark, persons):
    src = visits(spark, [(str(i), str(1 + i % 2), "2020-01-01", "2020-01-02") for i in range(40, 0, -1)])
    whole = jobs.load_visit(src, persons).orderBy("visit_occurrence_id").limit(11).collect()
    assert sorted(jobs.load_visit(src, persons, first=11).collect()) == sorted(whole)
