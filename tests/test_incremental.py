"""Incremental properties: A then B equals A+B; loading twice adds nothing."""
import datetime as dt

from pyspark.sql import functions as F

from cdmspark.plans import jobs

T0 = dt.datetime(2020, 1, 1)


def _src(spark, ids):
    rows = [(i, i % 3, "Outpatient clinic", T0 + dt.timedelta(days=i), T0 + dt.timedelta(days=i + 1),
             "1", "Emergency room", "Home") for i in ids]
    return spark.createDataFrame(rows, "visit_occurrence_id long, person_id long, visit_source_value string, "
                                       "visit_start_datetime timestamp_ntz, visit_end_datetime timestamp_ntz, "
                                       "care_site_id string, admitted_from string, discharged_to string")


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_a_then_b_equals_a_plus_b(spark):
    """Holds when B's ids follow A's (append order); a load of A cannot see ids that
    arrive later but sort earlier."""
    persons = spark.createDataFrame([(0,), (1,), (2,)], "person_id long")
    a, b = list(range(0, 10)), list(range(10, 20))
    first = jobs.load_visit(_src(spark, a), persons)
    second = jobs.load_visit(_src(spark, a + b), persons, existing=first)
    whole = jobs.load_visit(_src(spark, a + b), persons)
    assert _rows(first.unionByName(second)) == _rows(whole)


def test_unseeded_is_reference_behaviour(spark):
    persons = spark.createDataFrame([(0,), (1,), (2,)], "person_id long")
    first = jobs.load_visit(_src(spark, [0, 3]), persons)
    second = jobs.load_visit(_src(spark, [0, 3, 6]), persons, existing=first, seed=False)
    assert second.first().preceding_visit_occurrence_id is None


def test_loading_twice_adds_nothing(spark):
    persons = spark.createDataFrame([(0,), (1,), (2,)], "person_id long")
    first = jobs.load_visit(_src(spark, range(10)), persons)
    assert jobs.load_visit(_src(spark, range(10)), persons, existing=first).count() == 0


def test_blank_care_site_is_null(spark):
    persons = spark.createDataFrame([(0,)], "person_id long")
    src = _src(spark, [0]).withColumn("care_site_id", F.lit(" "))
    assert jobs.load_visit(src, persons).first().care_site_id is None


def test_condition_and_procedure_date_floor(spark):
    persons = spark.createDataFrame([(1,)], "person_id long")
    cond = spark.createDataFrame(
        [(1, 1, dt.datetime(1929, 12, 31), None, None, 5, "a", None),
         (2, 1, dt.datetime(1930, 1, 1), None, None, 5, "b", None),      # on the floor: excluded
         (3, 1, dt.datetime(1930, 1, 2), None, None, 5, "c", None),
         (4, 1, dt.datetime(1950, 1, 1), None, None, None, "d", None)],  # no visit: excluded
        "condition_occurrence_id long, person_id long, condition_start_date timestamp_ntz, "
        "condition_end_date timestamp_ntz, provider_id long, visit_occurrence_id long, "
        "condition_source_value string, condition_status_source_value string")
    got = [r.condition_occurrence_id for r in jobs.load_condition(cond, persons).collect()]
    assert got == [3]
    visits = spark.createDataFrame([(5, 1)], "visit_occurrence_id long, person_id long")
    proc = spark.createDataFrame(
        [(10, dt.datetime(1930, 1, 1), 5, "x"), (11, dt.datetime(1931, 1, 1), 5, "y"),
         (12, dt.datetime(1931, 1, 1), 6, "z")],                          # visit not loaded
        "procedure_occurrence_id long, procedure_date timestamp_ntz, visit_occurrence_id long, "
        "procedure_source_value string")
    rows = jobs.load_procedure(proc, visits).collect()
    assert [(r.procedure_occurrence_id, r.person_id, r.quantity) for r in rows] == [(11, 1, 1)]
    assert rows[0].procedure_end_date == rows[0].procedure_date


def test_person_edge_rows(spark):
    b = dt.datetime(1980, 5, 17)
    src = spark.createDataFrame(
        [(None, "Male", "White", "Hispanic", b),      # null id: dropped
         (1, "male", "white", None, None),           # null birth: dropped
         (0, "m", "", "latino", b),                  # id 0 is ordinary; 'm' is not male
         (2, " F ", "  asian ", "x", b),             # padded text
         (3, "female", "black", "non-hispanic", b)], # not in person_ids: dropped
        "person_id long, gender string, race string, ethnicity string, birth_datetime timestamp_ntz")
    ids = jobs.load_person_ids(spark.createDataFrame([(0,), (1,), (2,), (2,), (None,)], "person_id long"))
    assert sorted(r.person_id for r in ids.collect()) == [0, 1, 2]          # repeated id once, null dropped
    got = {r.person_id: r for r in jobs.load_person(src, ids).collect()}
    assert sorted(got) == [0, 2]
    assert (got[0].gender_concept_id, got[0].race_concept_id, got[0].ethnicity_concept_id) == (0, 0, 38003563)
    assert (got[2].gender_concept_id, got[2].race_concept_id) == (8532, 8515)
    assert (got[2].year_of_birth, got[2].month_of_birth, got[2].day_of_birth) == (1980, 5, 17)
    assert got[0].race_source_value == "" and got[2].gender_source_value == " F "


def test_visit_text_dates_and_preceding_order(spark):
    persons = spark.createDataFrame([(1,)], "person_id long")
    src = spark.createDataFrame(
        [(10, 1, "Outpatient", "2020-03-01 08:00:00", "2020-03-01 09:00:00", None, None, None),
         (20, 1, "Outpatient", "2020-01-01T08:00:00", "2020-01-01T10:00:00", None, None, None),  # later id, earlier time
         (30, 1, "Outpatient", "not a date", "2020-05-01 00:00:00", None, None, None)],           # bad text: dropped
        "visit_occurrence_id long, person_id long, visit_source_value string, visit_start_datetime string, "
        "visit_end_datetime string, care_site_id string, admitted_from string, discharged_to string")
    by_id = {r.visit_occurrence_id: r for r in jobs.load_visit(src, persons).collect()}
    assert sorted(by_id) == [10, 20]
    assert by_id[20].preceding_visit_occurrence_id == 10 and by_id[10].preceding_visit_occurrence_id is None
    assert str(by_id[20].visit_start_date) == "2020-01-01"
    by_time = {r.visit_occurrence_id: r.preceding_visit_occurrence_id
               for r in jobs.load_visit(src, persons, order_by="visit_start_datetime").collect()}
    assert by_time == {20: None, 10: 20}


def test_procedures_are_compared_by_key_and_date_only(spark, monkeypatch):
    """neither load carries columns that it does not read, and what is loaded is found without texts."""
    from cdmspark.plans import catalog as C
    from conftest import SF001
    plain, seen = C.jobs.load_procedure, []
    monkeypatch.setattr(C.jobs, "load_procedure", lambda src, *a, **kw: seen.append(src) or plain(src, *a, **kw))
    got = C.q_incremental_procedure(spark, SF001)
    assert len(seen) == 2 and not any({"procedure_source_code", "procedure_source_type"} & set(x.columns) for x in seen)
    assert seen[0].where("procedure_source_value IS NOT NULL").isEmpty() and not got.isEmpty()
    assert got.where(f"procedure_date < date'{C.EXISTING_VISIT_BEFORE}'").isEmpty()
