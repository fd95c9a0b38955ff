"""K2 in one pass: counts per table, null and unknown persons, a hot person, an empty table."""
from cdmspark.operators.quality import orphans


def test_orphans_of_several_tables(spark):
    persons = spark.range(1, 5).withColumnRenamed("id", "person_id")
    visits = spark.createDataFrame([(1,)] * 50 + [(None,), (9,), (9,)], "person_id long")
    notes = spark.createDataFrame([(4,), (5,)], "person_id long")
    out = orphans({"visit": visits, "note": notes, "none": notes.limit(0)}, persons)
    assert out.columns == ["table_name", "n_rows", "n_orphans"]
    assert sorted(map(tuple, out.collect())) == [("none", 0, 0), ("note", 2, 1), ("visit", 53, 3)]


def test_plan_reads_persons_once(spark):
    persons = spark.range(1, 5).withColumnRenamed("id", "person_id")
    out = orphans({"a": persons, "b": persons, "c": persons}, persons)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1
