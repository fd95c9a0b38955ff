"""Vocabulary files by header, the partitioned table, the stream target, cluster settings."""
import os

import pytest

from cdmspark import schemas as S
from cdmspark.sources.vocabulary import read_by_domain, read_concept, write_by_domain
from cdmspark.streaming.incremental_stream import ensure_target

ROW = {"concept_id": "777", "concept_name": "NA", "domain_id": "Condition", "vocabulary_id": "V", "concept_class_id": "C",
       "standard_concept": "S", "concept_code": "E11", "valid_start_date": "19700101", "valid_end_date": "20991231",
       "invalid_reason": ""}


def write(folder, names, rows):
    path = os.path.join(folder, "concept.csv")
    with open(path, "w", encoding="utf-8") as fh:
        fh.write("\t".join(names) + "\n")
        fh.writelines("\t".join(r[n.lower()] for n in names) + "\n" for r in rows)
    return path


def test_columns_are_taken_by_name(spark, tmp_dir):
    names = ["concept_code", "Concept_Name", *[n for n in ROW if n not in ("concept_code", "concept_name", "concept_id")], "concept_id"]
    got = read_concept(spark, write(tmp_dir, names, [ROW])).first()
    assert (got.concept_id, got.concept_name, got.concept_code) == ("777", "NA", "E11")
    assert got.invalid_reason is None and list(got.asDict()) == S.CONCEPT_RAW.names


def test_a_missing_column_is_an_error(spark, tmp_dir):
    with pytest.raises(ValueError, match="domain_id"):
        read_concept(spark, write(tmp_dir, [n for n in ROW if n != "domain_id"], [ROW]))


def test_table_by_domain(spark, tmp_dir):
    from cdmspark.plans import jobs
    rows = [ROW | {"concept_id": str(i), "domain_id": d} for i, d in enumerate(["Drug", "drug", "Device", "Drug"])]
    path = write(tmp_dir, list(ROW), rows)
    write_by_domain(jobs.load_concept(read_concept(spark, path)), f"{tmp_dir}/table")
    assert any(x.startswith("domain_id=") for x in os.listdir(f"{tmp_dir}/table"))
    assert sorted(r.concept_id for r in read_by_domain(spark, f"{tmp_dir}/table", "DRUG").collect()) == [0, 1, 3]
    assert read_by_domain(spark, f"{tmp_dir}/table").count() == 4


def test_an_unreadable_target_is_left_alone(spark, tmp_dir):
    path = f"{tmp_dir}/visits"
    ensure_target(spark, path)
    spark.createDataFrame([], S.VISIT_OCCURRENCE).write.mode("append").parquet(path)
    with open(f"{path}/part-broken.parquet", "wb") as fh:
        fh.write(b"this is no parquet file")
    before = sorted(os.listdir(path))
    ensure_target(spark, path)
    assert sorted(os.listdir(path)) == before


def test_a_cluster_must_name_its_folder(spark, monkeypatch):
    from cdmspark import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default):
                return default
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())


def test_absent_columns_are_typed(spark):
    from cdmspark.config import PERSON_CONFIG, bind_source
    df = bind_source(spark.createDataFrame([(1,)], "sex_txt long"), PERSON_CONFIG, "person")
    assert dict(df.dtypes) == {"person_id": "bigint", "gender": "bigint", "race": "string", "ethnicity": "string",
                               "birth_datetime": "timestamp_ntz"}
