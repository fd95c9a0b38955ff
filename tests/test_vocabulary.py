"""Vocabulary files: reader edge rows, typing, rejects, both-ends semi-joins."""
import os

from pyspark.sql import functions as F

from cdmspark import schemas as S
from cdmspark.operators.quality import validate_vocabulary
from cdmspark.plans import jobs
from cdmspark.sources.vocabulary import read_concept, read_concept_relationship

CONCEPT_TSV = """concept_id\tconcept_name\tdomain_id\tvocabulary_id\tconcept_class_id\tstandard_concept\tconcept_code\tvalid_start_date\tvalid_end_date\tinvalid_reason
1\tNA\tCondition\tSNOMED\tClinical Finding\tS\tC1\t19700101\t20991231\t
2\tSays "hello"\tcondition\tSNOMED\tClinical Finding\tS\tC2\t19700101\t20991231\t
3\tTwin\tCONDITION\tSNOMED\tClinical Finding\t\tC3\t1970-01-01\t20991231\t
4\tTwin\tProcedure\tSNOMED\tProcedure\tS\tC4\t19700101\t20991231\t
5\tBad date\tCondition\tSNOMED\tClinical Finding\tS\tC5\tnot-a-date\t20991231\t
x\tBad id\tCondition\tSNOMED\tClinical Finding\tS\tC6\t19700101\t20991231\t
"""

REL_TSV = """concept_id_1\tconcept_id_2\trelationship_id\tvalid_start_date\tvalid_end_date\tinvalid_reason
1\t2\tMaps to\t19700101\t20991231\t
1\t99\tMaps to\t19700101\t20991231\t
3\t4\tIs a\t19700101\t20991231\t
1\t2\tMaps to\t19700101\t20991231\t
"""


def _write(tmp, name, text):
    p = os.path.join(tmp, name)
    with open(p, "w", encoding="utf-8") as fh:
        fh.write(text)
    return p


def test_concept_reader_and_typing(spark, tmp_dir):
    raw = read_concept(spark, _write(tmp_dir, "concept.csv", CONCEPT_TSV))
    assert raw.count() == 6
    c = {r.concept_id: r for r in jobs.load_concept(raw, "ALL").collect()}
    assert sorted(c) == [1, 2, 3, 4]                      # bad date and bad id rejected
    assert c[1].concept_name == "NA"                      # the text NA stays a name
    assert c[2].concept_name == 'Says "hello"'            # quotes are characters
    assert c[3].standard_concept is None
    cond = jobs.load_concept(raw, "condition")            # any case of the domain
    assert sorted(r.concept_id for r in cond.collect()) == [1, 2, 3]
    assert jobs.load_concept(raw, "all").count() == 4     # ALL in any case


def test_incremental_concept_and_validation(spark, tmp_dir):
    raw = read_concept(spark, _write(tmp_dir, "concept.csv", CONCEPT_TSV))
    existing = jobs.load_concept(raw).where("concept_id = 1")
    assert sorted(r.concept_id for r in jobs.load_concept(raw, existing=existing).collect()) == [2, 3, 4]
    v = validate_vocabulary(raw, S.CONCEPT, ["concept_id"]).first()
    assert v.n_rows == 6 and v.bad_concept_id == 1 and v.bad_valid_start_date == 1 and v.repeated_keys == 0


def test_relationships_both_ends(spark, tmp_dir):
    craw = read_concept(spark, _write(tmp_dir, "concept.csv", CONCEPT_TSV))
    rraw = read_concept_relationship(spark, _write(tmp_dir, "rel.csv", REL_TSV))
    concepts = jobs.load_concept(craw)
    rel = jobs.load_concept_relationship(rraw, concepts)
    keys = sorted((r.concept_id_1, r.concept_id_2, r.relationship_id) for r in rel.collect())
    assert keys == [(1, 2, "Maps to"), (3, 4, "Is a")]    # foreign endpoint 99 dropped, repeat collapsed
    from cdmspark.sources.vocabulary import domain_filter, typed
    dom = domain_filter(typed(craw, S.CONCEPT), "Condition")
    rel_c = jobs.load_concept_relationship(rraw, jobs.load_concept(craw, "Condition"), "Condition", dom)
    assert sorted((r.concept_id_1, r.concept_id_2) for r in rel_c.collect()) == [(1, 2)]
    empty = concepts.limit(0)
    assert jobs.load_concept_relationship(rraw, empty).count() == 0
    existing = rel.where(F.col("relationship_id") == "Is a")
    assert jobs.load_concept_relationship(rraw, concepts, existing=existing).count() == 1


def test_validation_counts_repeats_and_null_keys(spark, tmp_dir):
    extra = "1\tDup\tCondition\tSNOMED\tClinical Finding\tS\tC9\t19700101\t20991231\t\n" \
            "\tNo id\tCondition\tSNOMED\tClinical Finding\tS\tC10\t19700101\t20991231\t\n"
    raw = read_concept(spark, _write(tmp_dir, "concept2.csv", CONCEPT_TSV + extra))
    v = validate_vocabulary(raw, S.CONCEPT, ["concept_id"]).first()
    assert v.n_rows == 8 and v.repeated_keys == 1 and v.null_keys == 1
    # the repeated id keeps one row (latest validity, then name) and the null id is rejected
    c = jobs.load_concept(raw)
    assert c.where("concept_id = 1").count() == 1 and c.where("concept_id IS NULL").count() == 0
