"""Mapping strategies on the demo fixtures (coded sources, visit types)."""
from pyspark.sql import functions as F

from cdmspark.operators import mapping as M
from cdmspark.operators import reports as Rp

CODES = ["K35.9", "K80.20", "I25.10", "J44.1", "E11.9", "PEDS_CARDIO", "Z51.11", "N18.6", "F32.9",
         "HEART_SURG", "K35.8", "ORTHO_SPEC", "I21.9", "J45.9", "ENDO_SPEC"]
DESCS = ["Acute appendicitis", "Gallbladder stones", "Coronary artery disease", "COPD exacerbation",
         "Type 2 diabetes", "Pediatric Cardiology", "Chemotherapy treatment", "Kidney failure", "Depression",
         "Cardiovascular surgery", "Complicated appendicitis", "Orthopedic specialty", "Heart attack", "Asthma",
         "Endocrinology specialty"]
TYPES = ["ICD"] * 5 + ["SPECIALTY", "ICD", "ICD", "ICD", "PROCEDURE", "ICD", "SPECIALTY", "ICD", "ICD",
                       "SPECIALTY"]
CONCEPTS = [
    (4023928, "Acute appendicitis", "K35.9", "Condition"), (4134287, "Cholelithiasis", "K80.20", "Condition"),
    (4170143, "Coronary arteriosclerosis", "I25.10", "Condition"),
    (4145356, "Chronic obstructive lung disease", "J44.1", "Condition"),
    (4193704, "Type 2 diabetes mellitus", "E11.9", "Condition"),
    (45756805, "Pediatric Cardiology", "OMOP4821938", "Provider"),
    (4273629, "Antineoplastic chemotherapy", "Z51.11", "Condition"),
    (4030518, "End-stage renal disease", "N18.6", "Condition"), (4152280, "Depressive disorder", "F32.9", "Condition"),
    (4110056, "Cardiovascular surgical procedure", "4110056", "Procedure"),
    (4023929, "Complicated acute appendicitis", "K35.3", "Condition"),
    (45756743, "Orthopedic Surgery", "OMOP4821940", "Provider"), (4329847, "Myocardial infarction", "I21.9", "Condition"),
    (4051466, "Asthma", "J45.9", "Condition"), (45756744, "Endocrinology", "OMOP4821941", "Provider"),
]


def _frames(spark):
    src = spark.createDataFrame([(i + 1, c, d, t) for i, (c, d, t) in enumerate(zip(CODES, DESCS, TYPES))],
                                "patient_id long, source_code string, description string, source_type string")
    con = spark.createDataFrame(CONCEPTS, "concept_id long, concept_name string, concept_code string, domain_id string")
    return src, con


def test_code_match_ten_of_fifteen(spark):
    src, con = _frames(spark)
    m = M.code_match(src, "source_code", con)
    miss = sorted(r.source_code for r in m.where("concept_id IS NULL").collect())
    assert miss == sorted(["PEDS_CARDIO", "HEART_SURG", "K35.8", "ORTHO_SPEC", "ENDO_SPEC"])


def test_cascade_labels_and_reports(spark):
    src, con = _frames(spark)
    c = M.cascade(src, "source_code", "description", con, threshold=0.6)
    methods = {r.source_code: r.mapping_method for r in c.collect()}
    assert methods["K35.9"] == "DIRECT_CODE_MATCH"
    assert methods["PEDS_CARDIO"] == "SEMANTIC_MATCH"          # same words as the concept name
    assert set(methods.values()) <= {"DIRECT_CODE_MATCH", "SEMANTIC_MATCH", "UNMAPPED_FINAL"}
    assert c.count() == 15
    by_dom = {r.matched_domain: r.n_records for r in Rp.mapped_by_domain(c).collect()}
    assert sum(by_dom.values()) == c.where("concept_id IS NOT NULL").count()
    assert M.review_list(c).count() == sum(1 for v in methods.values() if v == "UNMAPPED_FINAL")


def test_exact_is_case_insensitive_and_takes_highest_id(spark):
    con = spark.createDataFrame([(1, "Emergency Department Visit", "Visit"), (2, "Telemedicine Visit", "Visit"),
                                 (3, "telemedicine visit", "Visit")], "concept_id long, concept_name string, domain_id string")
    src = spark.createDataFrame([("Emergency Department Visit",), ("Telemedicine visit",), ("x",)], "v string")
    got = {r.v: r.concept_id for r in M.exact_match(src, "v", con).collect()}
    assert got == {"Emergency Department Visit": 1, "Telemedicine visit": 3, "x": None}


def test_multi_strategy_stages(spark):
    con = spark.createDataFrame([(1, "Emergency Department", "Visit"), (2, "Outpatient Visit", "Visit")],
                                "concept_id long, concept_name string, domain_id string")
    src = spark.createDataFrame([("ED",), ("Outpatient visits",), ("zzz",), (None,)], "v string")
    got = {r.v: (r.matching_strategy, r.concept_id, r.similarity_score)
           for r in M.multi_strategy(src, "v", con, threshold=0.7).collect()}
    assert got["ED"] == ("exact_match", 1, 1.0)                 # 'ed' expands to the concept name
    assert got["Outpatient visits"][0] == "semantic_match" and got["Outpatient visits"][1] == 2
    assert got["zzz"] == (None, None, 0.0) and got[None] == (None, None, 0.0)


def test_mapping_report_zero_rows(spark):
    empty = spark.createDataFrame([], "concept_id long, similarity_score double")
    r = Rp.mapping_report(empty).first()
    assert r.total_records == 0 and r.mapping_rate is None


def test_fallback_order(spark):
    from cdmspark.functions.rules import map_visit_type
    con = spark.createDataFrame([(1, "Emergency Room", "Visit")], "concept_id long, concept_name string, domain_id string")
    src = spark.createDataFrame([("emergency room",), ("Emergency rooms",), ("Outpatient",)], "v string")
    got = {r.v: (r.concept_id, r.mapping_method)
           for r in M.fallback(src, "v", [("exact", None), ("semantic", 0.7), ("rule", map_visit_type)], con).collect()}
    assert got == {"emergency room": (1, "exact"), "Emergency rooms": (1, "semantic"), "Outpatient": (9202, "rule")}


def test_map_columns_maps_each_value_once(spark):
    con = spark.createDataFrame([(1, "Home", "Visit"), (2, "Clinic", "Visit")], "concept_id long, concept_name string, domain_id string")
    df = spark.createDataFrame([("home", "clinic"), ("clinic", None)], "a string, b string")
    out = M.map_columns(df, {"a": "a_id", "b": "b_id"}, con, strategy="exact_match")
    assert sorted((r.a, r.a_id, r.b_id) for r in out.collect()) == [("clinic", 2, None), ("home", 1, 2)]


def test_similar_concepts_top_k(spark):
    _, con = _frames(spark)
    q = spark.createDataFrame([("heart disease",)], "q string")
    out = M.similar_concepts(q, "q", con, k=3).orderBy("rank").collect()
    assert [r.rank for r in out] == [1, 2, 3]
    assert out[0].similarity_score >= out[1].similarity_score >= out[2].similarity_score


def test_mapped_plus_unmapped_is_total(spark):
    from cdmspark.plans import catalog as C
    from conftest import SF001
    r = Rp.mapping_report(C._multi(C.Tables(spark, SF001))).first()
    assert r.mapped_records + r.unmapped_records == r.total_records > 0
    counts = Rp.mapping_counts(C._multi(C.Tables(spark, SF001))).first()
    assert counts.mapped + counts.unmapped == r.total_records


def test_fallback_with_code_and_fuzzy_steps(spark):
    from cdmspark.functions.rules import map_visit_type
    con = spark.createDataFrame([(1, "Emergency Room", "E1", "Visit"), (2, "Outpatient Visit", "O1", "Visit")],
                                "concept_id long, concept_name string, concept_code string, domain_id string")
    src = spark.createDataFrame([("E1", "zzz"), ("X9", "Emergency Rooms"), ("X9", "inpatient")],
                                "code string, v string")
    got = {(r.code, r.v): (r.concept_id, r.mapping_method) for r in M.fallback(
        src, "v", [("code", "code"), ("fuzzy", 80), ("rule", map_visit_type)], con).collect()}
    assert got[("E1", "zzz")] == (1, "code")
    assert got[("X9", "Emergency Rooms")] == (1, "fuzzy")
    assert got[("X9", "inpatient")] == (9201, "rule")
