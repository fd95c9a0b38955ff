"""Target table contracts: one StructType per CDM table, keys, lengths, constants."""

from __future__ import annotations

from pyspark.sql import types as T

L, I, S, D, TS = T.LongType(), T.IntegerType(), T.StringType(), T.DateType(), T.TimestampNTZType()


def _schema(*fields):
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


PERSON_IDS = _schema(("person_id", L, False))

PERSON = _schema(
    ("person_id", L, False), ("gender_concept_id", L, True), ("year_of_birth", I, True),
    ("month_of_birth", I, True), ("day_of_birth", I, True), ("birth_datetime", TS, True),
    ("race_concept_id", L, True), ("ethnicity_concept_id", L, True), ("location_id", L, True),
    ("provider_id", L, True), ("care_site_id", L, True), ("person_source_value", L, True),
    ("gender_source_value", S, True), ("race_source_value", S, True),
    ("ethnicity_source_value", S, True),
)

VISIT_OCCURRENCE = _schema(
    ("visit_occurrence_id", L, False), ("person_id", L, False), ("visit_concept_id", L, False),
    ("visit_start_date", D, False), ("visit_start_datetime", TS, True), ("visit_end_date", D, True),
    ("visit_end_datetime", TS, True), ("visit_type_concept_id", L, False), ("provider_id", L, True),
    ("care_site_id", L, True), ("visit_source_value", S, True), ("visit_source_concept_id", L, True),
    ("admitted_from_concept_id", L, True), ("admitted_from_source_value", S, True),
    ("discharged_to_concept_id", L, True), ("discharged_to_source_value", S, True),
    ("preceding_visit_occurrence_id", L, True),
)

CONDITION_OCCURRENCE = _schema(
    ("condition_occurrence_id", L, False), ("person_id", L, False), ("condition_concept_id", L, False),
    ("condition_start_date", D, False), ("condition_start_datetime", TS, True),
    ("condition_end_date", D, True), ("condition_end_datetime", TS, True),
    ("condition_type_concept_id", I, False), ("condition_status_concept_id", I, True),
    ("stop_reason", S, True), ("provider_id", L, True), ("visit_occurrence_id", L, True),
    ("visit_detail_id", L, True), ("condition_source_value", S, True),
    ("condition_source_concept_id", L, True), ("condition_status_source_value", S, True),
)

PROCEDURE_OCCURRENCE = _schema(
    ("procedure_occurrence_id", L, False), ("person_id", L, False), ("procedure_concept_id", L, False),
    ("procedure_date", D, False), ("procedure_datetime", TS, True), ("procedure_end_date", D, False),
    ("procedure_end_datetime", TS, True), ("procedure_type_concept_id", I, False),
    ("modifier_concept_id", L, True), ("quantity", I, True), ("provider_id", L, True),
    ("visit_occurrence_id", L, True), ("visit_detail_id", L, True),
    ("procedure_source_value", S, True), ("procedure_source_concept_id", L, True),
    ("modifier_source_value", S, True),
)

OBSERVATION_PERIOD = _schema(
    ("observation_period_id", L, False), ("person_id", L, False),
    ("observation_period_start_date", D, False), ("observation_period_end_date", D, False),
    ("period_type_concept_id", I, False),
)

CONCEPT = _schema(
    ("concept_id", L, False), ("concept_name", S, False), ("domain_id", S, False),
    ("vocabulary_id", S, False), ("concept_class_id", S, False), ("standard_concept", S, True),
    ("concept_code", S, False), ("valid_start_date", D, False), ("valid_end_date", D, False),
    ("invalid_reason", S, True),
)

CONCEPT_RELATIONSHIP = _schema(
    ("concept_id_1", L, False), ("concept_id_2", L, False), ("relationship_id", S, False),
    ("valid_start_date", D, False), ("valid_end_date", D, False), ("invalid_reason", S, True),
)

# Vocabulary files are read as text first; typing happens in one pass with try_cast.
CONCEPT_RAW = T.StructType([T.StructField(f.name, S, True) for f in CONCEPT.fields])
CONCEPT_RELATIONSHIP_RAW = T.StructType([T.StructField(f.name, S, True) for f in CONCEPT_RELATIONSHIP.fields])

TABLES = {
    "person_ids": PERSON_IDS,
    "person": PERSON,
    "visit_occurrence": VISIT_OCCURRENCE,
    "condition_occurrence": CONDITION_OCCURRENCE,
    "procedure_occurrence": PROCEDURE_OCCURRENCE,
    "observation_period": OBSERVATION_PERIOD,
    "concept": CONCEPT,
    "concept_relationship": CONCEPT_RELATIONSHIP,
}

KEYS = {
    "person_ids": ["person_id"],
    "person": ["person_id"],
    "visit_occurrence": ["visit_occurrence_id"],
    "condition_occurrence": ["condition_occurrence_id"],
    "procedure_occurrence": ["procedure_occurrence_id"],
    "observation_period": ["observation_period_id"],
    "concept": ["concept_id"],
    "concept_relationship": ["concept_id_1", "concept_id_2", "relationship_id"],
}

# Declared text lengths of the target DDL (VARCHAR(n)).
MAX_LENGTHS = {
    "person": {"gender_source_value": 50, "race_source_value": 50, "ethnicity_source_value": 50},
    "visit_occurrence": {"visit_source_value": 50, "admitted_from_source_value": 50,
                         "discharged_to_source_value": 50},
    "condition_occurrence": {"stop_reason": 20, "condition_source_value": 50,
                             "condition_status_source_value": 50},
    "procedure_occurrence": {"procedure_source_value": 50, "modifier_source_value": 50},
    "concept": {"concept_name": 255, "domain_id": 20, "vocabulary_id": 20, "concept_class_id": 20,
                "standard_concept": 1, "concept_code": 50, "invalid_reason": 1},
    "concept_relationship": {"relationship_id": 20, "invalid_reason": 1},
}

# Type concept ids and defaults written by the table jobs.
VISIT_TYPE_CONCEPT_ID = 32827
CONDITION_TYPE_CONCEPT_ID = 32817
PROCEDURE_TYPE_CONCEPT_ID = 32817
PERIOD_TYPE_CONCEPT_ID = 32813
PROCEDURE_QUANTITY = 1
CONDITION_SOURCE_CONCEPT_ID = 0
DATE_FLOOR = "1930-01-01"
ISLAND_GAP_DAYS = 7300
