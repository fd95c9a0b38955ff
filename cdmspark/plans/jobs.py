"""Table jobs J1-J6: source frames (already bound to CDM field names) -> target rows.

A job checks each row against its contract, keeps one row per key (least start, then the
other columns), and joins the target tables ``left_semi`` (existence) or ``left_anti`` (not
yet loaded), so the target side contributes keys only.  What a job does not load comes back
from the matching ``*_rejects`` function.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import rules
from ..functions.dates import birth_parts
from ..operators.contract import checked, good, one_per_key, rejects
from ..operators.dense_id import dense_ids
from ..operators.incremental import new_rows, with_preceding
from ..operators.islands import HOT_ROWS, islands
from ..sources.ledger import split_once


def _null(t: str) -> Column:
    return F.lit(None).cast(t)


def conform(df: DataFrame, schema) -> DataFrame:
    """Select the contract's columns in order, cast to the contract's types."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def _floor(c: Column, date_floor: str | None) -> Column:
    if date_floor is None:
        return F.lit(True)
    return c > F.lit(date_floor).cast("timestamp_ntz")


# --------------------------------------------------------------------- J1 person_ids
def load_person_ids(src: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    ids = good(checked(src.select("person_id"), "person_id", {"person_id": "bigint"}, ["person_id"]))
    return new_rows(ids.distinct(), existing, ["person_id"])


# --------------------------------------------------------------------- J2 person
def check_person(src: DataFrame) -> DataFrame:
    return checked(src, "person_id", {"person_id": "bigint", "birth_datetime": "timestamp"},
                   ["person_id", "birth_datetime"])


def person_rejects(src: DataFrame, person_ids: DataFrame) -> DataFrame:
    return rejects(check_person(src), "person_id", person_ids)


def load_person(src: DataFrame, person_ids: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    x = good(check_person(src)).join(person_ids.select("person_id"), "person_id", "left_semi")
    x = one_per_key(new_rows(x, existing, ["person_id"]), ["person_id"], [F.col("birth_datetime")])
    out = x.select(
        F.col("person_id").cast("long").alias("person_id"),
        rules.map_gender("gender").alias("gender_concept_id"),
        *birth_parts("birth_datetime"),
        F.col("birth_datetime"),
        rules.map_race("race").alias("race_concept_id"),
        rules.map_ethnicity("ethnicity").alias("ethnicity_concept_id"),
        _null("long").alias("location_id"), _null("long").alias("provider_id"),
        _null("long").alias("care_site_id"),
        F.col("person_id").cast("long").alias("person_source_value"),
        F.coalesce(F.col("gender"), F.lit("")).alias("gender_source_value"),
        F.coalesce(F.col("race"), F.lit("")).alias("race_source_value"),
        F.coalesce(F.col("ethnicity"), F.lit("")).alias("ethnicity_source_value"),
    )
    return conform(out, S.PERSON)


# --------------------------------------------------------------------- J3 visit
def check_visit(src: DataFrame) -> DataFrame:
    return checked(src, "visit_occurrence_id", {"visit_occurrence_id": "bigint", "person_id": "bigint",
                                                "visit_start_datetime": "timestamp", "visit_end_datetime": "timestamp"},
                   ["visit_occurrence_id", "visit_start_datetime", "visit_end_datetime"])


def visit_rejects(src: DataFrame, persons: DataFrame) -> DataFrame:
    return rejects(check_visit(src), "visit_occurrence_id", persons)


def eligible_visits(src: DataFrame, persons: DataFrame, start_after: int | None = None) -> DataFrame:
    """B2 + C2 (+ B11): visits with id, start and end, of a loaded person, one per id."""
    x = good(check_visit(src))
    if start_after is not None:
        x = x.where(F.col("visit_occurrence_id") > F.lit(start_after))
    x = x.join(persons.select("person_id"), "person_id", "left_semi")
    return one_per_key(x, ["visit_occurrence_id"], [F.col("visit_start_datetime"), F.col("visit_end_datetime")])


def load_visit(src: DataFrame, persons: DataFrame, existing: DataFrame | None = None,
               seed: bool | DataFrame = True, order_by: str | None = None, start_after: int | None = None,
               concept_ids: dict[str, Column] | None = None, first: int | None = None,
               eligible: DataFrame | None = None) -> DataFrame:
    """J3.  ``concept_ids`` may supply mapped columns (visit/admitted/discharged);
    otherwise the rule maps H4-H6 are used.  ``first`` (F1) loads the visits with the least
    ids only; a visit's predecessor has a smaller id, so the limit may come before the window.
    ``eligible`` may hold the checked rows of the source, one per id; ``seed`` a table of the
    loaded visits that is better read by person than ``existing``."""
    if eligible is None:
        eligible = eligible_visits(src, persons, start_after)
    x = new_rows(eligible, existing, ["visit_occurrence_id"])
    if first is not None:
        x = x.orderBy("visit_occurrence_id").limit(first)
    loaded = seed if isinstance(seed, DataFrame) else existing if seed else None
    return visit_rows(with_preceding(x, order_by=order_by, existing=loaded), concept_ids)


def visit_rows(x: DataFrame, concept_ids: dict[str, Column] | None = None) -> DataFrame:
    """Target rows of eligible visits with their preceding visit."""
    cm = concept_ids or {}
    out = x.select(
        "visit_occurrence_id", "person_id",
        F.coalesce(cm.get("visit", rules.map_visit_type("visit_source_value")), F.lit(0)).alias("visit_concept_id"),
        F.to_date("visit_start_datetime").alias("visit_start_date"), "visit_start_datetime",
        F.to_date("visit_end_datetime").alias("visit_end_date"), "visit_end_datetime",
        F.lit(S.VISIT_TYPE_CONCEPT_ID).alias("visit_type_concept_id"),
        _null("long").alias("provider_id"),
        # Blank text -> NULL, never '' into a BIGINT
        F.expr("try_cast(nullif(trim(cast(care_site_id AS STRING)), '') AS BIGINT)").alias("care_site_id"),
        "visit_source_value", _null("long").alias("visit_source_concept_id"),
        # Rule path keeps the rule set's NULLs; a mapped column is filled with 0.
        (F.coalesce(cm["admitted"], F.lit(0)) if "admitted" in cm else rules.map_admit("admitted_from"))
        .alias("admitted_from_concept_id"),
        F.coalesce(F.col("admitted_from"), F.lit("")).alias("admitted_from_source_value"),
        F.coalesce(cm.get("discharged", rules.map_discharge("discharged_to")), F.lit(0)).alias("discharged_to_concept_id"),
        F.coalesce(F.col("discharged_to"), F.lit("")).alias("discharged_to_source_value"),
        "preceding_visit_occurrence_id",
    )
    return conform(out, S.VISIT_OCCURRENCE)


def load_visit_split(src: DataFrame, persons: DataFrame, existing: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(visits, rejects) from one evaluation of the source; already loaded visits are neither."""
    rows, lost = split_once(check_visit(src), "visit_occurrence_id", [F.col("visit_start_datetime"), F.col("visit_end_datetime")],
                            persons)
    return load_visit(src, persons, existing=existing, eligible=rows), lost


# --------------------------------------------------------------------- J4 condition
def _before_floor(tagged: DataFrame, col: str, date_floor: str | None) -> DataFrame:
    """Good rows on or before the floor become rejects too."""
    late = F.coalesce("reject_reason", F.when(~_floor(F.col(col), date_floor), F.lit(f"{col} before floor")))
    return tagged.withColumn("reject_reason", late)


def check_condition(src: DataFrame, date_floor: str | None = S.DATE_FLOOR) -> DataFrame:
    kinds = {"condition_occurrence_id": "bigint", "person_id": "bigint", "visit_occurrence_id": "bigint",
             "provider_id": "bigint", "condition_start_date": "timestamp", "condition_end_date": "timestamp"}
    tagged = checked(src, "condition_occurrence_id", kinds, ["condition_occurrence_id", "person_id",
                                                             "visit_occurrence_id", "condition_start_date"])
    return _before_floor(tagged, "condition_start_date", date_floor)


def condition_rejects(src: DataFrame, persons: DataFrame, date_floor: str | None = S.DATE_FLOOR) -> DataFrame:
    return rejects(check_condition(src, date_floor), "condition_occurrence_id", persons)


def load_condition(src: DataFrame, persons: DataFrame, existing: DataFrame | None = None,
                   date_floor: str | None = S.DATE_FLOOR, condition_concept: Column | None = None,
                   status_concept: Column | None = None) -> DataFrame:
    x = good(check_condition(src, date_floor)).join(persons.select("person_id"), "person_id", "left_semi")
    x = x.withColumnsRenamed({"condition_start_date": "_start", "condition_end_date": "_end"})
    x = one_per_key(new_rows(x, existing, ["condition_occurrence_id"]), ["condition_occurrence_id"],
                    [F.col("_start"), F.col("_end")])
    out = x.select(
        "condition_occurrence_id", "person_id",
        F.coalesce(condition_concept if condition_concept is not None else F.lit(None), F.lit(0))
        .alias("condition_concept_id"),
        F.to_date("_start").alias("condition_start_date"), F.col("_start").alias("condition_start_datetime"),
        F.to_date("_end").alias("condition_end_date"), F.col("_end").alias("condition_end_datetime"),
        F.lit(S.CONDITION_TYPE_CONCEPT_ID).alias("condition_type_concept_id"),
        F.coalesce(status_concept if status_concept is not None else F.lit(None), F.lit(0))
        .alias("condition_status_concept_id"),
        _null("string").alias("stop_reason"), "provider_id", "visit_occurrence_id",
        _null("long").alias("visit_detail_id"), "condition_source_value",
        F.lit(S.CONDITION_SOURCE_CONCEPT_ID).alias("condition_source_concept_id"),
        "condition_status_source_value",
    )
    return conform(out, S.CONDITION_OCCURRENCE)


# --------------------------------------------------------------------- J5 procedure
def check_procedure(src: DataFrame, date_floor: str | None = S.DATE_FLOOR) -> DataFrame:
    kinds = {"procedure_occurrence_id": "bigint", "visit_occurrence_id": "bigint", "procedure_date": "timestamp"}
    return _before_floor(checked(src, "procedure_occurrence_id", kinds, list(kinds)), "procedure_date", date_floor)


def procedure_rejects(src: DataFrame, visits: DataFrame, date_floor: str | None = S.DATE_FLOOR) -> DataFrame:
    return rejects(check_procedure(src, date_floor), "procedure_occurrence_id", visits, "visit_occurrence_id",
                   "unknown visit")


def load_procedure(src: DataFrame, visits: DataFrame, existing: DataFrame | None = None,
                   date_floor: str | None = S.DATE_FLOOR, procedure_concept: Column | None = None) -> DataFrame:
    """C4: the person comes from the loaded visit, not from the procedure source."""
    v = visits.select("visit_occurrence_id", "person_id")
    x = good(check_procedure(src, date_floor)).drop("person_id").join(v, "visit_occurrence_id", "inner")
    x = x.where(F.col("person_id").isNotNull()).withColumnRenamed("procedure_date", "_date")
    x = one_per_key(new_rows(x, existing, ["procedure_occurrence_id"]), ["procedure_occurrence_id"], [F.col("_date")])
    out = x.select(
        "procedure_occurrence_id", "person_id",
        F.coalesce(procedure_concept if procedure_concept is not None else F.lit(None), F.lit(0))
        .alias("procedure_concept_id"),
        F.to_date("_date").alias("procedure_date"), F.col("_date").alias("procedure_datetime"),
        F.to_date("_date").alias("procedure_end_date"), F.col("_date").alias("procedure_end_datetime"),
        F.lit(S.PROCEDURE_TYPE_CONCEPT_ID).alias("procedure_type_concept_id"),
        _null("long").alias("modifier_concept_id"), F.lit(S.PROCEDURE_QUANTITY).alias("quantity"),
        _null("long").alias("provider_id"), "visit_occurrence_id", _null("long").alias("visit_detail_id"),
        "procedure_source_value", _null("long").alias("procedure_source_concept_id"),
        _null("string").alias("modifier_source_value"),
    )
    return conform(out, S.PROCEDURE_OCCURRENCE)


# --------------------------------------------------------------------- J6 observation period
def eligible_encounters(src: DataFrame, persons: DataFrame, date_floor: str | None = None) -> DataFrame:
    """B2 + B4 + C5: encounters with person, start, end (start and end after the floor)."""
    kinds = {"person_id": "bigint", "observation_period_start_date": "timestamp",
             "observation_period_end_date": "timestamp"}
    x = good(checked(src, "person_id", kinds, list(kinds))).select(
        "person_id", F.to_date("observation_period_start_date").alias("start_date"),
        F.to_date("observation_period_end_date").alias("end_date"))
    if date_floor is not None:
        fl = F.lit(date_floor).cast("date")
        x = x.where((F.col("start_date") > fl) & (F.col("end_date") > fl))
    return x.join(persons.select("person_id"), "person_id", "left_semi")


def observation_period(src: DataFrame, persons: DataFrame, gap_days: int = S.ISLAND_GAP_DAYS,
                       date_floor: str | None = None, overlap_aware: bool = False,
                       hot_rows: int | None = HOT_ROWS) -> DataFrame:
    periods = islands(eligible_encounters(src, persons, date_floor), gap_days=gap_days,
                      overlap_aware=overlap_aware, hot_rows=hot_rows)
    numbered = dense_ids(periods, ["person_id", "observation_period_start_date"],
                         id_col="observation_period_id")
    out = numbered.select("observation_period_id", "person_id", "observation_period_start_date",
                          "observation_period_end_date",
                          F.lit(S.PERIOD_TYPE_CONCEPT_ID).alias("period_type_concept_id"))
    return conform(out, S.OBSERVATION_PERIOD)


# --------------------------------------------------------------------- J7 concept
def load_concept(raw: DataFrame, domain: str | None = "ALL", existing: DataFrame | None = None) -> DataFrame:
    """Text rows -> typed concepts of ``domain``: contract rejects dropped, one row per
    concept_id (highest valid_start_date, then name), ids already loaded skipped."""
    from ..sources.sinks import good_rows, split_rejects
    from ..sources.vocabulary import domain_filter, typed
    x = domain_filter(typed(raw, S.CONCEPT), domain)
    x = good_rows(split_rejects(x, S.CONCEPT, S.MAX_LENGTHS["concept"]))
    x = one_per_key(x, ["concept_id"], [-F.unix_date("valid_start_date"), F.col("concept_name")])
    return conform(new_rows(x, existing, ["concept_id"]), S.CONCEPT)


def concept_rejects(raw: DataFrame, domain: str | None = "ALL") -> DataFrame:
    """Vocabulary rows of ``domain`` that ``load_concept`` does not load."""
    from ..sources.sinks import split_rejects
    from ..sources.vocabulary import domain_filter, typed
    tagged = split_rejects(domain_filter(typed(raw, S.CONCEPT), domain), S.CONCEPT, S.MAX_LENGTHS["concept"])
    return rejects(tagged.withColumn("source_key", F.col("concept_id").cast("string")), "concept_id")


# --------------------------------------------------------------------- J8 concept_relationship
REL_KEY = ["concept_id_1", "concept_id_2", "relationship_id"]


def both_ends_in(rel: DataFrame, concept_ids: DataFrame) -> DataFrame:
    """Keep edges whose two endpoints are both in ``concept_ids``."""
    ids = concept_ids.select(F.col("concept_id")).distinct()
    return (rel.join(ids.withColumnRenamed("concept_id", "concept_id_1"), "concept_id_1", "left_semi")
               .join(ids.withColumnRenamed("concept_id", "concept_id_2"), "concept_id_2", "left_semi"))


def load_concept_relationship(raw: DataFrame, loaded_concepts: DataFrame, domain: str | None = "ALL",
                              domain_concepts: DataFrame | None = None,
                              existing: DataFrame | None = None) -> DataFrame:
    """Typed edges; for a domain both ends must be that domain's concepts (file level);
    both ends must be in the loaded concept table; composite keys already loaded skipped."""
    from ..sources.sinks import good_rows, split_rejects
    from ..sources.vocabulary import typed
    x = good_rows(split_rejects(typed(raw, S.CONCEPT_RELATIONSHIP), S.CONCEPT_RELATIONSHIP,
                                S.MAX_LENGTHS["concept_relationship"]))
    if domain is not None and domain.upper() != "ALL" and domain_concepts is not None:
        x = both_ends_in(x, domain_concepts)
    x = both_ends_in(x, loaded_concepts)
    x = one_per_key(x, REL_KEY, [-F.unix_date("valid_start_date")])
    return conform(new_rows(x, existing, REL_KEY), S.CONCEPT_RELATIONSHIP)


def relationship_with_names(rel: DataFrame, concepts: DataFrame) -> DataFrame:
    """C11: edges joined to both endpoint concepts (names carried along)."""
    c = concepts.select("concept_id", "concept_name")
    return (rel.join(c.withColumnRenamed("concept_id", "concept_id_1")
                      .withColumnRenamed("concept_name", "concept_name_1"), "concept_id_1")
               .join(c.withColumnRenamed("concept_id", "concept_id_2")
                      .withColumnRenamed("concept_name", "concept_name_2"), "concept_id_2"))
