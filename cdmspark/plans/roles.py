"""Roles of the driver's test tables: how each CDM source is derived from them.

The derivations are plain SQL projections (CASE on keys and text columns), written
once with two dialect spellings so that Spark evaluates them through Catalyst
(``selectExpr`` on a pruned parquet scan) and the DuckDB oracle derives the very same
inputs.  Only inputs are shared this way; every operator on top is written
separately on each side.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Dialect:
    ts: str
    string: str

    def add_days(self, ts: str, n: str) -> str:
        raise NotImplementedError

    def add_hours(self, ts: str, n: str) -> str:
        raise NotImplementedError

    def yyyymmdd(self, d: str) -> str:
        raise NotImplementedError

    def date_plus(self, d: str, n: str) -> str:
        raise NotImplementedError


class _Spark(Dialect):
    def add_days(self, ts, n):
        return f"timestampadd(DAY, CAST({n} AS INT), {ts})"

    def add_hours(self, ts, n):
        return f"timestampadd(HOUR, CAST({n} AS INT), {ts})"

    def yyyymmdd(self, d):
        return f"date_format({d}, 'yyyyMMdd')"

    def date_plus(self, d, n):
        return f"date_add({d}, CAST({n} AS INT))"


class _Duck(Dialect):
    def add_days(self, ts, n):
        return f"({ts} + to_days(CAST({n} AS INTEGER)))"

    def add_hours(self, ts, n):
        return f"({ts} + to_hours(CAST({n} AS INTEGER)))"

    def yyyymmdd(self, d):
        return f"strftime({d}, '%Y%m%d')"

    def date_plus(self, d, n):
        return f"CAST({d} + CAST({n} AS INTEGER) AS DATE)"


SPARK = _Spark(ts="TIMESTAMP_NTZ", string="STRING")
DUCK = _Duck(ts="TIMESTAMP", string="VARCHAR")


# ----------------------------------------------------------------- expressions
def person_source(d: Dialect) -> list[str]:
    return [
        "CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE c_custkey END AS person_id",
        "CASE c_custkey % 6 WHEN 0 THEN 'Male' WHEN 1 THEN ' female ' WHEN 2 THEN 'F' "
        "WHEN 3 THEN 'm' WHEN 4 THEN NULL ELSE '' END AS gender",
        "CASE c_nationkey % 8 WHEN 0 THEN 'Black or African American' WHEN 1 THEN 'ASIAN' "
        "WHEN 2 THEN 'White' WHEN 3 THEN 'Native Hawaiian' WHEN 4 THEN ' american indian ' "
        "WHEN 5 THEN '' WHEN 6 THEN 'Caucasian' ELSE 'Other' END AS race",
        "CASE c_custkey % 5 WHEN 0 THEN 'Hispanic or Latino' WHEN 1 THEN 'Not Hispanic' "
        "WHEN 2 THEN 'non-hispanic' WHEN 3 THEN 'Latino' ELSE NULL END AS ethnicity",
        "CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE CAST(make_date(CAST(1925 + c_custkey % 75 AS INT), "
        f"CAST(1 + c_custkey % 12 AS INT), CAST(1 + c_custkey % 28 AS INT)) AS {d.ts}) END AS birth_datetime",
    ]


def visit_source(d: Dialect) -> list[str]:
    return [
        "o_orderkey AS visit_occurrence_id",
        "o_custkey AS person_id",
        "CASE o_orderpriority WHEN '1-URGENT' THEN 'ER - Emergency Dept' WHEN '2-HIGH' THEN 'Inpatient Hospital' "
        "WHEN '3-MEDIUM' THEN 'Outpatient clinic' WHEN '4-NOT SPECIFIED' THEN 'Telephone consult' "
        "ELSE 'Lab draw' END AS visit_source_value",
        "o_orderdate AS visit_start_datetime",
        f"CASE WHEN o_orderkey % 23 = 0 THEN NULL ELSE {d.add_days('o_orderdate', 'o_orderkey % 5 - 1')} END "
        "AS visit_end_datetime",
        "CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_custkey % 50 END AS care_site_id",
        "CASE o_orderkey % 9 WHEN 0 THEN 'Clinic or physician referral' WHEN 1 THEN 'clinic walk-in' "
        "WHEN 2 THEN 'Emergency room' WHEN 3 THEN 'Born inside this hospital' WHEN 4 THEN 'sick born' "
        "WHEN 5 THEN 'Information not available' WHEN 6 THEN 'Transfer from hospital' "
        "WHEN 7 THEN 'hospital' ELSE NULL END AS admitted_from",
        "CASE o_orderkey % 11 WHEN 0 THEN 'Home' WHEN 1 THEN 'home hospice' WHEN 2 THEN 'Nursing home' "
        "WHEN 3 THEN 'Expired - least' WHEN 4 THEN 'Long term care' WHEN 5 THEN 'ambulatory' "
        "WHEN 6 THEN 'Transfer to HC' WHEN 7 THEN 'Lab' WHEN 8 THEN 'hospice' WHEN 9 THEN '' "
        "ELSE NULL END AS discharged_to",
    ]


CONDITION_PART = "1 + event_id % 150"     # the part whose name an event's condition text varies


def condition_source(d: Dialect) -> list[str]:
    """Over events with the name of their part."""
    return [
        "event_id AS condition_occurrence_id",
        "user_id AS person_id",
        "ts AS condition_start_date",
        f"CASE WHEN event_id % 10 = 0 THEN NULL ELSE {d.add_hours('ts', 'event_id % 72')} END AS condition_end_date",
        "CAST(event_id % 20 AS BIGINT) AS provider_id",
        "CASE WHEN event_id % 19 = 0 THEN NULL ELSE event_id END AS visit_occurrence_id",
        "CASE event_id % 5 WHEN 0 THEN event_type WHEN 1 THEN upper(p_name) WHEN 2 THEN p_name || 's' "
        "WHEN 3 THEN replace(p_name, ' ', '-') ELSE p_name END AS condition_source_value",
        "CASE event_id % 4 WHEN 0 THEN 'Primary diagnosis' WHEN 1 THEN 'Secondary dx' "
        "WHEN 2 THEN 'Admitting' ELSE NULL END AS condition_status_source_value",
    ]


# A second, dirty form of two sources: text where the contract has ids and times, bad values, repeats.
def dirty_visit_source(d: Dialect) -> list[str]:
    """Over visit sources (the columns of ``visit_source``)."""
    text = d.string
    return [
        f"CASE WHEN visit_occurrence_id % 29 = 0 THEN 'x' ELSE '' END || CAST(visit_occurrence_id AS {text}) "
        "AS visit_occurrence_id",
        "person_id",
        f"CASE WHEN visit_occurrence_id % 31 = 0 THEN 'not a date' ELSE CAST(CAST(visit_start_datetime AS DATE) AS {text}) "
        "END AS visit_start_datetime",
        f"CAST(CAST(visit_end_datetime AS DATE) AS {text}) AS visit_end_datetime",
        "visit_source_value", "care_site_id", "admitted_from", "discharged_to",
    ]


REPEATED_VISITS = "visit_occurrence_id % 37 = 0"
REPEATED_PERSONS = "person_id % 9 = 0"


def repeated_person(d: Dialect) -> list[str]:
    """A second registration of a person, one day earlier."""
    return ["person_id", "'Female' AS gender", "race", "ethnicity",
            f"{d.add_days('birth_datetime', '-1')} AS birth_datetime"]


def encounter_source(d: Dialect) -> list[str]:
    return [
        "o_custkey AS person_id",
        "CAST(o_orderdate AS DATE) AS observation_period_start_date",
        f"CAST({d.add_days('o_orderdate', 'o_orderkey % 4')} AS DATE) AS observation_period_end_date",
    ]


# Procedures: one row per (order, line); the part of the line names the procedure.
def procedure_lines_sql() -> str:
    return ("SELECT l_orderkey, l_linenumber, min(l_partkey) AS partkey, min(l_shipdate) AS shipdate "
            "FROM lineitem GROUP BY l_orderkey, l_linenumber")


def procedure_source(d: Dialect) -> list[str]:
    return [
        "l_orderkey * 10 + l_linenumber AS procedure_occurrence_id",
        "shipdate AS procedure_date",
        "l_orderkey AS visit_occurrence_id",
        "CASE (l_orderkey + l_linenumber) % 5 WHEN 0 THEN upper(p_name) WHEN 1 THEN p_name || 's' "
        "WHEN 2 THEN replace(p_name, ' ', '-') WHEN 3 THEN p_brand || ' f/u eval' "
        "ELSE p_name END AS procedure_source_value",
        f"CASE WHEN (l_orderkey * 3 + l_linenumber) % 7 = 0 THEN 'X' || CAST(partkey AS {d.string}) "
        f"ELSE 'P' || CAST(partkey AS {d.string}) END AS procedure_source_code",
        "CASE WHEN l_linenumber <= 2 THEN 'Standard' WHEN l_linenumber <= 4 THEN 'economy' "
        "ELSE 'PROMO' END AS procedure_source_type",
    ]


def concept_raw(d: Dialect) -> list[str]:
    """Vocabulary rows as the tab-separated file would hold them (all text)."""
    start = d.yyyymmdd(d.date_plus("DATE '1970-01-01'", "p_partkey"))
    return [
        f"CAST(p_partkey AS {d.string}) AS concept_id",
        "p_name AS concept_name",
        "p_type AS domain_id",
        "p_brand AS vocabulary_id",
        "'Part' AS concept_class_id",
        "'S' AS standard_concept",
        f"'P' || CAST(p_partkey AS {d.string}) AS concept_code",
        f"CASE WHEN p_partkey % 97 = 0 THEN 'not-a-date' ELSE {start} END AS valid_start_date",
        "'20991231' AS valid_end_date",
        f"CAST(NULL AS {d.string}) AS invalid_reason",
    ]


def relationship_raw_sql(d: Dialect) -> str:
    """Parts ordered one after the other in the same order are related."""
    return (
        f"SELECT DISTINCT CAST(a.l_partkey AS {d.string}) AS concept_id_1, "
        f"CAST(b.l_partkey AS {d.string}) AS concept_id_2, "
        "CASE a.l_returnflag WHEN 'R' THEN 'Returned with' WHEN 'A' THEN 'Accepted with' "
        "ELSE 'Ordered with' END AS relationship_id, "
        "'19700101' AS valid_start_date, '20991231' AS valid_end_date, "
        f"CAST(NULL AS {d.string}) AS invalid_reason "
        "FROM lineitem a JOIN lineitem b ON a.l_orderkey = b.l_orderkey "
        "AND b.l_linenumber = a.l_linenumber + 1"
    )


# Cut-offs for "already loaded" snapshots in the incremental queries.
EXISTING_VISIT_BEFORE = "1998-01-01"
EXISTING_CONDITION_BEFORE = "2024-01-15"

# Standard concepts of condition statuses.
STATUS_CONCEPTS = [(32890, "Admission diagnosis"), (32902, "Primary diagnosis"), (32908, "Secondary diagnosis")]


# ----------------------------------------------------------------- SQL (oracle)
def duck_ctes() -> str:
    """WITH-clause bodies defining every derived source for DuckDB."""
    d = DUCK
    return ",\n".join([
        f"person_src AS (SELECT {', '.join(person_source(d))} FROM customer)",
        "person_ids_src AS (SELECT o_custkey AS person_id FROM orders)",
        f"visit_src AS (SELECT {', '.join(visit_source(d))} FROM orders)",
        f"condition_src AS (SELECT {', '.join(condition_source(d))} FROM events LEFT JOIN part "
        f"ON p_partkey = {CONDITION_PART})",
        f"dirty_visit_src AS (SELECT {', '.join(dirty_visit_source(d))} FROM visit_src UNION ALL "
        f"SELECT {', '.join(dirty_visit_source(d))} FROM visit_src WHERE {REPEATED_VISITS})",
        f"twice_person_src AS (SELECT person_id, gender, race, ethnicity, birth_datetime FROM person_src UNION ALL "
        f"SELECT {', '.join(repeated_person(d))} FROM person_src WHERE {REPEATED_PERSONS})",
        f"encounter_src AS (SELECT {', '.join(encounter_source(d))} FROM orders)",
        f"proc_lines AS ({procedure_lines_sql()})",
        f"procedure_src AS (SELECT {', '.join(procedure_source(d))} FROM proc_lines JOIN part ON p_partkey = partkey)",
        f"concept_raw AS (SELECT {', '.join(concept_raw(d))} FROM part)",
        f"relationship_raw AS ({relationship_raw_sql(d)})",
    ])


# ----------------------------------------------------------------- Spark
class Tables:
    """Lazy readers of the driver's parquet tables plus the derived sources."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def person_src(self) -> DataFrame:
        return self.table("customer").selectExpr(*person_source(SPARK))

    def person_ids_src(self) -> DataFrame:
        return self.table("orders").selectExpr("o_custkey AS person_id")

    def visit_src(self) -> DataFrame:
        return self.table("orders").selectExpr(*visit_source(SPARK))

    def condition_src(self) -> DataFrame:
        from pyspark.sql import functions as F
        part = self.table("part").select("p_partkey", "p_name")
        return (self.table("events").join(part, F.expr(f"p_partkey = {CONDITION_PART}"), "left")
                .selectExpr(*condition_source(SPARK)))

    def dirty_visit_src(self) -> DataFrame:
        v = self.visit_src()
        return v.selectExpr(*dirty_visit_source(SPARK)).unionByName(
            v.where(REPEATED_VISITS).selectExpr(*dirty_visit_source(SPARK)))

    def twice_person_src(self) -> DataFrame:
        p = self.person_src().select("person_id", "gender", "race", "ethnicity", "birth_datetime")
        return p.unionByName(p.where(REPEATED_PERSONS).selectExpr(*repeated_person(SPARK)))

    def status_concepts(self) -> DataFrame:
        return self.spark.createDataFrame(STATUS_CONCEPTS, "concept_id bigint, concept_name string").selectExpr(
            "*", "'Status' AS domain_id")

    def encounter_src(self) -> DataFrame:
        return self.table("orders").selectExpr(*encounter_source(SPARK))

    def procedure_src(self) -> DataFrame:
        from pyspark.sql import functions as F
        li = self.table("lineitem")
        lines = li.groupBy("l_orderkey", "l_linenumber").agg(
            F.min("l_partkey").alias("partkey"), F.min("l_shipdate").alias("shipdate"))
        part = self.table("part").select("p_partkey", "p_name", "p_brand")
        return (lines.join(part, lines.partkey == part.p_partkey)
                .selectExpr(*procedure_source(SPARK)))

    def concept_raw(self) -> DataFrame:
        return self.table("part").selectExpr(*concept_raw(SPARK))

    def relationship_raw(self) -> DataFrame:
        from pyspark.sql import functions as F
        li = self.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag")
        a, b = li.alias("a"), li.alias("b")
        j = a.join(b, (F.col("a.l_orderkey") == F.col("b.l_orderkey"))
                   & (F.col("b.l_linenumber") == F.col("a.l_linenumber") + 1))
        rel = (F.when(F.col("a.l_returnflag") == "R", "Returned with")
                .when(F.col("a.l_returnflag") == "A", "Accepted with").otherwise("Ordered with"))
        return j.select(
            F.col("a.l_partkey").cast("string").alias("concept_id_1"),
            F.col("b.l_partkey").cast("string").alias("concept_id_2"),
            rel.alias("relationship_id"),
            F.lit("19700101").alias("valid_start_date"), F.lit("20991231").alias("valid_end_date"),
            F.lit(None).cast("string").alias("invalid_reason"),
        ).distinct()
