"""DuckDB SQL for each registered query: the correctness oracle.

Written as plain SQL (windows, joins, CASE), independent of the Spark code paths.
The fixed value tables of the rule maps are shared so both sides use the same lists.
"""

from __future__ import annotations

from ..functions import rules as R
from ..functions.text import ABBREVIATIONS
from ..operators.embed import WORD_DIM, model
from ..operators.lsh import BITS, FLIPS, SEED, TABLES
from ..operators.sparse import IDF_SCALE, SPARSE_DIM
from . import catalog as C
from .roles import EXISTING_CONDITION_BEFORE, EXISTING_VISIT_BEFORE, duck_ctes


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _clean(c: str) -> str:
    return f"lower(trim({c}))"


def _blank(c: str) -> str:
    return f"({c} IS NULL OR {c} = '')"


def gender_sql(c):
    x = _clean(c)
    return (f"CAST(CASE WHEN {_blank(c)} THEN 0 WHEN {x} = 'male' THEN 8507 "
            f"WHEN {x} IN ('female', 'f') THEN 8532 ELSE 0 END AS BIGINT)")


def _in_chain(c, table):
    x = _clean(c)
    whens = " ".join(f"WHEN {x} IN ({', '.join(_q(v) for v in vals)}) THEN {cid}" for cid, vals in table)
    return f"CAST(CASE WHEN {_blank(c)} THEN 0 {whens} ELSE 0 END AS BIGINT)"


def race_sql(c):
    return _in_chain(c, R.RACE_RULES)


def ethnicity_sql(c):
    return _in_chain(c, R.ETHNICITY_RULES)


def visit_type_sql(c):
    x = _clean(c)
    whens = " ".join(f"WHEN contains({x}, {_q(k)}) THEN {cid}" for k, cid in R.VISIT_TYPE_RULES)
    return f"CAST(CASE WHEN {_blank(c)} THEN 0 {whens} ELSE 0 END AS BIGINT)"


def _nested_sql(x, rule, miss):
    if not isinstance(rule, list):
        return str(rule)
    parts = " ".join(f"WHEN {'TRUE' if k == '' else f'contains({x}, {_q(k)})'} THEN {cid}" for k, cid in rule)
    return f"(CASE {parts} ELSE {miss} END)"


def admit_sql(c):
    x = _clean(c)
    whens = " ".join(f"WHEN contains({x}, {_q(k)}) THEN {_nested_sql(x, r, 'NULL')}" for k, r in R.ADMIT_RULES)
    return f"CAST(CASE WHEN {_blank(c)} THEN 0 {whens} ELSE NULL END AS BIGINT)"


def discharge_sql(c):
    x = _clean(c)
    kws = " OR ".join(f"contains({x}, {_q(k)})" for k in dict.fromkeys(R.DISCHARGE_FACILITY_KEYWORDS))
    whens = " ".join(f"WHEN contains({x}, {_q(k)}) THEN {_nested_sql(x, r, '0')}" for k, r in R.DISCHARGE_RULES)
    return (f"CAST(CASE WHEN {_blank(c)} THEN 0 WHEN ({kws}) THEN {R.DISCHARGE_FACILITY_ID} "
            f"{whens} ELSE 0 END AS BIGINT)")


# --------------------------------------------------------------------------- CTEs
PERSONS = f"""
person_ids AS (SELECT DISTINCT CAST(person_id AS BIGINT) AS person_id FROM person_ids_src WHERE person_id IS NOT NULL),
persons AS (
  SELECT CAST(person_id AS BIGINT) AS person_id, {gender_sql('gender')} AS gender_concept_id,
    CAST(year(birth_datetime) AS INTEGER) AS year_of_birth, CAST(month(birth_datetime) AS INTEGER) AS month_of_birth,
    CAST(day(birth_datetime) AS INTEGER) AS day_of_birth, birth_datetime,
    {race_sql('race')} AS race_concept_id, {ethnicity_sql('ethnicity')} AS ethnicity_concept_id,
    CAST(NULL AS BIGINT) AS location_id, CAST(NULL AS BIGINT) AS provider_id, CAST(NULL AS BIGINT) AS care_site_id,
    CAST(person_id AS BIGINT) AS person_source_value, coalesce(gender, '') AS gender_source_value,
    coalesce(race, '') AS race_source_value, coalesce(ethnicity, '') AS ethnicity_source_value
  FROM person_src
  WHERE person_id IS NOT NULL AND birth_datetime IS NOT NULL AND person_id IN (SELECT person_id FROM person_ids))"""


def _visit_cols(prev: str) -> str:
    return f"""visit_occurrence_id, person_id, {visit_type_sql('visit_source_value')} AS visit_concept_id,
    CAST(visit_start_datetime AS DATE) AS visit_start_date, visit_start_datetime,
    CAST(visit_end_datetime AS DATE) AS visit_end_date, visit_end_datetime,
    CAST(32827 AS BIGINT) AS visit_type_concept_id, CAST(NULL AS BIGINT) AS provider_id,
    CAST(care_site_id AS BIGINT) AS care_site_id, visit_source_value, CAST(NULL AS BIGINT) AS visit_source_concept_id,
    {admit_sql('admitted_from')} AS admitted_from_concept_id, coalesce(admitted_from, '') AS admitted_from_source_value,
    {discharge_sql('discharged_to')} AS discharged_to_concept_id, coalesce(discharged_to, '') AS discharged_to_source_value,
    {prev} AS preceding_visit_occurrence_id"""


def _vis_elig(extra: str = "") -> str:
    return f"""
vis_elig AS (SELECT * FROM visit_src WHERE visit_occurrence_id IS NOT NULL AND visit_start_datetime IS NOT NULL
  AND visit_end_datetime IS NOT NULL AND person_id IN (SELECT person_id FROM persons) {extra})"""


VISITS = PERSONS + "," + _vis_elig() + f""",
visits AS (SELECT {_visit_cols('LAG(visit_occurrence_id) OVER (PARTITION BY person_id ORDER BY visit_occurrence_id)')}
  FROM vis_elig)"""

CONDITIONS = PERSONS + """,
conditions AS (
  SELECT condition_occurrence_id, person_id, CAST(0 AS BIGINT) AS condition_concept_id,
    CAST(condition_start_date AS DATE) AS condition_start_date, condition_start_date AS condition_start_datetime,
    CAST(condition_end_date AS DATE) AS condition_end_date, condition_end_date AS condition_end_datetime,
    CAST(32817 AS INTEGER) AS condition_type_concept_id, CAST(0 AS INTEGER) AS condition_status_concept_id,
    CAST(NULL AS VARCHAR) AS stop_reason, provider_id, visit_occurrence_id, CAST(NULL AS BIGINT) AS visit_detail_id,
    condition_source_value, CAST(0 AS BIGINT) AS condition_source_concept_id, condition_status_source_value
  FROM condition_src
  WHERE condition_occurrence_id IS NOT NULL AND condition_start_date IS NOT NULL
    AND condition_start_date > TIMESTAMP '1930-01-01' AND person_id IS NOT NULL
    AND visit_occurrence_id IS NOT NULL AND person_id IN (SELECT person_id FROM persons))"""

PROCEDURES = VISITS + """,
procedures AS (
  SELECT p.procedure_occurrence_id, v.person_id, CAST(0 AS BIGINT) AS procedure_concept_id,
    CAST(p.procedure_date AS DATE) AS procedure_date, p.procedure_date AS procedure_datetime,
    CAST(p.procedure_date AS DATE) AS procedure_end_date, p.procedure_date AS procedure_end_datetime,
    CAST(32817 AS INTEGER) AS procedure_type_concept_id, CAST(NULL AS BIGINT) AS modifier_concept_id,
    CAST(1 AS INTEGER) AS quantity, CAST(NULL AS BIGINT) AS provider_id, p.visit_occurrence_id,
    CAST(NULL AS BIGINT) AS visit_detail_id, p.procedure_source_value,
    CAST(NULL AS BIGINT) AS procedure_source_concept_id, CAST(NULL AS VARCHAR) AS modifier_source_value
  FROM procedure_src p JOIN visits v ON p.visit_occurrence_id = v.visit_occurrence_id
  WHERE p.procedure_occurrence_id IS NOT NULL AND p.procedure_date IS NOT NULL
    AND p.procedure_date > TIMESTAMP '1930-01-01' AND p.visit_occurrence_id IS NOT NULL AND v.person_id IS NOT NULL)"""


PREV_END = "LAG(end_date) OVER (PARTITION BY person_id ORDER BY start_date, end_date)"
PREV_MAX_END = ("max(end_date) OVER (PARTITION BY person_id ORDER BY start_date, end_date "
                "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)")


def _enc(floor: str | None = None, prev_end: str = PREV_END) -> str:
    f = (f" AND observation_period_start_date > DATE '{floor}' AND observation_period_end_date > DATE '{floor}'"
         if floor else "")
    return PERSONS + f""",
enc AS (SELECT CAST(person_id AS BIGINT) AS person_id, observation_period_start_date AS start_date,
    observation_period_end_date AS end_date FROM encounter_src
  WHERE person_id IS NOT NULL AND observation_period_start_date IS NOT NULL
    AND observation_period_end_date IS NOT NULL {f} AND person_id IN (SELECT person_id FROM persons)),
lagged AS (SELECT *, {prev_end} AS prev_end_date FROM enc),
flagged AS (SELECT *, CAST(CASE WHEN prev_end_date IS NULL THEN 1
    WHEN date_diff('day', prev_end_date, start_date) > {C.OBS_GAP_DAYS} THEN 1 ELSE 0 END AS INTEGER) AS new_period_flag
  FROM lagged),
grouped AS (SELECT *, CAST(SUM(new_period_flag) OVER (PARTITION BY person_id ORDER BY start_date, end_date
    ROWS UNBOUNDED PRECEDING) AS INTEGER) AS period_group FROM flagged),
periods AS (SELECT person_id, period_group, min(start_date) AS s, max(end_date) AS e FROM grouped GROUP BY ALL),
obs AS (SELECT CAST(row_number() OVER (ORDER BY person_id, s) AS BIGINT) AS observation_period_id, person_id,
    s AS observation_period_start_date, e AS observation_period_end_date,
    CAST(32813 AS INTEGER) AS period_type_concept_id FROM periods)"""


def W(body: str, select: str) -> str:
    return f"WITH {duck_ctes()},\n{body.strip().lstrip(',')}\n{select}"


def _rule_sql(src, key, col, fn):
    return f"WITH {duck_ctes()}\nSELECT {key}, {col} AS source_value, {fn(col)} AS concept_id FROM {src}"


VISIT_EXISTING = f"ex AS (SELECT person_id, visit_occurrence_id FROM visits WHERE visit_start_date < DATE '{EXISTING_VISIT_BEFORE}')"

SQL: dict[str, str] = {
    "load_person_ids": W(PERSONS, "SELECT person_id FROM person_ids"),
    "load_person": W(PERSONS, "SELECT * FROM persons"),
    "incremental_person": W(VISITS + ",\n" + VISIT_EXISTING,
                            "SELECT * FROM persons WHERE person_id NOT IN (SELECT person_id FROM ex)"),
    "preceding_visit_by_start": W(PERSONS + "," + _vis_elig(), """SELECT visit_occurrence_id, person_id, visit_start_datetime,
  LAG(visit_occurrence_id) OVER (PARTITION BY person_id ORDER BY visit_start_datetime, visit_occurrence_id)
    AS preceding_visit_occurrence_id FROM vis_elig"""),
    "observation_period_merged": W(_enc(prev_end=PREV_MAX_END), "SELECT * FROM obs"),
    "person_by_birth_year": W(PERSONS, f"SELECT person_id, year_of_birth, gender_concept_id FROM persons "
                                       f"WHERE year_of_birth = {C.BIRTH_YEAR}"),
    "load_visit": W(VISITS, "SELECT * FROM visits"),
    "preceding_visit": W(VISITS, "SELECT visit_occurrence_id, person_id, preceding_visit_occurrence_id FROM visits"),
    "limit_visit": W(VISITS, f"SELECT * FROM visits ORDER BY visit_occurrence_id LIMIT {C.LIMIT_TOTAL}"),
    "load_visit_resume": W(PERSONS + "," + _vis_elig(f"AND visit_occurrence_id > {C.RESUME_AFTER}") + f""",
visits AS (SELECT {_visit_cols('LAG(visit_occurrence_id) OVER (PARTITION BY person_id ORDER BY visit_occurrence_id)')}
  FROM vis_elig)""", "SELECT * FROM visits"),
    "load_condition": W(CONDITIONS, "SELECT * FROM conditions"),
    "load_procedure": W(PROCEDURES, "SELECT * FROM procedures"),
    "map_gender": _rule_sql("person_src", "person_id", "gender", gender_sql),
    "map_race": _rule_sql("person_src", "person_id", "race", race_sql),
    "map_ethnicity": _rule_sql("person_src", "person_id", "ethnicity", ethnicity_sql),
    "map_visit_type": _rule_sql("visit_src", "visit_occurrence_id", "visit_source_value", visit_type_sql),
    "map_admit": _rule_sql("visit_src", "visit_occurrence_id", "admitted_from", admit_sql),
    "map_discharge": _rule_sql("visit_src", "visit_occurrence_id", "discharged_to", discharge_sql),
    "obs_lag": W(_enc(), "SELECT person_id, start_date, end_date, prev_end_date FROM lagged"),
    "obs_flag": W(_enc(), "SELECT person_id, start_date, end_date, prev_end_date, new_period_flag FROM flagged"),
    "obs_group": W(_enc(), "SELECT person_id, start_date, end_date, prev_end_date, new_period_flag, period_group "
                           "FROM grouped"),
    "observation_period": W(_enc(), "SELECT * FROM obs"),
    "observation_period_floor": W(_enc(C.OBS_FLOOR), "SELECT * FROM obs"),
    "observation_period_id": W(_enc(), "SELECT person_id, start_date, CAST(row_number() OVER "
                                       "(ORDER BY person_id, start_date) AS BIGINT) AS row_id "
                                       "FROM (SELECT DISTINCT person_id, start_date FROM enc)"),
    "incremental_visit": W(VISITS + ",\n" + VISIT_EXISTING + """,
newv AS (SELECT * FROM vis_elig WHERE visit_occurrence_id NOT IN (SELECT visit_occurrence_id FROM ex)),
u AS (SELECT person_id, visit_occurrence_id, 1 AS is_new FROM newv
      UNION ALL SELECT person_id, visit_occurrence_id, 0 AS is_new FROM ex),
pv AS (SELECT visit_occurrence_id, is_new,
       LAG(visit_occurrence_id) OVER (PARTITION BY person_id ORDER BY visit_occurrence_id) AS prev FROM u)""",
        f"SELECT {_visit_cols('pv.prev')} FROM newv JOIN pv USING (visit_occurrence_id) WHERE pv.is_new = 1"),
    "incremental_condition": W(CONDITIONS, f"SELECT * FROM conditions WHERE condition_occurrence_id NOT IN "
                               f"(SELECT condition_occurrence_id FROM conditions "
                               f"WHERE condition_start_date < DATE '{EXISTING_CONDITION_BEFORE}')"),
    "incremental_procedure": W(PROCEDURES, f"SELECT * FROM procedures WHERE procedure_occurrence_id NOT IN "
                               f"(SELECT procedure_occurrence_id FROM procedures "
                               f"WHERE procedure_date < DATE '{EXISTING_VISIT_BEFORE}')"),
    "load_report": W(VISITS + ",\n" + VISIT_EXISTING, """SELECT count(*) AS eligible_rows,
  count(ex.visit_occurrence_id) AS already_loaded, count(*) FILTER (WHERE ex.visit_occurrence_id IS NULL) AS to_insert,
  CASE WHEN count(*) > 0 THEN round(CAST(count(ex.visit_occurrence_id) AS DOUBLE) * 100.0 / count(*), 4) END
    AS completion_pct
FROM vis_elig e LEFT JOIN ex USING (visit_occurrence_id)"""),
    "dq_date_order": W(VISITS, "SELECT visit_occurrence_id, visit_start_datetime, visit_end_datetime FROM visits "
                               "WHERE visit_end_datetime < visit_start_datetime"),
    "dq_orphans": W(PERSONS, " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, count(*) AS n_rows, count(*) FILTER (WHERE person_id IS NULL OR person_id "
        f"NOT IN (SELECT person_id FROM persons)) AS n_orphans FROM {t}"
        for n, t in [("visit", "visit_src"), ("condition", "condition_src"), ("observation", "encounter_src")])),
    "dq_nulls": f"WITH {duck_ctes()}\n" + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS n_rows, count(*) FILTER (WHERE {c} IS NULL) AS n_null FROM visit_src"
        for c in ["visit_occurrence_id", "person_id", "visit_start_datetime", "visit_end_datetime",
                  "care_site_id", "admitted_from", "discharged_to"]),
    "dq_duplicates": "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1",
    "dq_date_range": f"""WITH {duck_ctes()},
d AS (SELECT concept_id, valid_start_date, coalesce(CAST(try_strptime(valid_start_date, '%Y%m%d') AS DATE),
    CAST(try_strptime(valid_start_date, '%Y-%m-%d') AS DATE)) AS dt FROM concept_raw)
SELECT concept_id, valid_start_date, CASE WHEN valid_start_date IS NULL THEN 'missing'
  WHEN dt IS NULL THEN 'unparseable' WHEN dt <= DATE '1930-01-01' THEN 'before_floor' END AS reason
FROM d WHERE valid_start_date IS NULL OR dt IS NULL OR dt <= DATE '1930-01-01'""",
}


# --------------------------------------------------------------------------- vocabulary
def _vdate(c):
    return (f"coalesce(CAST(try_strptime({c}, '%Y%m%d') AS DATE), CAST(try_strptime({c}, '%Y-%m-%d') AS DATE))")


def _blank_null(c):
    return f"CASE WHEN trim({c}) = '' THEN NULL ELSE {c} END"


def _concepts_sql(domain: str | None = None, name: str = "concepts") -> str:
    dom = f"AND upper(domain_id) = '{domain.upper()}'" if domain else ""
    return f"""
{name}_typed AS (SELECT TRY_CAST(concept_id AS BIGINT) AS concept_id, {_blank_null('concept_name')} AS concept_name,
    {_blank_null('domain_id')} AS domain_id, {_blank_null('vocabulary_id')} AS vocabulary_id,
    {_blank_null('concept_class_id')} AS concept_class_id, {_blank_null('standard_concept')} AS standard_concept,
    {_blank_null('concept_code')} AS concept_code, {_vdate('valid_start_date')} AS valid_start_date,
    {_vdate('valid_end_date')} AS valid_end_date, {_blank_null('invalid_reason')} AS invalid_reason
  FROM concept_raw WHERE TRUE {dom}),
{name}_good AS (SELECT * FROM {name}_typed WHERE concept_id IS NOT NULL AND concept_name IS NOT NULL
    AND domain_id IS NOT NULL AND vocabulary_id IS NOT NULL AND concept_class_id IS NOT NULL
    AND concept_code IS NOT NULL AND valid_start_date IS NOT NULL AND valid_end_date IS NOT NULL
    AND length(concept_name) <= 255 AND length(domain_id) <= 20 AND length(vocabulary_id) <= 20
    AND length(concept_class_id) <= 20 AND coalesce(length(standard_concept), 0) <= 1
    AND length(concept_code) <= 50 AND coalesce(length(invalid_reason), 0) <= 1),
{name} AS (SELECT concept_id, concept_name, domain_id, vocabulary_id, concept_class_id, standard_concept,
    concept_code, valid_start_date, valid_end_date, invalid_reason FROM (
  SELECT *, row_number() OVER (PARTITION BY concept_id ORDER BY valid_start_date DESC, concept_name) AS rn
  FROM {name}_good) WHERE rn = 1)"""


def _rels_sql(concepts: str, name: str = "rels", extra_where: str = "") -> str:
    return f"""
{name}_typed AS (SELECT TRY_CAST(concept_id_1 AS BIGINT) AS concept_id_1, TRY_CAST(concept_id_2 AS BIGINT) AS concept_id_2,
    {_blank_null('relationship_id')} AS relationship_id, {_vdate('valid_start_date')} AS valid_start_date,
    {_vdate('valid_end_date')} AS valid_end_date, {_blank_null('invalid_reason')} AS invalid_reason
  FROM relationship_raw),
{name} AS (SELECT concept_id_1, concept_id_2, relationship_id, valid_start_date, valid_end_date, invalid_reason FROM (
  SELECT *, row_number() OVER (PARTITION BY concept_id_1, concept_id_2, relationship_id
                               ORDER BY valid_start_date DESC) AS rn
  FROM {name}_typed
  WHERE concept_id_1 IS NOT NULL AND concept_id_2 IS NOT NULL AND relationship_id IS NOT NULL
    AND valid_start_date IS NOT NULL AND valid_end_date IS NOT NULL AND length(relationship_id) <= 20
    AND coalesce(length(invalid_reason), 0) <= 1
    AND concept_id_1 IN (SELECT concept_id FROM {concepts}) AND concept_id_2 IN (SELECT concept_id FROM {concepts})
    {extra_where}) WHERE rn = 1)"""


_EXC = f"valid_start_date < DATE '{C.EXISTING_CONCEPT_BEFORE}'"

SQL.update({
    "load_concept": W(_concepts_sql(), "SELECT * FROM concepts"),
    "concept_lookup": W(_concepts_sql(C.LOOKUP_DOMAIN), "SELECT * FROM concepts"),
    "incremental_concept": W(_concepts_sql(), f"SELECT * FROM concepts WHERE concept_id NOT IN "
                                              f"(SELECT concept_id FROM concepts WHERE {_EXC})"),
    "validate_vocabulary": W("", f"""SELECT
  (SELECT count(*) FROM concept_raw) AS n_rows,
  (SELECT count(*) FROM concept_raw WHERE concept_id IS NOT NULL AND TRY_CAST(concept_id AS BIGINT) IS NULL)
    AS bad_concept_id,
  (SELECT count(*) FROM concept_raw WHERE valid_start_date IS NOT NULL AND {_vdate('valid_start_date')} IS NULL)
    AS bad_valid_start_date,
  (SELECT count(*) FROM concept_raw WHERE valid_end_date IS NOT NULL AND {_vdate('valid_end_date')} IS NULL)
    AS bad_valid_end_date,
  (SELECT count(*) FROM concept_raw WHERE concept_id IS NULL) AS null_keys,
  (SELECT CAST(coalesce(sum(c - 1), 0) AS BIGINT) FROM (SELECT concept_id, count(*) AS c FROM concept_raw
    GROUP BY concept_id) WHERE c > 1) AS repeated_keys"""),
    "load_concept_relationship": W(_concepts_sql() + "," + _rels_sql("concepts"), "SELECT * FROM rels"),
    "relationship_domain": W(
        _concepts_sql(C.LOOKUP_DOMAIN) + f""",
file_level AS (SELECT TRY_CAST(concept_id AS BIGINT) AS concept_id FROM concept_raw
               WHERE upper(domain_id) = '{C.LOOKUP_DOMAIN.upper()}'),""" + _rels_sql(
            "concepts", extra_where="AND concept_id_1 IN (SELECT concept_id FROM file_level) "
                                    "AND concept_id_2 IN (SELECT concept_id FROM file_level)"),
        "SELECT * FROM rels"),
    "relationship_existing": W(_concepts_sql() + f""",
loaded AS (SELECT * FROM concepts WHERE {_EXC}),""" + _rels_sql("loaded"), """SELECT r.concept_id_1, r.concept_id_2,
  r.relationship_id, a.concept_name AS concept_name_1, b.concept_name AS concept_name_2
FROM rels r JOIN loaded a ON a.concept_id = r.concept_id_1 JOIN loaded b ON b.concept_id = r.concept_id_2"""),
    "incremental_relationship": W(_concepts_sql() + "," + _rels_sql("concepts"), f"""SELECT * FROM rels r
WHERE NOT EXISTS (SELECT 1 FROM rels e WHERE e.relationship_id = '{C.EXISTING_RELATIONSHIP}'
  AND e.concept_id_1 = r.concept_id_1 AND e.concept_id_2 = r.concept_id_2 AND e.relationship_id = r.relationship_id)"""),
})


# --------------------------------------------------------------------------- text (DuckDB / RE2)
import re as _re  # noqa: E402

_WORD = r"\pL\pN_"
_WS = r"\t-\r\x1c-\x1f\x{85}\pZ"


def duck_preprocess(expr: str) -> str:
    """The normalisation of ``preprocess_text`` in RE2 terms.  RE2 has no look-around,
    so a whole word is matched with its delimiters and put back; two passes catch
    words whose leading delimiter the previous match consumed."""
    x = f"lower({expr})"
    for abbr, full in ABBREVIATIONS:
        pat = f"(^|[^{_WORD}]){_re.escape(abbr)}([^{_WORD}]|$)"
        rep = "\\1" + full + "\\2"
        for _ in range(2):
            x = f"regexp_replace({x}, {_q(pat)}, {_q(rep)}, 'g')"
    x = f"regexp_replace({x}, '[^{_WORD}{_WS}/-]', ' ', 'g')"
    x = f"regexp_replace({x}, '[{_WS}]+', ' ', 'g')"
    return f"coalesce(trim({x}), '')"


def _grams(table: str, key: str, text: str, name: str, dim: int = 512) -> str:
    s = f"(' ' || {text} || ' ')"
    return f"""
{name}_g AS (SELECT k, (unicode(substr(s, i, 1)) * 1369 + unicode(substr(s, i + 1, 1)) * 37
      + unicode(substr(s, i + 2, 1))) % {dim} AS b
  FROM (SELECT {key} AS k, {s} AS s, unnest(range(1, length({s}) - 1)) AS i FROM {table} WHERE {text} <> '')),
{name}_v AS (SELECT k, b, count(*) AS w FROM {name}_g GROUP BY ALL),
{name}_n AS (SELECT k, sqrt(sum(w * w)) AS n FROM {name}_v GROUP BY k)"""


def text_nn(src_table: str, cand_table: str, name: str, dim: int = 512) -> str:
    """Best candidate per source text: ``{name}_best(sk, ck, score)``.  Tables:
    src_table(ptext), cand_table(ptext, concept_id).  A text sharing no trigram with any
    candidate scores 0 against all, so its best is the lowest candidate id at 0.0."""
    return (_grams(src_table, "ptext", "ptext", f"{name}_s", dim) + ","
            + _grams(cand_table, "concept_id", "ptext", f"{name}_c", dim) + f""",
{name}_dot AS (SELECT s.k AS sk, c.k AS ck, sum(s.w * c.w) AS d FROM {name}_s_v s JOIN {name}_c_v c ON s.b = c.b
  GROUP BY ALL),
{name}_sc AS (SELECT d.sk, d.ck, CAST(d.d AS DOUBLE) / (sn.n * cn.n) AS score FROM {name}_dot d
  JOIN {name}_s_n sn ON sn.k = d.sk JOIN {name}_c_n cn ON cn.k = d.ck),
{name}_top AS (SELECT sk, ck, score FROM (SELECT *, row_number() OVER (PARTITION BY sk ORDER BY score DESC, ck) AS rn
  FROM {name}_sc) WHERE rn = 1),
{name}_best AS (SELECT s.k AS sk, coalesce(t.ck, (SELECT min(k) FROM {name}_c_n)) AS ck,
  coalesce(t.score, 0.0) AS score FROM {name}_s_n s LEFT JOIN {name}_top t ON t.sk = s.k)""")


def _cands() -> str:
    return f"""
cand_pp AS (SELECT concept_id, {duck_preprocess('concept_name')} AS ptext FROM concepts),
cands AS (SELECT ptext, min(concept_id) AS concept_id FROM cand_pp WHERE ptext <> '' GROUP BY ptext),
exact_pp AS (SELECT ptext AS k, max(concept_id) AS eid FROM cand_pp WHERE ptext <> '' GROUP BY ptext)"""


PROC_PP = f"""
proc AS (SELECT procedure_occurrence_id, procedure_source_value, procedure_source_code, procedure_source_type,
    {duck_preprocess('procedure_source_value')} AS ptext FROM procedure_src),
proc_texts AS (SELECT DISTINCT ptext FROM proc WHERE ptext <> '')"""

MULTI = _concepts_sql() + "," + _cands() + "," + PROC_PP + "," + text_nn("proc_texts", "cands", "nn") + f""",
multi AS (
  SELECT p.procedure_occurrence_id, p.procedure_source_value,
    CASE WHEN e.eid IS NOT NULL THEN 'exact_match' WHEN b.score >= {C.SEM_THRESHOLD} THEN 'semantic_match'
         WHEN b.score >= {max(0.5, C.SEM_THRESHOLD - 0.2)} THEN 'partial_match' END AS matching_strategy,
    b.ck AS sid, b.score AS sscore, e.eid
  FROM proc p LEFT JOIN nn_best b ON b.sk = p.ptext LEFT JOIN exact_pp e ON e.k = p.ptext),
multi_out AS (
  SELECT m.procedure_occurrence_id, m.procedure_source_value AS source_value,
    CASE WHEN m.matching_strategy = 'exact_match' THEN m.eid WHEN m.matching_strategy IS NOT NULL THEN m.sid END
      AS concept_id,
    c.concept_name AS matched_concept_name, m.matching_strategy,
    CASE WHEN m.matching_strategy = 'exact_match' THEN 1.0 WHEN m.matching_strategy IS NOT NULL THEN m.sscore
         ELSE 0.0 END AS similarity_score
  FROM multi m LEFT JOIN concepts c ON c.concept_id =
    CASE WHEN m.matching_strategy = 'exact_match' THEN m.eid WHEN m.matching_strategy IS NOT NULL THEN m.sid END)"""

CASCADE = _concepts_sql() + "," + _cands() + "," + PROC_PP + """,
code_lk AS (SELECT concept_code AS k, max(concept_id) AS code_id FROM concepts GROUP BY 1),
proc_c AS (SELECT p.*, l.code_id FROM proc p LEFT JOIN code_lk l ON l.k = p.procedure_source_code),
rest_texts AS (SELECT DISTINCT ptext FROM proc_c WHERE code_id IS NULL AND ptext <> '')""" + "," + text_nn(
    "rest_texts", "cands", "cn") + f""",
cascade AS (
  SELECT p.procedure_occurrence_id, p.procedure_source_code AS source_code, p.procedure_source_value AS source_value,
    p.procedure_source_type AS source_type,
    CASE WHEN p.code_id IS NOT NULL THEN p.code_id WHEN b.score >= {C.CASCADE_THRESHOLD} THEN b.ck END AS concept_id,
    CASE WHEN p.code_id IS NOT NULL THEN 'DIRECT_CODE_MATCH' WHEN b.score >= {C.CASCADE_THRESHOLD}
         THEN 'SEMANTIC_MATCH' ELSE 'UNMAPPED_FINAL' END AS mapping_method,
    CASE WHEN p.code_id IS NULL AND b.score >= {C.CASCADE_THRESHOLD} THEN b.score END AS similarity_score
  FROM proc_c p LEFT JOIN cn_best b ON p.code_id IS NULL AND b.sk = p.ptext),
cascade_out AS (SELECT x.*, c.concept_name AS matched_concept_name, c.domain_id AS matched_domain
  FROM cascade x LEFT JOIN concepts c ON c.concept_id = x.concept_id)"""

VISIT_FALLBACK = _concepts_sql() + "," + _cands() + f""",
vis AS (SELECT visit_occurrence_id, visit_source_value, {duck_preprocess('visit_source_value')} AS ptext
  FROM visit_src),
vis_texts AS (SELECT DISTINCT ptext FROM vis WHERE ptext <> '')""" + "," + text_nn("vis_texts", "cands", "vn") + f""",
up_lk AS (SELECT upper(concept_name) AS k, max(concept_id) AS eid FROM concepts GROUP BY 1),
fb AS (SELECT v.visit_occurrence_id, v.visit_source_value, u.eid,
    CASE WHEN b.score >= {C.SEM_THRESHOLD} THEN b.ck END AS sid, {visit_type_sql('v.visit_source_value')} AS rid
  FROM vis v LEFT JOIN up_lk u ON u.k = upper(v.visit_source_value) LEFT JOIN vn_best b ON b.sk = v.ptext)"""

_VEC = """
e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
pairs AS (SELECT a.vec_id, b.vec_id AS nid, b.label AS nlabel, list_cosine_similarity(a.v, b.v) AS s
  FROM e a JOIN e b ON a.vec_id <> b.vec_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY s DESC, nid) AS rk FROM pairs)"""

SQL.update({
    "map_exact": W(_concepts_sql() + """,
lk AS (SELECT upper(concept_name) AS k, max(concept_id) AS concept_id FROM concepts GROUP BY 1)""",
                   "SELECT p.procedure_occurrence_id, p.procedure_source_value AS source_value, lk.concept_id "
                   "FROM procedure_src p LEFT JOIN lk ON upper(p.procedure_source_value) = lk.k"),
    "map_code": W(_concepts_sql() + """,
lk AS (SELECT concept_code AS k, max(concept_id) AS concept_id FROM concepts GROUP BY 1)""",
                  """SELECT p.procedure_occurrence_id, p.procedure_source_code AS source_code, lk.concept_id,
  c.concept_name AS matched_concept_name, c.domain_id AS matched_domain
FROM procedure_src p LEFT JOIN lk ON p.procedure_source_code = lk.k LEFT JOIN concepts c ON c.concept_id = lk.concept_id"""),
    "map_semantic": W(_VEC, f"""SELECT vec_id, CASE WHEN s >= {C.VEC_THRESHOLD} THEN nid END AS concept_id,
  CASE WHEN s >= {C.VEC_THRESHOLD} THEN nlabel END AS matched_label, round(s, 4) AS similarity_score
FROM ranked WHERE rk = 1"""),
    "similar_concepts": W(_VEC, f"SELECT vec_id, nid AS concept_id, round(s, 4) AS similarity_score, "
                                f"CAST(rk AS INTEGER) AS rank FROM ranked WHERE rk <= {C.TOP_K}"),
    "cosine": """SELECT a.vec_id, b.vec_id AS next_id,
  round(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 6) AS cosine
FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1""",
    "preprocess_text": f"SELECT doc_id, {duck_preprocess('text')} AS clean_text FROM documents",
    "embed_text": W(_concepts_sql() + f""",
names AS (SELECT DISTINCT concept_name, {duck_preprocess('concept_name')} AS ptext FROM concepts)""" + "," + _grams(
        "names", "concept_name", "ptext", "en"),
        "SELECT v.k AS concept_name, CAST(v.b AS INTEGER) AS bucket, round(v.w / n.n, 6) AS weight "
        "FROM en_v v JOIN en_n n ON n.k = v.k"),
    "map_multi": W(MULTI, "SELECT procedure_occurrence_id, source_value, concept_id, matched_concept_name, "
                          "matching_strategy, round(similarity_score, 4) AS similarity_score FROM multi_out"),
    "map_source": W(_concepts_sql() + "," + _cands() + "," + PROC_PP + "," + text_nn("proc_texts", "cands", "nn"),
                    f"""SELECT p.procedure_occurrence_id, p.procedure_source_value AS source_value,
  CASE WHEN b.score >= {C.SEM_THRESHOLD} THEN b.ck END AS concept_id,
  CASE WHEN b.score >= {C.SEM_THRESHOLD} THEN c.concept_name END AS matched_concept_name,
  round(b.score, 4) AS similarity_score
FROM proc p LEFT JOIN nn_best b ON b.sk = p.ptext LEFT JOIN concepts c ON c.concept_id = b.ck"""),
    "map_cascade": W(CASCADE, "SELECT procedure_occurrence_id, source_code, source_value, source_type, concept_id, "
                              "matched_concept_name, matched_domain, mapping_method, "
                              "round(similarity_score, 4) AS similarity_score FROM cascade_out"),
    "cross_domain": W(CASCADE, "SELECT procedure_occurrence_id, source_type, matched_domain, matched_concept_name "
                               "FROM cascade_out WHERE mapping_method = 'SEMANTIC_MATCH' "
                               "AND lower(source_type) <> lower(matched_domain)"),
    "review_list": W(CASCADE, "SELECT procedure_occurrence_id, source_code, source_value, source_type "
                              "FROM cascade_out WHERE mapping_method IN ('UNMAPPED', 'UNMAPPED_FINAL')"),
    "mapped_by_domain": W(CASCADE, "SELECT matched_domain, count(*) AS n_records FROM cascade_out "
                                   "WHERE concept_id IS NOT NULL GROUP BY matched_domain"),
    "mapping_report": W(MULTI, """SELECT count(*) AS total_records, count(concept_id) AS mapped_records,
  count(*) - count(concept_id) AS unmapped_records,
  CASE WHEN count(*) > 0 THEN round(CAST(count(concept_id) AS DOUBLE) * 100.0 / count(*), 4) END AS mapping_rate,
  round(avg(similarity_score) FILTER (WHERE concept_id IS NOT NULL), 4) AS avg_similarity,
  round(min(similarity_score) FILTER (WHERE concept_id IS NOT NULL), 4) AS min_similarity,
  round(max(similarity_score) FILTER (WHERE concept_id IS NOT NULL), 4) AS max_similarity
FROM multi_out"""),
    "strategy_breakdown": W(MULTI, "SELECT matching_strategy, count(*) AS n_records FROM multi_out "
                                   "WHERE matching_strategy IS NOT NULL GROUP BY 1"),
    "confidence_band": W(MULTI, """SELECT source_value, matched_concept_name, round(max(similarity_score), 4)
  AS similarity_score, count(*) AS n_records FROM multi_out
WHERE concept_id IS NOT NULL AND similarity_score >= 0.7 AND similarity_score < 0.9 GROUP BY ALL"""),
    "top_unmapped": W(MULTI, """SELECT source_value, count(*) AS n_records FROM multi_out WHERE concept_id IS NULL
GROUP BY 1 ORDER BY n_records DESC, source_value ASC NULLS FIRST LIMIT 10"""),
    "mapping_summary": W(MULTI, """SELECT concept_id, count(*) AS n_records FROM multi_out GROUP BY 1
ORDER BY n_records DESC, concept_id ASC NULLS FIRST LIMIT 10"""),
    "map_fallback": W(VISIT_FALLBACK, """SELECT visit_occurrence_id, visit_source_value,
  coalesce(eid, sid, rid) AS concept_id,
  CASE WHEN eid IS NOT NULL THEN 'exact' WHEN sid IS NOT NULL THEN 'semantic' WHEN rid IS NOT NULL THEN 'rule' END
    AS mapping_method FROM fb"""),
    "map_custom": W(_concepts_sql() + """,
custom AS (SELECT p_name || 's' AS k, max(p_partkey) AS cid FROM part GROUP BY 1),
lk AS (SELECT upper(concept_name) AS k, max(concept_id) AS eid FROM concepts GROUP BY 1)""",
                    """SELECT p.procedure_occurrence_id, p.procedure_source_value AS source_value,
  coalesce(cu.cid, lk.eid) AS concept_id,
  CASE WHEN cu.cid IS NOT NULL THEN 'custom' WHEN lk.eid IS NOT NULL THEN 'exact_match' END AS mapping_method
FROM procedure_src p LEFT JOIN custom cu ON cu.k = p.procedure_source_value
  LEFT JOIN lk ON lk.k = upper(p.procedure_source_value)"""),
})


# --------------------------------------------------------------------------- config / profile / rejects / stream
def _reject_case() -> str:
    from .. import schemas as S
    lengths = S.MAX_LENGTHS["concept"]
    whens = []
    for f in S.CONCEPT.fields:
        if not f.nullable:
            whens.append(f"WHEN {f.name} IS NULL THEN '{f.name} is null'")
        if f.name in lengths:
            whens.append(f"WHEN length({f.name}) > {lengths[f.name]} THEN '{f.name} too long'")
    return "CASE " + " ".join(whens) + " END"


_PROFILE_COLS = [("reg_no", "person_id", "BIGINT"), ("born_at", "birth_datetime", "TIMESTAMP"),
                 ("sex_txt", "gender", "VARCHAR"), ("race_txt", "race", "VARCHAR")]

SQL.update({
    "bind_source": W("", "SELECT * FROM person_src"),
    "apply_config": W("", f"""SELECT *, {gender_sql('gender')} AS gender_concept_id, {race_sql('race')} AS race_concept_id,
  {ethnicity_sql('ethnicity')} AS ethnicity_concept_id FROM person_src"""),
    "validate_source": W("", " UNION ALL ".join(
        [f"SELECT '{n}' AS column_name, TRUE AS present, count(*) AS n_rows, count({c}) AS n_non_null, "
         f"count(TRY_CAST({c} AS {t})) AS n_castable FROM person_src" for n, c, t in _PROFILE_COLS]
        + ["SELECT 'ethn_txt' AS column_name, FALSE AS present, count(*) AS n_rows, "
           "CAST(NULL AS BIGINT) AS n_non_null, CAST(NULL AS BIGINT) AS n_castable FROM person_src"])),
    "split_rejects": W(_concepts_sql(), f"SELECT concept_id, concept_name, {_reject_case()} AS reject_reason "
                                        f"FROM concepts_typed"),
    "stream_visit": W(VISITS, "SELECT * FROM visits"),
})


def _routes_sql() -> str:
    from ..operators.mapping import MAPPABILITY
    rows = [f"({_q(cat)}, {_q(v)})" for cat, _d, vocabs in MAPPABILITY for v in vocabs]
    return "routes(category, vocabulary_id) AS (VALUES " + ", ".join(rows) + ")"


_DEALT = (f"dealt AS (SELECT list_extract([{', '.join(_q(v) for v in C.ROUTE_VOCABULARIES)}], "
          f"concept_id % {len(C.ROUTE_VOCABULARIES)} + 1) AS vocabulary_id FROM concepts)")
SQL["mappability"] = W(_concepts_sql() + ",\n" + _DEALT + ",\n" + _routes_sql(), """SELECT r.category, r.vocabulary_id,
  CAST(coalesce(c.n, 0) AS BIGINT) AS n_concepts FROM routes r
LEFT JOIN (SELECT vocabulary_id, count(*) AS n FROM dealt GROUP BY 1) c ON c.vocabulary_id = r.vocabulary_id""")


_VM = VISITS.replace("visits AS (", "visits_rules AS (", 1) + ",\n" + _concepts_sql() + "," + _cands() + f""",
vm_vals AS (SELECT visit_source_value AS v FROM visit_src UNION SELECT admitted_from FROM visit_src
            UNION SELECT discharged_to FROM visit_src),
vm_texts0 AS (SELECT v, {duck_preprocess('v')} AS ptext FROM vm_vals WHERE v IS NOT NULL),
vm_texts AS (SELECT DISTINCT ptext FROM vm_texts0 WHERE ptext <> '')""" + "," + text_nn("vm_texts", "cands", "vm") + f""",
vm_map AS (SELECT t.v, CASE WHEN b.score >= {C.SEM_THRESHOLD} THEN b.ck END AS cid
           FROM vm_texts0 t LEFT JOIN vm_best b ON b.sk = t.ptext)"""

SQL["load_visit_mapped"] = W(_VM, """SELECT r.visit_occurrence_id, r.person_id,
  CAST(coalesce(a.cid, 0) AS BIGINT) AS visit_concept_id, r.visit_start_date, r.visit_start_datetime,
  r.visit_end_date, r.visit_end_datetime, r.visit_type_concept_id, r.provider_id, r.care_site_id,
  r.visit_source_value, r.visit_source_concept_id, CAST(coalesce(b.cid, 0) AS BIGINT) AS admitted_from_concept_id,
  r.admitted_from_source_value, CAST(coalesce(c.cid, 0) AS BIGINT) AS discharged_to_concept_id,
  r.discharged_to_source_value, r.preceding_visit_occurrence_id
FROM visits_rules r
LEFT JOIN vm_map a ON a.v = r.visit_source_value
LEFT JOIN vm_map b ON b.v = nullif(r.admitted_from_source_value, '')
LEFT JOIN vm_map c ON c.v = nullif(r.discharged_to_source_value, '')""")


# --------------------------------------------------------------------------- mapped condition / procedure loads
def _value_map(name: str, column: str, src: str, cands: str, threshold: float, dim: int = 512) -> str:
    """``{name}(v, cid)``: concept of each distinct value of ``column``, NULL under the threshold."""
    return f"""
{name}_t0 AS (SELECT v, {duck_preprocess('v')} AS ptext FROM (SELECT DISTINCT {column} AS v FROM {src})
  WHERE v IS NOT NULL),
{name}_tx AS (SELECT DISTINCT ptext FROM {name}_t0 WHERE ptext <> '')""" + "," + text_nn(
        f"{name}_tx", cands, f"{name}_n", dim) + f""",
{name} AS (SELECT t.v, CASE WHEN b.score >= {threshold} THEN b.ck END AS cid
  FROM {name}_t0 t LEFT JOIN {name}_n_best b ON b.sk = t.ptext)"""


def _status_cands() -> str:
    from .roles import STATUS_CONCEPTS
    rows = ", ".join(f"({i}, {_q(n)})" for i, n in STATUS_CONCEPTS)
    return (f"status_concepts(concept_id, concept_name) AS (VALUES {rows}),\n"
            f"status_cands AS (SELECT {duck_preprocess('concept_name')} AS ptext, min(concept_id) AS concept_id "
            "FROM status_concepts GROUP BY 1)")


_COND_MAPPED = (CONDITIONS + "," + _concepts_sql() + "," + _cands() + ",\n" + _status_cands() + ","
                + _value_map("cond_map", "condition_source_value", "condition_src", "cands", C.SEM_THRESHOLD) + ","
                + _value_map("status_map", "condition_status_source_value", "condition_src", "status_cands",
                             C.SEM_THRESHOLD, C.STATUS_DIM) + """,
cond_out AS (SELECT c.* REPLACE (CAST(coalesce(m.cid, 0) AS BIGINT) AS condition_concept_id,
    CAST(coalesce(s.cid, 0) AS INTEGER) AS condition_status_concept_id)
  FROM conditions c LEFT JOIN cond_map m ON m.v = c.condition_source_value
  LEFT JOIN status_map s ON s.v = c.condition_status_source_value)""")

_PROC_MAPPED = (PROCEDURES + "," + _concepts_sql() + "," + _cands() + ","
                + _value_map("proc_map", "procedure_source_value", "procedure_src", "cands", C.SEM_THRESHOLD) + """,
proc_out AS (SELECT p.* REPLACE (CAST(coalesce(m.cid, 0) AS BIGINT) AS procedure_concept_id)
  FROM procedures p LEFT JOIN proc_map m ON m.v = p.procedure_source_value)""")

# --------------------------------------------------------------------------- dirty sources, repeats, rejects
_DIRTY = PERSONS + """,
dirty0 AS (SELECT *, TRY_CAST(visit_occurrence_id AS BIGINT) AS id, TRY_CAST(visit_start_datetime AS TIMESTAMP) AS s,
    TRY_CAST(visit_end_datetime AS TIMESTAMP) AS e FROM dirty_visit_src),
dirty AS (SELECT *, CASE WHEN visit_occurrence_id IS NOT NULL AND id IS NULL THEN 'visit_occurrence_id bad value'
    WHEN visit_start_datetime IS NOT NULL AND s IS NULL THEN 'visit_start_datetime bad value'
    WHEN visit_end_datetime IS NOT NULL AND e IS NULL THEN 'visit_end_datetime bad value'
    WHEN id IS NULL THEN 'visit_occurrence_id is null' WHEN s IS NULL THEN 'visit_start_datetime is null'
    WHEN e IS NULL THEN 'visit_end_datetime is null' END AS reason FROM dirty0),
dirty_ok AS (SELECT * FROM dirty WHERE reason IS NULL AND person_id IN (SELECT person_id FROM persons))"""

_DIRTY_VISITS = _DIRTY + f""",
dv AS (SELECT * EXCLUDE (visit_occurrence_id, visit_start_datetime, visit_end_datetime, reason, rn),
    id AS visit_occurrence_id, s AS visit_start_datetime, e AS visit_end_datetime FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY s, e) AS rn FROM dirty_ok) WHERE rn = 1)"""

_TWICE = PERSONS.replace("FROM person_src", "FROM (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY "
                         "person_id ORDER BY birth_datetime) AS rn FROM twice_person_src WHERE birth_datetime IS NOT NULL) "
                         "WHERE rn = 1)")

SQL.update({
    "load_condition": W(_COND_MAPPED, "SELECT * FROM cond_out"),
    "incremental_condition": W(_COND_MAPPED, "SELECT * FROM cond_out WHERE condition_occurrence_id NOT IN "
                               "(SELECT condition_occurrence_id FROM conditions "
                               f"WHERE condition_start_date < DATE '{EXISTING_CONDITION_BEFORE}')"),
    "load_procedure": W(_PROC_MAPPED, "SELECT * FROM proc_out"),
    "incremental_procedure": W(_PROC_MAPPED, "SELECT * FROM proc_out WHERE procedure_occurrence_id NOT IN "
                               "(SELECT procedure_occurrence_id FROM procedures "
                               f"WHERE procedure_date < DATE '{EXISTING_VISIT_BEFORE}')"),
    "load_visit_rejects": W(_DIRTY, """SELECT visit_occurrence_id AS source_key, reason AS reject_reason,
  CAST(1 AS BIGINT) AS n_rows FROM dirty WHERE reason IS NOT NULL
UNION ALL SELECT visit_occurrence_id, 'unknown person', 1 FROM dirty WHERE reason IS NULL
  AND (person_id IS NULL OR person_id NOT IN (SELECT person_id FROM persons))
UNION ALL SELECT CAST(id AS VARCHAR), 'repeated key', count(*) - 1 FROM dirty_ok GROUP BY id HAVING count(*) > 1"""),
    "load_visit_dirty": W(_DIRTY_VISITS, f"""SELECT
  {_visit_cols('LAG(visit_occurrence_id) OVER (PARTITION BY person_id ORDER BY visit_occurrence_id)')} FROM dv"""),
    "load_person_duplicates": W(_TWICE, "SELECT * FROM persons"),
    "observation_period_chunked": SQL["observation_period"],
    "dense_id_clustered": """WITH o AS (SELECT CASE WHEN o_orderkey % 1000 = 7 THEN o_orderkey * 1000000
    ELSE o_orderkey // 100 * 100 END AS cluster, o_orderkey FROM orders)
SELECT cluster, o_orderkey, CAST(row_number() OVER (ORDER BY cluster, o_orderkey) AS BIGINT) AS row_id FROM o""",
    "vocabulary_files": SQL["load_concept"],
    "relationship_files": SQL["load_concept_relationship"],
    "concept_rejects": W(_concepts_sql(), f"""SELECT CAST(concept_id AS VARCHAR) AS source_key, {_reject_case()} AS reject_reason,
  CAST(1 AS BIGINT) AS n_rows FROM concepts_typed WHERE {_reject_case()} IS NOT NULL
UNION ALL SELECT CAST(concept_id AS VARCHAR), 'repeated key', count(*) - 1 FROM concepts_good GROUP BY concept_id
HAVING count(*) > 1"""),
    "map_levenshtein": W(_concepts_sql() + f""",
lev_names AS (SELECT upper(trim(concept_name)) AS name, max(concept_id) AS id, arg_max(concept_name, concept_id) AS label
  FROM concepts GROUP BY 1),
lev_values AS (SELECT DISTINCT upper(trim(procedure_source_value)) AS value FROM procedure_src
  WHERE procedure_source_value IS NOT NULL),
lev_scored AS (SELECT value, name, 1 - levenshtein(value, name) / greatest(length(value), length(name)) AS ratio
  FROM lev_values JOIN lev_names ON abs(length(value) - length(name)) <= 0.2 * greatest(length(value), length(name)) + 1e-9),
lev_best AS (SELECT value, name, ratio FROM (SELECT *, row_number() OVER (PARTITION BY value ORDER BY ratio DESC, name) AS rn
  FROM lev_scored WHERE ratio >= {C.EDIT_RATIO} - 1e-12) WHERE rn = 1)""",
                         """SELECT p.procedure_occurrence_id, p.procedure_source_value AS source_value, n.id AS concept_id,
  n.label AS matched_concept_name, round(b.ratio, 6) AS edit_ratio
FROM procedure_src p LEFT JOIN lev_best b ON b.value = upper(trim(p.procedure_source_value))
LEFT JOIN lev_names n ON n.name = b.name"""),
    "map_semantic_blocked": SQL["map_semantic"],
    "similar_concepts_blocked": SQL["similar_concepts"],
    "provider_list": W(CASCADE, "SELECT procedure_occurrence_id, source_code, concept_id, matched_concept_name, "
                                f"mapping_method FROM cascade_out WHERE upper(matched_domain) = '{C.LOOKUP_DOMAIN.upper()}'"),
    "confidence_total": W(MULTI, """SELECT CAST(count(*) AS BIGINT) AS n_records,
  count(DISTINCT (source_value, matched_concept_name)) AS n_pairs, round(avg(similarity_score), 4) AS avg_similarity
FROM multi_out WHERE concept_id IS NOT NULL AND similarity_score >= 0.7 AND similarity_score < 0.9"""),
    "confidence_samples": W(MULTI, """SELECT source_value, matched_concept_name, round(max(similarity_score), 4)
  AS similarity_score, count(*) AS n_records FROM multi_out
WHERE concept_id IS NOT NULL AND similarity_score >= 0.7 AND similarity_score < 0.9 GROUP BY ALL
ORDER BY similarity_score DESC, source_value LIMIT 10"""),
    "mapping_counts": W(MULTI, """SELECT count(*) FILTER (WHERE concept_id IS NOT NULL AND concept_id <> 0) AS mapped,
  count(*) FILTER (WHERE concept_id IS NULL OR concept_id = 0) AS unmapped, count(concept_id) AS non_null FROM multi_out"""),
    "mapping_sample": W(MULTI, """SELECT DISTINCT source_value, concept_id FROM multi_out
ORDER BY source_value ASC NULLS FIRST, concept_id ASC NULLS FIRST LIMIT 10"""),
    "load_stats": W(VISITS + ",\n" + VISIT_EXISTING, """SELECT 'visit_occurrence' AS table_name,
  (SELECT count(*) FROM vis_elig) AS eligible, (SELECT count(*) FROM ex) AS existing,
  (SELECT count(*) FROM vis_elig) - (SELECT count(*) FROM ex) AS inserted,
  (SELECT count(*) FROM visit_src) - (SELECT count(*) FROM vis_elig) AS rejected,
  CAST(100.0 AS DOUBLE) AS completion_pct"""),
})


# --------------------------------------------------------------------------- IDF-weighted vectors
def _idf_grams(table: str, key: str, name: str, corpus: str) -> str:
    """``_grams`` over many buckets, weights times ``{corpus}_idf(b, idf)`` of ``{corpus}_n(n)`` texts."""
    return f"""
{name}_g AS (SELECT k, (unicode(substr(s, i, 1)) * 1369 + unicode(substr(s, i + 1, 1)) * 37
      + unicode(substr(s, i + 2, 1))) % {SPARSE_DIM} AS b
  FROM (SELECT {key} AS k, ' ' || ptext || ' ' AS s, unnest(range(1, length(ptext) + 1)) AS i FROM {table} WHERE ptext <> '')),
{name}_v AS (SELECT g.k, g.b, count(*) * any_value(coalesce(d.idf, {_idf_sql('0', f'(SELECT n FROM {corpus}_n)')})) AS w
  FROM {name}_g g LEFT JOIN {corpus}_idf d ON d.b = g.b GROUP BY ALL),
{name}_n AS (SELECT k, sqrt(sum(w * w)) AS n FROM {name}_v GROUP BY k)"""


def _idf_sql(df: str, n: str) -> str:
    return f"CAST(round((ln((1.0 + {n}) / (1.0 + {df})) + 1) * {IDF_SCALE}) AS BIGINT)"


def _idf(table: str, corpus: str) -> str:
    return f"""
{corpus}_t AS (SELECT DISTINCT ptext FROM {table} WHERE ptext <> ''),
{corpus}_n AS (SELECT count(*) AS n FROM {corpus}_t),
{corpus}_idf AS (SELECT b, {_idf_sql('count(*)', f'(SELECT n FROM {corpus}_n)')} AS idf FROM (
  SELECT DISTINCT ptext, (unicode(substr(s, i, 1)) * 1369 + unicode(substr(s, i + 1, 1)) * 37
      + unicode(substr(s, i + 2, 1))) % {SPARSE_DIM} AS b
  FROM (SELECT ptext, ' ' || ptext || ' ' AS s, unnest(range(1, length(ptext) + 1)) AS i FROM {corpus}_t)) GROUP BY b)"""


SQL.update({
    "embed_text_idf": W(_concepts_sql() + f""",
names AS (SELECT DISTINCT concept_name, {duck_preprocess('concept_name')} AS ptext FROM concepts)""" + ","
                        + _idf("names", "en") + "," + _idf_grams("names", "concept_name", "en", "en").replace("en_n AS (SELECT k", "en_norm AS (SELECT k"),
                        "SELECT v.k AS concept_name, CAST(v.b AS INTEGER) AS bucket, round(v.w / n.n, 6) AS weight "
                        "FROM en_v v JOIN en_norm n ON n.k = v.k"),
    "map_multi_idf": W(_concepts_sql() + "," + _cands() + "," + PROC_PP + "," + _idf("cands", "cc") + ","
                       + _idf_grams("proc_texts", "ptext", "s", "cc") + "," + _idf_grams("cands", "concept_id", "c", "cc") + f""",
dots AS (SELECT s.k AS sk, c.k AS ck, sum(s.w * c.w) AS d FROM s_v s JOIN c_v c ON s.b = c.b GROUP BY ALL),
best AS (SELECT sk, ck, score FROM (SELECT *, row_number() OVER (PARTITION BY sk ORDER BY score DESC, ck) AS rn FROM (
  SELECT d.sk, d.ck, CAST(d.d AS DOUBLE) / (sn.n * cn.n) AS score FROM dots d JOIN s_n sn ON sn.k = d.sk JOIN c_n cn ON cn.k = d.ck))
  WHERE rn = 1),
m AS (SELECT p.procedure_occurrence_id, p.procedure_source_value, e.eid, b.ck, b.score,
    CASE WHEN e.eid IS NOT NULL THEN 'exact_match' WHEN b.score >= {C.SEM_THRESHOLD} THEN 'semantic_match'
         WHEN b.score >= {C.IDF_FLOOR} THEN 'partial_match' END AS matching_strategy
  FROM proc p LEFT JOIN best b ON b.sk = p.ptext LEFT JOIN exact_pp e ON e.k = p.ptext)""",
                       """SELECT m.procedure_occurrence_id, m.procedure_source_value AS source_value, c.concept_id,
  c.concept_name AS matched_concept_name, m.matching_strategy,
  round(CASE WHEN m.matching_strategy = 'exact_match' THEN 1.0 WHEN m.matching_strategy IS NOT NULL THEN m.score ELSE 0.0 END, 4)
    AS similarity_score
FROM m LEFT JOIN concepts c ON c.concept_id =
  CASE WHEN m.matching_strategy = 'exact_match' THEN m.eid WHEN m.matching_strategy IS NOT NULL THEN m.ck END"""),
    "map_semantic_sparse": "SELECT * FROM (" + SQL["map_source"] + ") WHERE concept_id IS NOT NULL",
})


# --------------------------------------------------------------------------- nearest by hashing
_LSH = _VEC + f""",
cut AS (SELECT t, b, list((('0x' || substr(md5('{SEED}:' || t || ':' || b || ':' || d), 1, 8))::BIGINT / 2147483648.0) - 1 ORDER BY d) AS p
  FROM (SELECT unnest(range({TABLES})) AS t), (SELECT unnest(range({BITS})) AS b), (SELECT unnest(range(64)) AS d) GROUP BY t, b),
side AS (SELECT e.vec_id, c.t, c.b, list_dot_product(e.v, c.p) AS m FROM e, cut c),
slot AS (SELECT vec_id, t, sum(CASE WHEN m > 0 THEN 1 << b ELSE 0 END)::BIGINT AS own,
    sum(CASE WHEN near <= {FLIPS} THEN 1 << b ELSE 0 END)::BIGINT AS free
  FROM (SELECT *, row_number() OVER (PARTITION BY vec_id, t ORDER BY abs(m), b) AS near FROM side) GROUP BY vec_id, t),
met AS (SELECT DISTINCT a.vec_id, b.vec_id AS nid FROM slot a JOIN slot b
  ON a.t = b.t AND (a.own & ({(1 << BITS) - 1} - a.free)) = (b.own & ({(1 << BITS) - 1} - a.free)) AND a.vec_id <> b.vec_id),
close AS (SELECT p.*, row_number() OVER (PARTITION BY p.vec_id ORDER BY p.s DESC, p.nid) AS rk
  FROM pairs p JOIN met m ON m.vec_id = p.vec_id AND m.nid = p.nid)"""

SQL.update({
    "map_semantic_lsh": W(_LSH, f"""SELECT vec_id,
  CASE WHEN s >= {C.VEC_THRESHOLD} THEN nid END AS concept_id, CASE WHEN s >= {C.VEC_THRESHOLD} THEN nlabel END AS matched_label,
  round(s, 4) AS similarity_score FROM close WHERE rk = 1"""),
    "lsh_recall": W(_LSH, f"""SELECT count(*) AS n_mapped, count(c.nid) AS n_found,
  CASE WHEN count(*) > 0 THEN round(count(c.nid) / count(*), 4) END AS recall
FROM ranked r LEFT JOIN close c ON c.vec_id = r.vec_id AND c.nid = r.nid AND c.rk = 1
WHERE r.rk = 1 AND r.s >= {C.VEC_THRESHOLD}"""),
})


# --------------------------------------------------------------------------- bounds of the edit ratio
_NEED = (C.FUZZY_CUTOFF - 0.5) / 100.0


def _shared(width: int) -> str:
    """Common tokens of a pair, by multiset: the smaller count of each."""
    cut = lambda t: f"(SELECT {t}, substr({t}, i, {width}) AS x, count(*) AS n FROM (SELECT {t}, unnest(range(1, length({t}) - {width} + 2)) AS i FROM {t}s) GROUP BY ALL)"
    return f"SELECT p.v, q.c, sum(least(p.n, q.n)) AS k FROM {cut('v')} p JOIN {cut('c')} q ON p.x = q.x GROUP BY p.v, q.c"


def _full_process(c: str) -> str:
    return f"trim(lower(regexp_replace({c}, '[^{_WORD}]', ' ', 'g')))"


SQL["fuzzy_candidates"] = W(_concepts_sql() + f""",
vs AS (SELECT DISTINCT {_full_process('procedure_source_value')} AS v FROM procedure_src WHERE procedure_source_value IS NOT NULL),
cs AS (SELECT DISTINCT {_full_process('concept_name')} AS c FROM concepts WHERE concept_name IS NOT NULL),
ones AS ({_shared(1)}), twos AS ({_shared(2)}),
need AS (SELECT v, c, length(v) + length(c) AS total, ceil((length(v) + length(c)) * {_NEED / 2} - 1e-9) AS m FROM vs, cs)""",
    """SELECT n.v AS clean_value, count(*) AS n_candidates FROM need n JOIN ones o ON o.v = n.v AND o.c = n.c
LEFT JOIN twos t ON t.v = n.v AND t.c = n.c
WHERE o.k >= n.m AND coalesce(t.k, 0) >= 3 * n.m - n.total - 1 AND least(length(n.v), length(n.c)) >= n.m GROUP BY n.v""")


# --------------------------------------------------------------------------- loads with rejects, clustered files
SQL.update({
    "stream_visit_state": SQL["load_visit"],
    "incremental_visit_bucketed": SQL["incremental_visit"],
    "load_ledger": SQL["load_visit_dirty"],
    "load_ledger_rejects": f"""SELECT source_key, reject_reason, CAST(sum(n_rows) AS BIGINT) AS n_rows
FROM ({SQL['load_visit_rejects']}) GROUP BY source_key, reject_reason""",
    "load_ledger_stats": f"""SELECT (SELECT count(*) FROM ({SQL['load_visit_dirty']})) + rejected AS input,
  (SELECT count(*) FROM ({SQL['load_visit_dirty']})) AS loaded, rejected, true AS complete
FROM (SELECT CAST(sum(n_rows) AS BIGINT) AS rejected FROM ({SQL['load_visit_rejects']}))""",
    "observation_period_clustered": SQL["observation_period"],
    "period_lookup_clustered": f"""SELECT * FROM ({SQL['observation_period']})
WHERE person_id BETWEEN {C.LOOKUP_PERSONS[0]} AND {C.LOOKUP_PERSONS[1]}""",
})


# --------------------------------------------------------------------------- a registered model: hashed words
WORD_CUTOFF = model("words").threshold


def _words(table: str, key: str, name: str) -> str:
    return f"""
{name}_w AS (SELECT k, pos, word FROM (SELECT {key} AS k, unnest(string_split(ptext, ' ')) AS word,
    unnest(range(1, len(string_split(ptext, ' ')) + 1)) AS pos FROM {table} WHERE ptext <> '') WHERE word <> ''),
{name}_c AS (SELECT k, pos, unicode(substr(word, i, 1)) * i AS x FROM (
  SELECT k, pos, word, unnest(range(1, length(word) + 1)) AS i FROM {name}_w)),
{name}_v AS (SELECT k, b, count(*) AS w FROM (SELECT k, pos, sum(x) % {WORD_DIM} AS b FROM {name}_c GROUP BY k, pos) GROUP BY k, b),
{name}_n AS (SELECT k, sqrt(sum(w * w)) AS n FROM {name}_v GROUP BY k)"""


SQL["map_model"] = W(_concepts_sql() + "," + _cands() + "," + PROC_PP + "," + _words("proc_texts", "ptext", "s") + ","
                     + _words("cands", "concept_id", "c") + f""",
dots AS (SELECT s.k AS sk, c.k AS ck, sum(s.w * c.w) AS d FROM s_v s JOIN c_v c ON s.b = c.b GROUP BY ALL),
top AS (SELECT sk, ck, score FROM (SELECT *, row_number() OVER (PARTITION BY sk ORDER BY score DESC, ck) AS rn FROM (
  SELECT d.sk, d.ck, CAST(d.d AS DOUBLE) / (sn.n * cn.n) AS score FROM dots d JOIN s_n sn ON sn.k = d.sk JOIN c_n cn ON cn.k = d.ck))
  WHERE rn = 1),
best AS (SELECT s.k AS sk, coalesce(t.ck, (SELECT min(k) FROM c_n)) AS ck, coalesce(t.score, 0.0) AS score
  FROM s_n s LEFT JOIN top t ON t.sk = s.k)""", f"""SELECT p.procedure_occurrence_id, p.procedure_source_value AS source_value,
  CASE WHEN b.score >= {WORD_CUTOFF} THEN b.ck END AS concept_id,
  CASE WHEN b.score >= {WORD_CUTOFF} THEN c.concept_name END AS matched_concept_name, round(b.score, 4) AS similarity_score
FROM proc p LEFT JOIN best b ON b.sk = p.ptext LEFT JOIN concepts c ON c.concept_id = b.ck""")
