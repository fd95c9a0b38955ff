"""Registered queries: each (spark, sf_dir) -> DataFrame over the driver's tables.

Table jobs chain the way a real load does: person_ids -> person -> visit ->
procedure; conditions and observation periods need persons.  Every step is lazy, so
a query's plan holds the whole chain and Catalyst prunes what the output does not use.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import rules
from ..operators import islands as isl
from ..operators.dense_id import dense_ids
from ..session import scratch_path
from . import jobs
from .roles import (EXISTING_CONDITION_BEFORE, EXISTING_VISIT_BEFORE, Tables)

OBS_GAP_DAYS = 365          # test tables span 1995-2001; 7300 days would give one period per person
OBS_FLOOR = "1996-06-30"    # B4 floor for the floor-mode query
RESUME_AFTER = 5000         # B11 restart key
CHUNK_HOT = 5               # forced-chunk query: persons with more encounters are cut
LIMIT_TOTAL = 100           # F1 sample size
BIRTH_YEAR = 1990           # A5 example


class Pipeline:
    """Memoised lazy frames for one (session, data folder)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.t = Tables(spark, sf_dir)
        self.spark = spark
        self._memo: dict[str, DataFrame] = {}

    def _m(self, key, fn):
        if key not in self._memo:
            self._memo[key] = fn()
        return self._memo[key]

    def person_ids(self):
        return self._m("person_ids", lambda: jobs.load_person_ids(self.t.person_ids_src()))

    def persons(self):
        return self._m("persons", lambda: jobs.load_person(self.t.person_src(), self.person_ids()))

    def visits(self):
        return self._m("visits", lambda: jobs.load_visit(self.t.visit_src(), self.persons()))

    def existing_visits(self):
        """Keys of the visit target as an earlier load left it: the eligible visits that
        started before the cut-off (the target holds exactly those ids)."""
        return self._m("existing_visits", lambda: jobs.eligible_visits(self.t.visit_src(), self.persons()).where(
            F.to_date("visit_start_datetime") < F.lit(EXISTING_VISIT_BEFORE).cast("date"))
            .select("person_id", "visit_occurrence_id"))

    def condition_src(self):
        """Conditions mapped by the semantic path, their status with its own provider."""
        from ..operators import mapping as M
        from ..operators.embed import trigram_bags
        def mapped():
            src = M.map_columns(self.t.condition_src(), {"condition_source_value": "_cond"}, _concepts(self.t),
                                threshold=SEM_THRESHOLD)
            return M.map_columns(src, {"condition_status_source_value": "_status"}, self.t.status_concepts(),
                                 threshold=SEM_THRESHOLD, provider=trigram_bags(STATUS_DIM))
        return self._m("condition_src", mapped)

    def procedure_src(self):
        from ..operators import mapping as M
        return self._m("procedure_src", lambda: M.map_columns(
            self.t.procedure_src().drop(*UNUSED_PROCEDURE), {"procedure_source_value": "_proc"}, _concepts(self.t), threshold=SEM_THRESHOLD))

    def conditions(self, existing=None):
        return jobs.load_condition(self.condition_src(), self.persons(), existing=existing,
                                   condition_concept=F.col("_cond"), status_concept=F.col("_status"))

    def procedures(self, existing=None):
        return jobs.load_procedure(self.procedure_src(), self.visits(), existing=existing,
                                   procedure_concept=F.col("_proc"))

    def encounters(self, date_floor=None):
        return jobs.eligible_encounters(self.t.encounter_src(), self.persons(), date_floor)


#: Columns of the procedure source that the load does not read.
UNUSED_PROCEDURE = ["procedure_source_code", "procedure_source_type"]
STATUS_DIM = 1024           # the status column's own model: character trigrams over more buckets


def P(spark, sf_dir) -> Pipeline:
    return Pipeline(spark, sf_dir)


# ------------------------------------------------------------------ table jobs
def q_load_person_ids(spark, sf_dir):
    return P(spark, sf_dir).person_ids()


def q_load_person(spark, sf_dir):
    return P(spark, sf_dir).persons()


def q_incremental_person(spark, sf_dir):
    """Persons that the target lacks; it holds those with a visit of the earlier load."""
    p = P(spark, sf_dir)
    loaded = p.existing_visits().select("person_id").distinct()
    return jobs.load_person(p.t.person_src(), p.person_ids(), existing=loaded)


def q_person_by_birth_year(spark, sf_dir):
    """A5: ad-hoc SQL over a registered view of the loaded persons."""
    P(spark, sf_dir).persons().createOrReplaceTempView("cdm_person")
    return spark.sql(f"SELECT person_id, year_of_birth, gender_concept_id FROM cdm_person "
                     f"WHERE year_of_birth = {BIRTH_YEAR}")


def q_load_visit(spark, sf_dir):
    return P(spark, sf_dir).visits()


def q_preceding_visit(spark, sf_dir):
    return P(spark, sf_dir).visits().select("visit_occurrence_id", "person_id", "preceding_visit_occurrence_id")


def q_preceding_visit_by_start(spark, sf_dir):
    """E5 in order of the start, ties by id."""
    p = P(spark, sf_dir)
    return jobs.load_visit(p.t.visit_src(), p.persons(), order_by="visit_start_datetime").select(
        "visit_occurrence_id", "person_id", "visit_start_datetime", "preceding_visit_occurrence_id")


def q_limit_visit(spark, sf_dir):
    """the first ``total`` visits by id (sample mode) - the limit is the feature."""
    p = P(spark, sf_dir)
    return jobs.load_visit(p.t.visit_src(), p.persons(), first=LIMIT_TOTAL)


def q_load_visit_rejects(spark, sf_dir):
    """A10: every row of a dirty visit source that the load leaves out, with the reason."""
    p = P(spark, sf_dir)
    return jobs.visit_rejects(p.t.dirty_visit_src(), p.persons())


def q_load_visit_dirty(spark, sf_dir):
    """The other side of ``load_visit_rejects``: what the load takes from that source."""
    p = P(spark, sf_dir)
    return jobs.load_visit(p.t.dirty_visit_src(), p.persons())


def _ledger(spark, sf_dir) -> tuple[str, dict]:
    """A dirty visit source loaded with its rejects, and the same load run again."""
    from .run import load_table
    p, path, stats = P(spark, sf_dir), scratch_path(spark, f"ledger/{uuid.uuid4().hex}"), []
    for _ in range(2):
        rows, lost = jobs.load_visit_split(p.t.dirty_visit_src(), p.persons())
        stats.append(load_table(spark, rows, f"visits_{uuid.uuid4().hex}", "visit_occurrence", path=path, rejects=lost, load="first"))
    return path, stats[0]


def q_load_ledger(spark, sf_dir):
    """A9 + A10: what one job with rejects, run twice, has loaded."""
    from ..sources.ledger import loaded_rows
    return loaded_rows(spark, _ledger(spark, sf_dir)[0], S.VISIT_OCCURRENCE).drop("load")


def q_load_ledger_rejects(spark, sf_dir):
    """A10: the rejects of that job, with their numbers of rows."""
    from ..sources.ledger import loaded_rejects
    return loaded_rejects(spark, _ledger(spark, sf_dir)[0]).drop("load")


def q_load_ledger_stats(spark, sf_dir):
    """A10: loaded and rejected rows against the input's."""
    stats = _ledger(spark, sf_dir)[1]
    n = Tables(spark, sf_dir).dirty_visit_src().count()
    return spark.createDataFrame([(n, stats["inserted"], stats["rejected"], n == stats["inserted"] + stats["rejected"])],
                                 "input bigint, loaded bigint, rejected bigint, complete boolean")


def q_load_person_duplicates(spark, sf_dir):
    """J2 on a source that registers persons twice: one row each, the earliest birth."""
    p = P(spark, sf_dir)
    return jobs.load_person(p.t.twice_person_src(), p.person_ids())


def q_load_visit_resume(spark, sf_dir):
    p = P(spark, sf_dir)
    return jobs.load_visit(p.t.visit_src(), p.persons(), start_after=RESUME_AFTER)


def q_load_condition(spark, sf_dir):
    return P(spark, sf_dir).conditions()


def q_load_procedure(spark, sf_dir):
    return P(spark, sf_dir).procedures()


# ------------------------------------------------------------------ rule maps
def _rule_query(src: DataFrame, key: str, col: str, fn, out: str) -> DataFrame:
    return src.select(key, F.col(col).alias("source_value"), fn(col).alias(out))


def q_map_gender(spark, sf_dir):
    return _rule_query(Tables(spark, sf_dir).person_src(), "person_id", "gender", rules.map_gender, "concept_id")


def q_map_race(spark, sf_dir):
    return _rule_query(Tables(spark, sf_dir).person_src(), "person_id", "race", rules.map_race, "concept_id")


def q_map_ethnicity(spark, sf_dir):
    return _rule_query(Tables(spark, sf_dir).person_src(), "person_id", "ethnicity", rules.map_ethnicity,
                       "concept_id")


def q_map_visit_type(spark, sf_dir):
    return _rule_query(Tables(spark, sf_dir).visit_src(), "visit_occurrence_id", "visit_source_value",
                       rules.map_visit_type, "concept_id")


def q_map_admit(spark, sf_dir):
    return _rule_query(Tables(spark, sf_dir).visit_src(), "visit_occurrence_id", "admitted_from",
                       rules.map_admit, "concept_id")


def q_map_discharge(spark, sf_dir):
    return _rule_query(Tables(spark, sf_dir).visit_src(), "visit_occurrence_id", "discharged_to",
                       rules.map_discharge, "concept_id")


# ------------------------------------------------------------------ observation periods
_ENC = ["person_id", "start_date", "end_date", "prev_end_date"]


def q_obs_lag(spark, sf_dir):
    return isl.with_prev_end(P(spark, sf_dir).encounters()).select(*_ENC)


def q_obs_flag(spark, sf_dir):
    x = isl.with_new_period_flag(isl.with_prev_end(P(spark, sf_dir).encounters()), gap_days=OBS_GAP_DAYS)
    return x.select(*_ENC, "new_period_flag")


def q_obs_group(spark, sf_dir):
    x = isl.with_new_period_flag(isl.with_prev_end(P(spark, sf_dir).encounters()), gap_days=OBS_GAP_DAYS)
    return isl.with_period_group(x).select(*_ENC, "new_period_flag", "period_group")


def q_observation_period(spark, sf_dir):
    p = P(spark, sf_dir)
    return jobs.observation_period(p.t.encounter_src(), p.persons(), gap_days=OBS_GAP_DAYS)


def q_observation_period_merged(spark, sf_dir):
    """J6 with overlaps: an encounter belongs to the period at hand as long as any earlier
    encounter of the person reaches it."""
    p = P(spark, sf_dir)
    return jobs.observation_period(p.t.encounter_src(), p.persons(), gap_days=OBS_GAP_DAYS, overlap_aware=True)


CLUSTER_ROWS = 300          # rows of a file, so that the test tables fill several
LOOKUP_PERSONS = (400, 460)  # a range of person ids


def _clustered(spark, sf_dir) -> str:
    from ..session import persist_reliably
    from ..sources.clustered import write_clustered
    periods = persist_reliably(q_observation_period(spark, sf_dir))
    path = scratch_path(spark, f"clustered/{uuid.uuid4().hex}")
    write_clustered(periods, path, ["person_id", "observation_period_start_date"], periods.count(), CLUSTER_ROWS)
    return path


def q_observation_period_clustered(spark, sf_dir):
    """the periods written in files by range of (person, start) and read back."""
    from ..sources.clustered import read_clustered
    return read_clustered(spark, _clustered(spark, sf_dir), "person_id")


def q_period_lookup_clustered(spark, sf_dir):
    """the periods of a range of persons, from the files that may hold them."""
    from ..sources.clustered import read_clustered
    return read_clustered(spark, _clustered(spark, sf_dir), "person_id", *LOOKUP_PERSONS)


def q_observation_period_floor(spark, sf_dir):
    p = P(spark, sf_dir)
    return jobs.observation_period(p.t.encounter_src(), p.persons(), gap_days=OBS_GAP_DAYS, date_floor=OBS_FLOOR)


def q_observation_period_chunked(spark, sf_dir):
    """E4 + J6 with every person of over ``CHUNK_HOT`` encounters cut into chunks."""
    p = P(spark, sf_dir)
    return jobs.observation_period(p.t.encounter_src(), p.persons(), gap_days=OBS_GAP_DAYS, hot_rows=CHUNK_HOT)


def q_dense_id_clustered(spark, sf_dir):
    """E6 on clustered keys with one far out: ids follow the order, ranges stay even."""
    key = F.expr("CASE WHEN o_orderkey % 1000 = 7 THEN o_orderkey * 1000000 ELSE o_orderkey DIV 100 * 100 END")
    o = Tables(spark, sf_dir).table("orders").select(key.alias("cluster"), "o_orderkey")
    return dense_ids(o, ["cluster", "o_orderkey"], id_col="row_id", range_rows=500)


def q_observation_period_id(spark, sf_dir):
    """E6 alone: dense ids over (person, start) of the encounters."""
    enc = P(spark, sf_dir).encounters().dropDuplicates(["person_id", "start_date"])
    return dense_ids(enc.select("person_id", "start_date"), ["person_id", "start_date"], id_col="row_id")


# ------------------------------------------------------------------ incremental
def q_incremental_visit(spark, sf_dir):
    p = P(spark, sf_dir)
    return jobs.load_visit(p.t.visit_src(), p.persons(), existing=p.existing_visits())


def q_incremental_visit_bucketed(spark, sf_dir):
    """The incremental load against a target in buckets by id and by person, which stays
    where it lies; the new rows are written before the tables go."""
    from ..sources.bucketed import bucketed_keys
    p, path = P(spark, sf_dir), scratch_path(spark, f"bucketed/{uuid.uuid4().hex}")
    old = p.existing_visits()
    with bucketed_keys(old, ["visit_occurrence_id", "person_id"], old.count()) as by:
        jobs.load_visit(p.t.visit_src(), p.persons(), existing=by["visit_occurrence_id"], seed=by["person_id"]).write.parquet(path)
    return spark.read.schema(S.VISIT_OCCURRENCE).parquet(path)


def q_incremental_condition(spark, sf_dir):
    p = P(spark, sf_dir)
    loaded = jobs.load_condition(p.t.condition_src(), p.persons())
    existing = loaded.where(F.col("condition_start_date") < F.lit(EXISTING_CONDITION_BEFORE).cast("date"))
    return p.conditions(existing)


def q_incremental_procedure(spark, sf_dir):
    p = P(spark, sf_dir)
    # of the loaded rows only key and date are looked at: the earliest date of a key needs no text
    src = p.t.procedure_src().withColumn("procedure_source_value", F.lit(None).cast("string"))
    loaded = jobs.load_procedure(src.drop(*UNUSED_PROCEDURE), p.visits())
    return p.procedures(loaded.where(F.col("procedure_date") < F.lit(EXISTING_VISIT_BEFORE).cast("date")))


# ------------------------------------------------------------------ reports / DQ
def q_load_report(spark, sf_dir):
    from ..operators.quality import load_report
    p = P(spark, sf_dir)
    eligible = jobs.eligible_visits(p.t.visit_src(), p.persons())
    return load_report(eligible, p.existing_visits(), "visit_occurrence_id")


def q_dq_date_order(spark, sf_dir):
    from ..operators.quality import date_order
    return date_order(P(spark, sf_dir).visits(), "visit_occurrence_id", "visit_start_datetime",
                      "visit_end_datetime")


def q_dq_orphans(spark, sf_dir):
    from ..operators.quality import orphans
    p = P(spark, sf_dir)
    return orphans({"visit": p.t.visit_src(), "condition": p.t.condition_src(),
                    "observation": p.t.encounter_src()}, p.persons())


def q_dq_nulls(spark, sf_dir):
    from ..operators.quality import null_counts
    src = Tables(spark, sf_dir).visit_src()
    return null_counts(src, ["visit_occurrence_id", "person_id", "visit_start_datetime",
                             "visit_end_datetime", "care_site_id", "admitted_from", "discharged_to"])


def q_dq_duplicates(spark, sf_dir):
    from ..operators.quality import duplicates
    li = Tables(spark, sf_dir).table("lineitem")
    return duplicates(li, ["l_orderkey", "l_linenumber"])


def q_dq_date_range(spark, sf_dir):
    from ..operators.quality import date_range
    raw = Tables(spark, sf_dir).concept_raw()
    return date_range(raw, "concept_id", "valid_start_date", floor=S.DATE_FLOOR)


# ------------------------------------------------------------------ vocabulary
EXISTING_CONCEPT_BEFORE = "1975-01-01"
LOOKUP_DOMAIN = "economy"        # mixed case on purpose: the filter ignores case
EXISTING_RELATIONSHIP = "Returned with"


def _concepts(t: Tables, domain="ALL"):
    return jobs.load_concept(t.concept_raw(), domain)


def q_load_concept(spark, sf_dir):
    return _concepts(Tables(spark, sf_dir))


def q_concept_lookup(spark, sf_dir):
    return _concepts(Tables(spark, sf_dir), LOOKUP_DOMAIN)


def q_incremental_concept(spark, sf_dir):
    t = Tables(spark, sf_dir)
    existing = _concepts(t).where(F.col("valid_start_date") < F.lit(EXISTING_CONCEPT_BEFORE).cast("date"))
    return jobs.load_concept(t.concept_raw(), "ALL", existing=existing)


def q_vocabulary_files(spark, sf_dir):
    """A1 + A12: the vocabulary written as a tab-separated file in another column order, read
    back by header, loaded, written partitioned by domain, and read from there."""
    from ..sources.vocabulary import read_by_domain, read_concept, write_by_domain
    raw = Tables(spark, sf_dir).concept_raw()
    base = scratch_path(spark, f"vocabulary/{uuid.uuid4().hex}")
    (raw.select(*reversed(raw.columns)).write.option("sep", "\t").option("header", "true").option("quote", "")
     .option("nullValue", "").option("emptyValue", "").csv(f"{base}/concept.tsv"))
    write_by_domain(jobs.load_concept(read_concept(spark, f"{base}/concept.tsv"), "ALL"), f"{base}/concept")
    return read_by_domain(spark, f"{base}/concept")


def q_relationship_files(spark, sf_dir):
    """A2: the relationships through a file, taken by header, and loaded."""
    from ..sources.vocabulary import read_concept_relationship
    t = Tables(spark, sf_dir)
    raw = t.relationship_raw()
    path = scratch_path(spark, f"vocabulary/{uuid.uuid4().hex}.tsv")
    (raw.select(*reversed(raw.columns)).write.option("sep", "\t").option("header", "true").option("quote", "")
     .option("nullValue", "").option("emptyValue", "").csv(path))
    return jobs.load_concept_relationship(read_concept_relationship(spark, path), _concepts(t))


def q_concept_rejects(spark, sf_dir):
    """A10: the vocabulary rows that the concept load leaves out."""
    return jobs.concept_rejects(Tables(spark, sf_dir).concept_raw())


def q_validate_vocabulary(spark, sf_dir):
    from ..operators.quality import validate_vocabulary
    return validate_vocabulary(Tables(spark, sf_dir).concept_raw(), S.CONCEPT, ["concept_id"])


def q_load_concept_relationship(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return jobs.load_concept_relationship(t.relationship_raw(), _concepts(t))


def q_relationship_domain(spark, sf_dir):
    from ..sources.vocabulary import domain_filter, typed
    t = Tables(spark, sf_dir)
    file_level = domain_filter(typed(t.concept_raw(), S.CONCEPT), LOOKUP_DOMAIN)
    return jobs.load_concept_relationship(t.relationship_raw(), _concepts(t, LOOKUP_DOMAIN),
                                          domain=LOOKUP_DOMAIN, domain_concepts=file_level)


def q_relationship_existing(spark, sf_dir):
    t = Tables(spark, sf_dir)
    loaded = _concepts(t).where(F.col("valid_start_date") < F.lit(EXISTING_CONCEPT_BEFORE).cast("date"))
    rel = jobs.load_concept_relationship(t.relationship_raw(), loaded)
    return jobs.relationship_with_names(rel, loaded).select(
        *jobs.REL_KEY, "concept_name_1", "concept_name_2")


def q_incremental_relationship(spark, sf_dir):
    t = Tables(spark, sf_dir)
    concepts = _concepts(t)
    existing = jobs.load_concept_relationship(t.relationship_raw(), concepts).where(
        F.col("relationship_id") == EXISTING_RELATIONSHIP)
    return jobs.load_concept_relationship(t.relationship_raw(), concepts, existing=existing)


# ------------------------------------------------------------------ concept mapping
SEM_THRESHOLD = 0.7        # text similarity cut-off (multi-strategy and basic)
IDF_FLOOR = 0.4            # lower cut-off where rare trigrams weigh more
CASCADE_THRESHOLD = 0.6    # second stage of the code cascade
VEC_THRESHOLD = 0.4        # nearest other vector in the embeddings table
TOP_K = 5
FUZZY_CUTOFF = 80
EDIT_RATIO = 0.8


def _proc_rows(t: Tables) -> DataFrame:
    return t.procedure_src().select("procedure_occurrence_id", "procedure_source_value",
                                    "procedure_source_code", "procedure_source_type")


def _vectors(t: Tables) -> DataFrame:
    return t.table("embeddings").select("vec_id", "label", F.transform("embedding", lambda x: x.cast("double"))
                                        .alias("vec"))


def q_map_exact(spark, sf_dir):
    from ..operators import mapping as M
    t = Tables(spark, sf_dir)
    m = M.exact_match(_proc_rows(t), "procedure_source_value", _concepts(t))
    return m.select("procedure_occurrence_id", F.col("procedure_source_value").alias("source_value"), "concept_id")


def q_map_code(spark, sf_dir):
    from ..operators import mapping as M
    t = Tables(spark, sf_dir)
    m = M.code_match(_proc_rows(t), "procedure_source_code", _concepts(t))
    return m.select("procedure_occurrence_id", F.col("procedure_source_code").alias("source_code"), "concept_id",
                    "matched_concept_name", "matched_domain")


def q_map_fuzzy(spark, sf_dir, strategy="auto"):
    from ..operators import mapping as M
    t = Tables(spark, sf_dir)
    m = M.fuzzy(_proc_rows(t), "procedure_source_value", _concepts(t), cutoff=FUZZY_CUTOFF, strategy=strategy)
    return m.select("procedure_occurrence_id", F.col("procedure_source_value").alias("source_value"),
                    "concept_id", "matched_concept_name", "fuzzy_score")


def q_map_fuzzy_bucketed(spark, sf_dir):
    """C15 beyond the broadcast bound: pairs found by length and shared characters."""
    return q_map_fuzzy(spark, sf_dir, "bucketed")


def q_fuzzy_candidates(spark, sf_dir):
    """Per cleaned source value, how many names pass the bounds and are scored."""
    from ..functions.text import full_process
    from ..operators.ratio_join import ratio_pairs
    t = Tables(spark, sf_dir)
    values = _proc_rows(t).select(full_process(F.col("procedure_source_value")).alias("v")).where(F.col("procedure_source_value").isNotNull())
    names = _concepts(t).where(F.col("concept_name").isNotNull()).select(full_process(F.col("concept_name")).alias("c"))
    pairs = ratio_pairs(values, "v", names, "c", (FUZZY_CUTOFF - 0.5) / 100.0)
    return pairs.groupBy(F.col("a").alias("clean_value")).agg(F.count(F.lit(1)).alias("n_candidates"))


def q_map_levenshtein(spark, sf_dir):
    """C15 by edit distance: exact best name at a ratio of 0.8, segments joined, no pairs listed."""
    from ..operators.fuzzy import levenshtein_match
    t = Tables(spark, sf_dir)
    m = levenshtein_match(_proc_rows(t), "procedure_source_value", _concepts(t), threshold=EDIT_RATIO)
    return m.select("procedure_occurrence_id", F.col("procedure_source_value").alias("source_value"),
                    "concept_id", "matched_concept_name", "edit_ratio")


def _nn_named(v: DataFrame, k: int, **kw) -> DataFrame:
    from ..operators.nearest import nearest
    src = v.select(F.col("vec_id").alias("source_id"), "vec")
    cand = v.select(F.col("vec_id").alias("neighbour_id"), "vec")
    return nearest(src, cand, "source_id", "neighbour_id", k=k, exclude_self=True, **kw)


def q_map_semantic(spark, sf_dir, **kw):
    """I4 / C16 on the given vectors: each vector's nearest other vector, kept at or
    above the threshold; unmapped otherwise (best score still reported)."""
    t = Tables(spark, sf_dir)
    v = _vectors(t)
    nn = _nn_named(v, 1, **kw)
    labels = v.select(F.col("vec_id").alias("neighbour_id"), F.col("label").alias("matched_label"))
    hit = F.col("score") >= VEC_THRESHOLD
    return (nn.join(labels, "neighbour_id")
              .select(F.col("source_id").alias("vec_id"), F.when(hit, F.col("neighbour_id")).alias("concept_id"),
                      F.when(hit, F.col("matched_label")).alias("matched_label"),
                      F.round("score", 4).alias("similarity_score")))


def q_map_semantic_lsh(spark, sf_dir):
    """I4 / C16 approximate: ``map_semantic`` with partners found by hashing, scored exactly."""
    from ..operators.lsh import nearest_lsh
    v = _vectors(Tables(spark, sf_dir))
    nn = nearest_lsh(v.select(F.col("vec_id").alias("source_id"), "vec"), v.select(F.col("vec_id").alias("neighbour_id"), "vec"),
                     "source_id", "neighbour_id", exclude_self=True)
    labels = v.select(F.col("vec_id").alias("neighbour_id"), F.col("label").alias("matched_label"))
    hit = F.col("score") >= VEC_THRESHOLD
    return nn.join(labels, "neighbour_id").select(
        F.col("source_id").alias("vec_id"), F.when(hit, F.col("neighbour_id")).alias("concept_id"),
        F.when(hit, F.col("matched_label")).alias("matched_label"), F.round("score", 4).alias("similarity_score"))


def q_lsh_recall(spark, sf_dir):
    """How many vectors that the exact join maps have the same partner by hashing."""
    exact, found = (q(spark, sf_dir).where(F.col("concept_id").isNotNull()).select("vec_id", "concept_id")
                    for q in (q_map_semantic, q_map_semantic_lsh))
    both = exact.join(found.withColumn("same", F.lit(1)), ["vec_id", "concept_id"], "left")
    return both.agg(F.count(F.lit(1)).alias("n_mapped"), F.count("same").alias("n_found")).withColumn(
        "recall", F.when(F.col("n_mapped") > 0, F.round(F.col("n_found") / F.col("n_mapped"), 4)))


#: The plan for candidates beyond the broadcast bound, with blocks that the test tables fill.
BLOCKED = {"strategy": "blocked", "block_rows": 150, "src_block_rows": 400}


def q_map_semantic_blocked(spark, sf_dir):
    return q_map_semantic(spark, sf_dir, **BLOCKED)


def q_similar_concepts_blocked(spark, sf_dir):
    return q_similar_concepts(spark, sf_dir, **BLOCKED)


def q_similar_concepts(spark, sf_dir, **kw):
    """Top-k most similar other vectors per vector, ranked."""
    nn = _nn_named(_vectors(Tables(spark, sf_dir)), TOP_K, **kw)
    return nn.select(F.col("source_id").alias("vec_id"), F.col("neighbour_id").alias("concept_id"),
                     F.round("score", 4).alias("similarity_score"), "rank")


def q_cosine(spark, sf_dir):
    """H15 / M4 native: cosine of each vector with the next vector id."""
    from ..functions.similarity import cosine
    e = Tables(spark, sf_dir).table("embeddings").select("vec_id", "embedding")
    nxt = e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("vec_id").alias("next_id"),
                   F.col("embedding").alias("next_embedding"))
    return e.join(nxt, "vec_id").select("vec_id", "next_id",
                                        F.round(cosine("embedding", "next_embedding"), 6).alias("cosine"))


def q_preprocess_text(spark, sf_dir):
    """H12 over whole documents (bulk form: one regex pass per document)."""
    from ..functions.text import preprocess_text_bulk
    d = Tables(spark, sf_dir).table("documents")
    return d.select("doc_id", preprocess_text_bulk(F.col("text")).alias("clean_text"))


def q_embed_text(spark, sf_dir):
    """Sparse default embedding (bucket, weight) of every distinct concept name."""
    from ..operators.embed import trigram_weights
    names = _concepts(Tables(spark, sf_dir)).select("concept_name").distinct()
    w = trigram_weights(names, "concept_name", "concept_name")
    return w.select("concept_name", "bucket", F.round("weight", 6).alias("weight"))


def _multi(t: Tables) -> DataFrame:
    from ..operators import mapping as M
    return M.multi_strategy(_proc_rows(t), "procedure_source_value", _concepts(t), threshold=SEM_THRESHOLD)


def q_map_multi(spark, sf_dir):
    m = _multi(Tables(spark, sf_dir))
    return m.select("procedure_occurrence_id", F.col("procedure_source_value").alias("source_value"),
                    "concept_id", "matched_concept_name", "matching_strategy",
                    F.round("similarity_score", 4).alias("similarity_score"))


def q_embed_text_idf(spark, sf_dir):
    """The sparse embedding of every distinct concept name, weighted by inverse document
    frequency over the names' normalised texts."""
    from ..functions.text import preprocess_text
    from ..operators.sparse import fit_idf, sparse_vectors, unit_weights
    names = _concepts(Tables(spark, sf_dir)).select("concept_name").distinct().withColumn(
        "ptext", preprocess_text(F.col("concept_name")))
    idf = fit_idf(names.select("ptext").distinct(), "ptext")
    w = unit_weights(sparse_vectors(names, "concept_name", "ptext", idf=idf))
    return w.select(F.col("key").alias("concept_name"), F.col("feature").alias("bucket"),
                    F.round("weight", 6).alias("weight"))


def q_map_multi_idf(spark, sf_dir):
    """I5 on IDF-weighted vectors: the exact threshold join in place of the dense one."""
    from ..operators import mapping as M
    from ..operators.sparse import sparse_matcher
    t = Tables(spark, sf_dir)
    m = M.multi_strategy(_proc_rows(t), "procedure_source_value", _concepts(t), threshold=SEM_THRESHOLD,
                         partial_floor=IDF_FLOOR, matcher=sparse_matcher(IDF_FLOOR, idf=True))
    return m.select("procedure_occurrence_id", F.col("procedure_source_value").alias("source_value"),
                    "concept_id", "matched_concept_name", "matching_strategy",
                    F.round("similarity_score", 4).alias("similarity_score"))


def q_map_semantic_sparse(spark, sf_dir):
    """I4 / C16 by prefix filtering, on the default embedding: the mapped rows of ``map_source``."""
    from ..operators import mapping as M
    from ..operators.embed import DIM
    from ..operators.sparse import sparse_matcher
    t = Tables(spark, sf_dir)
    m = M.map_source(_proc_rows(t), "procedure_source_value", _concepts(t), "semantic", threshold=SEM_THRESHOLD,
                     matcher=sparse_matcher(SEM_THRESHOLD, dim=DIM))
    return m.where(F.col("concept_id").isNotNull()).select(
        "procedure_occurrence_id", F.col("procedure_source_value").alias("source_value"), "concept_id",
        "matched_concept_name", F.round("similarity_score", 4).alias("similarity_score"))


def q_map_model(spark, sf_dir):
    """M2: the mapping by the registered model ``words`` at its own cut-off."""
    from ..operators import mapping as M
    t = Tables(spark, sf_dir)
    m = M.map_with_model(_proc_rows(t), "procedure_source_value", _concepts(t), "words")
    return m.select("procedure_occurrence_id", F.col("procedure_source_value").alias("source_value"),
                    "concept_id", "matched_concept_name", F.round("similarity_score", 4).alias("similarity_score"))


def q_map_source(spark, sf_dir):
    from ..operators import mapping as M
    t = Tables(spark, sf_dir)
    m = M.map_source(_proc_rows(t), "procedure_source_value", _concepts(t), "semantic", threshold=SEM_THRESHOLD)
    return m.select("procedure_occurrence_id", F.col("procedure_source_value").alias("source_value"),
                    "concept_id", "matched_concept_name", F.round("similarity_score", 4).alias("similarity_score"))


def _cascade(t: Tables) -> DataFrame:
    from ..operators import mapping as M
    return M.cascade(_proc_rows(t), "procedure_source_code", "procedure_source_value", _concepts(t),
                     threshold=CASCADE_THRESHOLD)


def q_map_cascade(spark, sf_dir):
    c = _cascade(Tables(spark, sf_dir))
    return c.select("procedure_occurrence_id", F.col("procedure_source_code").alias("source_code"),
                    F.col("procedure_source_value").alias("source_value"),
                    F.col("procedure_source_type").alias("source_type"), "concept_id", "matched_concept_name",
                    "matched_domain", "mapping_method", F.round("similarity_score", 4).alias("similarity_score"))


def q_cross_domain(spark, sf_dir):
    from ..operators import mapping as M
    c = M.cross_domain(_cascade(Tables(spark, sf_dir)), "procedure_source_type")
    return c.select("procedure_occurrence_id", F.col("procedure_source_type").alias("source_type"),
                    "matched_domain", "matched_concept_name")


def q_review_list(spark, sf_dir):
    from ..operators import mapping as M
    c = M.review_list(_cascade(Tables(spark, sf_dir)))
    return c.select("procedure_occurrence_id", F.col("procedure_source_code").alias("source_code"),
                    F.col("procedure_source_value").alias("source_value"),
                    F.col("procedure_source_type").alias("source_type"))


def q_provider_list(spark, sf_dir):
    """Rows mapped into one domain (the provider list, on a domain these tables have)."""
    from ..operators import mapping as M
    c = M.provider_list(_cascade(Tables(spark, sf_dir)), LOOKUP_DOMAIN)
    return c.select("procedure_occurrence_id", F.col("procedure_source_code").alias("source_code"), "concept_id",
                    "matched_concept_name", "mapping_method")


def q_mapped_by_domain(spark, sf_dir):
    from ..operators.reports import mapped_by_domain
    return mapped_by_domain(_cascade(Tables(spark, sf_dir)))


def q_mapping_report(spark, sf_dir):
    from ..operators.reports import mapping_report
    return mapping_report(_multi(Tables(spark, sf_dir)))


def q_strategy_breakdown(spark, sf_dir):
    from ..operators.reports import strategy_breakdown
    return strategy_breakdown(_multi(Tables(spark, sf_dir)))


def q_confidence_band(spark, sf_dir):
    from ..operators.reports import confidence_band
    return confidence_band(_multi(Tables(spark, sf_dir)), "procedure_source_value")


def q_confidence_total(spark, sf_dir):
    from ..operators.reports import confidence_total
    return confidence_total(_multi(Tables(spark, sf_dir)), "procedure_source_value")


def q_confidence_samples(spark, sf_dir):
    """the ten best entries of the band - the limit is the feature."""
    from ..operators.reports import confidence_samples
    return confidence_samples(_multi(Tables(spark, sf_dir)), "procedure_source_value")


def q_mapping_counts(spark, sf_dir):
    from ..operators.reports import mapping_counts
    return mapping_counts(_multi(Tables(spark, sf_dir)))


def q_mapping_sample(spark, sf_dir):
    """Ten distinct (source value, concept) pairs - the limit is the feature."""
    from ..operators.reports import mapping_sample
    return mapping_sample(_multi(Tables(spark, sf_dir)), "procedure_source_value")


def q_load_stats(spark, sf_dir):
    """The visit target loaded in two appends; eligible, existing, inserted, rejected rows
    and the share done, as the one-row frame of a load history (without the clock)."""
    from ..operators.reports import load_stats
    from ..sources.sinks import drop_if_exists
    from .run import load_table
    p = P(spark, sf_dir)
    name = f"visit_load_{uuid.uuid4().hex}"
    path = scratch_path(spark, name)
    old = p.existing_visits()
    first = load_table(spark, jobs.load_visit(p.t.visit_src().join(old, "visit_occurrence_id", "left_semi"), p.persons()),
                       name, "visit_occurrence", path=path)
    new = jobs.load_visit(p.t.visit_src(), p.persons(), existing=spark.read.schema(S.VISIT_OCCURRENCE).parquet(path))
    second = load_table(spark, new, name, "visit_occurrence")
    lost = jobs.visit_rejects(p.t.visit_src(), p.persons()).agg(F.coalesce(F.sum("n_rows"), F.lit(0))).first()[0]
    eligible = jobs.eligible_visits(p.t.visit_src(), p.persons()).count()
    drop_if_exists(spark, name)     # the history holds counts only
    return load_stats(spark, "visit_occurrence", eligible, first["inserted"], second["inserted"], lost,
                      first["elapsed_s"] + second["elapsed_s"]).drop("elapsed_s")


def q_top_unmapped(spark, sf_dir):
    from ..operators.reports import top_unmapped
    return top_unmapped(_multi(Tables(spark, sf_dir)), "procedure_source_value")


def q_mapping_summary(spark, sf_dir):
    from ..operators.reports import concept_distribution
    return concept_distribution(_multi(Tables(spark, sf_dir)))


def q_map_fallback(spark, sf_dir):
    """Visit source values: exact name, then text similarity, then the visit-type rules."""
    from ..operators import mapping as M
    t = Tables(spark, sf_dir)
    v = t.visit_src().select("visit_occurrence_id", "visit_source_value")
    m = M.fallback(v, "visit_source_value", [("exact", None), ("semantic", SEM_THRESHOLD),
                                              ("rule", rules.map_visit_type)], _concepts(t))
    return m.select("visit_occurrence_id", "visit_source_value", "concept_id", "mapping_method")


def q_map_custom(spark, sf_dir):
    """M3: a custom lookup (plural part names -> their part) ahead of the exact match."""
    from ..operators import mapping as M
    t = Tables(spark, sf_dir)
    rules_df = t.table("part").select(F.concat("p_name", F.lit("s")).alias("source_value"),
                                      F.col("p_partkey").alias("concept_id"))
    x = M.custom_match(_proc_rows(t), "procedure_source_value", rules_df)
    x = M.exact_match(x, "procedure_source_value", _concepts(t))
    method = (F.when(F.col("custom_concept_id").isNotNull(), F.lit("custom"))
               .when(F.col("concept_id").isNotNull(), F.lit("exact_match")))
    return x.select("procedure_occurrence_id", F.col("procedure_source_value").alias("source_value"),
                    F.coalesce("custom_concept_id", "concept_id").alias("concept_id"), method.alias("mapping_method"))


ROUTE_VOCABULARIES = ["ICD10CM", "CPT4", "NUCC", "Other", "ICD10PCS", "RxNorm", "NDC"]
VISIT_MAP_COLUMNS = {"visit_source_value": "_visit_cid", "admitted_from": "_admit_cid",
                     "discharged_to": "_discharge_cid"}


def q_load_visit_mapped(spark, sf_dir):
    """J3 with I14: the three visit text columns are stacked, their distinct values mapped
    once by text similarity against the vocabulary, joined back; misses become 0."""
    from ..operators import mapping as M
    p = P(spark, sf_dir)
    src = M.map_columns(p.t.visit_src(), VISIT_MAP_COLUMNS, _concepts(p.t), strategy="semantic",
                        threshold=SEM_THRESHOLD)
    cm = {"visit": F.col("_visit_cid"), "admitted": F.col("_admit_cid"), "discharged": F.col("_discharge_cid")}
    return jobs.load_visit(src, p.persons(), concept_ids=cm)


def q_mappability(spark, sf_dir):
    """Concepts per mapping route (fixed 3-route reference table x concept counts), on
    concepts dealt to the routes' vocabularies and one other."""
    from ..operators import mapping as M
    names = F.array(*[F.lit(v) for v in ROUTE_VOCABULARIES])
    dealt = F.element_at(names, (F.col("concept_id") % len(ROUTE_VOCABULARIES) + 1).cast("int"))
    return M.mappability(_concepts(Tables(spark, sf_dir)).withColumn("vocabulary_id", dealt))


# ------------------------------------------------------------------ config, profiles, rejects, stream
CONTRACT_TYPES = {"int": "BIGINT", "string": "STRING", "datetime": "TIMESTAMP"}


def _raw_person(t: Tables, drop: str | None = None) -> DataFrame:
    from ..config import PERSON_CONFIG, table_config
    names = table_config(PERSON_CONFIG, "person")["source_columns"]
    cols = [F.col(k).alias(v) for k, v in names.items() if v != drop]
    return t.person_src().select(*cols)


def q_bind_source(spark, sf_dir):
    from ..config import PERSON_CONFIG, bind_source
    return bind_source(_raw_person(Tables(spark, sf_dir)), PERSON_CONFIG, "person")


def q_apply_config(spark, sf_dir):
    from ..config import PERSON_CONFIG, apply_config
    return apply_config(_raw_person(Tables(spark, sf_dir)), PERSON_CONFIG, "person")


def q_validate_source(spark, sf_dir):
    """Profile of a person source that lacks one optional column."""
    from ..config import PERSON_CONFIG, optional_columns, required_columns, table_config
    from ..operators.quality import profile_source
    cm = table_config(PERSON_CONFIG, "person")["column_mappings"]
    contract = {c: CONTRACT_TYPES[cm[c]["data type"]]
                for c in required_columns(PERSON_CONFIG, "person") + optional_columns(PERSON_CONFIG, "person")}
    return profile_source(_raw_person(Tables(spark, sf_dir), drop="ethn_txt"), contract)


def q_split_rejects(spark, sf_dir):
    """A10: every vocabulary row with the first contract violation (NULL = good)."""
    from ..sources.sinks import split_rejects
    from ..sources.vocabulary import typed
    raw = Tables(spark, sf_dir).concept_raw()
    tagged = split_rejects(typed(raw, S.CONCEPT), S.CONCEPT, S.MAX_LENGTHS["concept"])
    return tagged.select("concept_id", "concept_name", "reject_reason")


def q_stream_visit(spark, sf_dir):
    """L1: the visit load as a file-source stream with foreachBatch appends."""
    from ..streaming.incremental_stream import stream_visit_query
    from .roles import SPARK, visit_source
    return stream_visit_query(spark, sf_dir, visit_source(SPARK), P(spark, sf_dir).persons())


def q_stream_visit_state(spark, sf_dir):
    """L1: the stream that keeps seen ids and last visits in its state, with repeats and a restart."""
    from ..streaming.stateful_visits import stream_visit_state_query
    from .roles import SPARK, visit_source
    return stream_visit_state_query(spark, sf_dir, visit_source(SPARK), P(spark, sf_dir).persons())


QUERIES = {
    "load_person_ids": q_load_person_ids,
    "load_person": q_load_person,
    "incremental_person": q_incremental_person,
    "preceding_visit_by_start": q_preceding_visit_by_start,
    "observation_period_merged": q_observation_period_merged,
    "person_by_birth_year": q_person_by_birth_year,
    "load_visit": q_load_visit,
    "preceding_visit": q_preceding_visit,
    "limit_visit": q_limit_visit,
    "load_visit_rejects": q_load_visit_rejects,
    "load_visit_dirty": q_load_visit_dirty,
    "load_ledger": q_load_ledger,
    "load_ledger_rejects": q_load_ledger_rejects,
    "load_ledger_stats": q_load_ledger_stats,
    "load_person_duplicates": q_load_person_duplicates,
    "load_visit_resume": q_load_visit_resume,
    "load_condition": q_load_condition,
    "load_procedure": q_load_procedure,
    "map_gender": q_map_gender,
    "map_race": q_map_race,
    "map_ethnicity": q_map_ethnicity,
    "map_visit_type": q_map_visit_type,
    "map_admit": q_map_admit,
    "map_discharge": q_map_discharge,
    "obs_lag": q_obs_lag,
    "obs_flag": q_obs_flag,
    "obs_group": q_obs_group,
    "observation_period": q_observation_period,
    "observation_period_clustered": q_observation_period_clustered,
    "period_lookup_clustered": q_period_lookup_clustered,
    "observation_period_floor": q_observation_period_floor,
    "observation_period_id": q_observation_period_id,
    "observation_period_chunked": q_observation_period_chunked,
    "dense_id_clustered": q_dense_id_clustered,
    "incremental_visit": q_incremental_visit,
    "incremental_visit_bucketed": q_incremental_visit_bucketed,
    "incremental_condition": q_incremental_condition,
    "incremental_procedure": q_incremental_procedure,
    "load_report": q_load_report,
    "dq_date_order": q_dq_date_order,
    "dq_orphans": q_dq_orphans,
    "dq_nulls": q_dq_nulls,
    "dq_duplicates": q_dq_duplicates,
    "dq_date_range": q_dq_date_range,
    "load_concept": q_load_concept,
    "concept_lookup": q_concept_lookup,
    "incremental_concept": q_incremental_concept,
    "vocabulary_files": q_vocabulary_files,
    "relationship_files": q_relationship_files,
    "concept_rejects": q_concept_rejects,
    "validate_vocabulary": q_validate_vocabulary,
    "load_concept_relationship": q_load_concept_relationship,
    "relationship_domain": q_relationship_domain,
    "relationship_existing": q_relationship_existing,
    "incremental_relationship": q_incremental_relationship,
    "map_exact": q_map_exact,
    "map_code": q_map_code,
    "map_fuzzy": q_map_fuzzy,
    "map_fuzzy_bucketed": q_map_fuzzy_bucketed,
    "fuzzy_candidates": q_fuzzy_candidates,
    "map_levenshtein": q_map_levenshtein,
    "map_semantic": q_map_semantic,
    "map_semantic_blocked": q_map_semantic_blocked,
    "map_semantic_lsh": q_map_semantic_lsh,
    "lsh_recall": q_lsh_recall,
    "similar_concepts_blocked": q_similar_concepts_blocked,
    "similar_concepts": q_similar_concepts,
    "cosine": q_cosine,
    "preprocess_text": q_preprocess_text,
    "embed_text": q_embed_text,
    "map_multi": q_map_multi,
    "embed_text_idf": q_embed_text_idf,
    "map_multi_idf": q_map_multi_idf,
    "map_semantic_sparse": q_map_semantic_sparse,
    "map_model": q_map_model,
    "map_source": q_map_source,
    "map_cascade": q_map_cascade,
    "cross_domain": q_cross_domain,
    "review_list": q_review_list,
    "provider_list": q_provider_list,
    "mapped_by_domain": q_mapped_by_domain,
    "mapping_report": q_mapping_report,
    "strategy_breakdown": q_strategy_breakdown,
    "confidence_band": q_confidence_band,
    "confidence_total": q_confidence_total,
    "confidence_samples": q_confidence_samples,
    "mapping_counts": q_mapping_counts,
    "mapping_sample": q_mapping_sample,
    "load_stats": q_load_stats,
    "top_unmapped": q_top_unmapped,
    "mapping_summary": q_mapping_summary,
    "map_fallback": q_map_fallback,
    "map_custom": q_map_custom,
    "mappability": q_mappability,
    "load_visit_mapped": q_load_visit_mapped,
    "bind_source": q_bind_source,
    "apply_config": q_apply_config,
    "validate_source": q_validate_source,
    "split_rejects": q_split_rejects,
    "stream_visit": q_stream_visit,
    "stream_visit_state": q_stream_visit_state,
}
