"""Concept mapping strategies.

Every strategy maps the *distinct* source values once and joins the answer back to the
rows by value, so a value repeated in a third of all rows is looked up once (the
dedup is a partial aggregation before the shuffle) and the join back is against a
table of distinct values that AQE broadcasts when its run-time size is small.

Tie rules (deterministic, stated so the oracle can state them too):
  exact / code: among concepts with the same key, the highest concept_id;
  similarity:   highest score, then the lowest concept_id.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import preprocess_text
from ..session import persist_reliably
from .embed import DIM, model, trigram_bag
from .fuzzy import fuzzy_match
from .nearest import nearest

DEFAULT_THRESHOLD = 0.7


# ----------------------------------------------------------------- lookups
def name_lookup(concepts: DataFrame, key: Column, name_col="concept_name", id_col="concept_id") -> DataFrame:
    """One row per key: the highest concept_id with that key, and its name and domain."""
    x = concepts.select(key.alias("_key"), F.struct(F.col(id_col).alias("concept_id"),
                                                    F.col(name_col).alias("matched_concept_name"),
                                                    F.col("domain_id").alias("matched_domain")).alias("c"))
    return (x.where(F.col("_key").isNotNull())
             .groupBy("_key").agg(F.max_by("c", "c.concept_id").alias("c"))
             .select("_key", "c.concept_id", "c.matched_concept_name", "c.matched_domain"))


def exact_match(src: DataFrame, value_col: str, concepts: DataFrame, name_col="concept_name") -> DataFrame:
    """Upper-cased value equals upper-cased concept name."""
    lk = name_lookup(concepts, F.upper(F.col(name_col)), name_col)
    return (src.withColumn("_key", F.upper(F.col(value_col)))
               .join(lk, "_key", "left").drop("_key"))


def code_match(src: DataFrame, code_col: str, concepts: DataFrame, code_field="concept_code") -> DataFrame:
    """Source code equals concept_code; name and domain carried along."""
    lk = name_lookup(concepts, F.col(code_field))
    return src.withColumn("_key", F.col(code_col)).join(lk, "_key", "left").drop("_key")


def custom_match(src: DataFrame, value_col: str, rules: DataFrame, rule_value="source_value",
                 rule_id="concept_id") -> DataFrame:
    """M3: a user's lookup (source value -> concept id) applied as-is."""
    lk = (rules.groupBy(F.col(rule_value).alias("_key")).agg(F.max(rule_id).alias("custom_concept_id")))
    return src.withColumn("_key", F.col(value_col)).join(lk, "_key", "left").drop("_key")


def fuzzy(src: DataFrame, value_col: str, concepts: DataFrame, cutoff: int = 80, **kw) -> DataFrame:
    """I3 / C15."""
    return fuzzy_match(src, value_col, concepts, cutoff=cutoff, **kw)


# ----------------------------------------------------------------- similarity
def normalised_vocabulary(concepts: DataFrame, name_col="concept_name", id_col="concept_id") -> DataFrame:
    """One row per normalised name with its lowest and highest concept, written once to
    the shared checkpoint folder: every later branch (vectors, exact lookup, names)
    reads it instead of recomputing the vocabulary and its regex chain."""
    c = F.struct(F.col(id_col).alias("concept_id"), F.col(name_col).alias("concept_name"), "domain_id")
    per_name = (concepts.where(F.col(name_col).isNotNull()).groupBy(F.col(name_col).alias("_name"))
                        .agg(F.min_by(c, F.col(id_col)).alias("lo"), F.max_by(c, F.col(id_col)).alias("hi"))
                        .withColumn("ptext", preprocess_text(F.col("_name")))
                        .where(F.col("ptext") != ""))
    per_text = per_name.groupBy("ptext").agg(F.min_by("lo", "lo.concept_id").alias("lo"),
                                             F.max_by("hi", "hi.concept_id").alias("hi"))
    return persist_reliably(per_text)


def concept_candidates(concepts: DataFrame, name_col="concept_name", id_col="concept_id", provider=None,
                       vocab: DataFrame | None = None) -> DataFrame:
    """Concepts as vectors: one row per normalised name (its lowest concept_id)."""
    v = vocab if vocab is not None else normalised_vocabulary(concepts, name_col, id_col)
    per = v.select("ptext", "lo.concept_id", "lo.concept_name", "lo.domain_id")
    vec = provider(F.col("ptext")) if provider else trigram_bag(F.col("ptext"), preprocess=False)
    return per.withColumn("vec", vec)


def exact_candidates(concepts: DataFrame, name_col="concept_name", id_col="concept_id",
                     vocab: DataFrame | None = None) -> DataFrame:
    """Normalised name -> its highest concept_id (the exact stage's tie rule)."""
    v = vocab if vocab is not None else normalised_vocabulary(concepts, name_col, id_col)
    return v.select(F.col("ptext").alias("_key"), "hi.concept_id", F.col("hi.concept_name").alias("matched_concept_name"))


def distinct_texts(values: DataFrame, value_col: str) -> DataFrame:
    """(raw value, normalised text) for each distinct non-null raw value.  Normalising
    after the dedup (partial aggregation first, so a hot value costs one row per task)
    runs the regex chain once per value; the result is written once so the scoring
    and the join back both read it."""
    return persist_reliably(values.select(F.col(value_col).alias("_raw")).where(F.col("_raw").isNotNull())
                            .distinct().withColumn("ptext", preprocess_text(F.col("_raw"))))


def best_concepts(texts: DataFrame, cands: DataFrame, k: int = 1, provider=None,
                  strategy: str = "auto") -> DataFrame:
    """Distinct normalised texts (column ``ptext``) -> top-k (concept_id, score, rank)."""
    v = texts.select("ptext").where(F.col("ptext") != "").distinct()
    vec = provider(F.col("ptext")) if provider else trigram_bag(F.col("ptext"), preprocess=False)
    nn = nearest(v.withColumn("vec", vec), cands, "ptext", "concept_id", k=k, strategy=strategy,
                 bag_dim=getattr(provider, "bag_dim", None) if provider else DIM)
    return nn.join(cands.select("concept_id", "concept_name", "domain_id"), "concept_id")


def semantic_match(src: DataFrame, value_col: str, concepts: DataFrame, threshold: float = DEFAULT_THRESHOLD,
                   provider=None, name_col="concept_name", cands: DataFrame | None = None, matcher=None) -> DataFrame:
    """Best cosine per value; concept kept when score >= threshold.
    Adds concept_id, matched_concept_name, matched_domain, similarity_score (best score,
    also when under the threshold; NULL for a blank value).  ``matcher`` (``sparse_matcher``)
    takes the place of the dense join; values that it gives no row have no score."""
    cands = cands if cands is not None else concept_candidates(concepts, name_col, provider=provider)
    texts = distinct_texts(src, value_col)
    best = matcher(texts, cands) if matcher else best_concepts(texts, cands, 1, provider)
    hit = F.col("score") >= F.lit(threshold)
    table = texts.join(best, "ptext").select(
        F.col("_raw").alias(value_col),
        F.when(hit, F.col("concept_id")).alias("concept_id"),
        F.when(hit, F.col("concept_name")).alias("matched_concept_name"),
        F.when(hit, F.col("domain_id")).alias("matched_domain"),
        F.col("score").alias("similarity_score"))
    return src.join(table, value_col, "left")


def multi_strategy(src: DataFrame, value_col: str, concepts: DataFrame, threshold: float = DEFAULT_THRESHOLD,
                   partial_floor: float | None = None, provider=None, name_col="concept_name",
                   matcher=None) -> DataFrame:
    """Exact on normalised text (score 1.0) -> cosine >= threshold (semantic_match)
    -> cosine >= max(0.5, threshold - 0.2) (partial_match) -> unmatched (score 0.0).

    One nearest join serves stages 2 and 3, over the values that stage 1 leaves; ``matcher``
    takes its place (it must find what reaches the lower cut-off)."""
    floor = partial_floor if partial_floor is not None else max(0.5, threshold - 0.2)
    vocab = normalised_vocabulary(concepts, name_col)
    cands = concept_candidates(concepts, name_col, provider=provider, vocab=vocab)
    exact = exact_candidates(concepts, name_col, vocab=vocab)
    texts = distinct_texts(src, value_col)
    found = exact.select(F.col("_key").alias("ptext"), F.col("concept_id").alias("_eid"),
                         F.col("matched_concept_name").alias("_ename"))
    left = texts.join(found, "ptext", "left_anti")                                     # what stage 1 left
    best = matcher(left, cands) if matcher else best_concepts(left, cands, 1, provider)
    table = (texts.join(best.select("ptext", F.col("concept_id").alias("_sid"),
                                    F.col("concept_name").alias("_sname"), F.col("score").alias("_score")),
                        "ptext", "left").join(found, "ptext", "left"))
    strat = (F.when(F.col("_eid").isNotNull(), F.lit("exact_match"))
              .when(F.col("_score") >= threshold, F.lit("semantic_match"))
              .when(F.col("_score") >= floor, F.lit("partial_match")))
    table = table.select(
        F.col("_raw").alias(value_col),
        F.when(strat == "exact_match", F.col("_eid")).when(strat.isNotNull(), F.col("_sid")).alias("concept_id"),
        F.when(strat == "exact_match", F.col("_ename")).when(strat.isNotNull(), F.col("_sname"))
        .alias("matched_concept_name"),
        strat.alias("matching_strategy"),
        F.when(strat == "exact_match", F.lit(1.0)).when(strat.isNotNull(), F.col("_score")).otherwise(F.lit(0.0))
        .alias("similarity_score"))
    out = src.join(table, value_col, "left")
    return out.withColumn("similarity_score", F.coalesce("similarity_score", F.lit(0.0)))


def map_with_model(src: DataFrame, value_col: str, concepts: DataFrame, name: str, threshold: float | None = None,
                   strategy: str = "semantic") -> DataFrame:
    """M2: ``semantic_match`` or ``multi_strategy`` with a registered model, at the model's own
    cut-off where none is given."""
    m = model(name)
    fn = {"semantic": semantic_match, "multi_strategy": multi_strategy}[strategy]
    return fn(src, value_col, concepts, threshold=m.threshold if threshold is None else threshold, provider=m.provider)


def similar_concepts(queries: DataFrame, value_col: str, concepts: DataFrame, k: int = 10,
                     provider=None) -> DataFrame:
    """Top-k concepts per query text, with score, rank and the query echoed."""
    cands = concept_candidates(concepts, provider=provider)
    texts = distinct_texts(queries, value_col)
    best = best_concepts(texts, cands, k, provider)
    return texts.join(best, "ptext").select(F.col("_raw").alias("query_text"), "concept_id", "concept_name",
                                            F.col("score").alias("similarity_score"), "rank")


# ----------------------------------------------------------------- composition
STRATEGIES = ("exact_match", "code_match", "fuzzy_match", "semantic", "multi_strategy")


def map_source(src: DataFrame, value_col: str, concepts: DataFrame, strategy: str = "semantic", **kw) -> DataFrame:
    """One entry point; strategy name -> operator."""
    s = strategy.lower()
    if s == "exact_match":
        return exact_match(src, value_col, concepts)
    if s == "code_match":
        return code_match(src, value_col, concepts)
    if s == "fuzzy_match":
        return fuzzy(src, value_col, concepts, **kw)
    if s == "multi_strategy":
        return multi_strategy(src, value_col, concepts, **kw)
    if s in ("semantic", "basic"):
        return semantic_match(src, value_col, concepts, **kw)
    raise ValueError(f"unknown strategy {strategy!r}; one of {STRATEGIES}")


def fallback(src: DataFrame, value_col: str, steps: list[tuple[str, object]], concepts: DataFrame) -> DataFrame:
    """I7 re-aimed: declared order of strategies, first non-null concept wins.

    ``steps``: ("exact", None), ("code", code_col), ("semantic", threshold),
    ("fuzzy", cutoff), ("rule", Column -> Column).  The distinct keys (value, and code where a
    step uses one) are mapped in one small table; a step sees only the keys that earlier steps
    left.  Adds ``concept_id`` and ``mapping_method``."""
    keys = list(dict.fromkeys([value_col, *(str(a) for k, a in steps if k == "code")]))
    todo, done = persist_reliably(src.select(*keys).distinct()), []
    for kind, arg in steps:
        key = str(arg) if kind == "code" else value_col
        if kind == "rule":
            hit = todo.withColumn("concept_id", arg(F.col(value_col)).cast("long"))
        else:
            vals = todo.select(key).where(F.col(key).isNotNull()).distinct()
            if kind == "exact":
                m = exact_match(vals, key, concepts)
            elif kind == "code":
                m = code_match(vals, key, concepts)
            elif kind == "semantic":
                m = semantic_match(vals, key, concepts, threshold=float(arg))
            elif kind == "fuzzy":
                m = fuzzy(vals, key, concepts, cutoff=int(arg))
            else:
                raise ValueError(kind)
            hit = todo.join(m.select(key, F.col("concept_id").cast("long")), key, "left").select(*keys, "concept_id")
        hit = persist_reliably(hit)
        done.append(hit.where(F.col("concept_id").isNotNull()).withColumn("mapping_method", F.lit(kind)))
        todo = hit.where(F.col("concept_id").isNull()).select(*keys)
    table = reduce(DataFrame.unionByName, done).withColumnsRenamed({k: f"_k{i}" for i, k in enumerate(keys)})
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)])
    return src.join(table, same, "left").drop(*[f"_k{i}" for i in range(len(keys))])


def cascade(src: DataFrame, code_col: str, desc_col: str, concepts: DataFrame, threshold: float = 0.6,
            provider=None) -> DataFrame:
    """I8 + C14 + G1: code match, then semantic on the description of what is left.

    Labels DIRECT_CODE_MATCH / SEMANTIC_MATCH / UNMAPPED_FINAL.  The three parts are
    one frame with a label column (the union of disjoint parts of one input)."""
    codes = src.select(F.col(code_col).alias("_c")).distinct()
    lk = persist_reliably(code_match(codes, "_c", concepts).where(F.col("concept_id").isNotNull())
                          .select(F.col("_c"), F.col("concept_id").alias("_code_id"),
                                  F.col("matched_concept_name").alias("_code_name"),
                                  F.col("matched_domain").alias("_code_dom")))
    coded = src.withColumn("_c", F.col(code_col)).join(lk, "_c", "left").drop("_c")
    texts = distinct_texts(src.join(lk, F.col(code_col) == lk["_c"], "left_anti"), desc_col)
    cands = concept_candidates(concepts, provider=provider)
    best = best_concepts(texts, cands, 1, provider)
    hit = F.col("score") >= F.lit(threshold)
    sem = texts.join(best.where(hit), "ptext").select(
        F.col("_raw").alias("_p"), F.col("concept_id").alias("_sem_id"), F.col("concept_name").alias("_sem_name"),
        F.col("domain_id").alias("_sem_dom"), F.col("score").alias("_sem_score"))
    x = (coded.withColumn("_p", F.when(F.col("_code_id").isNull(), F.col(desc_col)))
              .join(sem, "_p", "left"))
    method = (F.when(F.col("_code_id").isNotNull(), F.lit("DIRECT_CODE_MATCH"))
               .when(F.col("_sem_id").isNotNull(), F.lit("SEMANTIC_MATCH"))
               .otherwise(F.lit("UNMAPPED_FINAL")))
    return x.select(
        *[c for c in src.columns],
        F.coalesce("_code_id", "_sem_id").alias("concept_id"),
        F.coalesce("_code_name", "_sem_name").alias("matched_concept_name"),
        F.coalesce("_code_dom", "_sem_dom").alias("matched_domain"),
        method.alias("mapping_method"),
        F.col("_sem_score").alias("similarity_score"))


def cross_domain(mapped: DataFrame, type_col: str = "source_type") -> DataFrame:
    """Semantic hits whose matched domain differs from the source type (case ignored)."""
    return mapped.where((F.col("mapping_method") == "SEMANTIC_MATCH")
                        & (F.lower(F.col(type_col)) != F.lower(F.col("matched_domain"))))


def review_list(mapped: DataFrame) -> DataFrame:
    """Rows left unmapped, for manual review."""
    return mapped.where(F.col("mapping_method").isin("UNMAPPED", "UNMAPPED_FINAL"))


def provider_list(mapped: DataFrame, domain: str = "Provider") -> DataFrame:
    """Rows mapped to concepts of the provider domain (specialties, not codes)."""
    return mapped.where(F.col("concept_id").isNotNull() & (F.upper("matched_domain") == domain.upper()))


def map_columns(df: DataFrame, columns: dict[str, str], concepts: DataFrame, strategy: str = "semantic",
                **kw) -> DataFrame:
    """Several columns mapped against one lookup: stack their distinct values, map
    once, join each column back.  ``columns``: source column -> output column."""
    vals = reduce(DataFrame.unionByName, [df.select(F.col(c).alias("_v")) for c in columns]).distinct()
    mapped = persist_reliably(map_source(vals, "_v", concepts, strategy, **kw).select("_v", "concept_id"))
    out = df
    for c, o in columns.items():
        out = out.join(mapped.select(F.col("_v").alias(c), F.col("concept_id").alias(o)), c, "left")
    return out


# Reference table of which domains and vocabularies map by code.
MAPPABILITY = [
    ("High ICD Mappability", ["Condition", "Observation"], ["ICD10CM", "ICD9CM", "ICD10PCS"]),
    ("Medium ICD Mappability", ["Procedure"], ["CPT4", "HCPCS", "ICD10PCS"]),
    ("Low/No ICD Mappability", ["Provider", "Specialty", "Device", "Drug"], ["ABMS", "NUCC", "RxNorm", "NDC"]),
]


def mappability(concepts: DataFrame) -> DataFrame:
    """Concepts counted per mapping route (by vocabulary), routes as a 3-row frame."""
    spark = concepts.sparkSession
    rows = [(cat, v) for cat, _doms, vocabs in MAPPABILITY for v in vocabs]
    routes = spark.createDataFrame(rows, "category string, vocabulary_id string")
    counts = concepts.groupBy("vocabulary_id").agg(F.count(F.lit(1)).alias("n_concepts"))
    return (routes.join(counts, "vocabulary_id", "left")
                  .select("category", "vocabulary_id", F.coalesce("n_concepts", F.lit(0)).alias("n_concepts")))
