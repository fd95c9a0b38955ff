"""Exact threshold join of sparse weighted vectors by an inverted index with prefix filtering
(C16, I4), and trigram vectors weighted by inverse document frequency (I11).

A vector is rows (key, feature, w) with whole-number weights, so that dot products and squared
norms are exact and a score, ``dot / (|a| |b|)``, is the same double in any engine.

Features are ordered by how many candidates hold them, rarest first.  A vector's prefix are its
features up to where the norm of the rest falls under ``threshold`` times the whole.  Two vectors
whose cosine reaches the threshold share a feature that lies in both prefixes: all features that
they share beyond the shorter prefix add up to less than the threshold (Cauchy-Schwarz).  So only
prefixes are joined; what a pair has gathered there plus the greater of the two rests bounds its
score, and only pairs whose bound reaches the threshold are compared in full.  Common features,
which most vectors hold, fall behind the prefixes and never meet.  Everything is native; pairs
under the bound are never formed.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import persist_reliably
from .embed import trigram_buckets

#: Buckets of the sparse embedding: nearly one per trigram of letters, digits and blanks.
SPARSE_DIM = 1 << 18
#: Inverse document frequencies are whole multiples of 1 / IDF_SCALE.
IDF_SCALE = 64
_EPS = 1e-9


@dataclass
class Idf:
    """Weights of a fitted corpus: rows (feature, idf), ``dim`` at most, and that of any other."""

    weights: DataFrame
    unseen: int
    dim: int


def idf_of(df: Column, texts: int) -> Column:
    """``1 + ln((1 + texts) / (1 + df))`` as a whole multiple of 1 / IDF_SCALE."""
    return F.round((F.log((F.lit(1.0) + texts) / (F.lit(1.0) + df)) + 1) * IDF_SCALE).cast("long")


def fit_idf(texts: DataFrame, text_col: str, dim: int = SPARSE_DIM) -> Idf:
    """Weights from the texts of ``texts`` (one row each, empty ones left out): one count per
    feature, added up in each task before the shuffle."""
    t = texts.select(F.col(text_col).alias("t")).where(F.length("t") > 0)
    n = t.count()
    df = t.select(F.explode(F.array_distinct(trigram_buckets(F.col("t"), dim))).alias("feature")).groupBy("feature").agg(
        F.count(F.lit(1)).alias("df"))
    unseen = t.sparkSession.range(1).select(idf_of(F.lit(0), n)).first()[0]
    return Idf(persist_reliably(df.select("feature", idf_of(F.col("df"), n).alias("idf"))), int(unseen), dim)


def sparse_vectors(texts: DataFrame, key: str, text_col: str, dim: int = SPARSE_DIM, idf: Idf | None = None) -> DataFrame:
    """Rows (key, feature, w): trigram counts of each text, times the feature's weight where
    ``idf`` is given. Empty and null texts have no rows."""
    dim = idf.dim if idf else dim
    grams = texts.select(F.col(key).alias("key"), F.explode(trigram_buckets(F.col(text_col), dim)).alias("feature"))
    counts = grams.groupBy("key", "feature").agg(F.count(F.lit(1)).alias("w"))
    if idf is None:
        return counts
    return (counts.join(idf.weights, "feature", "left")
            .select("key", "feature", (F.col("w") * F.coalesce("idf", F.lit(idf.unseen))).alias("w")))


def unit_weights(vectors: DataFrame) -> DataFrame:
    """(key, feature, weight) of length 1."""
    norm = vectors.groupBy("key").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("n"))
    return vectors.join(norm, "key").select("key", "feature", (F.col("w") / F.col("n")).alias("weight"))


def _indexed(vectors: DataFrame, held_by: DataFrame, threshold: float) -> DataFrame:
    """(key, v, n2, behind): features rarest first, squared norm, and for each feature of the
    prefix the norm of all features behind it as a share of the whole."""
    entry = F.struct(F.coalesce("df", F.lit(0)).alias("df"), "feature", "w")
    rows = vectors.join(held_by, "feature", "left").groupBy("key").agg(
        F.sort_array(F.collect_list(entry)).alias("v"), F.sum(F.col("w") * F.col("w")).alias("n2"))
    enough = F.col("n2") * (threshold * threshold * (1 - _EPS))
    start = F.struct(F.col("n2").alias("left"), F.array().cast("array<double>").alias("behind"))

    def step(acc, x):
        left = acc["left"] - x["w"] * x["w"]
        return F.when(acc["left"] >= enough, F.struct(left.alias("left"), F.concat(
            acc["behind"], F.array(F.sqrt(left / F.col("n2")))).alias("behind"))).otherwise(acc)
    return rows.select("key", "v", "n2", F.aggregate("v", start, step)["behind"].alias("behind"))


def candidate_pairs(a: DataFrame, b: DataFrame, threshold: float) -> DataFrame:
    """(a, b) pairs whose bound reaches ``threshold``; ``a`` and ``b`` are indexed vectors.

    What a pair shares outside both prefixes lies behind the shorter prefix, and behind the last
    feature that it was seen to share."""
    def prefix(x, side):
        entries = F.arrays_zip(F.slice("v", 1, F.size("behind")).alias("e"), F.col("behind").alias("behind"))
        return x.select(F.col("key").alias(side), F.col("n2").alias(f"n2_{side}"), F.element_at("behind", -1).alias(f"rest_{side}"),
                        F.explode(entries).alias("x")).select(
            side, f"n2_{side}", f"rest_{side}", F.col("x.e.feature").alias("feature"), F.col("x.e.w").alias(f"w_{side}"),
            F.col("x.behind").alias(f"behind_{side}"))
    met = prefix(a, "a").join(prefix(b, "b"), "feature").groupBy("a", "b").agg(
        F.sum(F.col("w_a") * F.col("w_b")).alias("dot"), F.min("n2_a").alias("n2_a"), F.min("n2_b").alias("n2_b"),
        F.least(F.greatest(F.min("rest_a"), F.min("rest_b")), F.min("behind_a") * F.min("behind_b")).alias("rest"))
    bound = F.col("dot") / (F.sqrt("n2_a") * F.sqrt("n2_b")) + F.col("rest")
    return met.where(bound >= threshold - _EPS).select("a", "b")


def threshold_join(a: DataFrame, b: DataFrame, threshold: float) -> DataFrame:
    """All pairs (a, b, score) of rows (key, feature, w) whose cosine is at least ``threshold``
    (over 0).  Keys may be of any type; weights are whole numbers over 0; vectors without rows match nothing."""
    if not 0 < threshold <= 1:
        raise ValueError("the threshold must lie in (0, 1]")
    held_by = b.groupBy("feature").agg(F.count(F.lit(1)).alias("df"))
    va, vb = (persist_reliably(_indexed(x, held_by, threshold)) for x in (a, b))
    pairs = candidate_pairs(va, vb, threshold)
    own = va.select(F.col("key").alias("a"), F.col("v").alias("va"), F.col("n2").alias("n2_a"))
    other = vb.select(F.col("key").alias("b"), F.map_from_arrays("v.feature", "v.w").alias("vb"), F.col("n2").alias("n2_b"))
    dot = F.aggregate("va", F.lit(0).cast("long"), lambda acc, x: acc + x["w"] * F.coalesce(
        F.try_element_at("vb", x["feature"]), F.lit(0).cast("long")))
    score = dot.cast("double") / (F.sqrt("n2_a") * F.sqrt("n2_b"))
    return pairs.join(own, "a").join(other, "b").select("a", "b", score.alias("score")).where(F.col("score") >= threshold)


def best_above(a: DataFrame, b: DataFrame, threshold: float) -> DataFrame:
    """The best (a, b, score) at or above ``threshold`` per ``a``; ties: the lower ``b``."""
    best = F.min_by(F.struct("b", "score"), F.struct(-F.col("score"), F.col("b")))
    return threshold_join(a, b, threshold).groupBy("a").agg(best.alias("x")).select("a", "x.b", "x.score")


Matcher = Callable[[DataFrame, DataFrame], DataFrame]


def sparse_matcher(threshold: float, dim: int = SPARSE_DIM, idf: bool = False) -> Matcher:
    """What the mapping strategies take in place of the dense join: (texts, candidates), both
    with ``ptext``, to (ptext, concept_id, concept_name, domain_id, score) of the best candidate
    at or above ``threshold``; other texts have no row.  With ``idf`` the weights are fitted on
    the candidates' texts."""
    def match(texts: DataFrame, cands: DataFrame) -> DataFrame:
        weights = fit_idf(cands, "ptext", dim) if idf else None
        values = texts.select("ptext").where(F.col("ptext") != "").distinct()
        best = best_above(sparse_vectors(values, "ptext", "ptext", dim, weights),
                          sparse_vectors(cands, "concept_id", "ptext", dim, weights), threshold)
        return (best.withColumnsRenamed({"a": "ptext", "b": "concept_id"})
                .join(cands.select("concept_id", "concept_name", "domain_id"), "concept_id"))
    return match
