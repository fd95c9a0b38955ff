"""Prefix-filtered threshold join: equal to all pairs and to the dense join, few pairs formed; IDF weights."""
import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from cdmspark.operators import mapping as M
from cdmspark.operators import sparse as S
from cdmspark.operators.embed import DIM, trigram_bag
from cdmspark.operators.nearest import nearest


def vectors(spark, rows):
    return spark.createDataFrame([(k, f, w) for k, v in rows.items() for f, w in v.items()], "key long, feature int, w long")


def brute(a, b, t):
    out = {}
    for i, x in a.items():
        for j, y in b.items():
            dot = sum(w * y.get(f, 0) for f, w in x.items())
            s = dot / (math.sqrt(sum(w * w for w in x.values())) * math.sqrt(sum(w * w for w in y.values())))
            if s >= t:
                out[i, j] = s
    return out


@pytest.mark.parametrize("t", [0.05, 0.3, 0.5, 0.7, 0.95, 1.0])
def test_equals_all_pairs(spark, t):
    rng = random.Random(int(t * 100))
    def some(n):
        return {i: {f: rng.randint(1, 9) for f in {int(rng.paretovariate(.6)) % 80 for _ in range(rng.randint(1, 14))}} for i in range(n)}
    a, b = some(90), some(70)
    a.update({1000 + i: dict(b[i]) for i in range(10)})                 # exact copies
    a.update({2000 + i: {900 + i: 3} for i in range(3)})                # features that no candidate holds
    got = {(r.a, r.b): r.score for r in S.threshold_join(vectors(spark, a), vectors(spark, b), t).collect()}
    want = brute(a, b, t)
    assert got == want and len(want) >= 10
    best = {r.a: (r.b, r.score) for r in S.best_above(vectors(spark, a), vectors(spark, b), t).collect()}
    top = defaultdict(list)
    for (i, j), s in want.items():
        top[i].append((-s, j))
    assert best == {i: (min(v)[1], -min(v)[0]) for i, v in top.items()}


def names(n, seed):
    words = ["".join(random.Random(i).choices("abcdefghijklmnopqrstuvwxyz", k=random.Random(i).randint(5, 11))) for i in range(400)]
    rng = random.Random(seed)
    return sorted({" ".join([*rng.sample(words, 3), "of the left side"]) for _ in range(n)})


def test_forms_few_of_all_pairs_and_equals_the_dense_join(spark):
    cand, rng = names(600, 1), random.Random(2)
    src = [n[:k] + n[k + 1:] for n in cand for k in [rng.randrange(len(n))]] + names(200, 3)
    texts = spark.createDataFrame([(s,) for s in sorted(set(src))], "ptext string")
    cands = spark.createDataFrame(list(enumerate(cand)), "concept_id long, ptext string")
    a = S.sparse_vectors(texts, "ptext", "ptext", DIM)
    b = S.sparse_vectors(cands, "concept_id", "ptext", DIM)
    got = {r.a: (r.b, r.score) for r in S.best_above(a, b, 0.8).collect()}
    dense = nearest(texts.withColumn("vec", trigram_bag("ptext", preprocess=False)),
                    cands.withColumn("vec", trigram_bag("ptext", preprocess=False)), "ptext", "concept_id", bag_dim=DIM)
    assert got == {r.ptext: (r.concept_id, r.score) for r in dense.collect() if r.score >= 0.8} and len(got) > 200
    # with rare trigrams weighing more, few pairs are ever formed
    idf = S.fit_idf(cands, "ptext")
    a, b = (S.sparse_vectors(x, k, "ptext", idf=idf) for x, k in ((texts, "ptext"), (cands, "concept_id")))
    held = b.groupBy("feature").agg(F.count(F.lit(1)).alias("df"))
    formed = S.candidate_pairs(S._indexed(a, held, 0.8), S._indexed(b, held, 0.8), 0.8).count()
    assert formed < 0.02 * texts.count() * len(cand)
    assert S.threshold_join(a, b, 0.8).count() <= formed


def test_hot_feature_stays_behind_the_prefixes(spark):
    """A feature that every vector holds is in no prefix as long as it is not most of the vector."""
    rows = {i: {0: 1, 1 + i: 3, 5000 + i: 3} for i in range(300)}
    v = vectors(spark, rows)
    held = v.groupBy("feature").agg(F.count(F.lit(1)).alias("df"))
    x = S._indexed(v, held, 0.7)
    assert S.candidate_pairs(x, x, 0.7).count() == 300 == S.threshold_join(v, v, 0.7).count()


def test_no_python_in_the_plan(spark):
    v = vectors(spark, {1: {1: 1, 2: 2}, 2: {1: 1, 2: 3}})
    plan = S.best_above(v, v, 0.5)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "CartesianProduct"))


def test_idf_weights(spark):
    texts = ["ab", "ab", "abc", "", None, "xyz"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    idf = S.fit_idf(df, "t")
    grams = Counter(g for t in texts if t for g in {f" {t} "[i:i + 3] for i in range(len(t))})
    bucket = lambda g: (ord(g[0]) * 1369 + ord(g[1]) * 37 + ord(g[2])) % S.SPARSE_DIM
    want = {bucket(g): round((math.log(5 / (1 + n)) + 1) * S.IDF_SCALE) for g, n in grams.items()}
    assert {r.feature: r.idf for r in idf.weights.collect()} == want
    assert idf.unseen == round((math.log(5) + 1) * S.IDF_SCALE)
    got = S.sparse_vectors(spark.createDataFrame([(1, "ab"), (2, "q"), (3, None)], "k long, t string"), "k", "t", idf=idf)
    rows = {(r.key, r.feature): r.w for r in got.collect()}
    assert rows[1, bucket(" ab")] == want[bucket(" ab")] and rows[2, bucket(" q ")] == idf.unseen and len(rows) == 3
    unit = S.unit_weights(got).groupBy("key").agg(F.sum(F.col("weight") ** 2).alias("n")).collect()
    assert all(r.n == pytest.approx(1) for r in unit)


def test_mapping_with_idf_prefers_the_rare_word(spark):
    """Counted raw, the common words decide; weighted, the rare one does."""
    concepts = [(i, f"chronic disease of the {w} unspecified side", "D") for i, w in enumerate(("heart", "liver", "lung", "brain", "skin"))]
    c = spark.createDataFrame(concepts, "concept_id long, concept_name string, domain_id string")
    src = spark.createDataFrame([("liver",), ("Chronic disease of the liver",), ("zzz",), (None,), ("chronic disease of the brain unspecified side",)], "v string")
    got = {r.v: (r.concept_id, r.matching_strategy) for r in M.multi_strategy(
        src, "v", c, threshold=0.6, partial_floor=0.25, matcher=S.sparse_matcher(0.25, idf=True)).collect()}
    assert got["liver"] == (1, "partial_match") and got["Chronic disease of the liver"] == (1, "semantic_match")
    assert got["zzz"] == got[None] == (None, None) and got["chronic disease of the brain unspecified side"] == (3, "exact_match")


def test_empty_sides(spark):
    v = vectors(spark, {1: {1: 1}})
    none = v.where("key < 0")
    assert S.threshold_join(v, none, 0.5).count() == S.threshold_join(none, v, 0.5).count() == 0
    with pytest.raises(ValueError):
        S.threshold_join(v, v, 0.0)
