"""Nearest and fuzzy joins against brute force, both plans, ties included."""
import numpy as np
import pytest

from cdmspark.functions.similarity import clean_py, ratio_py
from cdmspark.operators.fuzzy import fuzzy_match, fuzzy_match_brute
from cdmspark.operators.nearest import nearest


def _brute(src, cand, k, exclude_self):
    out = {}
    for sk, sv in src:
        sc = []
        for ck, cv in cand:
            if exclude_self and sk == ck:
                continue
            na, nb = np.sqrt(np.sum(np.square(sv))), np.sqrt(np.sum(np.square(cv)))
            sc.append((-(np.dot(sv, cv) / (na * nb)), ck))
        out[sk] = [ck for _, ck in sorted(sc)[:k]]
    return out


@pytest.mark.parametrize("strategy", ["broadcast", "blocked"])
@pytest.mark.parametrize("k", [1, 3])
def test_nearest_matches_brute_force(spark, strategy, k):
    rng = np.random.default_rng(7)
    vecs = rng.integers(0, 3, size=(120, 8)).astype(float)     # small integers: many exact ties
    vecs[5] = 0.0                                                # zero vector never matches
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vecs)]
    df = spark.createDataFrame(rows, "id long, vec array<double>")
    src, cand = df.withColumnRenamed("id", "sid"), df.withColumnRenamed("id", "cid")
    got = nearest(src, cand, "sid", "cid", k=k, exclude_self=True, strategy=strategy, block_rows=25,
                  src_block_rows=30)
    res = {}
    for r in got.orderBy("sid", "rank").collect():
        res.setdefault(r.sid, []).append(r.cid)
    nz = [(i, v) for i, v in enumerate(vecs) if np.any(v)]
    want = _brute(nz, nz, k, True)
    assert res == want


CONCEPTS = [(1, "Acute appendicitis"), (2, "Cholelithiasis"), (3, "Coronary arteriosclerosis"),
            (4, "Type 2 diabetes mellitus"), (5, "Pediatric Cardiology"), (6, "Depressive disorder"),
            (7, "Asthma"), (8, "Endocrinology"), (9, "Asthma"), (10, "asthma!")]
VALUES = ["Acute appendicitis", "acute apendicitis", "Asthma", "Depression", "Endocrinology specialty",
          "Pediatric cardiology", None, "", "zzzz", "Type 2 diabetes", "asthma"]


@pytest.mark.parametrize("strategy", ["broadcast", "blocked"])
def test_fuzzy_matches_brute_force(spark, strategy):
    cdf = spark.createDataFrame(CONCEPTS, "concept_id long, concept_name string")
    sdf = spark.createDataFrame([(i, v) for i, v in enumerate(VALUES)], "i int, v string")
    got = {r.i: r.concept_id for r in fuzzy_match(sdf, "v", cdf, strategy=strategy, block_rows=3,
                                                            src_block_rows=4).collect()}
    want = fuzzy_match_brute(VALUES, CONCEPTS)
    assert [got[i] for i in range(len(VALUES))] == want


def test_fuzzy_cutoff_edges():
    assert ratio_py("abcd", "abcd") == 100
    assert ratio_py("", "") == 100 and ratio_py("a", "") == 0
    # difflib is order-dependent: the source goes first
    assert ratio_py("tide", "diet") != ratio_py("diet", "tide")
    # 79.5 rounds to 80 (round half to even)
    assert int(round(79.5)) == 80 and int(round(80.5)) == 80


def test_fuzzy_pair_udf(spark):
    from cdmspark.functions.similarity import fuzz_ratio
    df = spark.createDataFrame([("Asthma", "asthma!"), ("tide", "diet")], "a string, b string")
    got = [r[0] for r in df.select(fuzz_ratio("a", "b")).collect()]
    assert got == [ratio_py(clean_py("Asthma"), clean_py("asthma!")), ratio_py("tide", "diet")]


def test_blocks_grow_with_the_table(spark):
    """rows are copied to a fixed number of blocks, and the best are those of every pair in double precision."""
    from cdmspark.operators import nearest as N
    assert [N.blocks(n, 150, 64) for n in (0, 100, 600, 100_000, 600_000)] == [1, 1, 4, 8, 8]
    assert N.blocks(6_000_000, 150, 64) == 60 and N.blocks(100_000, 20_000, 512) == 5
    rng = np.random.default_rng(3)
    x = rng.normal(size=(900, 12))
    x[300:600] = x[0] + rng.normal(size=(300, 12)) * 1e-9          # closer than single precision tells
    x[600:700] = x[1]
    v = spark.createDataFrame([(i, e.tolist()) for i, e in enumerate(x)], "id long, vec array<double>")
    s, c = v.withColumnRenamed("id", "s"), v.withColumnRenamed("id", "c")
    dot = x @ x.T / np.outer(*[np.sqrt((x * x).sum(1))] * 2)
    np.fill_diagonal(dot, -2)
    best = -np.sort(-dot, axis=1)[:, :3]
    for kind in ("blocked", "broadcast"):
        got = nearest(s, c, "s", "c", k=3, exclude_self=True, strategy=kind, block_rows=10, src_block_rows=20).collect()
        assert len(got) == 2700 and max(abs(r.score - best[r.s, r["rank"] - 1]) for r in got) < 1e-13
        assert [r.c for r in sorted((r for r in got if r.s == 650), key=lambda r: r["rank"])] == [1, 600, 601]
