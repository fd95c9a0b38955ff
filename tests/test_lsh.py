"""Nearest join by hashing: exact scores, recall, copies, few pairs on clustered vectors."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from cdmspark.operators import lsh as H
from cdmspark.operators.nearest import nearest

SF = "/root/testdata/sf0.01"


def frame(spark, x, first=0):
    return spark.createDataFrame([(first + i, [float(e) for e in v]) for i, v in enumerate(x)], "id long, vec array<double>")


def rows(df):
    return {(r.s, r.rank): (r.c, round(r.score, 9)) for r in df.collect()}


def test_slots():
    rng = np.random.default_rng(0)
    x, cut = rng.normal(size=(20, 9)), H.planes(3, 6, 9)
    own, probes = H.slots_of(x, cut, 0), H.slots_of(x, cut, 2)
    assert own.shape == (20, 3) and probes.shape == (20, 12) and np.abs(cut).max() <= 1
    for i in range(20):
        for t in range(3):
            side = cut[t] @ x[i]
            slot = sum(1 << b for b in range(6) if side[b] > 0)
            near = sorted(range(6), key=lambda b: abs(side[b]))[:2]
            want = {slot ^ m for m in (0, 1 << near[0], 1 << near[1], (1 << near[0]) | (1 << near[1]))}
            assert own[i, t] == (t << 6) + slot
            assert {int(p) - (t << 6) for p in probes[i, 4 * t:4 * t + 4]} == want


@pytest.mark.parametrize("k", [1, 3])
def test_recall_on_the_given_vectors_and_exact_scores(spark, k):
    v = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", F.col("embedding").cast("array<double>").alias("vec"))
    s, c = v.withColumnRenamed("vec_id", "s"), v.withColumnRenamed("vec_id", "c")
    exact, got = (rows(f(s, c, "s", "c", k=k, exclude_self=True)) for f in (nearest, H.nearest_lsh))
    mapped = {key: x for key, x in exact.items() if x[1] >= 0.4}
    assert sum(got.get(key) == x for key, x in mapped.items()) >= 0.9 * len(mapped) > 50
    every = rows(nearest(s, c, "s", "c", k=500, exclude_self=True))
    by_pair = {(key[0], x[0]): x[1] for key, x in every.items()}
    assert all(abs(by_pair[key[0], x[0]] - x[1]) < 1e-8 for key, x in got.items())


def test_clustered_vectors_form_few_pairs(spark):
    rng = np.random.default_rng(5)
    centre = rng.normal(size=(150, 32))
    a, b = (np.repeat(centre, 4, 0) + rng.normal(0, .15, (600, 32)) for _ in range(2))
    s, c = frame(spark, a).withColumnRenamed("id", "s"), frame(spark, b).withColumnRenamed("id", "c")
    exact, got = (rows(f(s, c, "s", "c")) for f in (nearest, lambda *x: H.nearest_lsh(*x, tables=16)))
    assert sum(got.get(key) == x for key, x in exact.items()) >= 0.95 * len(exact)
    one, other = (x.withColumnRenamed(n, "key") for x, n in ((s, "s"), (c, "c")))
    assert H.candidate_pairs(one, other, 32, tables=16).count() < 0.2 * 600 * 600


def test_a_third_are_copies(spark):
    """Copies add no pairs, and ties go to the lowest keys as in the exact join."""
    rng = np.random.default_rng(6)
    x = np.concatenate([rng.normal(size=(60, 16)), np.repeat(rng.normal(size=(1, 16)), 240, 0)])
    v = frame(spark, x)
    s, c = v.withColumnRenamed("id", "s"), v.withColumnRenamed("id", "c")
    got = rows(H.nearest_lsh(s, c, "s", "c", k=2, exclude_self=True, tables=8, bits=4, flips=4))   # all slots probed: exact
    assert got == rows(nearest(s, c, "s", "c", k=2, exclude_self=True))
    assert got[60, 1][0] == 61 and got[60, 2][0] == 62 and got[200, 1][0] == 60 and got[200, 2][0] == 61


def test_odd_vectors(spark):
    rows_ = [(1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, None), (4, [1.0]), (5, [1.0, None]), (6, [float("nan"), 1.0]), (7, [2.0, 0.0]),
             (8, [float("inf"), 1.0])]
    v = spark.createDataFrame(rows_, "id long, vec array<double>")
    s, c = v.withColumnRenamed("id", "s"), v.withColumnRenamed("id", "c")
    got = rows(H.nearest_lsh(s, c, "s", "c", exclude_self=True, bits=2, flips=2))
    assert got == {(1, 1): (7, 1.0), (7, 1): (1, 1.0)}
    assert H.nearest_lsh(s.where("s > 99"), c, "s", "c").count() == H.nearest_lsh(s, c.where("c > 99"), "s", "c").count() == 0
    with pytest.raises(ValueError):
        H.nearest_lsh(s, c, "s", "c", bits=2, flips=3)


def test_pairs_are_no_rows_and_the_best_of_them_are_found(spark, monkeypatch):
    """slots are looked up inside tasks of blocks; what is found is the best of all pairs that meet."""
    rng = np.random.default_rng(8)
    x = rng.normal(size=(700, 10))
    s, c = frame(spark, x[:400]).withColumnRenamed("id", "s"), frame(spark, x[200:], 200).withColumnRenamed("id", "c")
    met = H.candidate_pairs(s.withColumnRenamed("s", "key"), c.withColumnRenamed("c", "key"), 10, 3, 6, 2).collect()
    unit = x / np.sqrt((x * x).sum(1))[:, None]
    want = {}
    for r in met:
        if r.s != r.c:
            want.setdefault(r.s, []).append((-float(unit[r.s] @ unit[r.c]), r.c))
    want = {(key, i): (z, round(-y, 9)) for key, v in want.items() for i, (y, z) in enumerate(sorted(v)[:2], 1)}
    monkeypatch.setattr(H, "candidate_pairs", None)
    for rows_ in (10_000, 60):
        monkeypatch.setattr(H, "SLOT_BLOCK_ROWS", rows_)
        assert rows(H.nearest_lsh(s, c, "s", "c", k=2, exclude_self=True, tables=3, bits=6, flips=2)) == want
