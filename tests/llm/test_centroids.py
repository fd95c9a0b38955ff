"""Centroid clustering: heaps, brute-force rounds, few scans, odd rows."""
import hashlib
import heapq

import duckdb
import numpy as np
import pytest

from cdmspark.llm import centroids as C

SF = "/root/testdata/sf0.01"


def brute(rows, k=8, dim=64, rounds=10, salt=3):
    """rows: (id, vector) -> sorted (id, cluster, distance, cluster inertia, inertia, digest)."""
    kept = [(i, [int(np.floor(1024 * float(x))) for x in v]) for i, v in rows
            if v is not None and len(v) == dim and all(x is not None and np.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"{salt}:{r[0]}".encode()).hexdigest(), r[1]))
    cents = [v for _, v in order[:k]]
    v = np.array([x for _, x in kept], np.int64)            # components up to 2 ** 27 stay exact

    def nearest():
        d = np.stack([((v - np.array(c, np.int64)) ** 2).sum(1) for c in cents], 1)
        own = [min(range(len(cents)), key=lambda c: (row[c], c)) for row in d]
        return own, [int(row[c]) for row, c in zip(d, own, strict=True)]
    for _ in range(rounds):
        own, _ = nearest()
        for c in range(len(cents)):
            mine = [x for (_, x), o in zip(kept, own, strict=True) if o == c]
            if mine:
                cents[c] = [sum(col) // len(mine) for col in zip(*mine, strict=True)]
    own, d = nearest()
    sums = [sum(x for x, o in zip(d, own, strict=True) if o == c) for c in range(len(cents))]
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cents]
    return sorted((i, c, x, sums[c], sum(d), sha[c]) for (i, _), c, x in zip(kept, own, d, strict=True))


def rows_of(df):
    return sorted((r.vec_id, r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in df.collect())


@pytest.mark.parametrize("seed", range(6))
def test_heap_against_heapq(seed):
    rng = np.random.default_rng(seed)
    heap, plain, number = C.GapHeap(), [], 0
    for _ in range(40):
        n = int(rng.integers(0, 60))
        keys = np.round(rng.normal(0, 3, n), int(rng.integers(0, 3)))
        heap.push(keys, np.arange(number, number + n))
        for j, x in enumerate(keys):
            heapq.heappush(plain, (x, number + j))
        number += n
        k = heap.keys
        assert all(k[(i - 1) // 2] <= k[i] for i in range(1, len(k)))
        limit = float(rng.normal(-2, 2))
        want = []
        while plain and plain[0][0] <= limit:
            want.append(heapq.heappop(plain)[1])
        assert sorted(heap.pop_up_to(limit).tolist()) == sorted(want)
        k = heap.keys
        assert len(k) == len(plain) and all(k[(i - 1) // 2] <= k[i] for i in range(1, len(k)))


@pytest.mark.parametrize("block", [7, 64, 8192])
def test_equals_brute_force_and_looks_at_few(spark, block, monkeypatch):
    monkeypatch.setattr(C, "BLOCK", block)
    df = spark.read.parquet(f"{SF}/embeddings.parquet").repartition(3)
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    trace = []
    assert rows_of(C.cluster_vectors(df, trace=trace)) == brute(rows)
    assert trace[0] == len(rows) and len(trace) == 11 and trace[-1] < len(rows)


def test_sql_gives_the_same(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    assert sorted(con.execute(C.OP13_SQL).fetchall()) == rows_of(C.op13_centroids(spark, SF))


def test_clear_groups_need_few_comparisons(spark):
    rng = np.random.default_rng(4)
    centre = rng.normal(0, 8, (8, 64))
    rows = [(i, [float(x) for x in centre[i % 8] + rng.normal(0, .3, 64)]) for i in range(4000)]
    trace = []
    got = C.cluster_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), trace=trace)
    assert rows_of(got) == brute(rows)
    assert sum(trace[4:]) < 0.2 * 4000 * len(trace[4:])


def test_ties_large_components_and_repeated_rows(spark):
    rng = np.random.default_rng(1)
    base = [[float(x) for x in rng.integers(-2, 3, 64)] for _ in range(5)]
    rows = [(i % 17, base[i % 5]) for i in range(60)]                       # repeated ids and rows, many ties
    rows += [(100 + i, [float(x) * 20000 for x in rng.normal(0, 1, 64)]) for i in range(9)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    assert rows_of(C.cluster_vectors(df)) == brute(rows)


def test_odd_rows(spark):
    v = [0.5] * 64
    rows = [(1, v, 3, "a"), (1, v, 3, "a"), (2, None, None, "b"), (3, [0.5] * 63, 1, "c"), (4, [*v[:63], None], 1, "d"),
            (5, [*v[:63], float("nan")], 1, "e"), (6, [*v[:63], float("inf")], 1, "f"), (None, [-1.0] * 64, None, None),
            (7, [1e30] * 64, 1, "g"), (8, [], 1, "h")]
    odd = spark.createDataFrame(rows, "vec_id long, embedding array<float>, cluster int, distance string")
    got = sorted(((r.vec_id, r.distance, r.inertia) for r in C.cluster_vectors(odd).collect()), key=str)
    assert got == [(1, 0, 0), (1, 0, 0), (None, 0, 0)]
    empty = C.cluster_vectors(odd.filter("vec_id > 100"))
    assert empty.count() == 0 and empty.columns == C.cluster_vectors(odd).columns
    assert C.cluster_vectors(spark.createDataFrame([(1, "x")], "vec_id long, other string")).count() == 0
    far = spark.createDataFrame([(i, [(-1.0) ** i * 131000.0] * 64) for i in range(20)], "vec_id long, embedding array<double>")
    assert {r.inertia for r in C.cluster_vectors(far, k=1).collect()} == {None}
