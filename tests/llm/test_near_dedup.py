"""Near-duplicates against brute force on full string sets, and the defined odd cases."""
import re

import numpy as np

from cdmspark.llm import near_dedup as N


def string_set(text, k=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return set()
    return {tuple(words[i:i + k]) for i in range(max(1, len(words) - k + 1))}


def brute(rows, percent=85):
    sets = [(r[0], string_set(r[1])) for r in rows]
    comp = {i: i for i, _ in sets}

    def root(x):
        while comp[x] != x:
            x = comp[x]
        return x
    for i, (a, s) in enumerate(sets):
        for b, t in sets[:i]:
            if s and t and 100 * len(s & t) >= percent * len(s | t):
                x, y = sorted((root(a), root(b)))
                comp[y] = x
    return {i: (len(s), root(i), root(i) == i) for i, s in sets}


def result(df):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in df.collect()}


def test_equals_brute_force(docs, corpus):
    want = brute(corpus)
    assert max(sum(v[1] == c for v in want.values()) for c in {v[1] for v in want.values()}) >= 30
    assert result(N.near_duplicates(docs)) == want


def test_blocks_change_nothing(docs, corpus):
    assert result(N.near_duplicates(docs, block_nodes=7, block_shingles=900)) == brute(corpus)


def test_rest_is_compared_with_every_block(docs, corpus, monkeypatch):
    """Without pivots, and with all members as pivots, links across blocks are found."""
    for pivots in (0, 10**6):
        monkeypatch.setattr(N, "PIVOTS", pivots)
        assert result(N.near_duplicates(docs, block_nodes=3, block_shingles=300)) == brute(corpus)


def test_a_chain_across_blocks(spark):
    """Each text is linked to the next alone; blocks of two hold few of the links."""
    words = [f"w{i}" for i in range(140)]
    rows = [(i, " ".join(words[2 * i:2 * i + 60])) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for nodes in (2, 1024):
        assert result(N.near_duplicates(df, block_nodes=nodes)) == brute(rows)


def test_every_pair_within_the_distance_shares_a_key(spark):
    rng = np.random.default_rng(3)
    a = rng.integers(0, 2**16, (200, N.SYMBOLS), dtype=np.uint16)
    b = a.copy()
    for r in b:
        r[rng.choice(N.SYMBOLS, N.MAX_DISTANCE, replace=False)] += 1
    df = spark.createDataFrame([(x.tobytes(), y.tobytes()) for x, y in zip(a, b)], "a binary, b binary")
    from pyspark.sql import functions as F
    shared = df.select(F.arrays_overlap(N._keys(F.col("a")), N._keys(F.col("b"))).alias("hit"))
    assert shared.filter("not hit").count() == 0


def test_dense_and_walked_intersections_agree():
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(0, 300, 200).astype(np.uint64)) for _ in range(40)]
    got = N._intersections(sets)
    assert got is not None
    assert all(got[i, j] == len(np.intersect1d(sets[i], sets[j])) for i in range(40) for j in range(40))


def test_odd_rows(odd):
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in N.near_duplicates(odd).collect()), key=str)
    assert got == sorted([(1, 3, 1, True), (1, 3, 1, True), (1, 1, 1, True), (None, 3, 1, False), (None, 0, None, False),
                          (2, 0, 2, True), (3, 0, 3, True), (4, 3, 1, False), (4, 3, 1, False)], key=str)


def test_keep_one(odd, docs, corpus, nothing):
    left = N.keep_one(docs)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect()) == sorted(i for i, v in brute(corpus).items() if v[2])
    rest = N.keep_one(odd)
    assert rest.columns == odd.columns
    # id 1 has two texts that aren't linked: both stay, its exact repeat goes
    assert sorted((r.doc_id, r.text) for r in rest.collect() if r.doc_id) == [(1, "a b c d e"), (1, "f g h"), (2, None), (3, "")]
    assert N.keep_one(nothing).count() == 0
    assert N.near_duplicates(nothing).count() == 0


def test_keep_one_keeps_every_text_class(spark):
    """Ids that repeat with other texts: each text stays in some row, or a linked one does."""
    t, u = "one two three four five six", "seven eight nine ten eleven twelve"
    rows = [(1, t), (1, None), (2, u), (3, t), (3, "x y z"), (3, "x y z"), (4, ""), (4, None), (None, u), (None, "only here"), (5, t)]
    got = sorted(((r.doc_id, r.text) for r in N.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=str)
    assert got == sorted([(1, t), (1, None), (2, u), (3, "x y z"), (4, ""), (4, None), (None, "only here")], key=str)


def test_keep_one_on_a_hot_id(spark, corpus):
    """A third of all rows share an id: no text class is lost and one row of each stays."""
    rows = [(7 if i % 3 == 0 else r[0] * 10, r[1]) for i, r in enumerate(corpus)]
    sets = [string_set(t) for _, t in rows]
    kept = [string_set(r.text) for r in N.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    comp = list(range(len(rows)))

    def root(x):
        while comp[x] != x:
            x = comp[x]
        return x
    for i, s in enumerate(sets):
        for j in range(i):
            if s and sets[j] and 100 * len(s & sets[j]) >= 85 * len(s | sets[j]):
                comp[root(i)] = root(j)
    members = {}
    for i, s in enumerate(sets):
        if s:
            members.setdefault(root(i), []).append(s)
    assert all(sum(k in own for k in kept) == 1 for own in members.values())


def test_components_with_hubs(spark, monkeypatch):
    """Hubs joined by broadcast and by shuffle give the same components."""
    from cdmspark.llm import components as C
    edges = [(1, i) for i in range(2, 400)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5000, i) for i in range(4000, 4100)] + [(399, 4000)]
    df = spark.createDataFrame(edges, "a long, b long")
    want = {i: 1 for i in [*range(1, 400), *range(4000, 4100), 5000]} | {1000 + i: 1000 for i in range(61)}
    for share in (1, 50, 10**9):
        monkeypatch.setattr(C, "HUB_SHARE", share)
        assert {r.node: r.comp for r in C.connected_components(df, "test").collect()} == want
