"""Edit-ratio join by segments against brute force; forced plans check their bound."""
import random

import pytest

from cdmspark.operators.fuzzy import fuzzy_match, levenshtein_match
from cdmspark.operators.nearest import nearest


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@pytest.mark.parametrize("threshold", [0.5, 0.8, 0.9, 1.0])
def test_equals_brute_force(spark, threshold):
    rng = random.Random(int(threshold * 10))
    names = ["".join(rng.choice("abc") for _ in range(rng.randrange(1, 14))) for _ in range(40)]
    values = []
    for n in names * 2:
        v = list(n)
        for _ in range(rng.randrange(0, 4)):
            op, i = rng.randrange(3), rng.randrange(len(v) + 1)
            if op == 0:
                v.insert(i, rng.choice("abc"))
            elif v and op == 1:
                v.pop(min(i, len(v) - 1))
            elif v:
                v[min(i, len(v) - 1)] = rng.choice("abcX")
        values.append("".join(v))
    values += [None, "", "  "]
    src = spark.createDataFrame(list(enumerate(values)), "i long, v string")
    concepts = spark.createDataFrame([(k, n) for k, n in enumerate(names)], "concept_id long, concept_name string")
    got = {r.i: (r.concept_id, r.edit_ratio) for r in levenshtein_match(src, "v", concepts, threshold).collect()}
    for i, v in enumerate(values):
        v = (v or "").strip().upper()
        scored = [(-(1 - distance(v, n.upper()) / max(len(v), len(n))), n.upper()) for n in names] if v else []
        scored = [s for s in scored if -s[0] >= threshold - 1e-12]
        if not scored:
            assert got[i] == (None, None)
            continue
        best = min(scored)
        assert got[i] == (max(k for k, n in enumerate(names) if n.upper() == best[1]), round(-best[0], 6))


def test_a_forced_broadcast_still_checks_its_bound(spark):
    v = spark.createDataFrame([(i, [1.0, float(i)]) for i in range(50)], "k long, vec array<double>")
    with pytest.raises(ValueError, match="max_broadcast_bytes"):
        nearest(v.withColumnRenamed("k", "a"), v.withColumnRenamed("k", "b"), "a", "b", strategy="broadcast",
                max_broadcast_bytes=100)
    names = spark.createDataFrame([(i, f"name {i}") for i in range(50)], "concept_id long, concept_name string")
    with pytest.raises(ValueError, match="max_broadcast_bytes"):
        fuzzy_match(spark.createDataFrame([("x",)], "v string"), "v", names, strategy="broadcast", max_broadcast_bytes=100)


def test_plans_agree_on_vectors_that_are_not_whole_numbers(spark):
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, 1) for _ in range(9)]) for i in range(300)]
    s = spark.createDataFrame(rows[:120], "a long, vec array<double>")
    c = spark.createDataFrame(rows, "b long, vec array<double>")
    one = {(r.a, r["rank"]): (r.b, round(r.score, 9)) for r in nearest(s, c, "a", "b", k=4).collect()}
    two = {(r.a, r["rank"]): (r.b, round(r.score, 9)) for r in nearest(
        s, c, "a", "b", k=4, strategy="blocked", block_rows=37, src_block_rows=50).collect()}
    assert one == two
