"""Edit-ratio candidates: nothing lost, few scored, equal to brute force."""
import random
import string

import pytest

from cdmspark.functions.similarity import clean_py, ratio_py
from cdmspark.operators.fuzzy import fuzzy_match, fuzzy_match_brute
from cdmspark.operators.ratio_join import ratio_pairs


def edited(rng, text, times):
    for _ in range(times):
        i = rng.randrange(len(text) + 1)
        text = rng.choice([text[:i] + rng.choice("abc é") + text[i:], text[:i] + text[i + 1:], text[i:] + text[:i]]) if text else text
    return text


def some(seed, n, letters):
    rng = random.Random(seed)
    words = ["".join(rng.choices(letters, k=rng.randint(1, 9))) for _ in range(60)]
    names = [" ".join(rng.sample(words, rng.randint(1, 5))) for _ in range(n)]
    return names, [edited(rng, rng.choice(names), rng.randint(0, 6)) for _ in range(n)]


@pytest.mark.parametrize("cutoff, letters", [(80, string.ascii_lowercase), (80, "ab"), (60, "abcd"), (95, "abcdef"), (100, "abc"), (30, "abcdefgh")])
def test_no_pair_at_the_cutoff_is_lost(spark, cutoff, letters):
    names, values = some(cutoff, 80, letters)
    names += ["a", "ab", "xy z", "日本語 テキスト", "x" * 300, "xy" * 150]
    values += ["a", "b", "xyz", "日本語テキスト", "x" * 290, "xy" * 140, "yx" * 150]
    a, b = sorted({clean_py(x) for x in values} - {""}), sorted({clean_py(x) for x in names} - {""})
    got = {(r.a, r.b) for r in ratio_pairs(spark.createDataFrame([(x,) for x in a], "v string"), "v",
                                           spark.createDataFrame([(x,) for x in b], "c string"), "c", (cutoff - .5) / 100).collect()}
    want = {(x, y) for x in a for y in b if ratio_py(x, y) >= cutoff}
    assert want <= got and len(want) > 10


@pytest.mark.parametrize("cutoff", [80, 55])
def test_equals_brute_force(spark, cutoff):
    names, values = some(7, 120, "abcdefghijkl")
    concepts = [(i, n) for i, n in enumerate(names + names[:20] + ["", "   ", "A-B", "a b"])]
    rows = list(enumerate([*values, None, "", "?!", "A B", "a  b", values[0]]))
    out = fuzzy_match(spark.createDataFrame(rows, "k long, v string"), "v",
                      spark.createDataFrame(concepts, "concept_id long, concept_name string"), cutoff=cutoff, strategy="bucketed")
    got = {r.k: r.concept_id for r in out.collect()}
    assert got == dict(enumerate(fuzzy_match_brute([v for _, v in rows], concepts, cutoff)))


def test_few_pairs_are_scored(spark):
    rng = random.Random(3)
    names = sorted({" ".join("".join(rng.choices(string.ascii_lowercase, k=rng.randint(4, 10))) for _ in range(4)) for _ in range(500)})
    values = sorted({edited(rng, n, 2) for n in names})
    pairs = ratio_pairs(spark.createDataFrame([(x,) for x in values], "v string"), "v",
                        spark.createDataFrame([(x,) for x in names], "c string"), "c", .795)
    n = pairs.count()
    assert 400 < n < 0.01 * len(values) * len(names)
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "CartesianProduct", "NestedLoop"))


def test_empty_sides_and_cutoff_zero(spark):
    none = spark.createDataFrame([], "v string")
    one = spark.createDataFrame([("ab",)], "v string")
    assert ratio_pairs(none, "v", one, "v", .8).count() == ratio_pairs(one, "v", none, "v", .8).count() == 0
    with pytest.raises(ValueError):
        ratio_pairs(one, "v", one, "v", 0.0)
