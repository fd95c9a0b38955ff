"""Quality rules: measures against brute force, the fit on votes with known accuracies, odd rows."""
import math
import random
import re

from cdmspark.llm import quality_rules as Q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    grams = {}
    for i in range(len(words) - 2):
        grams.setdefault(tuple(words[i:i + 3]), []).append(i)
    hit = {i + j for at in grams.values() if len(at) > 1 for i in at for j in range(3)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit))


def measured(df):
    return {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in df.collect()}


def planted(corpus):
    rng = random.Random(8)
    rows = [(r[0], r[1]) for r in corpus]
    for i in range(60):
        words = [rng.choice("abc") if i % 2 else rng.choice(["x#", "y|", "zé", "<w>", "v"]) for _ in range(rng.randrange(0, 30))]
        rows.append((5000 + i, "".join(w + rng.choice([" ", "\n", "\t", "  ", " ", "\x0c"]) for w in words)))
    return rows


def test_measures_equal_brute_force(spark, corpus):
    rows = planted(corpus)
    out = Q.quality(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    want = {i: brute(t) for i, t in rows}
    assert sum(v[4] > 0 for v in want.values()) >= 20
    assert measured(out) == want
    for r in out.collect():
        failed = r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words
        assert r.base_failed == failed and (not r.kept or not failed)
        assert r.kept == (not failed and r.p_good >= Q.KEEP_FROM)


def test_fit_finds_planted_accuracies():
    rng = random.Random(1)
    counts, truth = {}, []
    for _ in range(20000):
        good = rng.random() < 0.8
        pattern = 0
        for j in range(len(Q.RULES)):
            bad = rng.random() < (0.003 if good else 0.35)
            fine = not bad and rng.random() < (0.7 if good else 0.3)
            pattern += (0 if bad else 2 if fine else 1) * 3**j
        counts[pattern] = counts.get(pattern, 0) + 1
        truth.append((pattern, good))
    prior, weights = Q.fit(counts)
    assert abs(1 / (1 + math.exp(-prior)) - 0.8) < 0.03
    right = sum((prior + sum(w[p // 3**j % 3] for j, w in enumerate(weights)) > 0) == g for p, g in truth)
    assert right / len(truth) > 0.97
    assert all(w[0] < w[1] < w[2] for w in weights)


def test_agrees_with_labels(spark):
    d = "/root/testdata/sf0.01"
    out = Q.quality(spark.read.parquet(f"{d}/documents.parquet"))
    got = out.join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id").filter("not base_failed").collect()
    assert sum(r.kept == (r.quality == 1) for r in got) / len(got) > 0.98


def test_odd_rows_and_stage(odd, nothing, docs, spark):
    assert Q.quality(odd).count() == odd.count()
    assert Q.quality(nothing).count() == 0 and Q.keep_good(nothing).count() == 0
    out = Q.keep_good(docs)
    assert out.columns == docs.columns
    assert sorted(r.doc_id for r in out.collect()) == sorted(r.doc_id for r in Q.quality(docs).filter("kept").collect())
    assert Q.keep_good(odd).columns == odd.columns
    good = " ".join(f"Word{i} follows another." for i in range(60))
    kept = Q.keep_good(spark.createDataFrame([(None, good, "x"), (None, good, "y"), (3, None, None)],
                                             "doc_id long, text string, __q_words string"))
    assert kept.count() == 2 and kept.columns == ["doc_id", "text", "__q_words"]
