"""I-Match: fingerprints against a plain statement of the rules, the successor order, odd rows."""
import hashlib
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cdmspark.llm import imatch as I

M64 = (1 << 64) - 1


def terms(text):
    return set(re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower()))


@pytest.fixture(scope="module")
def labelled(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")


def brute(spark, rows):
    """Fingerprints, from term and set hashes that Spark computes for lists of terms."""
    n, df = len(rows), Counter(t for _, x in rows for t in terms(x))
    band = {t for t, c in df.items() if max(2, .001 * n) <= c <= max(10, .02 * n)}
    hashed = {r.t: r.h for r in spark.createDataFrame([(t,) for t in df], "t string").withColumn("h", F.xxhash64("t")).collect()}

    def slots(text):
        out, at = [], 0
        own = terms(text)
        if not own:
            return "=" + hashlib.sha256((text or "").encode()).hexdigest()[:32], None
        mine = own if 5 * len(own & band) < len(own) else own & band
        mine = sorted(hashed[t] for t in mine)
        for bits in I.CELL_BITS:
            for i in range(16):
                out.append([h for h in mine if ((h & M64) >> at) & ((1 << bits) - 1) == i])
            at += bits
        return None, out
    ask = [(i, k, s) for i, x in rows for k, s in enumerate(slots(x)[1] or []) if s]
    hexed = {(r.i, r.k): r.v for r in spark.createDataFrame(ask, "i long, k int, s array<bigint>").select(
        "i", "k", F.expr("lpad(hex(xxhash64(s) & 65535L), 4, '0') AS v")).collect()}
    out = {}
    for i, x in rows:
        whole, s = slots(x)
        out[i] = whole or "".join(hexed.get((i, k), "----") for k in range(64))
    return out


def alike(a, b):
    if a == b:
        return 1.0
    if a[0] == "=" or b[0] == "=":
        return 0.0
    x, y = ([v[i:i + 4] for i in range(0, 256, 4)] for v in (a, b))
    both = [(p, q) for p, q in zip(x, y, strict=True) if p != "----" or q != "----"]
    return sum(p == q for p, q in both) / max(1, len(both))


def test_equals_brute_force(spark, labelled):
    rows = [(r.doc_id, r.text) for r in labelled.collect()]
    got = {r.doc_id: r for r in I.fingerprints(labelled).collect()}
    want = brute(spark, rows)
    assert {i: r.fingerprint for i, r in got.items()} == want
    order = sorted(rows, key=lambda r: -r[0])
    for k, (i, text) in enumerate(order):
        after = order[(k + 1) % len(order)]
        cut = len(text) // 3
        edited = text[:len(text) - cut] + after[1][:cut]
        r = got[i]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.near_next == alike(want[i], want[after[0]])
        assert r.near_edited == alike(r.fingerprint, r.edited_fingerprint)
    assert sum(r.near_edited > r.near_next for r in got.values()) > 0.9 * len(got)


def test_order_is_one_over_many_ranges(spark):
    rows = [(i * i, f"t{i}") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    for size in (1, 7, 100, 1000):
        got = {r.doc_id: r.next_text for r in I.next_rows(df, ["text"], range_rows=size).collect()}
        assert got == {i * i: f"t{(i - 1) % 300}" for i in range(300)}


def test_equal_texts_and_odd_rows(spark, odd, nothing, docs, corpus):
    out = I.fingerprints(docs).collect()
    assert len(out) == len(corpus)
    text = {r[0]: r[1] or "" for r in corpus}
    by = {}
    for r in out:
        assert by.setdefault(text[r.doc_id], r.fingerprint) == r.fingerprint
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    assert I.fingerprints(odd).count() == odd.count()
    assert I.fingerprints(nothing).count() == 0
    one = I.fingerprints(spark.createDataFrame([(5, "abcdef")], "doc_id long, text string")).first()
    assert one.edited_sha256 == hashlib.sha256(b"abcdab").hexdigest() and one.near_next == 1.0


def test_hot_group_of_near_copies(spark):
    """A third of all rows are near copies, all of whose words are frequent, among texts with many
    terms in the band: each is nearer to its edited text than to an unlike document."""
    rng = random.Random(4)
    common, words = [f"c{i}" for i in range(30)], [f"w{i}" for i in range(20_000)]
    hot = rng.choices(words, k=160)
    rows = []
    for i in range(900):
        if i % 3 == 0:
            own = list(hot)
            for _ in range(5):
                own[rng.randrange(160)] = f"x{rng.randrange(10**6)}"
            rows.append((i, " ".join(own)))
        else:
            rows.append((i, " ".join(rng.choices(common, k=60) + rng.choices(words, k=60))))
    got = {r.doc_id: r for r in I.fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for group in ([got[i] for i in range(0, 900, 3)], [got[i] for i in range(900) if i % 3]):
        assert not any(r.fingerprint.startswith("=") for r in group)
        assert sum(r.near_edited > r.near_next for r in group) > 0.9 * len(group)
    group = [got[i] for i in range(0, 900, 3)]
    near = [alike(a.fingerprint, b.fingerprint) for a, b in zip(group, group[1:], strict=False)]
    far = [r.near_next for r in group]
    assert sum(near) / len(near) > 0.5 and sum(far) / len(far) < 0.1


def test_texts_of_rare_words(spark):
    """Words that occur once in the corpus are a fingerprint too, and an edit leaves part of it."""
    rows = [(i, " ".join(f"r{i}q{k}" for k in range(60))) for i in range(40)]
    for r in I.fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        assert not r.fingerprint.startswith("=") and r.near_edited > r.near_next == 0.0
