"""LM scores: gradients, base scores against brute force, a proper distribution, held-out gain."""
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from cdmspark.llm import gru as G
from cdmspark.llm import lm_score as L


def tokens(text):
    return [*re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode())), b""]


def brute(rows):
    own = {i: tokens(t) for i, t in rows}
    held = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i in own}
    c = Counter(w for i, t in own.items() if not held[i] for w in t)
    n, v = sum(c.values()), len(c)
    return {i: (held[i], len(t), sum(c[w] > 0 for w in t), n,
                sum(math.log10((c[w] + .1) / (n + .1 * (v + 1))) for w in t)) for i, t in own.items()}


@pytest.fixture(scope="module")
def scored(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    return [(r.doc_id, r.text) for r in docs.collect()], L.lm_scores(docs).collect()


def test_base_equals_brute_force(scored):
    rows, out = scored
    want = brute(rows)
    assert len(out) == len(want)
    for r in out:
        held, n, known, total, base = want[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, n, known, total)
        assert r.base_score == pytest.approx(base, abs=1e-6)


def by_known(rows):
    """(log10 a token, tokens) of base and score over documents of known words, learned from and held out."""
    out = {}
    for held in (False, True):
        own = [r for r in rows if r.held_out == held and r.n_known == r.n_tokens]
        n = sum(r.n_tokens for r in own)
        out[held] = (sum(r.base_score for r in own) / n, sum(r.score for r in own) / n, len(own),
                     sum(r.score > r.base_score for r in own))
    return out


@pytest.fixture(scope="module")
def untrained(spark):
    return by_known(L.lm_scores(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), rounds=()).collect())


@pytest.mark.parametrize("parts", [1, 32, 211])
def test_beats_base_and_untrained_start_on_known_words(spark, untrained, parts):
    """Unknown words cost the base more than the model, so only documents without any count."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").repartition(parts)
    got = by_known(L.lm_scores(docs).collect())
    for held in (False, True):
        base, score, n, better = got[held]
        assert score > base + 0.1 and score > untrained[held][1] + 0.1 and better > 0.85 * n


def test_beats_base_on_a_larger_table_in_shards(spark, monkeypatch):
    monkeypatch.setattr(L, "SHARD", 1_000_000)       # five shards, so the rounds train on different ones
    got = by_known(L.lm_scores(spark.read.parquet("/root/testdata/sf0.1/documents.parquet")).collect())
    for base, score, n, better in got.values():
        assert score > base + 0.1 and better > 0.9 * n


def test_harmful_rounds_are_not_kept(spark, docs):
    """A rate that wrecks the weights leaves the start in place."""
    start = {(r.doc_id, r.n_tokens): r.score for r in L.lm_scores(docs, rounds=()).collect()}
    for r in L.lm_scores(docs, rounds=(((0, 1, 2, 3), 1e6),)).collect():
        assert r.score == pytest.approx(start[r.doc_id, r.n_tokens], abs=1e-4)


def test_score_equals_a_plain_loop(spark, docs, corpus, monkeypatch):
    """Token by token, with the start weights: state, class, word in class, and rare words by their counts."""
    monkeypatch.setattr(L, "KNOWN", 200)             # most words are joined
    rows = [(r[0], r[1]) for r in corpus if len(r[1] or "") < 2000]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.score for r in L.lm_scores(table, rounds=()).collect()}
    own = {i: tokens(t) for i, t in rows}
    c = Counter(w for i, t in own.items() if zlib.crc32(str(i).encode()) % 10 for w in t)
    tails = np.zeros((G.TAILS, 2))
    for w, k in c.items():
        tails[L.tail_of(w)] += (k, k == 1)
    few = sorted(c.values(), reverse=True)
    least = few[200] + 1                              # words that often or more are in the table
    known = [w for w in c if c[w] >= least or w == b""]
    v = L.Vocabulary(known, [c[w] for w in known], sum(c.values()), len(c), tails[:, 0].tolist(), tails[:, 1].tolist())
    v.tables()
    p = v.start()
    sig = lambda x: 1 / (1 + np.exp(-x))
    for i, words in own.items():
        h, before, total = np.zeros(G.HIDDEN), v.words.index(b""), 0.0
        for w in words:
            x = p["x"][before].astype(float)
            g = h @ p["u"]
            z, r = sig(x[:12] + g[:12]), sig(x[12:24] + g[12:24])
            new = np.tanh(x[24:] + r * g[24:])
            h = new + z * (h - new)
            rank = v.lookup[w]
            head = 0 <= rank < v.heads
            tail = L.tail_of(w)
            cls = rank // G.WIDTH if head else G.HEADS + tail
            logit = h @ p["wc"] + p["bc"]
            total += logit[cls] - np.log(np.exp(logit).sum())
            if head:
                e = h @ p["ww"][cls] + p["bw"][cls]
                total += e[rank % G.WIDTH] - np.log(np.exp(e).sum())
            elif w in c:
                total += math.log((1 - v.unknown[tail]) * c[w] / max(v.tail_total[tail], 1))
            else:
                total += math.log(v.unknown[tail])
            before = rank if head else G.FREQUENT + tail
        assert got[i] == pytest.approx(total / math.log(10), rel=1e-4, abs=1e-3)


def test_small_table_changes_nothing(spark, docs, corpus, monkeypatch):
    whole = {r.doc_id: (r.n_known, r.base_score) for r in L.lm_scores(docs).collect()}
    monkeypatch.setattr(L, "KNOWN", 30)
    for r in L.lm_scores(docs).collect():
        assert r.n_known == whole[r.doc_id][0] and r.base_score == pytest.approx(whole[r.doc_id][1], abs=1e-6)
    want = brute([(r[0], r[1]) for r in corpus])
    assert all(v[1] == pytest.approx(want[i][4], abs=1e-6) for i, v in whole.items())


def test_probabilities_of_next_words_sum_to_one():
    counts = Counter({f"w{i}".encode(): 1 + 5000 // (i + 1) for i in range(4000)}) + Counter({b"": 500})
    tails = [[0, 0] for _ in range(G.TAILS)]
    for w, c in counts.items():
        tails[L.tail_of(w)][0] += c
        tails[L.tail_of(w)][1] += c == 1
    v = L.Vocabulary(list(counts), list(counts.values()), sum(counts.values()), len(counts),
                     [t[0] for t in tails], [t[1] for t in tails])
    v.tables()
    rng = np.random.default_rng(0)
    p = {k: x + rng.normal(0, .3, x.shape).astype(np.float32) for k, x in v.start().items()}
    before = v.inputs(v.ranks([b"w3", b"w900", b"nowhere"]))
    total = 0.0
    every = [*v.words, *(f"unk{k}".encode() for k in range(3000))]
    seen = set()
    for w in every:
        r = int(v.ranks([w])[0])
        if r < 0 and r in seen:
            continue  # one unknown word per tail stands for all
        seen.add(r) if r < 0 else None
        ids = np.append(before, v.inputs(np.array([r]))).astype(np.int32)
        log = [G.score(p, G.Lanes.deal([x], int(v.input[v.lookup[b""]])), 1)[0] for x in (ids[:-1], ids)]
        share = 10 ** v.share[r] if r >= 0 else v.unknown[-1 - r]
        total += math.exp(log[1] - log[0]) * share
    assert total == pytest.approx(1.0, abs=2e-3)


def test_gradients_by_differences(monkeypatch):
    rng = np.random.default_rng(0)
    lanes = G.Lanes.deal([rng.integers(0, G.INPUTS, n).astype(np.int32) for n in (3, 5, 9, 2)], 0, lanes=3)
    p, got = {k: rng.normal(0, .3, s) for k, s in G._SHAPES.items()}, {}
    monkeypatch.setattr(G, "WINDOW", 50)

    def note(self, k, grad, rows=slice(None)):
        got.setdefault(k, np.zeros_like(self.p[k]))[rows] += grad
    monkeypatch.setattr(G.Trainer, "_move", note)
    G.Trainer(p, .1).run(lanes)
    base = -G.score(p, lanes, 4).sum()
    for k in p:
        at = np.unravel_index(np.argsort(-np.abs(got[k]).ravel())[:5], p[k].shape)
        for i in zip(*at, strict=True):
            q = {a: b.copy() for a, b in p.items()}
            q[k][i] += 1e-5
            assert (-G.score(q, lanes, 4).sum() - base) / 1e-5 == pytest.approx(got[k][i], abs=1e-2)


def test_state_is_carried_and_lanes_do_not_matter():
    rng = np.random.default_rng(1)
    docs = [rng.integers(0, G.INPUTS, n).astype(np.int32) for n in (200, 1, 37, 90, 5, 5)]
    p = {k: rng.normal(0, .3, s).astype(np.float32) for k, s in G._SHAPES.items()}
    alone = [G.score(p, G.Lanes.deal([d], 0), 1)[0] for d in docs]
    assert np.allclose(G.score(p, G.Lanes.deal(docs, 0, lanes=3), len(docs), slab=7), alone, rtol=1e-4)


def test_model_has_its_whole_size():
    """Speed is not bought with a smaller model."""
    assert G.HIDDEN >= 12 and G.HEADS >= 16 and G.TAILS >= 48 and G.FREQUENT >= 768
    v = L.Vocabulary([b""], [1], 1, 1, [1] + [0] * (G.TAILS - 1), [0] * G.TAILS)
    p = v.start()
    assert p["u"].shape[0] >= 12 and p["wc"].shape[1] >= 64


def test_odd_rows(spark, odd, nothing):
    out = L.lm_scores(odd).collect()
    assert len(out) == odd.count() and all(r.n_tokens >= 1 for r in out)
    assert L.lm_scores(nothing).count() == 0
    one = [i for i in range(50) if zlib.crc32(str(i).encode()) % 10 == 0][:2]
    rows = [(i, "only held out text") for i in one]
    for r in L.lm_scores(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) == (True, 5, 0, 0, 0.0, 0.0)
