"""Packing: every id in exactly one piece, gapless full windows, balanced groups, exact ids."""
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from cdmspark.llm import packing as P


def check(spark, rows, out):
    exact = P.encoders(P.tokenizer_path())[0]
    pieces, windows = defaultdict(list), defaultdict(list)
    for r in out.collect():
        pieces[r.doc_id].append(r)
        windows[r.sequence_id].append(r)
    want = {i: np.array([*exact.encode(t or "", add_special_tokens=False).ids, P.END], "<u4") for i, t in rows}
    assert set(pieces) == set(want)
    for i, own in pieces.items():
        at = 0
        for r in sorted(own, key=lambda r: r.start):
            assert r.start == at and r.length > 0 and r.doc_tokens == len(want[i])
            assert r.ids_crc32 == zlib.crc32(want[i][at:at + r.length].tobytes())
            at += r.length
        assert at == len(want[i])
    cost, tokens = defaultdict(int), defaultdict(int)
    for own in windows.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at == own[0].window and at & (at - 1) == 0 and at <= 2048
        assert len({(r.window, r.step_group) for r in own}) == 1
        tokens[own[0].step_group] += at
    return windows, tokens, cost


def test_pieces_and_windows(spark, docs, corpus):
    rows = [(r[0], r[1]) for r in corpus]
    windows, tokens, _ = check(spark, rows, P.pack(docs))
    assert max(tokens.values()) <= P.STEP_TOKENS
    short = [w for w in windows.values() if w[0].window < P.TIERS[0]]
    assert len(short) <= 8 * docs.rdd.getNumPartitions()


def test_many_documents_fill_tiers(spark, monkeypatch):
    rng = random.Random(2)
    rows = [(i, " ".join(f"word{rng.randrange(50)}" for _ in range(int(rng.paretovariate(0.7) * 20) % 6000))) for i in range(1500)]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    windows, tokens, _ = check(spark, rows, P.pack(df))
    by = defaultdict(int)
    for w in windows.values():
        by[w[0].window] += 1
    assert set(P.TIERS) <= set(by) and sum(n for s, n in by.items() if s < P.TIERS[0]) <= 8
    cuts = sum(len(w) for w in windows.values()) - len(rows)
    assert cuts <= len(windows)  # one cut a window at most
    full = [n for n in tokens.values() if n == P.STEP_TOKENS]
    assert len(full) >= 0.7 * len(tokens)


@pytest.mark.parametrize("text", ["", " ", "a", "<|endoftext|>", "x<|endoftext|>y  ", "\n\n \t", "é😀 中 文", "'ll I'LL",
                                  "1234567 89", " " * 5000, "a" * 20000, "ab " * 30000, "\x00\x01", "  x"])
def test_encoders_agree(text):
    P.encode(text, P.tokenizer_path(), compare=True)
    assert P.encoders(P.tokenizer_path())[1] is not None


def test_odd_rows(spark, odd, nothing):
    out = P.pack(odd)
    assert out.groupBy().sum("length").first()[0] == sum(
        r.doc_tokens for r in out.filter("start = 0").collect())
    assert out.filter("start = 0").count() == odd.count()
    assert out.filter("doc_id is null and doc_tokens = 1").count() >= 1
    assert P.pack(nothing).count() == 0
