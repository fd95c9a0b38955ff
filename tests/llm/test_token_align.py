"""Alignment of two tokenizers: pointer jumping and corpus counts against plain loops."""
import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from tokenizers import Tokenizer

from cdmspark.llm import token_align as A
from cdmspark.llm.packing import _byte_of_char

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def plain():
    exact = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    exact.encode_special_tokens = True
    lib = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    at = _byte_of_char()

    def tokens(text):
        if not text:
            return [], []
        e = exact.encode(" " + text, add_special_tokens=False)
        a = [(i, bytes(at[c] for c in t)) for i, t in zip(e.ids, e.tokens, strict=True)]
        b = [(i, bytes([i - lib.piece_to_id("<0x00>")]) if lib.is_byte(i) else lib.id_to_piece(i).replace("▁", " ").encode())
             for i in lib.encode(text)]
        raw = (" " + text).encode()
        return (a, b) if b"".join(x for _, x in a) == raw == b"".join(x for _, x in b) else ([], [])
    return tokens


def brute(rows, tokens):
    """Per row: n_a, n_b, n_groups, n_links, n_best, count_sum, digest."""
    docs, count = [], Counter()
    for _, text in rows:
        spans = []
        for side in tokens(text):
            at, own = 0, []
            for i, raw in side:
                own.append((i, at, at + len(raw)))
                at += len(raw)
            spans.append(own)
        a, b = spans
        cuts = sorted({e for *_, e in a} & {e for *_, e in b})
        ga, gb = defaultdict(list), defaultdict(list)
        for own, into in ((a, ga), (b, gb)):
            k = 0
            for i, _, e in own:
                while e > cuts[k]:
                    k += 1
                into[k].append(str(i))
        links, lo = [], 0
        for i, s, e in a:
            while b[lo][2] <= s:
                lo += 1
            j = lo
            while j < len(b) and b[j][1] < e:
                links.append((i, b[j][0]))
                j += 1
        count.update(set(links))
        s = ";".join(f"{','.join(ga[k])}|{','.join(gb[k])}" for k in range(len(cuts)))
        docs.append((len(a), len(b), len(cuts), links, hashlib.sha256(s.encode()).hexdigest() if s else ""))
    top = defaultdict(int)
    for (i, _), n in count.items():
        top[i] = max(top[i], n)
    return sorted(((i, na, nb, ng, len(ln), sum(count[x] == top[x[0]] for x in ln), sum(count[x] for x in ln), d)
                   for (i, _), (na, nb, ng, ln, d) in zip(rows, docs, strict=True)), key=str)


def got(df):
    return sorted(((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256)
                   for r in df.collect()), key=str)


def test_whole_table_equals_brute_force(spark, plain):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert got(A.op12_token_align(spark, SF)) == brute(rows, plain)


@pytest.mark.parametrize("known, together, counted", [(1 << 19, 1 << 20, 2_000_000), (50, 3000, 100), (0, 1, 1)])
def test_small_tables_and_parts_change_nothing(spark, docs, corpus, plain, monkeypatch, known, together, counted):
    for k, v in (("KNOWN", known), ("TOGETHER", together), ("COUNTED", counted)):
        monkeypatch.setattr(A, k, v)
    assert got(A.align(docs)) == brute([(r[0], r[1]) for r in corpus], plain)


def test_texts_of_all_kinds(spark, plain):
    texts = ["a", " ", "  two  spaces ", "naïve façade — ünïcödé", "日本語のテキスト", "😀👩‍👩‍👧‍👦 emoji", "<|endoftext|> and <s> </s> <unk>",
             "a▁b", "tab\tand\nline\r\n", "\x00nul", "ﬁ ligature Å Å", "١٢٣ 456", "x" * 3000, "ab " * 2000, "　wide", "", None]
    rows = [(i, t) for i, t in enumerate(texts)]
    out = got(A.align(spark.createDataFrame(rows, "doc_id long, text string")))
    assert out == brute(rows, plain)
    by = {r[0]: r for r in out}
    assert by[7][1:] == (0, 0, 0, 0, 0, 0, "") == by[15][1:] == by[16][1:] and by[6][1] > 0


def test_pointer_jumping_on_random_cuts():
    rng = np.random.default_rng(3)
    for n in (1, 2, 30, 4000):
        total = n * 3
        a, b = (np.unique(np.append(rng.integers(1, total + 1, n), total)) for _ in range(2))
        ga, gb, groups = A.groups_of(a, b)
        cuts = np.intersect1d(a, b)
        assert groups == len(cuts)
        assert (ga == np.searchsorted(cuts, a)).all() and (gb == np.searchsorted(cuts, b)).all()
    a = np.arange(2, 20002, 2)                         # one chain through the whole text
    b = np.append(np.arange(1, 20000, 2), 20000)
    ga, gb, groups = A.groups_of(a, b)
    assert groups == 1 and not ga.any() and not gb.any()
    assert [x.tolist() if hasattr(x, "tolist") else x for x in A.groups_of(a[:0], b[:0])] == [[], [], 0]


def test_groups_cover_the_text(spark):
    text = "Unbelievable tokenization — naïve"
    row = A.token_groups(spark.createDataFrame([(1, text), (2, None)], "doc_id long, text string")).collect()
    assert row[1].groups == [] and row[0].groups[0].start == 0 and row[0].groups[-1].end == len((" " + text).encode())
    assert all(x.end == y.start for x, y in zip(row[0].groups, row[0].groups[1:], strict=False))


def test_odd_rows(spark, odd, nothing, plain):
    assert got(A.align(odd)) == brute([(r.doc_id, r.text) for r in odd.collect()], plain)
    assert A.align(nothing).count() == 0 and A.token_groups(nothing).count() == 0
