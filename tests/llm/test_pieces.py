"""SentencePiece: own agenda and decoder against the library, whole texts, and odd rows."""
import hashlib
import random

import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from cdmspark.llm import pieces as S

MODEL = S.load(S.model_path())
LIB = sentencepiece.SentencePieceProcessor(model_file=S.model_path())


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \t\n▁aethinsd.,<>/0xé中😀　 \x00�"), st.characters(
    exclude_categories=["Cs"])), max_size=60))
def test_equals_the_library(text):
    (ids, n, decoded), = MODEL.encode_texts([text])
    want = LIB.encode(text)
    assert ids == ",".join(map(str, want)) and n == len(want) and decoded == LIB.decode(want)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 31999)), max_size=20))
def test_decoding_any_ids(ids):
    assert MODEL.decode(ids) == LIB.decode(ids)


def test_both_agendas_agree():
    rng = random.Random(3)
    for _ in range(500):
        chunk = "".join(rng.choice("▁etaoinshr.") for _ in range(rng.randrange(1, 200)))
        assert MODEL._merge_short(chunk) == MODEL._merge_long(chunk)


def test_query_columns(docs, corpus):
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    got = {r.doc_id: r for r in S.encode_decode(docs, with_text=True).collect()}
    for i, text, *_ in corpus:
        ids = LIB.encode(text or "")
        assert got[i].ids == ids and got[i].n_tokens == len(ids) and got[i].decoded == LIB.decode(ids)
        assert got[i].ids_sha256 == sha(",".join(map(str, ids))) and got[i].decoded_sha256 == sha(got[i].decoded)


def test_odd_rows_and_a_small_memory(odd, nothing, monkeypatch):
    assert S.encode_decode(odd).count() == odd.count()
    assert S.encode_decode(odd).filter("n_tokens = 0").count() == 3
    assert S.encode_decode(nothing).count() == 0
    monkeypatch.setattr(S, "REMEMBERED", 3)
    model = S.PieceModel(S.model_path())
    for t in ("one two three four five", "six seven eight", "one " + "y" * 100, "one two"):
        assert next(model.encode_texts([t]))[0] == ",".join(map(str, LIB.encode(t)))
    assert "y" * 100 not in "".join(model.memory)
