"""Language ID: held-out accuracy on the documents, codeword distances, noise, odd rows."""
import numpy as np
import pytest

from cdmspark.llm import lang_id as L


@pytest.fixture(scope="module")
def labelled(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


def test_held_out_accuracy(labelled):
    got = L.identify(labelled).join(labelled.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert len(got) > 200
    assert sum(r.lang_pred == r.lang for r in got) / len(got) > 0.98
    assert all(0 <= r.score <= 1 for r in got)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 6, 9, 20])
def test_codewords(n):
    code = L.codewords(n)
    assert code.shape[0] == n and set(np.unique(code)) <= {-1, 1}
    if n > 1:
        apart = (code[:, None, :] != code[None, :, :]).sum(2)[np.triu_indices(n, 1)]
        assert apart.min() >= (1 if n < 4 else 3)


def test_decoding_corrects_a_wrong_bit(labelled):
    model = L.learn(labelled)
    texts = [r.text for r in labelled.limit(60).collect()]
    before = [model.predict(t)[0] for t in texts]
    model.weight[:, 0] *= -1
    model.bias[0] *= -1
    assert sum(model.predict(t)[0] == b for t, b in zip(texts, before, strict=True)) >= 57


def test_learns_from_the_right_rows_only(spark):
    from pyspark.sql import functions as F
    from cdmspark.llm.common import crc_remainder
    base = [(i, "aaa bbb aab" if i % 2 else "xxx yyy xxy", "la" if i % 2 else "lx") for i in range(200)]
    df = spark.createDataFrame(base, "doc_id long, text string, lang string")
    turned = df.withColumn("lang", F.when(crc_remainder(F.col("doc_id"), 4) == 2, F.when(F.col("lang") == "la", "lx").otherwise("la"))
                           .otherwise(F.col("lang")))
    got = {r.doc_id: r.lang_pred for r in L.identify(turned).collect()}
    assert got == {i: lang for i, _, lang in base}


def test_odd_rows(spark, odd, nothing):
    out = {(r.doc_id, r.lang_pred, r.score) for r in L.identify(odd).collect()}
    assert (2, "und", 0.0) in out and (3, "und", 0.0) in out and len({x[0] for x in out}) == 5
    assert L.identify(nothing).count() == 0 and L.keep_identified(nothing).count() == 0
    none = spark.createDataFrame([(1, "some text", None), (2, "12 34", None)], "doc_id long, text string, lang string")
    assert {r.lang_pred for r in L.identify(none).collect()} == {"und"}
    assert L.keep_identified(none).count() == 2
    assert L.keep_identified(odd).columns == odd.columns


def test_stage_drops_texts_without_a_language(spark, labelled):
    junk = spark.createDataFrame([(10**6, "123 456 !!!", "en", "s", 1), (10**6 + 1, None, "en", "s", 1)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    out = L.keep_identified(labelled.unionByName(junk))
    assert out.filter("doc_id >= 1000000").count() == 0
    assert out.count() >= 0.99 * labelled.count()
