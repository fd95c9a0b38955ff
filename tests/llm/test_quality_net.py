"""Quality classifier: convolution against plain loops, gradients, held-out accuracy, odd rows."""
import numpy as np
import pytest

from cdmspark.llm import byte_cnn as N
from cdmspark.llm import quality_net as Q

SF = "/root/testdata/sf0.01"
LABEL = "doc_id long, quality int, toxic int"


def plain_logit(p, raw):
    """Chunk by chunk and window by window."""
    tops, at = [], 0
    while True:
        chunk = list(raw[at:at + N.CHUNK]) + [N.PAD] * (N.CHUNK - len(raw[at:at + N.CHUNK]))
        z = [p["e"][chunk[i:i + N.WIDTH]].reshape(-1) @ p["w"] + p["b"] for i in range(N.CHUNK - N.WIDTH + 1)]
        tops.append(np.maximum(np.max(z, 0), 0))
        if at + N.CHUNK >= len(raw):
            break
        at += N.CHUNK - N.OVERLAP
    vector = np.concatenate([np.max(tops, 0), np.mean(tops, 0)])
    return float(np.maximum(vector @ p["v"] + p["c"], 0) @ p["o"] + p["bias"][0])


def test_equals_plain_loops():
    p = {k: np.random.default_rng(1).normal(0, .3, s).astype(np.float32) for k, s in N._SHAPES.items()}
    rng = np.random.default_rng(2)
    texts = [rng.integers(0, 256, n).astype(np.uint8).tobytes() for n in (0, 1, 7, 8, 255, 256, 257, 480, 481, 2000)]
    assert N.logits(p, texts) == pytest.approx([plain_logit(p, t) for t in texts], rel=1e-4, abs=1e-4)


@pytest.mark.parametrize("n", [0, 1, 31, 32, 33, 256, 257, 479, 480, 481, 5000])
def test_chunks_cover_every_window(n):
    raw = bytes(i % 251 for i in range(n))
    own = N.chunks_of(raw)
    hop = N.CHUNK - N.OVERLAP
    seen = {k * hop + i for k in range(len(own)) for i in range(N.CHUNK - N.WIDTH + 1)}
    assert set(range(max(0, n - N.WIDTH + 1))) <= seen
    for k, row in enumerate(own):
        part = raw[k * hop:k * hop + N.CHUNK]
        assert bytes(row[:len(part)].astype(np.uint8)) == part and (row[len(part):] == N.PAD).all()
    assert len(own) == 1 or (len(own) - 2) * hop + N.CHUNK < n


def test_gradients_by_differences():
    rng = np.random.default_rng(0)
    p = {k: rng.normal(0, .3, s) for k, s in N._SHAPES.items()}
    own = [N.chunks_of(rng.integers(0, 256, n).astype(np.uint8).tobytes()) for n in (40, 700, 0, 300)]
    chunks, size, label = np.concatenate(own), np.array([len(x) for x in own]), np.array([1, 0, 1, 0], np.float32)
    _, g = N.gradients(p, chunks, size, label)
    for k in p:
        flat = np.argsort(-np.abs(g[k]).ravel())[:6]
        for i in flat:
            at = np.unravel_index(i, p[k].shape)
            move = []
            for step in (1e-4, -1e-4):
                q = {a: b.copy() for a, b in p.items()}
                q[k][at] += step
                move.append(N.gradients(q, chunks, size, label)[0])
            assert (move[0] - move[1]) / 2e-4 == pytest.approx(g[k][at], rel=0.05, abs=2e-3), k


def test_held_out_accuracy_and_contract(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    rows = Q.op11_byte_cnn(spark, SF).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert all(r.predicted == int(r.score >= 0.7) for r in rows)
    truth = {r.doc_id: r.quality for r in labels.collect()}
    held = [(truth[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in truth]
    assert len(held) > 60 and sum(a == b for a, b in held) / len(held) > 0.9
    assert sum(b == 0 for a, b in held if a == 0) / sum(a == 0 for a, _ in held) > 0.7


def test_learns_from_the_right_rows_only(spark, monkeypatch):
    from pyspark.sql import functions as F

    from cdmspark.llm.common import crc_remainder
    monkeypatch.setattr(N, "STEPS", 60)
    docs = spark.createDataFrame([(i, ("good text here " if i % 2 else "@@##$$ !! ") * 5) for i in range(300)], "doc_id long, text string")
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"))
    turned = labels.withColumn("quality", F.when(crc_remainder(F.col("doc_id"), 4) == 2, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = ({r.doc_id: (r.score, r.predicted) for r in Q.quality_scores(docs, x).collect()} for x in (labels, turned))
    assert a == b and all(p == i % 2 for i, (_, p) in a.items())


def test_sample_is_bounded_and_deterministic(spark, monkeypatch):
    monkeypatch.setattr(N, "STEPS", 12)
    monkeypatch.setattr(Q, "SAMPLE_BYTES", 3000)
    docs = spark.createDataFrame([(i, f"{'word' if i % 3 else '####'} " * (5 + i % 40)) for i in range(400)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(400)], LABEL)
    one = Q.learn(docs, labels, sample=100)
    two = Q.learn(docs.repartition(7), labels.repartition(3), sample=100)
    assert all(np.array_equal(one.weights[k], two.weights[k]) for k in one.weights)
    monkeypatch.setattr(Q, "SAMPLE_BYTES", 1)          # one text of each label is learned from in any case
    assert Q.learn(docs, labels).weights is not None


def test_odd_rows(spark, odd, nothing, monkeypatch):
    monkeypatch.setattr(N, "STEPS", 20)
    label = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (None, 1, 1), (3, 1, None), (4, 1, 1), (2, None, 0), (5, 7, 0), (99, 0, 0)], LABEL)
    out = Q.quality_scores(odd, label).collect()
    assert len(out) == odd.count() and all(r.score is not None for r in out)
    assert len({r.score for r in out if r.doc_id == 2}) == 1            # null text: scored as empty
    assert {r.score for r in out if r.doc_id == 2} == {r.score for r in out if r.doc_id == 3}
    assert Q.quality_scores(nothing, label).count() == 0
    assert {r.score for r in Q.quality_scores(odd, label.limit(0)).collect()} == {0.5}
    assert {r.score for r in Q.quality_scores(odd, label.filter("quality = 1 AND doc_id > 2")).collect()} == {1.0}
