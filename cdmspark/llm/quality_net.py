"""Quality scores of whole documents by a byte-level convolutional network (``byte_cnn``).

The network learns in one task from a bounded sample of labelled whole texts, as many of one
label as of the other, chosen by the hash of their ids; its weights have a fixed size and are
broadcast. Scoring is one pass over all documents without a shuffle. The labels' share over all
labelled documents enters the logit, so a score is a probability on documents like those.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdmspark.llm import byte_cnn
from cdmspark.llm.common import crc_remainder, materialise, or_null, read_table, struct_of

#: Labelled texts to learn from (at most twice as many by chance), and their bytes together.
SAMPLE, SAMPLE_BYTES = 4000, 32_000_000
#: From this score on a document is predicted to be good.
GOOD = 0.7


@dataclass
class Model:
    """``weights`` is None where there is nothing to tell apart; then all scores are the share."""

    weights: dict | None
    good: int
    bad: int

    def scores(self, texts: list[bytes]) -> np.ndarray:
        if self.weights is None:
            n = self.good + self.bad
            return np.full(len(texts), self.good / n if n else 0.5)
        return 1 / (1 + np.exp(-np.clip(byte_cnn.logits(self.weights, texts) + math.log(self.good / self.bad), -60, 60)))


def _fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    rows = [r for pdf in batches for r in zip(pdf["key"], pdf["doc_id"], pdf["text"], pdf["quality"], strict=True)]
    rows.sort(key=lambda r: r[:2])
    if rows:
        p = byte_cnn.fit([_bytes(r[2]) for r in rows], np.array([r[3] for r in rows]))
        yield pd.DataFrame([{k: x.astype(np.float32).tobytes() for k, x in p.items()}])


def _bytes(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def learn(docs: DataFrame, labels: DataFrame, sample: int | None = None) -> Model:
    """Learns from the labelled rows whose crc32(doc_id) mod 4 is not 2. A document with several
    labels counts by the lowest, one with several texts by the first in order; labels other than
    0 and 1 and labels without a document don't count."""
    known = labels.select(or_null(labels, "doc_id", "long").alias("doc_id"), or_null(labels, "quality", "int").alias("quality"))
    known = (known.filter("doc_id IS NOT NULL AND quality IN (0, 1)").filter(crc_remainder(F.col("doc_id"), 4) != 2)
             .groupBy("doc_id").agg(F.min("quality").alias("quality")))
    count = {r["quality"]: r["count"] for r in known.groupBy("quality").count().collect()}
    good, bad = count.get(1, 0), count.get(0, 0)
    if not good or not bad:
        return Model(None, good, bad)
    each = (sample or SAMPLE) / 2
    rate = F.when(F.col("quality") == 1, min(1.0, each / good)).otherwise(min(1.0, each / bad))
    key = F.pmod(F.xxhash64("doc_id", F.lit("quality sample")), F.lit(1 << 30))
    picked = known.withColumn("key", key).filter(F.col("key") < rate * (1 << 30))     # at most 2 * SAMPLE ids by chance
    base = docs.select(or_null(docs, "doc_id", "long").alias("doc_id"),
                       F.coalesce(or_null(docs, "text", "string"), F.lit("")).alias("text"))
    texts = materialise(base.join(F.broadcast(picked), "doc_id").groupBy("doc_id", "key", "quality").agg(F.min("text").alias("text")),
                        "quality-sample")
    size = sorted((r["key"], r["n"], r["quality"]) for r in texts.select("key", "quality", F.octet_length("text").alias("n")).collect())
    if len({q for *_, q in size}) < 2:
        return Model(None, good, bad)
    # whole texts in order of their hash while they fit, but one of each label in any case
    fits = int(np.searchsorted(np.cumsum([n for _, n, _ in size]), SAMPLE_BYTES, side="right"))
    need = 1 + max(next(i for i, r in enumerate(size) if r[2] == q) for q in (0, 1))
    last = size[max(fits, need) - 1][0]
    kinds = struct_of(**{k: T.BinaryType() for k in byte_cnn._SHAPES})
    row = texts.filter(F.col("key") <= last).repartition(1).mapInPandas(_fit, kinds).collect()[0]
    return Model({k: np.frombuffer(row[k], np.float32).reshape(s) for k, s in byte_cnn._SHAPES.items()}, good, bad)


def _score(shared):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = shared.value
        for pdf in batches:
            for at in range(0, len(pdf), 256):
                part = pdf.iloc[at:at + 256]
                yield pd.DataFrame({"doc_id": part["doc_id"].array, "held_out": part["held_out"].to_numpy(),
                                    "score": model.scores([_bytes(t) for t in part["text"]])})
    return run


def quality_scores(docs: DataFrame, labels: DataFrame, model: Model | None = None) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, held_out, score, predicted. Labels, lang,
    source and doc_id are never inputs of a score.

    Null texts are empty and scored as such. A null id counts as remainder 0 and has no label.
    Repeated rows are rows like any other. Where one label or both are missing, every score is
    the share of label 1 (0.5 without labels). Other columns are ignored; an empty table gives
    no rows."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model or learn(docs, labels))
    base = docs.select(or_null(docs, "doc_id", "long").alias("doc_id"), (crc_remainder(F.col("doc_id"), 4) == 2).alias("held_out"),
                       F.coalesce(or_null(docs, "text", "string"), F.lit("")).alias("text"))
    scored = base.mapInPandas(_score(shared), struct_of(doc_id=T.LongType(), held_out=T.BooleanType(), score=T.DoubleType()))
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= GOOD).cast("int").alias("predicted"))


def op11_byte_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
