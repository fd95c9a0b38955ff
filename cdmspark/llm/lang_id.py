"""Language identification by error-correcting output codes.

Each language has a codeword of bits; one linear classifier on byte n-grams predicts each bit.
A text's language is the codeword with the least loss, the logistic losses of the bits
weighted by how reliable each classifier proved; a small lead over the second is ambiguous.

The classifiers are fitted on a bounded sample of labelled rows (``SAMPLE`` texts, spread
evenly over the languages, whole texts); every text is then predicted whole, in one pass with
no shuffle. Only the model, of fixed size, is broadcast.
"""

from __future__ import annotations

import itertools
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdmspark.llm.common import crc_remainder, or_null, read_table, struct_of

#: Labelled texts that the classifiers are fitted on, at most twice as many by chance.
SAMPLE = 1600
FEATURES, ORDERS = 1 << 13, (1, 2, 3, 4)
ROUNDS, RATE, MOMENTUM, SHRINK = 160, 8.0, 0.9, 1e-5
#: A best language whose probability is lower than this is ambiguous.
AMBIGUOUS_BELOW = 0.5
UNKNOWN = "und"

_LETTER = re.compile(r"[^\W\d_]")
#: ASCII other than letters becomes a space, so symbols and digits carry no evidence.
_PLAIN = bytes(b if b >= 0x80 or chr(b).isalpha() else 0x20 for b in range(256))
_RUN = re.compile(rb" {2,}")


def grams(text: str) -> np.ndarray:
    """Unit vector of square roots of the hashed n-gram counts."""
    raw = _RUN.sub(b" ", b" " + text.lower().encode("utf-8", "replace").translate(_PLAIN) + b" ")
    b = np.frombuffer(raw, np.uint8).astype(np.uint32)
    counts, h = np.zeros(FEATURES), np.zeros(len(b), np.uint32)
    for n in ORDERS:
        if len(b) < n:
            break
        h = h[:len(b) - n + 1] * np.uint32(0x01000193) + b[n - 1:] + np.uint32(1)
        mixed = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
        counts += np.bincount(mixed >> np.uint32(32 - 13), minlength=FEATURES)
    return np.sqrt(counts / max(1.0, counts.sum())).astype(np.float32)


def codewords(n: int) -> np.ndarray:
    """A row of +1/-1 bits per language: all splits of up to 5 languages, else random columns
    (fixed seed) of which the distinct ones whose rows lie farthest apart are kept."""
    if n <= 5:
        rows = [[1, *x] for x in itertools.product((1, -1), repeat=n - 1)]
        return np.array(rows[1:] or [[1]], np.int8).T
    rng, bits = np.random.default_rng(7), 8 + 4 * math.ceil(math.log2(n))
    best = None
    for _ in range(200):
        m = rng.choice(np.array([1, -1], np.int8), (n, bits))
        apart = (m[:, None, :] != m[None, :, :]).sum(2)[np.triu_indices(n, 1)].min()
        if (np.abs(m.sum(0)) < n).all() and (best is None or apart > best[0]):
            best = (apart, m)
    return best[1]


@dataclass
class Model:
    langs: list[str]
    code: np.ndarray
    weight: np.ndarray
    bias: np.ndarray
    trust: np.ndarray

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """(language, probability, ambiguous); without a letter or any language ``und``, 0."""
        if text is None or not self.langs or not _LETTER.search(text):
            return UNKNOWN, 0.0, False
        f = grams(text) @ self.weight + self.bias
        loss = (np.logaddexp(0, -self.code * f) * self.trust).sum(1)
        p = np.exp(loss.min() - loss)
        p /= p.sum()
        i = int(np.argmin(loss))
        return self.langs[i], float(p[i]), bool(p[i] < AMBIGUOUS_BELOW)


def fit(x: np.ndarray, labels: list[str]) -> Model:
    """Bit classifiers by gradient descent with momentum on logistic loss, languages weighing
    alike; the last fifth of the rows sets the trust in each bit."""
    langs = sorted(set(labels))
    if not langs:
        return Model([], *[np.zeros(0)] * 4)
    code = codewords(len(langs))
    y = code[[langs.index(v) for v in labels]].astype(np.float32)
    own = np.array([1 / labels.count(v) for v in langs])[[langs.index(v) for v in labels]].astype(np.float32)
    held = np.arange(len(labels)) % 5 == 4

    products = x @ x.T  # the weights stay sums of rows, so the descent runs on these sums

    def descend(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        k, t, g = products[np.ix_(rows, rows)], y[rows], own[rows, None] / own[rows].sum()
        a, v = np.zeros((int(rows.sum()), code.shape[1]), np.float32), 0
        b, u = np.zeros(code.shape[1], np.float32), 0
        for _ in range(ROUNDS):
            d = -t * g / (1 + np.exp(np.clip(t * (k @ a + b), -60, 60)))
            v = MOMENTUM * v - RATE * (d + SHRINK * a)
            u = MOMENTUM * u - RATE * 0.1 * d.sum(0)
            a, b = a + v, b + u
        return x[rows].T @ a, b

    w, b = descend(~held)
    wrong = ((np.sign(x[held] @ w + b) != y[held]).sum(0) + 1) / (held.sum() + 2)
    trust = np.clip(np.log((1 - wrong) / wrong) / 2, 0.05, None)
    return Model(langs, code, *descend(held | ~held), trust / trust.mean())


def _sample_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        yield pd.DataFrame({"lang": pdf["lang"], "key": pdf["key"],
                            "x": [grams(t).astype(np.float16).tobytes() for t in pdf["text"]]})


def learn(docs: DataFrame, sample: int = SAMPLE) -> Model:
    """Fits on rows of ``docs`` (text, lang, both there) whose crc32(doc_id) mod 4 is not 2. A
    row's hash decides whether it is in the sample, at a rate per language from its count."""
    rows = docs.select(or_null(docs, "doc_id", "long").alias("doc_id"), or_null(docs, "text", "string").alias("text"),
                       or_null(docs, "lang", "string").alias("lang"))
    rows = rows.filter((crc_remainder(F.col("doc_id"), 4) != 2) & F.col("lang").isNotNull()
                       & F.col("text").isNotNull() & (F.col("lang") != UNKNOWN))
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not counts:
        return fit(np.zeros((0, FEATURES), np.float32), [])
    each = max(4, sample // len(counts))
    rate = F.create_map(*[F.lit(v) for lang, n in counts.items() for v in (lang, min(1.0, each / n))])
    key = F.pmod(F.xxhash64("doc_id", F.lit("language sample")), F.lit(1 << 30))
    picked = (rows.withColumn("key", key).filter(F.col("key") < F.element_at(rate, F.col("lang")) * (1 << 30))
              .limit(2 * max(sample, 4 * len(counts))))
    got = picked.mapInPandas(_sample_rows, struct_of(lang=T.StringType(), key=T.LongType(), x=T.BinaryType())).collect()
    got.sort(key=lambda r: (r["key"], r["lang"], bytes(r["x"])))
    x = np.frombuffer(b"".join(bytes(r["x"]) for r in got), np.float16).astype(np.float32).reshape(len(got), FEATURES)
    return fit(x, [r["lang"] for r in got])


_RESULT = struct_of(lang=T.StringType(), score=T.DoubleType(), ambiguous=T.BooleanType())


def predictor(spark: SparkSession, model: Model):
    """Column function text -> struct(lang, score, ambiguous); the model's size is fixed."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf(_RESULT)
    def predict(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = shared.value
        for s in texts:
            yield pd.DataFrame([own.predict(t) for t in s], columns=["lang", "score", "ambiguous"])
    return predict


def identify(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, lang): doc_id, held_out, lang_pred, score,
    ambiguous. ``lang``, ``source`` and ``doc_id`` are never inputs of a prediction.

    Null texts and texts without a letter are ``und`` with score 0, as is everything where no
    row is labelled. A null id counts as remainder 0. Repeated rows are rows like any other;
    other columns are ignored; an empty table gives no rows."""
    model = model or learn(docs)
    base = docs.select(or_null(docs, "doc_id", "long").alias("doc_id"), or_null(docs, "text", "string").alias("text"))
    found = base.select("doc_id", (crc_remainder(F.col("doc_id"), 4) == 2).alias("held_out"),
                        predictor(docs.sparkSession, model)("text").alias("p"))
    return found.select("doc_id", "held_out", F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score"),
                        F.col("p.ambiguous").alias("ambiguous"))


def _accepted(p: Column) -> Column:
    return (p["lang"] != UNKNOWN) & ~p["ambiguous"]


def keep_identified(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose language is found and not ambiguous, with all their columns.
    Where no row is labelled nothing can be judged and all rows stay."""
    model = learn(docs)
    if not model.langs:
        return docs
    p = predictor(docs.sparkSession, model)(or_null(docs, "text", "string"))
    name = "__lang"
    while name in docs.columns:
        name += "_"
    return docs.withColumn(name, p).filter(_accepted(F.col(name))).select(*[f"`{c}`" for c in docs.columns])


def op6_lang_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(read_table(spark, sf_dir, "documents"))
