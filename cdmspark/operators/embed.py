"""Text -> vector providers.

Default provider: hashed character trigrams of the normalised text, counted.  It is
computed with native array functions (no UDF), deterministic on every executor, and
simple enough that the SQL oracle can recompute it: the bucket of a trigram is ``(c1 * 37^2 + c2 * 37 + c3) mod dim`` over the code points of its letters.

Other providers plug in with the same contract (``DataFrame`` with a text column in,
an ``array<double>`` column out): a precomputed vector column, or a user's iterator
pandas UDF that loads its model once per worker process.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import preprocess_text

DIM = 512
_P1, _P2 = 37 * 37, 37


def trigram_buckets(text: Column, dim: int = DIM) -> Column:
    """array<int> of the trigram buckets of `` text `` (padded with one blank each side)."""
    t = F.concat(F.lit(" "), text, F.lit(" "))
    n = F.length(t) - 2

    def bucket(i):
        return F.pmod(F.ascii(F.substring(t, i, 1)) * _P1 + F.ascii(F.substring(t, i + 1, 1)) * _P2
                      + F.ascii(F.substring(t, i + 2, 1)), F.lit(dim))

    return F.when(F.length(text) > 0, F.transform(F.sequence(F.lit(1), n), bucket)).otherwise(
        F.array().cast("array<int>"))


def dense_counts(buckets: Column, dim: int = DIM) -> Column:
    """array<double> of length ``dim`` counting each bucket (for short texts: names, codes)."""
    return F.transform(F.sequence(F.lit(0), F.lit(dim - 1)),
                       lambda b: F.size(F.filter(buckets, lambda x: x == b)).cast("double"))


def trigram_vector(text_col, dim: int = DIM, preprocess: bool = True) -> Column:
    """Dense trigram counts (integers held as doubles); NULL for an empty text.  For
    short texts only: it costs O(length x dim) interpreted lambda calls per row."""
    c = F.col(text_col) if isinstance(text_col, str) else text_col
    t = preprocess_text(c) if preprocess else F.coalesce(c, F.lit(""))
    return F.when(F.length(t) > 0, dense_counts(trigram_buckets(t, dim), dim))


def trigram_bag(text_col, dim: int = DIM, preprocess: bool = True) -> Column:
    """The default embedding as a bag of bucket ids (``array<int>``, one per trigram);
    NULL for an empty text.  O(length) native work per row; the scorer turns bags into
    count vectors with ``numpy.bincount``, so cosine needs no normalisation step and
    every score is an exact integer dot product over correctly rounded norms."""
    c = F.col(text_col) if isinstance(text_col, str) else text_col
    t = preprocess_text(c) if preprocess else F.coalesce(c, F.lit(""))
    return F.when(F.length(t) > 0, trigram_buckets(t, dim))


def trigram_weights(df: DataFrame, key: str, text_col: str, dim: int = DIM) -> DataFrame:
    """Sparse form (key, bucket, weight) of the default embedding: explode + count, so
    long texts cost O(length), not O(length x dim)."""
    g = df.select(key, F.explode(trigram_buckets(preprocess_text(F.col(text_col)), dim)).alias("bucket"))
    counts = g.groupBy(key, "bucket").agg(F.count(F.lit(1)).cast("double").alias("w"))
    from pyspark.sql import Window
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(key)))
    return counts.select(key, "bucket", (F.col("w") / norm).alias("weight"))


Provider = Callable[[Column], Column]


def embed(df: DataFrame, text_col: str, out: str = "vec", provider: Provider | None = None) -> DataFrame:
    """Add an ``array<double>`` embedding of ``text_col``."""
    fn = provider or trigram_vector
    return df.withColumn(out, fn(F.col(text_col)))


@dataclass(frozen=True)
class Model:
    """A provider with the cut-off that suits its scores, and whether it gives bags of
    ``bag_dim`` buckets rather than vectors."""

    provider: Provider
    threshold: float


_MODELS: dict[str, Callable[[], Model]] = {}


def register_model(name: str, make: Callable[[], Model]) -> None:
    """M2: make a model known by name; ``make`` runs when the model is asked for."""
    if name in _MODELS:
        raise ValueError(f"a model {name!r} is registered already")
    _MODELS[name] = make


def model(name: str) -> Model:
    """The model of that name.  Like a config value, the name can come from outside."""
    try:
        make = _MODELS[name]
    except KeyError:
        raise ValueError(f"unknown model {name!r}; one of {sorted(_MODELS)}") from None
    return make()


def models() -> list[str]:
    return sorted(_MODELS)


def loaded_once(load: Callable[[], Callable[[pd.Series], list]]) -> Provider:
    """A provider around a model that has to be loaded: ``load`` runs once per task, before its
    first batch, and returns what turns a series of texts into vectors; null texts have none."""
    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def embed_texts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = None
        for texts in batches:
            encode = encode or load()
            out = pd.Series([None] * len(texts), dtype=object)
            there = texts.notna().to_numpy()
            if there.any():
                out[there] = pd.Series(list(encode(texts[there])), index=out.index[there], dtype=object)
            yield out
    return lambda text: embed_texts(text)


WORD_DIM = 256


def _word_model() -> Callable[[pd.Series], list]:
    """Counts of hashed words: a word's bucket is the sum of its code points times their place.
    Buckets of words seen are remembered as long as the task lives."""
    seen: dict[str, int] = {}

    def bucket(word: str) -> int:
        if word not in seen:
            seen[word] = sum(ord(c) * i for i, c in enumerate(word, 1)) % WORD_DIM
        return seen[word]
    return lambda texts: [np.bincount([bucket(w) for w in t.split(" ") if w] or [0], minlength=WORD_DIM).astype(float)
                          * bool(t.strip(" ")) for t in texts]


def trigram_bags(dim: int) -> Provider:
    """The default embedding over ``dim`` buckets of its own, as bags that only the scorer makes
    dense; for texts that are normalised already."""
    def provider(text: Column) -> Column:
        return trigram_bag(text, dim, preprocess=False)
    provider.bag_dim = dim
    return provider


def precomputed(vector_col: str) -> Provider:
    """Provider for a vector column already in the data."""
    return lambda _c: F.transform(F.col(vector_col), lambda x: x.cast("double"))


register_model("trigrams", lambda: Model(trigram_bags(DIM), 0.7))
register_model("words", lambda: Model(loaded_once(_word_model), 0.6))
