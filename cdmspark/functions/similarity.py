"""Similarity scores.

Cosine is native (``aggregate`` over ``zip_with``).  The edit-ratio score follows the
common fuzzy-matching convention: both strings cleaned (lower case, anything but
letters and digits to a blank, trimmed), equal strings score 100, an empty string
scores 0, otherwise ``round(100 * 2M / T)`` with ``difflib``'s matching-block count M
(argument order: source, then concept).  Only the pair scoring runs in Python, in an
Arrow-batched pandas UDF.
"""

from __future__ import annotations

import difflib
import re
from collections import Counter

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NON_WORD = re.compile(r"(?ui)\W")


def clean_py(s: str | None) -> str | None:
    if s is None:
        return None
    return _NON_WORD.sub(" ", s).lower().strip()


def ratio_py(a: str | None, b: str | None) -> int:
    """Score of two already-cleaned strings."""
    if a is None or b is None:
        return 0
    if a == b:
        return 100
    if not a or not b:
        return 0
    return int(round(100 * difflib.SequenceMatcher(None, a, b).ratio()))


def ratio_upper_bound(a: str, b: str) -> float:
    """Lossless bound on 100 * 2M / T from shared characters (M <= multiset overlap)."""
    t = len(a) + len(b)
    if t == 0:
        return 100.0
    return 100.0 * 2 * sum((Counter(a) & Counter(b)).values()) / t


@F.pandas_udf(T.IntegerType())
def fuzz_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """H16 over pair columns (raw strings; cleaned here)."""
    return pd.Series([ratio_py(clean_py(x), clean_py(y)) for x, y in zip(a, b)], dtype="int32")


def cosine(a, b) -> Column:
    """Cosine of two numeric arrays, native; NULL if either norm is 0."""
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    dot = F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0),
                      lambda acc, x: acc + x)
    na = F.sqrt(F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))
    nb = F.sqrt(F.aggregate(b, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))
    return F.when((na > 0) & (nb > 0), dot / (na * nb))
