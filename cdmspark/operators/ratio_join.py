"""Candidate pairs for the edit ratio ``2 M / (la + lb)`` (C15) without blocks of all pairs.

M counts characters in matching blocks, in the same order in both strings.  For a ratio of
``need`` two strings of lengths la and lb must match in ``M >= need (la + lb) / 2`` characters,
which bounds three things, all of them without losing a pair:

* the length: M is at most the shorter length, so lb lies in a band around la;
* the characters: both hold at least M of the same (a multiset);
* the pairs of neighbours: between two blocks at least one character of a string is left out,
  so there are at most ``la + lb - 2 M + 1`` blocks, and a block of n characters holds n - 1
  pairs: the strings share at least ``3 M - la - lb - 1`` of them.

Pairs of neighbours (characters, where strings are too short for that bound) are numbered by
occurrence, which makes the multisets sets, and ordered rarest first.  Two sets that share at
least ``n`` tokens share one among the first ``size - n + 1`` of each, so only those prefixes
are joined, on (length class, token).  Whoever meets is checked against all three bounds; only
what is left is scored.  Everything up to there is native.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import persist_reliably

_EPS = 1e-9


def _numbered(tokens: Column) -> Column:
    """Sorted tokens, each with the number of its occurrence."""
    t = F.array_sort(tokens)
    return F.transform(t, lambda x, i: F.concat(x, F.lit("\x00"), (i - F.array_position(t, x) + 1).cast("string")))


def _cut(text: Column, width: int) -> Column:
    last = F.length(text) - (width - 1)
    parts = F.transform(F.sequence(F.lit(1), last), lambda i: F.substring(text, i, F.lit(width)))
    return F.when(last >= 1, _numbered(parts)).otherwise(F.array().cast("array<string>"))


def _least_length(need: float) -> int | None:
    """The length from which strings surely share a pair of neighbours with any partner."""
    grow, ratio = 1.5 * need - 1, need / (2 - need)
    if grow <= 0:
        return None
    return next((n for n in range(1, 100_000) if grow * (n + math.ceil(n * ratio - _EPS)) - 1 > _EPS), None)


def _with_tokens(df: DataFrame, text: str) -> DataFrame:
    return persist_reliably(df.select(F.col(text).alias("t")).where(F.length("t") > 0).distinct().select(
        "t", F.length("t").alias("n"), _cut(F.col("t"), 1).alias("chars"), _cut(F.col("t"), 2).alias("twos")))


def ratio_pairs(srcs: DataFrame, src_col: str, names: DataFrame, name_col: str, need: float) -> DataFrame:
    """Distinct (a, b) of cleaned texts that may reach ``need`` (over 0, up to 1); no pair that
    does is left out.  Empty texts are left to the caller."""
    if not 0 < need <= 1:
        raise ValueError("the ratio must lie in (0, 1]")
    ratio, grow, least = need / (2 - need), 1.5 * need - 1, _least_length(need)
    sides = {"a": _with_tokens(srcs, src_col), "b": _with_tokens(names, name_col)}
    n = F.col("n")
    low, high = F.ceil(n * ratio - _EPS), F.floor(n / ratio + _EPS)
    # classes of lengths, each a band wide
    grade = (lambda x: F.floor(F.log(x.cast("double")) / -math.log(ratio))) if ratio < 1 else (lambda x: x.cast("long"))
    short = n < least if least else F.lit(True)                    # or has a partner that is
    kinds = [("chars", F.lit(True) if least is None else low < least, F.ceil((n + low) * (need / 2) - _EPS)),
             ("twos", ~short, F.ceil((n + low) * grow - 1 - _EPS))]

    def prefix(side: str, kind: str, wanted: Column, shared: Column, held_by: DataFrame, spread: bool) -> DataFrame:
        x = sides[side].where(wanted).select("t", "n", shared.alias("k"), F.size(kind).alias("size"),
                                             F.explode(kind).alias("token"), low.alias("low"), high.alias("high"))
        x = x.join(held_by, "token", "left")
        first = x.groupBy("t").agg(F.sort_array(F.collect_list(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "token"))).alias("o"),
                                   *[F.first(c).alias(c) for c in ("n", "k", "size", "low", "high")])
        classes = F.sequence(grade(F.greatest("low", F.lit(1))), grade(F.col("high"))) if spread else F.array(grade(n))
        first = first.select("t", "n", "low", "high", F.explode(classes).alias("grade"), "o", (F.col("size") - F.col("k") + 1).alias("keep"))
        return first.select(F.col("t").alias(side), F.col("n").alias(f"n_{side}"), "low", "high", "grade",
                            F.explode(F.slice("o", 1, F.greatest("keep", F.lit(1)).cast("int"))).alias("e")).select(
            side, f"n_{side}", *(["low", "high"] if spread else []), "grade", F.col("e.token").alias("token"))

    found = None
    for kind, wanted, shared in kinds:
        if kind == "twos" and least is None:
            continue
        held_by = sides["b"].select(F.explode(kind).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("df"))
        met = prefix("a", kind, wanted, shared, held_by, True).join(prefix("b", kind, wanted, shared, held_by, False), ["grade", "token"])
        pairs = met.where((F.col("n_b") >= F.col("low")) & (F.col("n_b") <= F.col("high"))).select("a", "b")
        found = pairs if found is None else found.union(pairs)
    full = found.distinct()
    for side in ("a", "b"):
        full = full.join(sides[side].select(F.col("t").alias(side), F.col("n").alias(f"n_{side}"),
                                            F.col("chars").alias(f"chars_{side}"), F.col("twos").alias(f"twos_{side}")), side)
    total = F.col("n_a") + F.col("n_b")
    match = F.ceil(total * (need / 2) - _EPS)
    common = lambda k: F.size(F.array_intersect(f"{k}_a", f"{k}_b"))
    return full.where((common("twos") >= 3 * match - total - 1) & (common("chars") >= match)).select("a", "b")
