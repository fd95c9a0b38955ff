"""Best edit-ratio match of source values against concept names.

Exact, with lossless pruning and without materialising candidate pairs as rows:

1. Both sides are deduplicated on the cleaned text (the score only sees cleaned text).
2. A ratio of at least ``cutoff - 0.5`` needs ``2 * min(len) / (len_a + len_b)`` at least
   that much, so each source only meets candidates in a length band (binary search on
   the length-sorted candidates), then a shared-character bound, then ``difflib``.
3. Plans: the candidate names are size-checked and broadcast (source partitions scored in
   place); beyond the bound, pairs that may reach the cut-off are found by length and shared
   characters (``ratio_join``) and only they are scored.  A cut-off of 0, which nothing can
   miss, has both sides hash-blocked and met in co-group tasks.

Ties: higher score, then the candidate whose original name sorts first, then for that
name the highest concept id.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.similarity import clean_py, ratio_py, ratio_upper_bound
from ..functions.text import full_process
from .ratio_join import ratio_pairs

MAX_BROADCAST_BYTES = 128 * 1024 * 1024
BLOCK_ROWS = 20_000          # candidate names per block in the blocked plan
SRC_BLOCK_ROWS = 200_000     # distinct source values per block

_OUT = T.StructType([T.StructField("clean_src", T.StringType()), T.StructField("cand_rank", T.StringType()),
                     T.StructField("score", T.IntegerType())])


def _best(srcs: list[str], cand: pd.DataFrame, cutoff: int) -> pd.DataFrame:
    """cand: columns clean, rank (the original name: ties go to the smaller one);
    returns the best (clean_src, cand_rank, score) at or above ``cutoff``."""
    cand = cand.assign(L=cand["clean"].str.len()).sort_values(["L", "rank"], kind="stable")
    lens = cand["L"].to_numpy()
    names = cand["clean"].tolist()
    ranks = cand["rank"].to_numpy()
    need = max(cutoff - 0.5, 0.0) / 100.0          # round-half-even: 79.5 rounds to 80
    ratio = need / (2.0 - need) if need < 2 else 1.0
    out_s, out_r, out_v = [], [], []
    for a in srcs:
        la = len(a)
        lo = math.ceil(la * ratio - 1e-9)
        hi = math.floor(la / ratio + 1e-9) if ratio > 0 else 10 ** 9
        i0, i1 = np.searchsorted(lens, lo, "left"), np.searchsorted(lens, hi, "right")
        best, best_rank = -1, None
        for j in range(i0, i1):
            b = names[j]
            if a != b and ratio_upper_bound(a, b) < need * 100.0 - 1e-9:
                continue
            sc = ratio_py(a, b)
            if sc > best or (sc == best and ranks[j] < best_rank):
                best, best_rank = sc, ranks[j]
        if best >= cutoff:
            out_s.append(a)
            out_r.append(str(best_rank))
            out_v.append(int(best))
    return pd.DataFrame({"clean_src": pd.Series(out_s, dtype="object"),
                         "cand_rank": pd.Series(out_r, dtype="object"),
                         "score": pd.Series(out_v, dtype="int32")})


def fuzzy_match(src: DataFrame, value_col: str, concepts: DataFrame, name_col: str = "concept_name",
                id_col: str = "concept_id", cutoff: int = 80, strategy: str = "auto",
                max_broadcast_bytes: int = MAX_BROADCAST_BYTES, block_rows: int = BLOCK_ROWS,
                src_block_rows: int = SRC_BLOCK_ROWS) -> DataFrame:
    """Adds ``concept_id``, ``matched_concept_name`` and ``fuzzy_score`` to ``src``.
    A NULL source value, or a best score under ``cutoff``, gives NULLs."""
    # Candidates: one row per cleaned name; its tie rank is the smallest original name.
    per_name = (concepts.where(F.col(name_col).isNotNull())
                .groupBy(F.col(name_col).alias("name")).agg(F.max(id_col).alias("cid")))
    cand = (per_name.withColumn("clean", full_process(F.col("name")))
                    .groupBy("clean").agg(F.min_by(F.struct("name", "cid"), F.col("name")).alias("b"))
                    .select("clean", F.col("b.name").alias("rank"), F.col("b.name").alias("name"), "b.cid"))
    srcs = src.select(full_process(F.col(value_col)).alias("clean_src")).where(
        F.col(value_col).isNotNull()).distinct()

    if strategy in ("auto", "broadcast"):
        st = cand.agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("clean")).alias("b")).first()
        fits = (st["b"] or 0) + 16 * (st["n"] or 0) <= max_broadcast_bytes
        if strategy == "broadcast" and not fits:
            raise ValueError("the names exceed max_broadcast_bytes: use strategy 'auto' or 'blocked'")
        strategy = "broadcast" if fits else "bucketed" if cutoff > 0 else "blocked"
    if strategy == "bucketed":
        best = _bucketed(srcs, cand, cutoff)
    elif strategy == "broadcast":
        pdf = cand.select("clean", "rank").toPandas()
        bc = src.sparkSession.sparkContext.broadcast(pdf)

        def run(batches):
            c = bc.value
            for b in batches:
                yield _best(b["clean_src"].tolist(), c, cutoff)

        best = srcs.mapInPandas(run, _OUT)
    else:
        n_s = srcs.count()
        n_c = cand.count()
        nb_s = max(1, math.ceil(n_s / max(src_block_rows, block_rows)))
        nb_c = max(1, math.ceil(n_c / block_rows))
        sx = (srcs.withColumn("sb", F.pmod(F.xxhash64("clean_src"), F.lit(nb_s)))
                  .withColumn("cb", F.explode(F.sequence(F.lit(0), F.lit(nb_c - 1)).cast("array<long>"))))
        cx = (cand.select("clean", "rank").withColumn("cb", F.pmod(F.xxhash64("clean"), F.lit(nb_c)))
                  .withColumn("sb", F.explode(F.sequence(F.lit(0), F.lit(nb_s - 1)).cast("array<long>"))))

        def grp(left, right):
            return _best(left["clean_src"].tolist(), right[["clean", "rank"]], cutoff)

        scored = sx.groupBy("sb", "cb").cogroup(cx.groupBy("sb", "cb")).applyInPandas(grp, _OUT)
        w = Window.partitionBy("clean_src").orderBy(F.col("score").desc(), F.col("cand_rank"))
        best = scored.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")

    matched = best.join(cand.select(F.col("rank").alias("cand_rank"), F.col("cid").alias("concept_id"),
                                    F.col("name").alias("matched_concept_name")), "cand_rank")
    keyed = src.withColumn("_clean", F.when(F.col(value_col).isNotNull(), full_process(F.col(value_col))))
    out = keyed.join(matched.withColumnRenamed("clean_src", "_clean"), "_clean", "left")
    return out.drop("_clean", "cand_rank").withColumnRenamed("score", "fuzzy_score")


def _bucketed(srcs: DataFrame, cand: DataFrame, cutoff: int) -> DataFrame:
    """(clean_src, cand_rank, score): equal texts score 100, other pairs that pass the bounds are scored."""
    names = cand.select("clean", "rank")
    same = srcs.join(names, srcs["clean_src"] == names["clean"]).select("clean_src", F.col("rank").alias("cand_rank"), F.lit(100).alias("score"))
    pairs = ratio_pairs(srcs, "clean_src", names, "clean", (cutoff - 0.5) / 100.0).where("a <> b")
    scored = (pairs.join(names, pairs["b"] == names["clean"])
              .select(F.col("a").alias("clean_src"), F.col("rank").alias("cand_rank"), _ratio("a", "b").alias("score")))
    best = F.min_by(F.struct("cand_rank", "score"), F.struct(-F.col("score"), F.col("cand_rank")))
    every = same.union(scored.where(F.col("score") >= cutoff))
    return every.groupBy("clean_src").agg(best.alias("x")).select("clean_src", "x.cand_rank", "x.score")


@F.pandas_udf(T.IntegerType())
def _ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([ratio_py(x, y) for x, y in zip(a, b, strict=True)], dtype="int32")


def levenshtein_match(src: DataFrame, value_col: str, concepts: DataFrame, threshold: float = 0.8,
                      name_col: str = "concept_name", id_col: str = "concept_id") -> DataFrame:
    """Best name by edit ratio ``1 - distance / longer length`` at or above ``threshold``, as one
    equi-join in native functions.

    Within d edits one of d + 1 even segments of the name stands unchanged in the value, at most
    d places off (pigeonhole).  Names are indexed by (length, segment number, segment); a value
    probes the lengths its ratio allows.  Only pairs that share a segment are compared, values
    and names once each.  Ties: the name that sorts first, then its highest concept id.  Adds
    ``concept_id``, ``matched_concept_name``, ``edit_ratio`` (NULL without a match)."""
    t = float(threshold)
    upper = lambda c: F.upper(F.trim(F.col(c)))
    names = (concepts.select(upper(name_col).alias("name"), F.struct(F.col(id_col).alias("id"),
                                                                     F.col(name_col).alias("label")).alias("c"))
             .where(F.length("name") > 0).groupBy("name").agg(F.max_by("c", "c.id").alias("c")))
    values = src.select(upper(value_col).alias("value")).where(F.length("value") > 0).distinct()
    # d edits at most between strings whose longer length is m: d = floor((1 - t) * m)
    edits = lambda m: F.floor((1 - t) * m + 1e-9).cast("int")
    # a segment: its number g of d + 1 over n characters, start floor(g * n / (d + 1))
    cut = lambda g, n, d: F.floor(g * n / (d + 1)).cast("int")
    # names take part once per d of a longer value, up to the length the ratio allows
    n_len = F.length("name")
    most = F.greatest(n_len, F.floor(n_len / t + 1e-9).cast("int"))
    idx = (names.select("name", F.explode(F.array_distinct(F.transform(F.sequence(n_len, most), edits))).alias("d"))
           .select("name", "d", F.explode(F.sequence(F.lit(0), F.col("d"))).alias("g"))
           .withColumn("n", F.length("name")).withColumn("at", cut(F.col("g"), F.col("n"), F.col("d")))
           .withColumn("part", F.substring("name", F.col("at") + 1, cut(F.col("g") + 1, F.col("n"), F.col("d")) - F.col("at"))))
    v_len = F.length("value")
    probe = (values.select("value", F.explode(F.sequence(F.ceil(v_len * t - 1e-9).cast("int"),
                                                         F.floor(v_len / t + 1e-9).cast("int"))).alias("n")).where("n > 0")
             .withColumn("d", edits(F.greatest("n", F.length("value"))))
             .select("*", F.explode(F.sequence(F.lit(0), F.col("d"))).alias("g"))
             .withColumn("at", cut(F.col("g"), F.col("n"), F.col("d")))
             .withColumn("width", cut(F.col("g") + 1, F.col("n"), F.col("d")) - F.col("at"))
             .select("*", F.explode(F.sequence(F.greatest(F.col("at") - F.col("d"), F.lit(0)), F.greatest(F.least(
                 F.col("at") + F.col("d"), F.length("value") - F.col("width")), F.lit(0)))).alias("from"))
             .select("value", "n", "d", "g", F.substring("value", F.col("from") + 1, F.col("width")).alias("part")).distinct())
    near = probe.join(idx.select("name", "n", "d", "g", "part"), ["n", "d", "g", "part"]).select("value", "name", "d").distinct()
    ratio = 1 - F.levenshtein("value", "name") / F.greatest(F.length("value"), F.length("name"))
    scored = near.withColumn("ratio", ratio).where(F.col("ratio") >= t - 1e-12)
    best = (scored.groupBy("value").agg(F.min_by(F.struct("name", "ratio"), F.struct(-F.col("ratio"), F.col("name"))).alias("b"))
            .select("value", F.col("b.name").alias("name"), F.round("b.ratio", 6).alias("edit_ratio"))
            .join(names, "name").select("value", F.col("c.id").alias("concept_id"),
                                        F.col("c.label").alias("matched_concept_name"), "edit_ratio"))
    keyed = src.withColumn("_value", upper(value_col))
    return keyed.join(best.withColumnRenamed("value", "_value"), "_value", "left").drop("_value")


def fuzzy_match_brute(values: list[str | None], concepts: list[tuple[int, str]], cutoff: int = 80):
    """Reference implementation for tests: every value against every concept name."""
    names = sorted({n for _, n in concepts})
    best_id = {n: max(i for i, m in concepts if m == n) for n in names}
    out = []
    for v in values:
        if v is None:
            out.append(None)
            continue
        a = clean_py(v)
        sc = [(ratio_py(a, clean_py(n)), -k) for k, n in enumerate(names)]
        s, negk = max(sc)
        out.append(best_id[names[-negk]] if s >= cutoff else None)
    return out
