"""Approximate nearest join of dense vectors by hashing with several probes.

Each of ``tables`` hash tables cuts space by ``bits`` planes; a vector's slot is the side it
lies on of each.  A source looks up its own slot and those that differ in any of the ``flips``
planes that it lies nearest to, the sides most likely wrong: ``2 ** flips`` probes a table.
Whoever meets in a slot is compared exactly, so scores are those of the exact join and only
partners can be missed.

Slots are looked up inside co-group tasks, one for each pair of a block of sources and a block
of candidates (``nearest.blocked``): a task indexes its candidates table by table, lets the
sources that probe a slot meet its rows, and gives back each source's best.  So neither probes
nor pairs are rows of a shuffle, which carries each vector once per block of the other side;
pairs looked at grow with the slots' load, which ``bits`` sets.

Equal vectors are one source, and of equal candidates only the ``k + 1`` lowest keys are kept
(none beyond can be among the best, ties going to the lower key), so a group of copies adds
no pairs.  Planes come from a digest of their number: the same in every engine and session.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .nearest import TILE_COLS, TILE_ROWS, Best, _matrix, best_rows, blocked, prepared

TABLES, BITS, FLIPS, SEED = 32, 12, 5, 7
PROBE_ROWS = 1 << 14             # sources whose probes are worked out at once
SLOT_BLOCK_ROWS = 10_000         # rows per block, at least


def planes(tables: int, bits: int, dim: int, seed: int = SEED) -> np.ndarray:
    """(tables, bits, dim) coefficients in [-1, 1): the first 32 bits of md5 ``seed:table:bit:place``."""
    digest = lambda t, b, d: int(hashlib.md5(f"{seed}:{t}:{b}:{d}".encode()).hexdigest()[:8], 16)
    return np.array([[[digest(t, b, d) for d in range(dim)] for b in range(bits)] for t in range(tables)]) / 2.0 ** 31 - 1


def slots_of(x: np.ndarray, cut: np.ndarray, flips: int) -> np.ndarray:
    """(rows, tables * 2 ** flips) slots of the rows of ``x``; without flips each row's own."""
    tables, bits, dim = cut.shape
    side = (x @ cut.reshape(-1, dim).T).reshape(len(x), tables, bits)
    own = ((side > 0) << np.arange(bits)).sum(2)
    if flips:
        near = 1 << np.argsort(np.abs(side), axis=2, kind="stable")[:, :, :flips]
        subsets = (np.arange(1 << flips)[:, None] >> np.arange(flips)) & 1
        own = own[:, :, None] ^ (near @ subsets.T)
    else:
        own = own[:, :, None]
    return (own + (np.arange(tables) << bits)[None, :, None]).reshape(len(x), -1)


def _slots(df: DataFrame, cut: np.ndarray, flips: int) -> DataFrame:
    """(key, slot) rows of ``df`` (key, vec)."""
    rows = max(1, (1 << 19) // (cut.shape[0] << flips))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for lo in range(0, len(pdf), rows):
                part = pdf.iloc[lo:lo + rows]
                found = slots_of(np.stack([np.asarray(v, np.float64) for v in part["vec"]]), cut, flips)
                yield pd.DataFrame({"key": part["key"].repeat(found.shape[1]).to_numpy(), "slot": found.ravel()})
    kind = T.StructType([T.StructField("key", df.schema["key"].dataType), T.StructField("slot", T.LongType())])
    return df.mapInPandas(run, kind)


def _usable(df: DataFrame, key: str, vec: str, dim: int) -> DataFrame:
    v = F.col(vec).cast("array<double>")
    x = df.select(F.col(key).alias("key"), v.alias("vec")).where((F.size("vec") == dim) & F.forall("vec", lambda e: e.isNotNull()))
    norm = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda acc, e: acc + e * e))
    return x.withColumn("norm", norm).where((F.col("norm") > 0) & (F.col("norm") < float("inf")))


def candidate_pairs(sources: DataFrame, candidates: DataFrame, dim: int, tables: int = TABLES, bits: int = BITS,
                    flips: int = FLIPS) -> DataFrame:
    """Distinct (s, c) keys of ``sources`` and ``candidates`` (key, vec) that meet in a slot."""
    cut = planes(tables, bits, dim)
    index = _slots(candidates.select("key", "vec"), cut, 0).withColumnRenamed("key", "c")
    probes = _slots(sources.select("key", "vec"), cut, flips).withColumnRenamed("key", "s")
    return probes.join(index, "slot").select("s", "c").distinct()


def _meet_in_slots(best: Best, cut: np.ndarray, flips: int) -> None:
    """Lets each row of ``best`` meet the candidates in the slots that it probes, table by table."""
    kind = np.uint16 if cut.shape[1] <= 16 else np.int64          # short keys sort in linear time
    for t in range(len(cut)):
        own = slots_of(best.cands.mat, cut[t:t + 1], 0).ravel().astype(kind)
        index = np.argsort(own, kind="stable")
        slot, start = np.unique(own[index], return_index=True)
        end = np.append(start[1:], len(own))
        probes = np.concatenate([slots_of(best.mat[lo:lo + PROBE_ROWS], cut[t:t + 1], flips).astype(kind)
                                 for lo in range(0, len(best.mat), PROBE_ROWS)]).ravel()
        by_slot = np.argsort(probes, kind="stable")
        probes = probes[by_slot]
        rows = by_slot >> flips
        first, last = np.searchsorted(probes, slot, "left"), np.searchsorted(probes, slot, "right")
        for a, b, lo, hi in zip(start.tolist(), end.tolist(), first.tolist(), last.tolist(), strict=True):
            for at in range(lo, hi, TILE_ROWS):
                for here in range(a, b, TILE_COLS):
                    best.meet(rows[at:min(at + TILE_ROWS, hi)], index[here:min(here + TILE_COLS, b)])
        best.settle()


def nearest_lsh(src: DataFrame, cand: DataFrame, src_key: str, cand_key: str, vec: str = "vec", k: int = 1,
                exclude_self: bool = False, dim: int | None = None, tables: int = TABLES, bits: int = BITS,
                flips: int = FLIPS) -> DataFrame:
    """``nearest`` by hashing: (src_key, cand_key, score, rank), the best ``k`` of the candidates
    that a source meets; a source that meets none has no row.  Null, zero and non-finite
    vectors and those of another length than ``dim`` (the longest candidate's) never match."""
    if flips > bits:
        raise ValueError("more flips than bits")
    dim = dim or cand.agg(F.max(F.size(vec))).first()[0] or 1
    s = _usable(src, src_key, vec, dim)
    copies = Window.partitionBy("vec").orderBy("key")
    c = (_usable(cand.withColumn(cand_key, F.col(cand_key).cast("long")), cand_key, vec, dim)
         .withColumn("n", F.row_number().over(copies)).where(F.col("n") <= k + 1).drop("n"))
    one = s.groupBy("vec").agg(F.min("key").alias("key"))
    cut, kind = planes(tables, bits, dim), one.schema["key"].dataType

    def score_block(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        cands, wanted = prepared(right["cand_key"].to_numpy(dtype=np.int64), _matrix(right["vec"]), k + 1, False)
        return best_rows(left["src_key"].to_numpy(), _matrix(left["vec"]), cands, wanted, k + 1, False,
                         lambda best: _meet_in_slots(best, cut, flips))

    found = T.StructType([T.StructField("src_key", kind), T.StructField("cand_key", T.LongType()),
                          T.StructField("score", T.DoubleType()), T.StructField("rank", T.IntegerType())])
    scored = blocked(one.select(F.col("key").alias("src_key"), "vec"), c.select(F.col("key").alias("cand_key"), "vec"),
                     score_block, found, SLOT_BLOCK_ROWS, SLOT_BLOCK_ROWS, dim).select(
        F.col("src_key").alias("s"), F.col("cand_key").alias("c"), "score")
    order = [F.col("score").desc(), F.col("c")]
    best = (scored.withColumn("n", F.row_number().over(Window.partitionBy("s").orderBy(*order))).where(F.col("n") <= k + 1)
            .drop("n"))
    back = s.select(F.col("key").alias("source"), "vec").join(one.select("vec", F.col("key").alias("s")), "vec").select("source", "s")
    every = back.join(best, "s")
    if exclude_self:
        every = every.where(~F.col("source").cast("long").eqNullSafe(F.col("c")))
    ranked = every.withColumn("rank", F.row_number().over(Window.partitionBy("source").orderBy(*order))).where(F.col("rank") <= k)
    return ranked.select(F.col("source").alias(src_key), F.col("c").alias(cand_key), "score", "rank")
