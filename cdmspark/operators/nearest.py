"""Exact top-k nearest-neighbour join by cosine similarity.

Both sides carry vectors (``array<double>``, any length scale) or, with ``bag_dim``,
bags of bucket ids (``array<int>``) that become count vectors of that length inside
the scorer; score = a.b / (|a| |b|), computed per pair in that order so integer-valued
vectors give exactly the same doubles as any engine that evaluates the same formula, and
copies of a vector the same score wherever they lie.  Zero vectors never match.  Two plans:

* ``broadcast`` - the candidate side (a vocabulary) is size-checked: rows x dim x 8
  bytes must stay under ``max_broadcast_bytes``.  It is then shipped once to every
  executor and the source side is scored partition by partition in a pandas function.
  The source is never shuffled.
* ``blocked`` - beyond the bound, both sides are cut into hash blocks and every
  (source block, candidate block) pair meets in one co-group task; each task keeps its
  own top-k per source row and a final window keeps the global top-k.  Memory per
  task is one source block plus one candidate block.  Rows shuffled are
  n_src x n_cand_blocks + n_cand x n_src_blocks: blocks grow with the table until a side
  has ``MAX_BLOCKS`` of them or they hold ``BLOCK_CELLS`` numbers, so that rows are copied
  a fixed number of times up to there.

Every pair is scored, in tiles of single precision; what may by its error bound be among a
row's best is scored again in double precision, and only that counts (``Best``).  Copies of a
candidate beyond those that can be among the best add nothing.

Ties are broken by the lower candidate key.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_BROADCAST_BYTES = 256 * 1024 * 1024
BLOCK_ROWS = 20_000              # candidate rows per block in the blocked plan, at least
SRC_BLOCK_ROWS = 500_000         # source rows per block, at least
MAX_BLOCKS = 8                   # blocks a side, as long as they stay under BLOCK_CELLS
BLOCK_CELLS = 6_400_000          # numbers in a block that had to grow
TILE_ROWS, TILE_COLS = 1024, 4096
SRC_ROWS = 8192                  # source rows made dense at once
PAIR_CELLS = 4_000_000           # numbers of pairs scored in double precision at once


def _norms(mat: np.ndarray) -> np.ndarray:
    return np.sqrt(np.sum(mat * mat, axis=1))


def _units(mat: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of length 1 in double precision, norms, and the rows that can match."""
    with np.errstate(all="ignore"):
        norm = _norms(mat)
        ok = (norm > 0) & np.isfinite(mat).all(axis=1)
        return np.where(ok[:, None], mat / np.where(ok, norm, 1.0)[:, None], 0.0), norm, ok


def _copies(mat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, group): the first row of each distinct row, and each row's number among them."""
    if not mat.size:
        return np.arange(len(mat)), np.arange(len(mat))
    whole = np.ascontiguousarray(mat).view(np.dtype((np.void, mat.shape[1] * mat.itemsize))).ravel()
    _, first, group = np.unique(whole, return_index=True, return_inverse=True)
    return first, group.ravel()


def _places(sorted_groups: np.ndarray) -> np.ndarray:
    """Each row's place in its run of equal values."""
    n = len(sorted_groups)
    start = np.flatnonzero(np.append(True, sorted_groups[1:] != sorted_groups[:-1])) if n else np.zeros(0, np.int64)
    return np.arange(n) - np.repeat(start, np.diff(np.append(start, n)))


class Candidates:
    """Candidates of one block in the order of their keys; of equal vectors the ``k`` lowest."""

    def __init__(self, keys: np.ndarray, mat: np.ndarray, k: int):
        order = np.argsort(keys, kind="stable")
        keys, mat = keys[order], mat[order]
        unit, norm, ok = _units(mat)
        group = _copies(mat)[1]
        by_group = np.argsort(group, kind="stable")
        few = np.empty(len(keys), bool)
        few[by_group] = _places(group[by_group]) < k
        use = np.flatnonzero(ok & few)
        self.keys, self.mat, self.norm = keys[use], mat[use], norm[use]
        self.near = unit[use].astype(np.float32)


class Best:
    """The ``k`` best candidates of each row of ``mat``, from tiles of pairs in any order.

    A tile's scores are wrong by ``error`` at most.  ``low`` is a score that the row's k-th best
    reaches at least; pairs that cannot reach it are passed over, the others wait until
    ``settle`` scores them in double precision."""

    def __init__(self, mat: np.ndarray, cands: Candidates, k: int):
        self.mat, self.cands, self.k = mat, cands, k
        self.unit, self.norm, self.ok = _units(mat)
        self.near = self.unit.astype(np.float32)
        self.error = (mat.shape[1] + 8) * 2.0 ** -24 if mat.ndim == 2 else 0.0
        self.low = np.where(self.ok, -np.inf, np.inf)
        self.score = np.full((len(mat), k), -np.inf)
        self.cand = np.full((len(mat), k), len(cands.keys), np.int64)
        self._wait: list[tuple[np.ndarray, np.ndarray]] = []
        self._waiting = 0

    def _beyond(self, tile: np.ndarray, rows, error: float) -> tuple[np.ndarray, np.ndarray]:
        hit = tile >= (self.low[rows] - error)[:, None]
        if np.count_nonzero(hit) > 4 * self.k * len(tile) and tile.shape[1] >= self.k:
            kth = tile.max(1) if self.k == 1 else np.partition(tile, -self.k, axis=1)[:, -self.k]
            self.low[rows] = np.maximum(self.low[rows], kth - error)
            hit = tile >= (self.low[rows] - error)[:, None]
        return np.nonzero(hit)

    def meet(self, rows, cols) -> None:
        """Distinct ``rows`` meet distinct ``cols`` (slices or indices)."""
        tile = self.near[rows] @ self.cands.near[cols].T
        r, c = self._beyond(tile, rows, self.error)
        if len(r) > 16 * self.k * len(tile):      # many within the error: told apart in double precision
            there = np.unique(r)
            some = np.arange(len(self.low))[rows][there]
            fine = self.unit[some] @ (self.cands.mat[cols] / self.cands.norm[cols][:, None]).T
            r, c = self._beyond(fine, some, self.error * 2.0 ** -28)
            r = there[r]
        if len(r):
            r = r + (rows.start or 0) if isinstance(rows, slice) else rows[r]
            self._wait.append((r, c + (cols.start or 0) if isinstance(cols, slice) else cols[c]))
            self._waiting += len(r)
            if self._waiting > 1_000_000:
                self.settle()

    def settle(self) -> None:
        if not self._wait:
            return
        r, c = (np.concatenate(x) for x in zip(*self._wait, strict=True))
        self._wait, self._waiting = [], 0
        score = np.empty(len(r))
        step = max(1, PAIR_CELLS // max(1, self.mat.shape[1]))
        with np.errstate(all="ignore"):
            for lo in range(0, len(r), step):
                x, y = r[lo:lo + step], c[lo:lo + step]
                score[lo:lo + step] = np.einsum("ij,ij->i", self.mat[x], self.cands.mat[y]) / (self.norm[x] * self.cands.norm[y])
        score[~np.isfinite(score)] = -np.inf
        rows = np.unique(r)
        r = np.concatenate([np.repeat(rows, self.k), r])
        c = np.concatenate([self.cand[rows].ravel(), c])
        score = np.concatenate([self.score[rows].ravel(), score])
        order = np.lexsort((c, -score, r))
        r, c, score = r[order], c[order], score[order]
        once = np.isfinite(score) & np.append(True, (r[1:] != r[:-1]) | (c[1:] != c[:-1]))
        r, c, score = r[once], c[once], score[once]
        place = _places(r)
        keep = place < self.k
        self.score[rows], self.cand[rows] = -np.inf, len(self.cands.keys)
        self.score[r[keep], place[keep]], self.cand[r[keep], place[keep]] = score[keep], c[keep]
        self.low[rows] = np.maximum(self.low[rows], self.score[rows, -1])


def prepared(keys: np.ndarray, mat: np.ndarray, k: int, exclude_self: bool) -> tuple[Candidates, int]:
    """The candidates, and how many best ones to look for so that ``k`` are left without a
    row's own key (more than one more only where keys repeat)."""
    more = int(np.unique(keys, return_counts=True)[1].max()) if exclude_self and len(keys) else 0
    return Candidates(keys, mat, k + more), k + more


def best_rows(src_keys: np.ndarray, mat: np.ndarray, cands: Candidates, wanted: int, k: int, exclude_self: bool,
              meet_all: Callable[[Best], None]) -> pd.DataFrame:
    """(src_key, cand_key, score, rank) of the rows of ``mat``; ``meet_all`` lets them meet candidates."""
    first, group = _copies(mat)
    best = Best(mat[first], cands, wanted)
    if len(cands.keys):
        meet_all(best)
        best.settle()
    score, found = best.score[group], best.cand[group]
    there = np.isfinite(score)
    if exclude_self:
        own = np.append(cands.keys, 0)[found] == src_keys.astype(np.int64)[:, None]
        there &= ~own
    rank = np.cumsum(there, axis=1)
    row, place = np.nonzero(there & (rank <= k))
    return pd.DataFrame({"src_key": src_keys[row], "cand_key": np.append(cands.keys, 0)[found[row, place]],
                         "score": score[row, place], "rank": rank[row, place].astype(np.int32)})


def _meet_all(best: Best) -> None:
    for lo in range(0, len(best.mat), TILE_ROWS):
        rows = slice(lo, min(lo + TILE_ROWS, len(best.mat)))
        for at in range(0, len(best.cands.keys), TILE_COLS):
            best.meet(rows, slice(at, at + TILE_COLS))


def _score(src_keys, src_vecs, cands, wanted, k, exclude_self, bag_dim=None):
    """Sub-batches of sources are made dense one at a time, so memory is one sub-batch's
    matrix and a tile of scores beside the candidates."""
    outs = [best_rows(src_keys[lo:lo + SRC_ROWS], _matrix(src_vecs[lo:lo + SRC_ROWS], bag_dim), cands, wanted, k, exclude_self,
                      _meet_all) for lo in range(0, len(src_keys), SRC_ROWS)]
    return pd.concat(outs, ignore_index=True)


def _matrix(series: pd.Series, bag_dim: int | None = None) -> np.ndarray:
    if bag_dim:
        out = np.zeros((len(series), bag_dim), dtype=np.float64)
        for r, bag in enumerate(series):
            out[r] = np.bincount(np.asarray(bag, dtype=np.int64), minlength=bag_dim)
        return out
    if len(series) == 0:
        return np.zeros((0, 0))
    return np.vstack([np.asarray(v, dtype=np.float64) for v in series])


def nearest(src: DataFrame, cand: DataFrame, src_key: str, cand_key: str, vec: str = "vec",
            k: int = 1, exclude_self: bool = False, strategy: str = "auto",
            max_broadcast_bytes: int = MAX_BROADCAST_BYTES, block_rows: int = BLOCK_ROWS,
            bag_dim: int | None = None, src_block_rows: int = SRC_BLOCK_ROWS) -> DataFrame:
    """Top-``k`` candidates per source row: (src_key, cand_key, score, rank).

    ``src_key`` must be unique (any type), ``cand_key`` a unique long; rows with a NULL
    vector are skipped on both sides.  ``exclude_self`` drops pairs with equal keys.
    """
    s = src.select(F.col(src_key).alias("src_key"), F.col(vec).alias("vec")).where(F.col("vec").isNotNull())
    c = cand.select(F.col(cand_key).cast("long").alias("cand_key"), F.col(vec).alias("vec")).where(
        F.col("vec").isNotNull())
    out_schema = T.StructType([T.StructField("src_key", s.schema["src_key"].dataType),
                               T.StructField("cand_key", T.LongType()),
                               T.StructField("score", T.DoubleType()),
                               T.StructField("rank", T.IntegerType())])
    collected = None
    if strategy in ("auto", "broadcast"):
        # the bound is checked also where a caller asks for the broadcast plan
        if bag_dim:
            # one job proves the bound and fetches the rows: never more than cap + 1 rows
            cap = max_broadcast_bytes // (bag_dim * 8)
            collected = c.limit(cap + 1).toPandas()
            fits = len(collected) <= cap
        else:
            stats = c.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vec")).alias("d")).first()
            fits = int(stats["n"] or 0) * max(int(stats["d"] or 0), 1) * 8 <= max_broadcast_bytes
        if strategy == "broadcast" and not fits:
            raise ValueError("the candidates exceed max_broadcast_bytes: use strategy 'auto' or 'blocked'")
        strategy = "broadcast" if fits else "blocked"
    if strategy == "broadcast":
        # every source row met every candidate in one call: its ranks are final
        ranked = _broadcast_plan(s, c, k, exclude_self, out_schema, bag_dim, collected)
    else:
        scored = _blocked_plan(s, c, k, exclude_self, out_schema, block_rows, bag_dim,
                               max(src_block_rows, block_rows)).drop("rank")
        w = Window.partitionBy("src_key").orderBy(F.col("score").desc(), F.col("cand_key"))
        ranked = scored.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return ranked.select(F.col("src_key").alias(src_key), F.col("cand_key").alias(cand_key), "score", "rank")


def _broadcast_plan(s, c, k, exclude_self, out_schema, bag_dim=None, collected=None):
    spark = s.sparkSession
    pdf = (collected if collected is not None else c.toPandas()).sort_values("cand_key", kind="stable")
    keys = pdf["cand_key"].to_numpy(dtype=np.int64)
    mat = _matrix(pdf["vec"], bag_dim)
    bc = spark.sparkContext.broadcast((keys, mat))

    def score_partition(batches):
        ck, cm = bc.value
        if len(ck) == 0:
            return
        cands, wanted = prepared(ck, cm, k, exclude_self)
        for b in batches:
            if len(b):
                yield _score(b["src_key"].to_numpy(), b["vec"], cands, wanted, k, exclude_self, bag_dim)

    return s.mapInPandas(score_partition, out_schema)


def blocks(rows: int, at_least: int, dim: int) -> int:
    """Number of blocks of ``at_least`` rows, or of more where that would be over MAX_BLOCKS."""
    grown = min(math.ceil(rows / MAX_BLOCKS), BLOCK_CELLS // max(1, dim))
    return max(1, math.ceil(rows / max(at_least, grown)))


def blocked(s: DataFrame, c: DataFrame, score_block: Callable, out_schema: T.StructType, src_block_rows: int, block_rows: int,
            dim: int | None = None) -> DataFrame:
    """``score_block(sources, candidates)`` for every pair of blocks of ``s`` (src_key, vec, ...)
    and ``c`` (cand_key, vec, ...)."""
    n_s = s.count()
    size = c.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vec")).alias("d")).first()
    dim = dim or int(size["d"] or 0)
    nb_s, nb_c = blocks(n_s, src_block_rows, dim), blocks(int(size["n"]), block_rows, dim)
    sx = (s.withColumn("sb", F.pmod(F.xxhash64("src_key"), F.lit(nb_s)))
           .withColumn("cb", F.explode(F.sequence(F.lit(0), F.lit(nb_c - 1)).cast("array<long>"))))
    cx = (c.withColumn("cb", F.pmod(F.xxhash64("cand_key"), F.lit(nb_c)))
           .withColumn("sb", F.explode(F.sequence(F.lit(0), F.lit(nb_s - 1)).cast("array<long>"))))

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if len(left) == 0 or len(right) == 0:
            return pd.DataFrame({"src_key": pd.Series([], dtype="object"),
                                 "cand_key": pd.Series([], dtype="int64"), "score": pd.Series([], dtype="float64"),
                                 "rank": pd.Series([], dtype="int32")})
        return score_block(left, right)

    return sx.groupBy("sb", "cb").cogroup(cx.groupBy("sb", "cb")).applyInPandas(run, out_schema)


def _blocked_plan(s, c, k, exclude_self, out_schema, block_rows, bag_dim=None, src_block_rows=SRC_BLOCK_ROWS):
    def score_block(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        cands, wanted = prepared(right["cand_key"].to_numpy(dtype=np.int64), _matrix(right["vec"], bag_dim), k, exclude_self)
        return _score(left["src_key"].to_numpy(), left["vec"], cands, wanted, k, exclude_self, bag_dim)

    return blocked(s, c, score_block, out_schema, src_block_rows, block_rows, bag_dim)
