"""Exact k-means over integer vectors with heap-ordered bounds.

Vectors lie in blocks of bounded size; a block is one row that also holds, for each cluster,
a min-heap of its members by gap: the distance to the nearest other centroid less the distance
to the own one, plus the cluster's offset when the entry was made. The offset grows every round
by the drift of the cluster's centroid and the greatest drift of any other, so an entry's gap
can have closed only if its key is at most the offset now. Only those entries are popped, and
their vectors compared with all centroids; all others keep their cluster unseen.

A round is one pass over the blocks without a shuffle: tasks return the new heaps and, for the
vectors that changed their cluster, the change of each cluster's sum and count. Those changes
are summed by Spark; the driver holds the centroids only. Rounds are persisted, each from the
one before, so a lost executor costs at most ``rounds`` passes over its own blocks.

All sums and squared distances are exact integers. Bounds are floating point with a margin, so
rounding can only pop an entry too early.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdmspark.llm.common import materialise, or_null, read_table, struct_of

#: Vectors of a block.
BLOCK = 8192
#: Components must be smaller than this, so that a squared distance of 64 of them is a long.
LARGEST = 1 << 27
#: Below this, float64 products and their sums over 64 components are exact integers.
EXACT_FLOAT = 1 << 22
SCALE = 1024


class GapHeap:
    """A binary min-heap in arrays that pops and takes many entries at a time.

    Entries at most some limit form a tree from the root down, so they are found level by
    level without touching others. After a change, the places whose order may be broken are
    mended from the deepest level up, all of a level together."""

    def __init__(self, keys: np.ndarray | None = None, members: np.ndarray | None = None):
        self.keys = np.zeros(0) if keys is None else keys
        self.members = np.zeros(0, np.int32) if members is None else members

    def __len__(self) -> int:
        return len(self.keys)

    def pop_up_to(self, limit: float) -> np.ndarray:
        """Members of all entries whose key is at most ``limit``; they leave the heap."""
        n, found, front = len(self), [], np.arange(min(1, len(self)))
        while len(front):
            front = front[self.keys[front] <= limit]
            found.append(front)
            front = np.concatenate([2 * front + 1, 2 * front + 2])
            front = front[front < n]
        gone = np.concatenate(found) if found else np.zeros(0, np.int64)
        if not len(gone):
            return np.zeros(0, np.int32)
        members, left = self.members[gone], n - len(gone)
        stays = np.ones(n - left, bool)
        stays[gone[gone >= left] - left] = False
        holes, tail = gone[gone < left], left + np.flatnonzero(stays)
        self.keys[holes], self.members[holes] = self.keys[tail], self.members[tail]
        self.keys, self.members = self.keys[:left].copy(), self.members[:left].copy()
        self._mend(holes)
        return members

    def push(self, keys: np.ndarray, members: np.ndarray) -> None:
        n = len(self)
        self.keys = np.concatenate([self.keys, keys])
        self.members = np.concatenate([self.members, members.astype(np.int32)])
        places, above = [], np.arange(n, len(self))
        while len(above := np.unique((above[above > 0] - 1) // 2)):
            places.append(above)
        if places:
            self._mend(np.unique(np.concatenate(places)))

    def _mend(self, places: np.ndarray) -> None:
        depth = np.frexp((places + 1).astype(float))[1]
        for d in range(int(depth.max(initial=0)), 0, -1):
            self._sink(places[depth == d])

    def _sink(self, at: np.ndarray) -> None:
        """Lets the entries at ``at``, all of one level, sink below smaller ones."""
        keys, members, n = self.keys, self.members, len(self)
        while len(at := at[2 * at + 1 < n]):
            child = 2 * at + 1
            right = np.minimum(child + 1, n - 1)
            child = np.where(keys[right] < keys[child], right, child)
            worse = keys[at] > keys[child]
            at, child = at[worse], child[worse]
            keys[at], keys[child] = keys[child], keys[at]
            members[at], members[child] = members[child], members[at]
            at = child


@dataclass
class Step:
    """What a round needs besides the blocks: centroids (k x dim), offsets, and what to write."""

    centroids: np.ndarray
    offset: np.ndarray
    first: bool
    last: bool = False


@dataclass
class Block:
    ids: np.ndarray                 # int64; ``known`` tells which are not null
    known: np.ndarray
    vectors: np.ndarray             # n x dim integers
    cluster: np.ndarray             # int32, -1 before the first round
    heaps: list[GapHeap] = field(default_factory=list)


def squared_distances(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances, n x k, as int64."""
    top = max(np.abs(vectors).max(initial=0), np.abs(centroids).max(initial=0))
    if top < EXACT_FLOAT and vectors.shape[1] <= 64:
        v, c = vectors.astype(np.float64), centroids.astype(np.float64)
        own = np.einsum("ij,ij->i", v, v)[:, None] + np.einsum("ij,ij->i", c, c)[None, :]
        return (own - 2 * (v @ c.T)).astype(np.int64)
    v = vectors.astype(np.int64)
    out = [((v - c) ** 2).sum(1) for c in centroids.astype(np.int64)]
    return np.stack(out, 1) if out else np.zeros((len(v), 0), np.int64)


def assign(block: Block, step: Step) -> np.ndarray:
    """Moves the block's vectors to their nearest centroids; the members that were looked at."""
    k = len(step.centroids)
    if step.first:
        block.heaps = [GapHeap() for _ in range(k)]
        seen = np.arange(len(block.cluster))
    else:
        # the margin is far above what rounding can add up to
        seen = np.sort(np.concatenate([h.pop_up_to(o + 1e-9 * (1 + o)) for h, o in zip(block.heaps, step.offset, strict=True)]))
    if not len(seen):
        return seen
    d = squared_distances(block.vectors[seen], step.centroids)
    own = d.argmin(1)                                   # the smaller number on ties
    rows = np.arange(len(seen))
    upper = np.sqrt(d[rows, own].astype(np.float64))
    if k > 1:
        d[rows, own] = np.iinfo(np.int64).max
        gap = np.sqrt(d.min(1).astype(np.float64)) - upper
        gap -= 1e-12 * (upper + 1) * 4
    else:
        gap = np.full(len(seen), np.inf)
    block.cluster[seen] = own
    for c in range(k):
        mine = own == c
        if mine.any():
            block.heaps[c].push(gap[mine] + step.offset[c], seen[mine])
    return seen


_BLOCK = struct_of(
    n=T.LongType(), ids=T.BinaryType(), known=T.BinaryType(), vectors=T.BinaryType(), cluster=T.BinaryType(),
    sizes=T.ArrayType(T.LongType()), keys=T.BinaryType(), members=T.BinaryType(),
    change=T.ArrayType(T.LongType()), looked_at=T.LongType(), inertia=T.ArrayType(T.LongType()), distance=T.BinaryType())


def _read(row: dict, dim: int) -> Block:
    keys, members = np.frombuffer(row["keys"]).copy(), np.frombuffer(row["members"], np.int32).copy()
    cuts = np.cumsum([0, *row["sizes"]])
    return Block(np.frombuffer(row["ids"], np.int64), np.frombuffer(row["known"], bool),
                 np.frombuffer(row["vectors"], np.int32).reshape(-1, dim), np.frombuffer(row["cluster"], np.int32).copy(),
                 [GapHeap(keys[a:b], members[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)])


def _write(b: Block, change=(), looked_at=0, inertia=(), distance=b"") -> dict:
    return {"n": len(b.ids), "ids": b.ids.tobytes(), "known": b.known.tobytes(), "vectors": b.vectors.tobytes(),
            "cluster": b.cluster.tobytes(), "sizes": [len(h) for h in b.heaps],
            "keys": b"".join(h.keys.tobytes() for h in b.heaps), "members": b"".join(h.members.tobytes() for h in b.heaps),
            "change": list(change), "looked_at": looked_at, "inertia": list(inertia), "distance": distance}


def _to_blocks(dim: int):
    """Rows of (id, vector as array<double>) to rows of whole blocks; vectors that are not kept go."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, known, vectors, held = [], [], [], 0

        def out(final: bool) -> Iterator[pd.DataFrame]:
            nonlocal ids, known, vectors, held
            if not held:
                return
            i, k, v = np.concatenate(ids), np.concatenate(known), np.concatenate(vectors)
            whole = held if final else held - held % BLOCK
            for at in range(0, whole, BLOCK):
                s = slice(at, min(at + BLOCK, whole))
                yield pd.DataFrame([_write(Block(i[s], k[s], v[s], np.full(s.stop - s.start, -1, np.int32)))])
            ids, known, vectors, held = [i[whole:]], [k[whole:]], [v[whole:]], held - whole

        for pdf in batches:
            right = [x is not None and len(x) == dim for x in pdf["vector"]]
            own = pdf[np.array(right, bool)]
            if not len(own):
                continue
            x = np.floor(np.stack([np.asarray(v, np.float64) for v in own["vector"]]) * SCALE)
            kept = np.isfinite(x).all(1) & (np.abs(np.nan_to_num(x, nan=0.0)) < LARGEST).all(1)
            there = own["id"].notna().to_numpy()[kept]
            ids.append(own["id"].fillna(0).to_numpy(np.int64)[kept])
            known.append(there)
            vectors.append(x[kept].astype(np.int32))
            held += int(kept.sum())
            if held >= BLOCK:
                yield from out(False)
        yield from out(True)
    return run


def _round(step: Step, dim: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        k = len(step.centroids)
        for pdf in batches:
            for row in pdf.to_dict("records"):
                b = _read(row, dim)
                before = b.cluster.copy()
                seen = assign(b, step)
                moved = seen[b.cluster[seen] != before[seen]]
                change = np.zeros((k + 1, dim + 1), np.int64)      # one more row for those without a cluster yet
                v = np.concatenate([b.vectors[moved].astype(np.int64), np.ones((len(moved), 1), np.int64)], 1)
                np.add.at(change, b.cluster[moved], v)
                np.subtract.at(change, before[moved], v)
                inertia, distance = (), b""
                if step.last:
                    d = np.zeros(len(b.ids), np.int64)
                    for c in range(k):
                        own = b.cluster == c
                        d[own] = squared_distances(b.vectors[own], step.centroids[c:c + 1])[:, 0]
                    # two halves, as a block's sum may be beyond a long
                    inertia = np.stack([np.bincount(b.cluster, x, k).astype(np.int64) for x in (d >> 31, d & ((1 << 31) - 1))]).ravel()
                    distance, b.heaps = d.tobytes(), []
                yield pd.DataFrame([_write(b, change[:k].ravel(), len(seen), inertia, distance)])
    return run


def _summed(blocks: DataFrame, column: str) -> list[int]:
    """The arrays of all blocks added up, place by place (their length is fixed)."""
    rows = (blocks.select(F.posexplode(column).alias("at", "x")).groupBy("at")
            .agg(F.sum(F.col("x").cast("decimal(38,0)")).alias("x")).collect())
    return [int(r["x"]) for r in sorted(rows, key=lambda r: r["at"])]


def starts(vectors: DataFrame, k: int, salt: int) -> DataFrame:
    """The k vectors with the smallest sha256 of ``salt:id``; equal ids by their components,
    null ids last."""
    key = F.sha2(F.concat(F.lit(f"{salt}:"), F.col("id").cast("string")), 256)
    return vectors.select("id", "vector", key.alias("key")).orderBy(F.col("key").asc_nulls_last(), "vector").limit(k)


def _kept(vectors: DataFrame, dim: int) -> DataFrame:
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (x >= LARGEST / SCALE) | (x < (1 - LARGEST) / SCALE))
    return vectors.filter((F.size("vector") == dim) & ~bad)


_ROW = struct_of(vec_id=T.LongType(), cluster=T.IntegerType(), distance=T.LongType())


def _rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for r in pdf.to_dict("records"):
            ids = pd.array(np.frombuffer(r["ids"], np.int64), dtype="Int64")
            ids[~np.frombuffer(r["known"], bool)] = pd.NA
            yield pd.DataFrame({"vec_id": ids, "cluster": np.frombuffer(r["cluster"], np.int32),
                                "distance": np.frombuffer(r["distance"], np.int64)})


def cluster_vectors(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", k: int = 8,
                    dim: int = 64, rounds: int = 10, salt: int = 3, trace: list | None = None) -> DataFrame:
    """One row per kept vector: vec_id, cluster, distance (squared, to its final centroid),
    cluster_inertia and inertia (distances summed over its cluster and over all), centroid_sha256.

    Kept are vectors of exactly ``dim`` components, none null or non-finite; a component x counts
    as floor(1024 * x). A component of 131072 or more in size has no squared distance that is
    surely a long, so its vector is left out too, as a null vector is. Null ids and repeated rows
    are vectors like any other, but null ids start no cluster while others can. With fewer than
    ``k`` vectors there are as many centroids as vectors; an inertia beyond a long is null; other
    columns are ignored; an empty table gives no rows. ``trace`` receives, per round, how many
    vectors were compared with the centroids."""
    spark = vectors.sparkSession
    base = vectors.select(or_null(vectors, id_column, "long").alias("id"),
                          or_null(vectors, vector_column, "array<double>").alias("vector"))
    found = starts(_kept(base, dim), k, salt).collect()
    found = sorted(found, key=lambda r: (r["key"] is None, r["key"] or "", r["vector"]))
    if not found:
        more = struct_of(cluster_inertia=T.LongType(), inertia=T.LongType(), centroid_sha256=T.StringType())
        return spark.createDataFrame([], T.StructType(_ROW.fields + more.fields))
    centroids = np.floor(np.array([r["vector"] for r in found]) * SCALE).astype(np.int64)
    k = len(centroids)
    totals = [[0] * (dim + 1) for _ in range(k)]
    offset = np.zeros(k)
    blocks = materialise(base.mapInPandas(_to_blocks(dim), _BLOCK), "centroid-blocks")
    held = []
    for r in range(rounds + 1):
        step = Step(centroids, offset, first=r == 0, last=r == rounds)
        blocks = blocks.mapInPandas(_round(step, dim), _BLOCK)
        if step.last:
            break
        blocks = blocks.persist(StorageLevel.MEMORY_AND_DISK)
        held.append(blocks)
        change = _summed(blocks, "change")
        if trace is not None:
            trace.append(blocks.agg(F.sum("looked_at")).first()[0])
        for old in held[:-1]:
            old.unpersist()
        held = held[-1:]
        for c in range(k):
            totals[c] = [a + b for a, b in zip(totals[c], change[c * (dim + 1):(c + 1) * (dim + 1)], strict=True)]
        moved = np.array([[s // t[-1] for s in t[:-1]] if t[-1] else list(c)
                          for t, c in zip(totals, centroids.tolist(), strict=True)], np.int64)
        drift = np.sqrt(((moved - centroids).astype(np.float64) ** 2).sum(1)) * (1 + 1e-12)
        others = np.array([np.delete(drift, c).max(initial=0.0) for c in range(k)])
        offset, centroids = offset + drift + others, moved
    final = materialise(blocks.select("n", "ids", "known", "cluster", "distance", "inertia", "looked_at"), "centroid-final")
    for old in held:
        old.unpersist()
    if trace is not None:
        trace.append(final.agg(F.sum("looked_at")).first()[0])
    halves = _summed(final, "inertia")
    own = [(halves[c] << 31) + halves[k + c] for c in range(k)]
    as_long = lambda x: x if x < 1 << 63 else None
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    at = F.col("cluster") + 1
    return final.mapInPandas(_rows, _ROW).select(
        "vec_id", "cluster", "distance",
        F.element_at(F.array(*[F.lit(as_long(x)).cast("long") for x in own]), at).alias("cluster_inertia"),
        F.lit(as_long(sum(own))).cast("long").alias("inertia"),
        F.element_at(F.array(*[F.lit(x) for x in digest]), at).alias("centroid_sha256"))


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_vectors(read_table(spark, sf_dir, "embeddings"))


def _sql(k: int = 8, dim: int = 64, rounds: int = 10, salt: int = 3) -> str:
    """The same rounds, one after another; distances over whole lists of integers."""
    parts = [f"""kept AS MATERIALIZED (
  SELECT vec_id, row_number() OVER (ORDER BY sha256('{salt}:' || vec_id), embedding) AS uid,
         list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE len(embedding) = {dim}
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS MATERIALIZED (SELECT (uid - 1)::INTEGER AS c, v FROM kept WHERE uid <= {k})"""]
    for r in range(rounds + 1):
        parts.append(f"""a{r} AS MATERIALIZED (
  SELECT uid, vec_id, v, (m % {k})::INTEGER AS c, (m // {k})::BIGINT AS d FROM (
    SELECT t.uid, any_value(t.vec_id) AS vec_id, any_value(t.v) AS v, min({k} * list_sum(list_transform(
             list_zip(t.v, o.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::HUGEINT + o.c) AS m
    FROM kept t, c{r} o GROUP BY t.uid))""")
        if r < rounds:
            parts.append(f"""m{r} AS MATERIALIZED (
  SELECT c, list(q ORDER BY i) AS v FROM (
    SELECT c, i, ((s - ((s % n) + n) % n) // n)::BIGINT AS q FROM (
      SELECT c, i, sum(x) AS s, count(*) AS n FROM (SELECT c, unnest(v) AS x, unnest(range({dim})) AS i FROM a{r}) GROUP BY c, i))
  GROUP BY c),
c{r + 1} AS MATERIALIZED (SELECT o.c, coalesce(m.v, o.v) AS v FROM c{r} o LEFT JOIN m{r} m ON m.c = o.c)""")
    return "WITH " + ",\n".join(parts) + f"""
SELECT a.vec_id, a.c AS cluster, a.d AS distance, (sum(a.d) OVER (PARTITION BY a.c))::BIGINT AS cluster_inertia,
       (sum(a.d) OVER ())::BIGINT AS inertia, sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} c ON c.c = a.c"""


OP13_SQL = _sql()
