"""Near-duplicate documents: multi-index Hamming join of b-bit MinHash signatures.

A signature has 48 symbols of 16 bits (the mixed low bits of 48 MinHashes over the text's
distinct word shingles). Two texts of Jaccard similarity s disagree in about 48 * (1 - s)
symbols. The join finds *every* pair with at most 23 disagreements: the signature is split
into 12 chunks, so by pigeonhole such a pair has a chunk with at most one wrong symbol, and
each chunk is indexed once per symbol left out (48 keys in all), which enumerates that
error. More than 23 disagreements have a probability of 1e-8 at s = 0.85 and 3e-6 at s = 0.8.

Plan, all over classes of equal shingle sets, so exact copies are one node:

1. one pass over the texts for set digest, set size and signature;
2. keys are counted (pre-aggregated) and only keys held by two nodes or more go on;
3. in a key's bucket the signatures are compared and only star edges of the near graph
   leave (never all pairs);
4. components of that graph are the groups of candidates; a text travels once per group, its
   full shingle set is rebuilt, and links are confirmed exactly:
   ``100 * intersection >= percent * union``;
5. components of the confirmed links give ``component_id``.

A bucket or group over a block's size is cut into blocks, one row a member, and a few pivot
members join every block, which ties the blocks together. Members that then are not in the
largest component of their bucket or group (the rest) are compared with all of its members,
block by block; all other pairs are linked already. So no pair goes unseen, and rows travel in
proportion to members + rest * blocks, not members * blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdmspark.llm.common import byte_words, materialise, or_null, read_table, struct_of
from cdmspark.llm.components import connected_components, join_by_size

SYMBOLS, CHUNKS = 48, 12
#: Signature distance within which every pair is found: 12 chunks with 2 errors each need 24.
MAX_DISTANCE = 2 * CHUNKS - 1
#: Nodes, and shingles, of a bucket or group that one task holds (twice this for two blocks).
BLOCK_NODES, BLOCK_SHINGLES = 1024, 2_000_000
#: Members of a large bucket or group, as expected, that join each of its blocks.
PIVOTS = 8

_BOUNDS = [round(i * SYMBOLS / CHUNKS) for i in range(CHUNKS + 1)]
_RNG = np.random.default_rng(20240229)
_MUL = _RNG.integers(1, 2**63, SYMBOLS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _RNG.integers(0, 2**63, SYMBOLS, dtype=np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingle_set(text: str | None, k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's k-word shingles; with fewer words the
    whole sequence is the one shingle; no words give an empty set."""
    words = byte_words(text)
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    width = min(k, len(words))
    s = np.full(len(words) - width + 1, width, np.uint64)
    for i in range(width):
        s = _mix(s * np.uint64(0x9E3779B97F4A7C15) + h[i:len(h) - width + 1 + i])
    return np.unique(s)


def set_digest(s: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(s.tobytes())


def signature(s: np.ndarray) -> np.ndarray:
    """48 symbols of 16 bits of a non-empty set; long sets go through in slices."""
    low = np.full(SYMBOLS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(s), 4096):
        part = s[at:at + 4096]
        for j in range(SYMBOLS):
            m = (part * _MUL[j] + _ADD[j]).min()
            if m < low[j]:
                low[j] = m
    return (_mix(low) & np.uint64(0xFFFF)).astype(np.uint16)


def _features(k: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            sets = [shingle_set(t, k) for t in pdf["text"]]
            yield pd.DataFrame({
                "doc_id": pdf["doc_id"],
                "digest": pdf["digest"],
                "n_shingles": np.array([len(s) for s in sets], np.int64),
                "node": [set_digest(s) if len(s) else None for s in sets],
                "sig": [signature(s).tobytes() if len(s) else None for s in sets],
            })
    return run


def _keys(sig) -> F.Column:
    """The 48 index keys: per chunk and left-out symbol a hash of the others, JVM side.
    Symbol j is bytes 2j+1 and 2j+2 of the signature."""
    out = []
    for c in range(CHUNKS):
        lo, hi = _BOUNDS[c], _BOUNDS[c + 1]
        for j in range(lo, hi):
            left, right = F.substring(sig, 2 * lo + 1, 2 * (j - lo)), F.substring(sig, 2 * j + 3, 2 * (hi - j - 1))
            out.append(F.xxhash64(F.lit(c * SYMBOLS + j), F.concat(left, right)))
    return F.array(*out)


def _block(node: str, n_blocks, seed: int) -> F.Column:
    return F.pmod(F.xxhash64(F.lit(seed), node), n_blocks).cast("int")


def _in_blocks(df: DataFrame) -> DataFrame:
    """Rows (node, n, blocks, ...) of groups of n members in their block, pivots in all blocks."""
    pivot = (F.col("blocks") > 1) & (F.pmod(F.xxhash64(F.lit(11), "node"), F.col("n")) < PIVOTS)
    every = F.sequence(F.lit(0), F.col("blocks").cast("int") - 1)
    return df.withColumn("block", F.explode(F.when(pivot, every).otherwise(F.array(_block("node", F.col("blocks"), 7)))))


def _total(sizes: DataFrame) -> int:
    return sizes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def _rest_of(members: DataFrame, group: str, linked: DataFrame, block_nodes: int, block_shingles: int) -> DataFrame | None:
    """What is left to compare in groups of several blocks. ``members`` are their rows (group,
    node, blocks, n_shingles), ``linked`` (node, comp) the components found within blocks. Rows
    (group, node, label, rest, ri, bj): members outside their group's largest component go to all
    blocks of their group, all members to all blocks of their group's rest. None if all members
    are in one component."""
    labelled = materialise(members.join(linked, "node", "left").select(
        group, "node", "blocks", "n_shingles", F.coalesce("comp", "node").alias("label")), "neardup-labels")
    per_label = labelled.groupBy(group, "label").agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("w"))
    sizes = materialise(per_label.groupBy(group).agg(
        F.max(F.struct("n", "label", "w")).alias("main"), F.sum("n").alias("n"), F.sum("w").alias("w")).select(
            group, F.col("main.label").alias("main"), "n", F.greatest(
                F.ceil((F.col("n") - F.col("main.n")) / block_nodes),
                F.ceil((F.col("w") - F.col("main.w")) / block_shingles)).cast("int").alias("rest_blocks")), "neardup-rest")
    open_groups = sizes.filter("rest_blocks > 0")
    if open_groups.isEmpty():
        return None
    open_ = (join_by_size(labelled, open_groups, group, _total(open_groups))
             .withColumn("rest", F.col("label") != F.col("main")).drop("main", "n"))
    first = (open_.filter("rest").withColumn("ri", _block("node", F.col("rest_blocks"), 13))
             .withColumn("bj", F.explode(F.sequence(F.lit(0), F.col("blocks").cast("int") - 1))))
    second = (open_.withColumn("rest", F.lit(False)).withColumn("bj", _block("node", F.col("blocks"), 7))
              .withColumn("ri", F.explode(F.sequence(F.lit(0), F.col("rest_blocks") - 1))))
    return first.unionByName(second).select(group, "node", "label", "rest", "ri", "bj")


def _groups(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Whole groups from a partition sorted by ``keys``, several per frame."""
    rest = None
    for pdf in batches:
        if not len(pdf):
            continue
        if rest is not None:
            pdf = pd.concat([rest, pdf], ignore_index=True)
        last = np.logical_and.reduce([(pdf[c] == pdf[c].iloc[-1]).to_numpy() for c in keys])
        cut = int(np.argmin(last[::-1])) if not last.all() else len(pdf)
        whole, rest = pdf.iloc[:len(pdf) - cut], pdf.iloc[len(pdf) - cut:].reset_index(drop=True)
        if len(whole):
            yield whole.reset_index(drop=True)
    if rest is not None:
        yield rest


def _starts(pdf: pd.DataFrame, keys: list[str]) -> np.ndarray:
    new = np.ones(len(pdf) + 1, bool)
    new[1:-1] = np.logical_or.reduce([pdf[c].to_numpy()[1:] != pdf[c].to_numpy()[:-1] for c in keys])
    return np.flatnonzero(new)


def _stars(n: int, near) -> Iterator[tuple[int, int]]:
    """Star edges (member, root) of the graph whose rows ``near(i, others)`` gives as a mask;
    every row is asked once, so connectivity is whole without listing pairs."""
    todo = np.arange(n)
    while len(todo) > 1:
        root, todo, front = todo[0], todo[1:], [todo[0]]
        while front and len(todo):
            hit = near(front.pop(), todo)
            if hit.any():
                for v in todo[hit]:
                    yield int(v), int(root)
                    front.append(v)
                todo = todo[~hit]


def _across(nodes: list, labels: list, rest: list, near) -> Iterator[tuple[int, int]]:
    """For each row of ``rest`` one edge to each component other than its own that it is near to."""
    label = np.unique(np.array(labels, object), return_inverse=True)[1]
    for i in rest:
        others = np.flatnonzero(label != label[i])
        hit = others[near(i, others)]
        for j in hit[np.unique(label[hit], return_index=True)[1]]:
            yield i, int(j)


def _bucket_edges(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    keys = ["key", "block"]
    for pdf in _groups(batches, keys):
        sig = np.frombuffer(b"".join(pdf["sig"]), np.uint16).reshape(-1, SYMBOLS)
        node, at = pdf["node"].to_numpy(), _starts(pdf, keys)
        size = np.diff(at)
        twos = at[:-1][size == 2]
        ok = twos[(sig[twos] != sig[twos + 1]).sum(1) <= MAX_DISTANCE]
        a, b = [node[ok + 1]], [node[ok]]
        for lo, n in zip(at[:-1][size > 2], size[size > 2], strict=True):
            s = sig[lo:lo + n]
            edges = list(_stars(int(n), lambda i, todo, s=s: (s[todo] != s[i]).sum(1) <= MAX_DISTANCE))
            if edges:
                e = np.array(edges) + lo
                a.append(node[e[:, 0]])
                b.append(node[e[:, 1]])
        yield pd.DataFrame({"a": np.concatenate(a), "b": np.concatenate(b)}).drop_duplicates()


def _bucket_across(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    keys = ["key", "ri", "bj"]
    for pdf in _groups(batches, keys):
        sig = np.frombuffer(b"".join(pdf["sig"]), np.uint16).reshape(-1, SYMBOLS)
        node, label, rest, at = pdf["node"].to_numpy(), pdf["label"].to_numpy(), pdf["rest"].to_numpy(bool), _starts(pdf, keys)
        edges = [(lo + i, lo + j) for lo, hi in zip(at[:-1], at[1:], strict=True)
                 for i, j in _across(node[lo:hi], label[lo:hi], np.flatnonzero(rest[lo:hi]),
                                     lambda i, others, s=sig[lo:hi]: (s[others] != s[i]).sum(1) <= MAX_DISTANCE)]
        e = np.array(edges, np.int64).reshape(-1, 2)
        yield pd.DataFrame({"a": node[e[:, 0]], "b": node[e[:, 1]]}).drop_duplicates()


def _intersections(sets: list[np.ndarray]) -> np.ndarray | None:
    """Exact pairwise intersection sizes as a matrix, where products of 0/1 slices over the
    shingles that two sets or more share cost less than walking pairs; else None."""
    n = len(sets)
    flat, owner = np.concatenate(sets), np.repeat(np.arange(n), [len(s) for s in sets])
    _, inv, count = np.unique(flat, return_inverse=True, return_counts=True)
    keep = count[inv] > 1
    col, inv2 = np.unique(inv[keep], return_inverse=True)
    if n < 32 or n * n * len(col) * 2 / 1.5e10 > n * n * 6e-6:
        return None
    owner = owner[keep]
    order = np.argsort(inv2, kind="stable")
    inv2, owner = inv2[order], owner[order]
    out = np.zeros((n, n), np.float64)
    for at in range(0, len(col), 2048):
        lo, hi = np.searchsorted(inv2, [at, at + 2048])
        m = np.zeros((n, 2048), np.float32)
        m[owner[lo:hi], inv2[lo:hi] - at] = 1
        out += m @ m.T
    return out


def _near_sets(sets: list[np.ndarray], percent: int, dense: bool):
    """``near(i, others)``: which of the sets ``others`` are linked to set i."""
    size, common = np.array([len(s) for s in sets]), _intersections(sets) if dense else None

    def near(i, others):
        small, large = np.minimum(size[others], size[i]), np.maximum(size[others], size[i])
        hit = 100 * small >= percent * large
        if common is not None:
            both = np.rint(common[i, others]).astype(np.int64)
        else:
            both = np.zeros(len(others), np.int64)
            for p in np.flatnonzero(hit):
                both[p] = len(np.intersect1d(sets[i], sets[others[p]], assume_unique=True))
        return hit & (100 * both >= percent * (size[others] + size[i] - both))
    return near


def _confirm(k: int, percent: int, keys: list[str]):
    """Confirmed links of whole groups, as stars; with a column ``label``, those of the rest
    with members of other components."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in _groups(batches, keys):
            at = _starts(pdf, keys)
            a, b = [], []
            for lo, hi in zip(at[:-1], at[1:], strict=True):
                group, seen = pdf.iloc[lo:hi], {}
                for node, text in zip(group["node"], group["text"], strict=True):
                    if node not in seen:
                        s = shingle_set(text, k)
                        if set_digest(s) == node:  # another text under a repeated id is not this node
                            seen[node] = s
                nodes, sets = list(seen), list(seen.values())
                if len(nodes) < 2:
                    continue
                if "label" in group:
                    label, rest = dict(zip(group["node"], group["label"], strict=True)), set(group["node"][group["rest"]])
                    rows = [i for i, node in enumerate(nodes) if node in rest]
                    edges = _across(nodes, [label[n] for n in nodes], rows, _near_sets(sets, percent, len(rows) >= 32))
                else:
                    edges = _stars(len(nodes), _near_sets(sets, percent, True))
                for v, root in edges:
                    a.append(nodes[v])
                    b.append(nodes[root])
            yield pd.DataFrame({"a": a, "b": b}, dtype=object)
    return run


_EDGE = struct_of(a=T.BinaryType(), b=T.BinaryType())


def _base(docs: DataFrame) -> DataFrame:
    return docs.select(or_null(docs, "doc_id", "long").alias("doc_id"), or_null(docs, "text", "string").alias("text")).withColumn(
        "digest", text_digest(F.col("text")))


def _as_edges(found: DataFrame) -> DataFrame:
    return found.select(F.col("node").alias("a"), F.col("comp").alias("b"))


def text_digest(text: F.Column) -> F.Column:
    """What tells the rows of a repeated id apart: null and empty texts differ."""
    return F.coalesce(F.md5(text.cast("binary")), F.lit("null"))


def _linked(docs: DataFrame, k: int, percent: int, block_nodes: int = BLOCK_NODES, block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """Rows of ``docs`` as (doc_id, digest, n_shingles, node, comp, component_id): the shingle
    set, the group of linked sets it belongs to, and the least id in that group."""
    base = _base(docs)
    feats = materialise(base.mapInPandas(_features(k), struct_of(
        doc_id=T.LongType(), digest=T.StringType(), n_shingles=T.LongType(), node=T.BinaryType(), sig=T.BinaryType())), "neardup-feats")
    least = F.coalesce(F.col("doc_id"), F.lit(2**63 - 1))
    nodes = materialise(feats.filter("node is not null").groupBy("node").agg(
        F.min("doc_id").alias("rep"), F.min_by("digest", least).alias("rep_digest"), F.first("sig").alias("sig"),
        F.first("n_shingles").alias("n_shingles")), "neardup-nodes")
    sigs = nodes.select("node", "sig")
    keyed = nodes.select("node", F.explode(_keys(F.col("sig"))).alias("key"))
    shared = materialise(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
                         .withColumn("blocks", F.ceil(F.col("n") / block_nodes)), "neardup-keys")
    hits = _in_blocks(keyed.join(shared, "key")).select("key", "node", "block").join(sigs, "node")
    near = (hits.repartition("key", "block").sortWithinPartitions("key", "block").mapInPandas(_bucket_edges, _EDGE))
    groups = connected_components(near, "neardup-near")
    large = shared.filter("blocks > 1")
    if not large.isEmpty():
        rest = _rest_of(keyed.join(large, "key").withColumn("n_shingles", F.lit(0)), "key", groups, block_nodes, block_shingles)
        if rest is not None:
            more = (rest.join(sigs, "node").repartition("key", "ri", "bj").sortWithinPartitions("key", "ri", "bj")
                    .mapInPandas(_bucket_across, _EDGE))
            groups = connected_components(_as_edges(groups).union(more), "neardup-near")
    members = groups.join(nodes.select("node", "rep", "rep_digest", "n_shingles"), "node")
    sizes = materialise(members.groupBy("comp").agg(F.count(F.lit(1)).alias("n"), F.greatest(
        F.ceil(F.count(F.lit(1)) / block_nodes), F.ceil(F.sum("n_shingles") / block_shingles)).alias("blocks")), "neardup-sizes")
    wanted = materialise(join_by_size(members, sizes, "comp", _total(sizes)).select("comp", "node", "rep", "rep_digest", "n_shingles", "n", "blocks"),
                         "neardup-wanted")
    own = base["doc_id"].eqNullSafe(wanted["rep"]) & (base["digest"] == wanted["rep_digest"])
    texts = _in_blocks(base.join(wanted, own).select("comp", "node", "n", "blocks", "text")).drop("n", "blocks")
    links = (texts.repartition("comp", "block").sortWithinPartitions("comp", "block")
             .mapInPandas(_confirm(k, percent, ["comp", "block"]), _EDGE))
    found = connected_components(links, "neardup-link")
    large = wanted.filter("blocks > 1")
    if not large.isEmpty():
        rest = _rest_of(large.withColumnRenamed("comp", "family"), "family", found, block_nodes, block_shingles)
        if rest is not None:
            keys = ["family", "ri", "bj"]
            ids_of = base.join(large.select("node", "rep", "rep_digest"), base["doc_id"].eqNullSafe(F.col("rep"))
                               & (base["digest"] == F.col("rep_digest"))).select("node", "text")
            more = (rest.join(ids_of, "node").repartition(*keys).sortWithinPartitions(*keys)
                    .mapInPandas(_confirm(k, percent, keys), _EDGE))
            found = connected_components(_as_edges(found).union(more), "neardup-link")
    lowest = materialise(found.join(nodes.select("node", "rep"), "node").groupBy("comp").agg(
        F.min("rep").alias("component_id"), F.count(F.lit(1)).alias("n")), "neardup-lowest")
    placed = join_by_size(found, lowest, "comp", _total(lowest)).select("node", "comp", "component_id")
    alone = F.col("comp").isNull()
    ids = nodes.select("node", "rep").join(placed, "node", "left").select(
        "node", F.coalesce("comp", "node").alias("comp"), F.when(alone, F.col("rep")).otherwise(F.col("component_id")).alias("component_id"))
    return (feats.drop("sig").join(ids, "node", "left")
            .withColumn("component_id", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))))


def near_duplicates(docs: DataFrame, k: int = 3, percent: int = 85, block_nodes: int = BLOCK_NODES,
                    block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text; other columns are not used): doc_id,
    n_shingles, component_id (least doc_id linked, directly or through others), kept.

    Null, empty and blank texts have no shingles and stay alone, each kept. A null id takes
    part in links but is never a component's id unless all its members' ids are null; then
    component_id is null and kept false. Rows that repeat an id all get that id's answer for
    their own text. Extra columns are ignored; an empty table gives no rows."""
    return _linked(docs, k, percent, block_nodes, block_shingles).select(
        "doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"))


def keep_one(docs: DataFrame, k: int = 3, percent: int = 85) -> DataFrame:
    """``docs`` without near copies: one row of each group of linked texts stays, one with the
    least id, whole and with all its columns.

    Rows are told apart by id and text, so rows that repeat an id with different texts are judged
    each by its own text, and every text of ``docs`` is kept or has a linked text that is. Of rows
    with the same id and text one stays, as does one per id of texts without words. Where all ids
    of a group are null, all its rows stay."""
    found = materialise(_linked(docs, k, percent), "neardup-rows")
    with_id = found.filter("doc_id is not null")
    first = (with_id.filter("comp is not null and doc_id = component_id").groupBy("comp")
             .agg(F.min(F.struct("doc_id", "digest")).alias("s")).select("s.doc_id", "s.digest"))
    linked = found.filter("comp is not null and component_id is not null").select("doc_id", "digest").distinct()
    same = linked["doc_id"].eqNullSafe(first["doc_id"]) & (linked["digest"] == first["digest"])
    gone = linked.join(first, same, "left_anti").select(F.col("doc_id").alias("__id"), F.col("digest").alias("__digest"))
    own_id, own_text = or_null(docs, "doc_id", "long"), text_digest(or_null(docs, "text", "string"))
    columns = [f"`{c}`" for c in docs.columns]
    left = docs.join(gone, own_id.eqNullSafe(F.col("__id")) & (own_text == F.col("__digest")), "left_anti")
    repeats = materialise(with_id.groupBy("doc_id", "digest").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
                          .select(F.col("doc_id").alias("__id"), F.col("digest").alias("__digest")), "neardup-repeats")
    if repeats.isEmpty():
        return left.select(*columns)
    among = (own_id == F.col("__id")) & (own_text == F.col("__digest"))
    # one row per repeated id and text: an aggregate of the whole row, the least
    one = left.join(repeats, among).groupBy("__id", "__digest").agg(F.min(F.struct(*columns)).alias("row")).select("row.*")
    return left.join(repeats, among, "left_anti").select(*columns).unionByName(one)


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"))
