"""Alignment of two tokenizations of the same text, and how often tokens meet.

Both tokenizations tile the same bytes. Every token points to the farthest-right token that
overlaps it; doubling the pointers of all tokens of many texts at once (pointer jumping) leads
each to the last token of its component, which is a token of the first vocabulary that ends
where a token of the second ends too. Tokens with one terminal are a group.

1. Texts are encoded and aligned in one pass; per document the distinct linked pairs of ids and
   how often each occurs are written as packed numbers.
2. Pairs are counted by documents, each task adding up its own before the shuffle, and compared
   with the highest count of their first id (one row per id of the vocabulary at most).
3. The most frequent pairs, ``KNOWN`` at most, are looked up in a broadcast table; what is left
   of a document is joined with the counts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdmspark.llm import packing, pieces
from cdmspark.llm.common import materialise, or_null, read_table, struct_of

#: Pairs of the broadcast table at most (17 bytes each).
KNOWN = 1 << 19
#: Distinct pairs that a task counts before it sends them on.
COUNTED = 2_000_000
#: Bytes of text that are aligned together (a longer text alone).
TOGETHER = 1 << 20


class Tokens:
    """One vocabulary: encoder, bytes of every id, and their lengths."""

    def __init__(self, spelt: list[bytes]):
        self.spelt, self.size = spelt, len(spelt)
        self.length = np.array([len(b) for b in spelt], np.int64)
        self.comma = [f"{i}," for i in range(self.size)]

    def table(self, end: str) -> np.ndarray:
        """Decimal ids by 2 * id, with ``end`` in place of the comma by 2 * id + 1."""
        out = np.empty(2 * self.size, object)
        out[::2], out[1::2] = self.comma, [f"{i}{end}" for i in range(self.size)]
        return out


@lru_cache(maxsize=2)
def load(path_a: str, path_b: str):
    """(first vocabulary, its encode, second vocabulary, its encode)."""
    import sentencepiece
    from tokenizers import Tokenizer
    exact, fast = Tokenizer.from_file(path_a), packing.encoders(path_a)[1]
    exact.encode_special_tokens = True         # special strings inside texts are plain text
    at, vocab = packing._byte_of_char(), exact.get_vocab()
    spelt = [b""] * (max(vocab.values()) + 1)
    for piece, i in vocab.items():
        spelt[i] = bytes(at[c] for c in piece) if all(c in at for c in piece) else piece.encode()

    def encode_a(texts: list[str]) -> list[np.ndarray]:
        out = []
        for t in texts:
            ids = None
            if fast is not None:
                try:
                    ids = fast.encode_to_numpy(" " + t, disallowed_special=())
                except BaseException as e:  # noqa: BLE001  its regex engine panics on some very long runs
                    if isinstance(e, (KeyboardInterrupt, SystemExit, MemoryError)):
                        raise
            if ids is None:
                ids = exact.encode(" " + t, add_special_tokens=False).ids
            out.append(np.asarray(ids, np.int64))
        if fast is not None and texts and not np.array_equal(out[0], exact.encode(" " + texts[0], add_special_tokens=False).ids):
            raise ValueError("the two encoders differ")
        return out

    lib = sentencepiece.SentencePieceProcessor(model_file=path_b)
    names = [lib.id_to_piece(i) for i in range(lib.vocab_size())]
    spelt_b = [bytes([int(p[3:5], 16)]) if lib.is_byte(i) else p.replace(pieces.MARK, " ").encode() for i, p in enumerate(names)]

    def encode_b(texts: list[str]) -> list[np.ndarray]:
        return [np.array(ids, np.int64) for ids in lib.encode(texts, num_threads=1)]
    return Tokens(spelt), encode_a, Tokens(spelt_b), encode_b


def groups_of(end_a: np.ndarray, end_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Group number of every token of both sides and how many there are; ends are byte offsets
    in rising order, the last of both the same."""
    n, start_a, start_b = len(end_a), _starts(end_a), _starts(end_b)
    right_b = np.searchsorted(start_b, end_a, "left") - 1          # the last of the other side that begins before the end
    right_a = np.searchsorted(start_a, end_b, "left") - 1
    to = np.concatenate([np.where(end_b[right_b] > end_a, n + right_b, np.arange(n)), right_a]) if n else np.zeros(0, np.int64)
    while not np.array_equal(jump := to[to], to):
        to = jump
    last = to[:n] == np.arange(n)
    number = np.cumsum(last) - last
    return number[to[:n]], number[to[n:]], int(last.sum())


def _starts(end: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], end])[:len(end)].astype(np.int64)


@dataclass
class Aligned:
    """Texts aligned together: tokens of both sides with their text, group and byte end."""

    a: np.ndarray
    b: np.ndarray
    doc_a: np.ndarray
    doc_b: np.ndarray
    end_a: np.ndarray
    end_b: np.ndarray
    group_a: np.ndarray
    group_b: np.ndarray
    groups: int
    docs: int

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """Places of the two tokens of every link, by the first."""
        lo = np.searchsorted(self.end_b, _starts(self.end_a), "right")
        hi = np.searchsorted(_starts(self.end_b), self.end_a, "left")
        n = hi - lo
        return np.repeat(np.arange(len(lo)), n), np.arange(n.sum()) - np.repeat(np.cumsum(n) - n - lo, n)

    def spelt(self, table_a: np.ndarray, table_b: np.ndarray) -> list[str]:
        """Per text, its groups' ids as ``a1,a2|b1;a3|b2,b3``."""
        na, nb = (np.bincount(g, minlength=self.groups) for g in (self.group_a, self.group_b))
        out = np.empty(len(self.a) + len(self.b), object)
        last_a, last_b = (np.append(g[1:] != g[:-1], True)[:len(g)] for g in (self.group_a, self.group_b))
        out[np.arange(len(self.a)) + (np.cumsum(nb) - nb)[self.group_a]] = table_a[2 * self.a + last_a]
        out[np.arange(len(self.b)) + np.cumsum(na)[self.group_b]] = table_b[2 * self.b + last_b]
        cut = np.concatenate([[0], np.cumsum(np.bincount(self.doc_a, minlength=self.docs) + np.bincount(self.doc_b, minlength=self.docs))])
        flat = out.tolist()
        return ["".join(flat[lo:hi])[:-1] for lo, hi in zip(cut, cut[1:], strict=False)]


def align_texts(texts: list[str | None], model) -> Aligned:
    """Null and empty texts, and texts that a vocabulary does not spell back, have no tokens."""
    va, encode_a, vb, encode_b = model
    full = [t or "" for t in texts]
    own_a, own_b = encode_a(full), encode_b(full)
    none = np.zeros(0, np.int64)
    for i, t in enumerate(full):
        raw = (" " + t).encode("utf-8", "surrogatepass")
        if not t or any(b"".join([v.spelt[x] for x in ids.tolist()]) != raw for v, ids in ((va, own_a[i]), (vb, own_b[i]))):
            own_a[i] = own_b[i] = none
    a, b = (np.concatenate([none, *own]) for own in (own_a, own_b))
    doc_a, doc_b = (np.repeat(np.arange(len(full)), [len(x) for x in own]) for own in (own_a, own_b))
    end_a, end_b = np.cumsum(va.length[a]), np.cumsum(vb.length[b])
    return Aligned(a, b, doc_a, doc_b, end_a, end_b, *groups_of(end_a, end_b), len(full))


def _together(texts: list[str | None]) -> Iterator[slice]:
    at, held = 0, 0
    for i, t in enumerate(texts):
        held += len(t or "")
        if held > TOGETHER:
            yield slice(at, i + 1)
            at, held = i + 1, 0
    if at < len(texts):
        yield slice(at, len(texts))


_ALIGNED = struct_of(uid=T.LongType(), doc_id=T.LongType(), n_a=T.LongType(), n_b=T.LongType(), n_groups=T.LongType(),
                     n_links=T.LongType(), groups_sha256=T.StringType(), pairs=T.BinaryType(), times=T.BinaryType())


def _key_type(size_a: int, size_b: int) -> np.dtype:
    return np.dtype(np.uint32 if size_a * size_b <= 1 << 32 else np.uint64)


def _align(path_a: str, path_b: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load(path_a, path_b)
        va, _, vb, _ = model
        table_a, table_b, kind = va.table("|"), vb.table(";"), _key_type(va.size, vb.size)
        uid = TaskContext.get().partitionId() << 40
        for pdf in batches:
            whole = [None if t is None or t is pd.NA else t for t in pdf["text"]]
            for part in _together(whole):
                x = align_texts(whole[part], model)
                n = x.docs
                ta, tb = x.links()
                space = va.size * vb.size
                seen, times = np.unique(x.doc_a[ta] * space + x.a[ta] * vb.size + x.b[tb], return_counts=True)
                cut = np.searchsorted(seen, np.arange(n + 1) * space)
                pairs = (seen % space).astype(kind)
                rows = []
                for lo, hi in zip(cut, cut[1:], strict=False):
                    t = times[lo:hi]
                    width = np.uint8 if t.max(initial=0) < 256 else np.uint32
                    rows.append((pairs[lo:hi].tobytes(), t.astype(width).tobytes()))
                spelt = x.spelt(table_a, table_b)
                last = np.append(x.group_a[1:] != x.group_a[:-1], True)[:len(x.group_a)]
                yield pd.DataFrame({
                    "uid": np.arange(uid, uid + n), "doc_id": pdf["doc_id"].iloc[part].array,
                    "n_a": np.bincount(x.doc_a, minlength=n), "n_b": np.bincount(x.doc_b, minlength=n),
                    "n_groups": np.bincount(x.doc_a[last], minlength=n),
                    "n_links": np.bincount(x.doc_a[ta], minlength=n),
                    "groups_sha256": [hashlib.sha256(s.encode()).hexdigest() if s else "" for s in spelt],
                    "pairs": [r[0] for r in rows], "times": [r[1] for r in rows]})
                uid += n
    return run


def _count(kind: np.dtype):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pair, n = np.zeros(0, kind), np.zeros(0, np.int64)
        for pdf in batches:
            for at in range(0, len(pdf), 512):
                more, times = np.unique(np.frombuffer(b"".join(pdf["pairs"].iloc[at:at + 512]), kind), return_counts=True)
                every = np.concatenate([pair, more])
                pair, back = np.unique(every, return_inverse=True)
                n = np.bincount(back, np.concatenate([n, times]), len(pair)).astype(np.int64)
                if len(pair) > COUNTED:
                    yield pd.DataFrame({"pair": pair.astype(np.int64), "n": n})
                    pair, n = np.zeros(0, kind), np.zeros(0, np.int64)
        yield pd.DataFrame({"pair": pair.astype(np.int64), "n": n})
    return run


def pair_counts(aligned: DataFrame, size_b: int, kind: np.dtype) -> DataFrame:
    """Rows (pair, n, best): in how many documents a pair of ids is linked, and whether that is
    the highest count of its first id."""
    counts = materialise(aligned.select("pairs").mapInPandas(_count(kind), struct_of(pair=T.LongType(), n=T.LongType()))
                         .groupBy("pair").agg(F.sum("n").alias("n")), "align-counts")
    first = F.floor(F.col("pair") / size_b) if kind == np.uint64 else F.expr(f"pair div {size_b}")
    highest = counts.groupBy(first.alias("a")).agg(F.max("n").alias("top"))       # an id each, at most
    return (counts.withColumn("a", first).join(F.broadcast(highest), "a")
            .select("pair", "n", (F.col("n") == F.col("top")).alias("best")))


_LOOKED = struct_of(uid=T.LongType(), best=T.LongType(), total=T.LongType(), rare=T.ArrayType(T.LongType()),
                    rare_times=T.ArrayType(T.LongType()))


def _look_up(shared, kind: np.dtype):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pair, count, best = shared.value
        for pdf in batches:
            for at in range(0, len(pdf), 512):
                part = pdf.iloc[at:at + 512]
                size = np.array([len(p) // kind.itemsize for p in part["pairs"]])
                keys = np.frombuffer(b"".join(part["pairs"]), kind).astype(np.int64)
                times = np.concatenate([np.zeros(0, np.int64), *[
                    np.frombuffer(t, np.uint8 if len(t) == n else np.uint32).astype(np.int64)
                    for t, n in zip(part["times"], size, strict=True)]])
                place = np.minimum(np.searchsorted(pair, keys), len(pair) - 1)
                hit = pair[place] == keys if len(pair) else np.zeros(len(keys), bool)
                own = np.concatenate([[0], np.cumsum(size)])
                known = np.where(hit, times, 0)
                sums = [np.concatenate([[0], np.cumsum(x)])[own] for x in (
                    known * best[place] if len(pair) else known, known * count[place] if len(pair) else known)]
                miss = np.flatnonzero(~hit)
                cut = np.searchsorted(miss, own)
                yield pd.DataFrame({"uid": part["uid"].to_numpy(), "best": np.diff(sums[0]), "total": np.diff(sums[1]),
                                    "rare": [keys[miss[a:b]] if b > a else None for a, b in zip(cut, cut[1:], strict=False)],
                                    "rare_times": [times[miss[a:b]] if b > a else None for a, b in zip(cut, cut[1:], strict=False)]})
    return run


def align(docs: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_a, n_b, n_groups, n_links, n_best,
    count_sum, groups_sha256.

    Null and empty texts, and texts that one of the vocabularies doesn't spell back, have no
    tokens: zeros and an empty digest. Null ids and repeated rows are documents like any other,
    each counted; other columns are ignored; an empty table gives no rows."""
    spark = docs.sparkSession
    path_a, path_b = path_a or packing.tokenizer_path(), path_b or pieces.model_path()
    va, _, vb, _ = load(path_a, path_b)
    kind = _key_type(va.size, vb.size)
    base = docs.select(or_null(docs, "doc_id", "long").alias("doc_id"), or_null(docs, "text", "string").alias("text"))
    aligned = materialise(base.mapInPandas(_align(path_a, path_b), _ALIGNED), "align-documents")
    counts = materialise(pair_counts(aligned, vb.size, kind), "align-pairs")
    # the counts from which pairs fit the table; as many rows as there are different counts below it
    spread = counts.groupBy("n").agg(F.count(F.lit(1)).alias("k")).orderBy(F.desc("n")).limit(KNOWN).collect()
    least, have = 1, 0
    for r in spread:
        have += r["k"]
        if have > KNOWN:
            least = r["n"] + 1
            break
    table = counts.filter(F.col("n") >= least).toPandas().sort_values("pair")
    shared = spark.sparkContext.broadcast((table["pair"].to_numpy(np.int64), table["n"].to_numpy(np.int64),
                                           table["best"].to_numpy(bool)))
    looked = materialise(aligned.select("uid", "pairs", "times").mapInPandas(_look_up(shared, kind), _LOOKED), "align-looked-up")
    rare = (looked.filter("rare is not null").select("uid", F.explode(F.arrays_zip("rare", "rare_times")).alias("r"))
            .select("uid", F.col("r.rare").alias("pair"), F.col("r.rare_times").alias("times")))
    more = (rare.join(counts.filter(F.col("n") < least), "pair").groupBy("uid").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"),
        F.sum(F.col("times") * F.col("n")).alias("more_total")))
    zero = F.lit(0).cast("long")
    return (aligned.drop("pairs", "times").join(looked.select("uid", "best", "total"), "uid").join(more, "uid", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", (F.col("best") + F.coalesce("more_best", zero)).alias("n_best"),
        (F.col("total") + F.coalesce("more_total", zero)).alias("count_sum"), "groups_sha256"))


_GROUP = T.ArrayType(struct_of(start=T.LongType(), end=T.LongType(), a=T.ArrayType(T.LongType()), b=T.ArrayType(T.LongType())))


def token_groups(docs: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id and its groups in order, each with its byte range in
    the text behind a space and the ids of both sides. Rows without tokens have no groups."""
    path_a, path_b = path_a or packing.tokenizer_path(), path_b or pieces.model_path()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load(path_a, path_b)
        for pdf in batches:
            for doc, text in zip(pdf["doc_id"].array, pdf["text"], strict=True):
                x = align_texts([text], model)
                found = [{"start": 0, "end": 0, "a": [], "b": []} for _ in range(x.groups)]
                for side, ids, group in (("a", x.a, x.group_a), ("b", x.b, x.group_b)):
                    for i, g in zip(ids.tolist(), group.tolist(), strict=True):
                        found[g][side].append(i)
                for g, e in zip(x.group_a.tolist(), x.end_a.tolist(), strict=True):
                    found[g]["end"] = e
                for left, right in zip(found, found[1:], strict=False):
                    right["start"] = left["end"]
                yield pd.DataFrame({"doc_id": pd.array([doc], "Int64"), "groups": [found]})
    base = docs.select(or_null(docs, "doc_id", "long").alias("doc_id"), or_null(docs, "text", "string").alias("text"))
    return base.mapInPandas(run, struct_of(doc_id=T.LongType(), groups=_GROUP))


def op12_token_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align(read_table(spark, sf_dir, "documents"))
