"""Language-model scores of whole documents by a gated recurrent model (``gru``).

1. Tokens of the training documents are counted, pre-aggregated per task: the counts give the
   base score of every document and the output classes. Frequent words have head classes; any
   other word belongs to a tail class that its spelling decides, and gets its count's share of
   it, unknown words together the share of words seen once.
2. Every document is encoded once, as the model's input ids in two bytes a token, and written;
   training and scoring read those.
3. The model is trained on all training documents by truncated backpropagation. Documents are
   dealt by hash to shards of ``SHARD`` tokens, whatever the partitioning; each shard trains
   from common weights, with as many lanes as leave it enough steps, and the weights are
   averaged by tokens, level by level, between two rounds over disjoint shards. One training
   document in ``HELD_BACK`` takes no part; of the start weights and those after each round the
   ones under which these documents are likeliest are kept.
4. One pass scores all documents, with the state carried across windows to the document's
   end. Words over a count that at most ``KNOWN`` words reach are looked up in a broadcast
   table of bounded size; the others, rare by construction, are joined with the counts.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdmspark.llm import gru
from cdmspark.llm.common import byte_words, crc_remainder, materialise, or_null, read_table, struct_of

#: Words, and bytes of a word, of the broadcast table at most.
KNOWN, KNOWN_BYTES = 1 << 17, 64
#: Distinct words that a task counts before it sends them on; tokens that it holds to train on or
#: score (a block takes as many steps as its longest document, so it should be large).
COUNTED, BLOCK = 300_000, 4_000_000
#: Tokens of a shard, and steps that a shard trains for at least (with fewer lanes, then again).
SHARD, STEPS, FEW_LANES, PASSES = 4_000_000, 250, 32, 4
#: Rounds of training: which shards by their number modulo 4, and Adagrad's rate. Fewer than
#: four shards take part in every round.
ROUNDS = (((0,), 0.1), ((1, 2, 3), 0.1))
#: Tokens from which training cuts a document, so that no lane runs on alone; scoring cuts none.
PIECE = 4096
#: One training document in so many is held back to choose the weights by.
HELD_BACK = 64
#: Weight vectors that one task adds up, and that reach the driver at most.
FAN_IN, AT_DRIVER = 16, 16
END = b""
PSEUDO = 0.1


def tail_of(word: bytes) -> int:
    """Tail class of a word, by its last two bytes."""
    return zlib.crc32(word[-2:]) % gru.TAILS


def _tail(word: Column) -> Column:
    """``tail_of`` for a binary column."""
    return (F.crc32(F.substring(word, -2, 2)) % gru.TAILS).cast("int")


def _tokens(text: str | None) -> list[bytes]:
    words = byte_words(text)
    words.append(END)
    return words


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    seen: Counter = Counter()

    def out() -> pd.DataFrame:
        frame = pd.DataFrame({"word": list(seen), "c": list(seen.values())})
        seen.clear()
        return frame.astype({"c": "int64"})
    for pdf in batches:
        for text in pdf["text"]:
            seen.update(_tokens(text))
            if len(seen) > COUNTED:
                yield out()
    yield out()


class _Lookup(dict):
    """Rank of a word in the table; of any other minus its tail class, less 1."""

    def __missing__(self, word: bytes) -> int:
        return -1 - tail_of(word)


class Vocabulary:
    """What workers know: the table's words by falling count, and what each is worth."""

    def __init__(self, words: list[bytes], counts: list[int], total: int, distinct: int,
                 tail_total: list[int], tail_once: list[int]):
        order = sorted(range(len(words)), key=lambda i: (words[i] != END, -counts[i], words[i]))
        self.words = [words[i] for i in order]
        self.counts = np.array([counts[i] for i in order], np.float64)
        self.total, self.distinct = total, distinct
        self.heads = min(len(words), gru.FREQUENT)
        left, once = np.array(tail_total, np.float64), np.array(tail_once, np.float64)
        for w, c in zip(self.words[:self.heads], self.counts, strict=False):
            left[tail_of(w)] -= c
            once[tail_of(w)] -= c == 1
        self.tail_total = left
        #: share of unknown words in each tail, by the words seen once; all of a tail without words
        self.unknown = np.where(left > 0, (once + 0.5) / (left + 1), 1.0)

    def tables(self) -> None:
        """Filled in by each worker: the lookup, input ids, and log10 values by rank."""
        if hasattr(self, "lookup"):
            return
        self.lookup = _Lookup({w: i for i, w in enumerate(self.words)})
        tail = np.array([tail_of(w) for w in self.words] or [0])
        self.input = np.where(np.arange(len(tail)) < self.heads, np.arange(len(tail)), gru.FREQUENT + tail).astype(np.int32)
        counts = self.counts if len(self.words) else np.zeros(1)
        self.base = np.log10(counts + PSEUDO)
        own = np.maximum(self.tail_total[tail], 1)
        with np.errstate(divide="ignore"):
            share = np.log10((1 - self.unknown[tail]) * counts / own)
        self.share = np.where(np.arange(len(tail)) < self.heads, 0.0, share)

    def ranks(self, tokens: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.lookup.__getitem__, tokens), np.int64, len(tokens))

    def inputs(self, ranks: np.ndarray) -> np.ndarray:
        return np.where(ranks >= 0, self.input[np.maximum(ranks, 0)], gru.FREQUENT - 1 - ranks).astype(np.int32)

    def start(self) -> dict:
        words = np.zeros(gru.FREQUENT)
        words[:self.heads] = self.counts[:self.heads]
        words = words.reshape(gru.HEADS, gru.WIDTH)
        heads = words.sum(1)
        return gru.start(np.concatenate([heads, self.tail_total]) / max(1, self.total),
                         words / np.maximum(heads, 1)[:, None])


def vocabulary(counts: DataFrame) -> tuple[Vocabulary, int]:
    """From (word, c) rows: what is broadcast, and the count from which words are in it."""
    by_count = counts.groupBy("c").agg(F.count(F.lit(1)).alias("n")).collect()  # about sqrt(tokens) rows at most
    total, distinct = sum(r["c"] * r["n"] for r in by_count), sum(r["n"] for r in by_count)
    least, have = 1, 0
    for r in sorted(by_count, key=lambda r: -r["c"]):
        have += r["n"]
        if have > KNOWN:
            least = r["c"] + 1
            break
    rows = counts.filter(((F.col("c") >= least) & (F.octet_length("word") <= KNOWN_BYTES)) | (F.col("word") == END))
    table = rows.select("word", "c").toPandas()
    tails = {r["tail"]: r for r in counts.groupBy(_tail(F.col("word")).alias("tail")).agg(
        F.sum("c").alias("c"), F.sum((F.col("c") == 1).cast("long")).alias("once")).collect()}
    each = [tails.get(k) for k in range(gru.TAILS)]
    return Vocabulary([bytes(w) for w in table["word"]], table["c"].tolist(), total, distinct,
                      [r["c"] if r else 0 for r in each], [r["once"] if r else 0 for r in each]), least


_ENCODED = struct_of(uid=T.LongType(), doc_id=T.LongType(), held_out=T.BooleanType(), n_tokens=T.LongType(),
                     known=T.LongType(), base=T.DoubleType(), share=T.DoubleType(), rare=T.BinaryType(), ids=T.BinaryType())


def _encode(vocab):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        v = vocab.value
        v.tables()
        uid = TaskContext.get().partitionId() << 40
        for pdf in batches:
            for at in range(0, len(pdf), 512):
                part = pdf.iloc[at:at + 512]
                own = [_tokens(t) for t in part["text"]]
                size = np.array([len(t) for t in own])
                words = [w for t in own for w in t]
                r, first = v.ranks(words), np.cumsum(size) - size
                ids, hit = v.inputs(r).astype(np.int16), r >= 0
                known = np.maximum(r, 0)
                sums = [np.add.reduceat(np.where(hit, x[known], 0.0), first) for x in (v.base, v.share)]
                miss = np.flatnonzero(~hit)
                cut = np.searchsorted(miss, [*first, len(words)])
                yield pd.DataFrame({
                    "uid": np.arange(uid, uid + len(part)), "doc_id": part["doc_id"].astype("Int64").array,
                    "held_out": part["held_out"].to_numpy(), "n_tokens": size, "known": np.add.reduceat(hit.astype(np.int64), first),
                    "base": sums[0], "share": sums[1],  # words hold no space
                    "rare": [b" ".join([words[i] for i in miss[a:b].tolist()]) if b > a else None for a, b in zip(cut, cut[1:], strict=False)],
                    "ids": [ids[a:a + n].tobytes() for a, n in zip(first.tolist(), size.tolist(), strict=True)]})
                uid += len(part)
    return run


def _blocks(column: pd.Series) -> Iterator[tuple[slice, list[np.ndarray]]]:
    """Ids of rows that make up about ``BLOCK`` tokens."""
    at, held, block = 0, 0, []
    for i, raw in enumerate(column):
        block.append(np.frombuffer(raw, np.int16))
        held += len(block[-1])
        if held >= BLOCK:
            yield slice(at, i + 1), block
            at, held, block = i + 1, 0, []
    if block:
        yield slice(at, len(column)), block


def _train(vocab, weights, rate: float):
    def run(key, pdf):
        v = vocab.value
        v.tables()
        pdf = pdf.sort_values("uid")     # rows come from the shuffle in any order
        end = int(v.input[v.lookup[END]])
        tokens = sum(map(len, pdf["ids"])) // 2
        lanes = min(gru.LANES, max(FEW_LANES, 1 << max(0, (tokens // (gru.WINDOW * STEPS)).bit_length() - 1)))
        passes = min(PASSES, -(-STEPS * gru.WINDOW * lanes // max(1, tokens)))
        trainer = gru.Trainer(gru.from_vector(np.frombuffer(weights.value, np.float32)), rate, lanes)
        for _ in range(passes):
            for _, block in _blocks(pdf["ids"]):
                cut = [x[i:i + PIECE] for x in block for i in range(0, len(x), PIECE)]
                trainer.run(gru.Lanes.deal(cut, end, lanes))
        return pd.DataFrame({"part": [int(key[0])], "tokens": [trainer.tokens], "loss": [trainer.loss],
                             "weights": [gru.to_bytes(trainer.p)]})
    return run


def _mean(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row with the mean weights by tokens; runs in tasks and, for the last few, on the driver."""
    part = TaskContext.get().partitionId() if TaskContext.get() else 0
    tokens, loss, total = 0, 0.0, None
    for pdf in batches:
        for n, x, w in zip(pdf["tokens"], pdf["loss"], pdf["weights"], strict=True):
            v = np.frombuffer(w, np.float32).astype(np.float64) * n
            total, tokens, loss = v if total is None else total + v, tokens + n, loss + x
    if total is not None:
        yield pd.DataFrame({"part": [part], "tokens": [tokens], "loss": [loss],
                            "weights": [(total / tokens).astype(np.float32).tobytes()]})


_WEIGHTS = struct_of(part=T.IntegerType(), tokens=T.LongType(), loss=T.DoubleType(), weights=T.BinaryType())


def _held_back(uid: str = "uid") -> Column:
    return F.pmod(F.xxhash64(uid, F.lit("held back")), F.lit(HELD_BACK)) == 0


def train(encoded: DataFrame, vocab: Vocabulary, rounds=ROUNDS) -> dict:
    """Weights learned from the rows of ``encoded`` that aren't held out."""
    spark = encoded.sparkSession
    start, shared = gru.to_bytes(vocab.start()), spark.sparkContext.broadcast(vocab)
    shards = max(1, -(-vocab.total // SHARD))
    shard = F.pmod(F.xxhash64("uid", F.lit("shard")), F.lit(shards))
    training = encoded.filter(~F.col("held_out"))
    learning = training.filter(~_held_back()).select(shard.cast("int").alias("shard"), "uid", "ids")
    every = [start]
    for part, rate in rounds:
        rows = learning.filter((F.col("shard") % 4).isin(*part)) if shards >= 4 else learning
        now = spark.sparkContext.broadcast(every[-1])
        got = materialise(rows.groupBy("shard").applyInPandas(_train(shared, now, rate), _WEIGHTS), "lm-weights")
        while (n := got.count()) > AT_DRIVER:
            got = materialise(got.repartition(-(-n // FAN_IN), "part").mapInPandas(_mean, _WEIGHTS), "lm-weights")
        parts = sorted(got.collect(), key=lambda r: r["part"])  # AT_DRIVER vectors of fixed size at most
        if parts:
            every.append(next(_mean(iter([pd.DataFrame([r.asDict() for r in parts])])))["weights"][0])
    likely = _log_sums(training.filter(_held_back()), every, vocab)
    return gru.from_vector(np.frombuffer(every[int(np.argmax(likely))], np.float32))


def _log_sums(encoded: DataFrame, every: list[bytes], vocab: Vocabulary) -> list[float]:
    """Log-probability of all rows under each of some weights."""
    end, shared = vocab.words.index(END), encoded.sparkSession.sparkContext.broadcast(every)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        models = [gru.from_vector(np.frombuffer(w, np.float32)) for w in shared.value]
        for pdf in batches:
            for _, block in _blocks(pdf["ids"]):
                lanes = gru.Lanes.deal(block, end)
                yield pd.DataFrame({"model": range(len(models)), "log": [gru.score(p, lanes, len(block)).sum() for p in models]})
    rows = encoded.select("ids").mapInPandas(run, struct_of(model=T.IntegerType(), log=T.DoubleType()))
    got = {r["model"]: r["log"] for r in rows.groupBy("model").agg(F.sum("log").alias("log")).collect()}
    return [got.get(i, 0.0) for i in range(len(every))]


_SCORED = struct_of(uid=T.LongType(), doc_id=T.LongType(), held_out=T.BooleanType(), n_tokens=T.LongType(),
                    known=T.LongType(), base=T.DoubleType(), score=T.DoubleType(), rare=T.BinaryType())


def _score(end: int | None, weights):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        p = gru.from_vector(np.frombuffer(weights.value, np.float32))
        held, size = [], 0

        def flush() -> pd.DataFrame:
            pdf = pd.concat(held, ignore_index=True)
            block = [np.frombuffer(raw, np.int16) for raw in pdf["ids"]]
            log = gru.score(p, gru.Lanes.deal(block, end), len(block)) if end is not None else np.zeros(len(block))
            pdf["score"] = pdf["share"] + log / math.log(10)
            held.clear()
            return pdf[[f.name for f in _SCORED]].astype({"doc_id": "Int64"})
        for pdf in batches:
            for part, block in _blocks(pdf["ids"]):  # a block takes as many steps as its longest document
                held.append(pdf.iloc[part])
                size += sum(map(len, block))
                if size >= BLOCK:
                    yield flush()
                    size = 0
        if held:
            yield flush()
    return run


def lm_scores(docs: DataFrame, rounds=ROUNDS) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, held_out (not learned from), n_tokens,
    n_known, train_tokens, base_score and score, both log10 probabilities.

    A null text is empty: its one token is the end. A null id counts as remainder 0 and so is
    held out. Repeated rows are documents each. Where nothing is learned from, both scores are
    0; without ``rounds`` the start weights score. Other columns are ignored; an empty table gives no rows."""
    spark = docs.sparkSession
    base = docs.select(or_null(docs, "doc_id", "long").alias("doc_id"), or_null(docs, "text", "string").alias("text"))
    base = base.withColumn("held_out", crc_remainder(F.col("doc_id"), 10) == 0)
    counts = materialise(
        base.filter(~F.col("held_out")).select("text").mapInPandas(_count, struct_of(word=T.BinaryType(), c=T.LongType()))
        .groupBy("word").agg(F.sum("c").alias("c")), "lm-counts")
    vocab, least = vocabulary(counts)
    encoded = materialise(base.mapInPandas(_encode(spark.sparkContext.broadcast(vocab)), _ENCODED), "lm-encoded")
    weights = train(encoded, vocab, rounds) if vocab.total else vocab.start()
    end = vocab.words.index(END) if vocab.total else None
    scored = materialise(encoded.mapInPandas(_score(end, spark.sparkContext.broadcast(gru.to_bytes(weights))), _SCORED), "lm-scored")
    # one row per occurrence of a rare word (the end is rare only where nothing was learned)
    parts = F.split(F.col("rare").cast("string"), " ")
    rare = (scored.filter("rare is not null").select("uid", F.explode(parts).alias("word"))
            .withColumn("word", F.col("word").cast("binary")))
    few = counts.filter((F.col("c") < least) | (F.octet_length("word") > KNOWN_BYTES)).select("word", "c")
    tail = _tail(F.col("word")) + 1
    own = F.array(*[F.lit(float(x)) for x in np.log10(np.maximum(vocab.tail_total, 1)) - np.log10(np.maximum(1 - vocab.unknown, 1e-300))])
    lost = F.array(*[F.lit(float(x)) for x in np.log10(vocab.unknown)])
    seen = F.col("c").isNotNull()
    joined = rare.join(few, "word", "left").select(
        "uid", seen.cast("long").alias("known"), F.log10(F.coalesce(F.col("c"), F.lit(0)) + F.lit(PSEUDO)).alias("base"),
        F.when(seen, F.log10(F.col("c")) - F.element_at(own, tail)).otherwise(F.element_at(lost, tail)).alias("score"))
    extra = joined.groupBy("uid").agg(F.sum("known").alias("k"), F.sum("base").alias("b"), F.sum("score").alias("s"))
    norm = math.log10(vocab.total + PSEUDO * (vocab.distinct + 1))
    zero = F.lit(0.0)
    return (scored.drop("rare").join(extra, "uid", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("k", F.lit(0))).cast("long").alias("n_known"),
        F.lit(vocab.total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("b", zero) - F.col("n_tokens") * F.lit(norm)).alias("base_score"),
        (F.col("score") + F.coalesce("s", zero) if vocab.total else zero).alias("score")))


def op4_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(read_table(spark, sf_dir, "documents"))
