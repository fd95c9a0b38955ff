"""Hierarchical multi-length packing of whole token streams into training windows.

Each task packs its own documents in one pass with bounded memory and no shuffle. A
document's whole 2048-token stretches are windows of their own. What remains is routed by
length to the tier of the smallest context size that holds it (256, 512, 1024 or 2048). When
the pool is full, windows are opened longest piece first, each at its piece's tier; the gap is
filled with the longest pieces that fit, which come from the same and shorter tiers, and the
last gap by cutting the smallest piece that is longer. So every window is exactly full, with
at most one cut. A task's last tokens, fewer than its next window, close into windows of
falling powers of two. Windows of one size are then dealt to step groups of equal tokens, back
and forth by attention cost, so that the groups of a deal cost about the same.

Window lengths are powers of two throughout, so there is no padding.
"""

from __future__ import annotations

import json
import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from cdmspark.llm.common import or_null, read_table, struct_of

TIERS = (256, 512, 1024, 2048)
#: Token that ends every document.
END = 1
#: Tokens that a task pools before it packs down to half of them.
POOL_TOKENS = 1 << 20
#: Tokens of a step group, and groups that are dealt together.
STEP_TOKENS, DEAL = 8 * 2048, 4
#: Texts of each Arrow batch that are encoded by both libraries and compared.
COMPARED = 1


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_of_char() -> dict[str, int]:
    """Byte-level BPE writes printable Latin-1 bytes as themselves and the others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@lru_cache(maxsize=2)
def encoders(path: str):
    """(tokenizers' Tokenizer, the same vocabulary as a tiktoken Encoding or None). The second
    is several times faster; it is used only where the file proves that both mean the same:
    plain byte-level BPE whose token ids follow its merge order."""
    import tiktoken
    from tokenizers import Tokenizer
    exact, spec = Tokenizer.from_file(path), json.load(open(path, encoding="utf-8"))
    model, added, pre = spec["model"], spec.get("added_tokens", []), spec.get("pre_tokenizer") or {}
    vocab, special = model["vocab"], {x["content"]: x["id"] for x in added}
    merged = [vocab.get("".join(m if isinstance(m, list) else m.split(" ")), -1) for m in model["merges"]]
    plain = (model["type"] == "BPE" and not model.get("unk_token") and not model.get("dropout")
             and not model.get("continuing_subword_prefix") and not model.get("end_of_word_suffix")
             and not model.get("ignore_merges") and spec.get("normalizer") is None and pre.get("type") == "ByteLevel"
             and not pre.get("add_prefix_space") and pre.get("use_regex", True)
             and all(a < b for a, b in zip(merged, merged[1:], strict=False)) and min(merged, default=0) >= 256
             and not any(x.get(k) for x in added for k in ("lstrip", "rstrip", "single_word")))
    if not plain:
        return exact, None
    at = _byte_of_char()
    ranks = {bytes(at[c] for c in piece): i for piece, i in vocab.items() if piece not in special}
    import public_tokenizers
    return exact, tiktoken.Encoding("packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                    special_tokens=special)


def encode(text: str, path: str, compare: bool = False) -> np.ndarray:
    """Ids as the tokenizers library gives them without added special tokens, as uint32."""
    exact, fast = encoders(path)
    ids = None
    if fast is not None:
        try:
            ids = np.asarray(fast.encode_to_numpy(text, allowed_special="all"), np.uint32)
        except BaseException as e:  # noqa: BLE001  its regex engine panics on some very long runs
            if isinstance(e, (KeyboardInterrupt, SystemExit, MemoryError)):
                raise
    if ids is None or compare:
        want = np.array(exact.encode(text, add_special_tokens=False).ids, np.uint32)
        if ids is not None and not np.array_equal(ids, want):
            raise ValueError("the two encoders differ")
        ids = want
    return ids


class Pool:
    """Pieces (document, its length, start, ids) by length; the longest that fits is found by a
    bit mask of the lengths present."""

    def __init__(self):
        self.by, self.mask, self.tokens = defaultdict(list), 0, 0

    def put(self, piece: tuple) -> None:
        n = len(piece[3])
        self.by[n].append(piece)
        self.mask |= 1 << n
        self.tokens += n

    def take(self, n: int) -> tuple:
        piece = self.by[n].pop()
        if not self.by[n]:
            del self.by[n]
            self.mask &= ~(1 << n)
        self.tokens -= n
        return piece

    def longest(self, most: int) -> int:
        """Length of the longest piece of at most ``most`` tokens, 0 if there is none."""
        return max(0, (self.mask & ((1 << (most + 1)) - 1)).bit_length() - 1)

    def window(self, size: int) -> list[tuple]:
        """Pieces that fill a window exactly; the pool must hold ``size`` tokens."""
        out, gap = [], size
        while gap:
            n = self.longest(gap)
            if n:
                out.append(self.take(n))
            else:  # all are longer: cut the smallest of them
                above = self.mask >> (gap + 1)
                doc, total, start, ids = self.take(gap + (above & -above).bit_length())
                out.append((doc, total, start, ids[:gap]))
                self.put((doc, total, start + gap, ids[gap:]))
                n = gap
            gap -= n
        return out


def _pack(path: str):
    top = TIERS[-1]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        base = TaskContext.get().partitionId() << 40
        pool, made, rows = Pool(), {t: [] for t in TIERS}, []
        ids_used = {"sequence": base, "group": base}

        def deal(size: int, last: bool = False) -> None:
            """Gives waiting windows of a size to full step groups, costliest first, back and
            forth; at the end what is left is one group more."""
            wait, per = made[size], max(1, STEP_TOKENS // size)
            while len(wait) >= per * DEAL or last and wait:
                groups = min(DEAL, len(wait) // per) or 1
                turn, made[size] = wait[:groups * per], wait[groups * per:]
                turn.sort(key=lambda w: -sum(len(p[3]) ** 2 for p in w))
                for i, pieces in enumerate(turn):
                    lap, j = divmod(i, groups)
                    group, offset = ids_used["group"] + (groups - 1 - j if lap % 2 else j), 0
                    for doc, total, start, ids in pieces:
                        rows.append((doc, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), total,
                                     ids_used["sequence"], offset, size, group))
                        offset += len(ids)
                    ids_used["sequence"] += 1
                ids_used["group"] += groups
                wait = made[size]

        def close(size: int) -> None:
            made.setdefault(size, []).append(pool.window(size))
            deal(size)

        def frame() -> pd.DataFrame:
            out = pd.DataFrame(rows, columns=COLUMNS)
            rows.clear()
            return out.astype({c: "int64" for c in COLUMNS[1:]}).astype({"doc_id": "Int64"})

        def drain(down_to: int) -> None:
            while pool.tokens > down_to:
                size = next(t for t in TIERS if t >= pool.longest(top))
                if pool.tokens < size:  # only at the end
                    size = 1 << (pool.tokens.bit_length() - 1)
                close(size)

        for pdf in batches:
            for i, (doc, text) in enumerate(zip(pdf["doc_id"].array, pdf["text"], strict=True)):
                ids = np.append(encode(text or "", path, i < COMPARED), np.uint32(END))
                cut, total = len(ids) // top * top, len(ids)
                for start in range(0, cut, top):
                    made[top].append([(doc, total, start, ids[start:start + top])])
                deal(top)
                if cut < total:
                    pool.put((doc, total, cut, ids[cut:].copy()))
                if pool.tokens >= POOL_TOKENS:
                    drain(POOL_TOKENS // 2)
                if len(rows) >= 20_000:
                    yield frame()
        drain(0)
        for size in sorted(made, reverse=True):
            deal(size, last=True)
        yield frame()
    return run


_SCHEMA = struct_of(doc_id=T.LongType(), start=T.LongType(), length=T.LongType(), ids_crc32=T.LongType(),
                    doc_tokens=T.LongType(), sequence_id=T.LongType(), offset=T.LongType(), window=T.LongType(),
                    step_group=T.LongType())
COLUMNS = _SCHEMA.names


def pack(docs: DataFrame, path: str | None = None) -> DataFrame:
    """One row per piece: doc_id, start (ids of the document before it), length, ids_crc32,
    doc_tokens, sequence_id, offset in its sequence, window (the sequence's length) and
    step_group.

    A null text is empty and, like an empty one, is the end token alone. Null ids and repeated
    rows are documents of their own; other columns are ignored; an empty table gives no rows.
    Which documents meet in a window depends on how the input is split, what the pieces of a
    document hold does not."""
    base = docs.select(or_null(docs, "doc_id", "long").alias("doc_id"), or_null(docs, "text", "string").alias("text"))
    return base.mapInPandas(_pack(path or tokenizer_path()), _SCHEMA)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read_table(spark, sf_dir, "documents"))
