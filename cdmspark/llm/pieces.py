"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

Encoding keeps an agenda of adjacent symbol pairs ordered by the score of the piece they
would make (then by place); the best is merged, its neighbours' pairs join the agenda, until
it is empty. Symbols that are no piece fall back to bytes. No piece holds a space mark except
at its front or a lone run of them, nor a character that is missing from all pieces, so a text
splits into chunks whose merges can't touch; each distinct chunk is encoded once per worker
and remembered, in a memory of bounded size.

Each Arrow batch is checked against the sentencepiece library: every chunk that is new to the
worker, and every sixteenth whole text (ids and decoded text). A difference stops the job.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from cdmspark.llm.common import or_null, read_table, struct_of

MARK, NONE = "▁", float("-inf")
#: Chunks that a worker remembers before it starts anew, and the longest it remembers.
REMEMBERED, LONGEST = 800_000, 48
#: Up to this length the agenda is a plain list.
SHORT = 40
#: Every so many texts are encoded whole by the library too.
WHOLE_EVERY = 16


def model_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


class PieceModel:
    """Vocabulary of a BPE model file and the two directions; texts in, ids out and back."""

    def __init__(self, path: str):
        import sentencepiece
        self.library = lib = sentencepiece.SentencePieceProcessor(model_file=path)
        size = lib.vocab_size()
        pieces = [lib.id_to_piece(i) for i in range(size)]
        special = [lib.is_control(i) or lib.is_unknown(i) or lib.is_unused(i) or lib.is_byte(i) for i in range(size)]
        self.ids = {p: i for i, p in enumerate(pieces) if not special[i]}
        self.score = {p: lib.get_score(i) for p, i in self.ids.items()}
        self.byte = {int(p[3:5], 16): i for i, p in enumerate(pieces) if lib.is_byte(i)}
        self.value = {i: b for b, i in self.byte.items()}
        self.control = {i for i in range(size) if lib.is_control(i)}
        self.unknown = lib.unk_id()
        self.pieces = pieces
        if any(MARK in p.strip(MARK) or (p.strip(MARK) and p.endswith(MARK)) for p in self.ids):
            raise ValueError("a piece joins words: chunks would not be independent")
        known = {c for p in self.ids for c in p}
        #: A chunk: marks with the text up to the next mark or lone character, or one of those.
        lone = "".join(re.escape(c) for c in map(chr, range(0x80)) if c not in known)
        self.chunk = re.compile(f"{MARK}*[^{MARK}{lone}]+|{MARK}+|[{lone}]")
        #: Ids of chunks seen, as text; and the few chunks that their ids do not spell alike.
        self.memory: dict[str, str] = {}
        self.respelt: dict[str, str] = {}

    def encode_chunk(self, chunk: str) -> list[int]:
        sym = self._merge_short(chunk) if len(chunk) <= SHORT else self._merge_long(chunk)
        out = []
        for s in sym:
            piece = self.ids.get(s)
            if piece is not None:
                out.append(piece)
            elif self.byte:
                out += [self.byte[b] for b in s.encode("utf-8", "replace")]
            else:
                out.append(self.unknown)
        return out

    def _merge_short(self, chunk: str) -> list[str]:
        """The agenda as a plain list, one score per adjacent pair: least work for a word."""
        get, sym = self.score.get, list(chunk)
        agenda = [get(a + b, NONE) for a, b in zip(sym, sym[1:], strict=False)]
        while agenda:
            best = max(agenda)
            if best == NONE:
                break
            i = agenda.index(best)
            sym[i:i + 2] = [sym[i] + sym[i + 1]]
            del agenda[i]
            if i < len(agenda):
                agenda[i] = get(sym[i] + sym[i + 1], NONE)
            if i:
                agenda[i - 1] = get(sym[i - 1] + sym[i], NONE)
        return sym

    def _merge_long(self, chunk: str) -> list[str]:
        """The agenda as a heap over linked symbols."""
        score = self.score
        sym, n = list(chunk), len(chunk)
        nxt, prv = [*range(1, n), -1], [*range(-1, n - 1)]
        agenda = []
        for i in range(n - 1):
            s = score.get(sym[i] + sym[i + 1])
            if s is not None:
                agenda.append((-s, i, len(sym[i]) + len(sym[i + 1])))
        heapq.heapify(agenda)
        while agenda:
            _, i, size = heapq.heappop(agenda)
            left = sym[i]
            j = nxt[i] if left else -1
            if j < 0 or len(left) + len(sym[j]) != size:
                continue  # one of the two has merged with another
            sym[i], sym[j] = left + sym[j], ""
            k = nxt[i] = nxt[j]
            if k >= 0:
                prv[k] = i
                s = score.get(sym[i] + sym[k])
                if s is not None:
                    heapq.heappush(agenda, (-s, i, len(sym[i]) + len(sym[k])))
            h = prv[i]
            if h >= 0:
                s = score.get(sym[h] + sym[i])
                if s is not None:
                    heapq.heappush(agenda, (-s, h, len(sym[h]) + len(sym[i])))
        return [s for s in sym if s]

    def normalise(self, text: str) -> str:
        """Spaces become marks and a mark goes in front; no text stays no text."""
        return MARK + text.replace(" ", MARK) if text else ""

    def decode(self, ids: list[int]) -> str:
        """Pieces joined, bytes as UTF-8 (U+FFFD for each byte that is not), marks as spaces,
        without the mark that encoding puts in front; control ids give nothing."""
        return self._front(self._spell(ids))

    def _front(self, spelt: str) -> str:
        return (spelt[1:] if spelt[:1] == MARK else spelt).replace(MARK, " ")

    def _spell(self, ids: list[int]) -> str:
        out, run = [], bytearray()
        for i in [*ids, None]:
            b = self.value.get(i)
            if b is not None:
                run.append(b)
                continue
            if run:
                out.append(_utf8(bytes(run)))
                run.clear()
            if i is not None and i not in self.control:
                out.append(" ⁇ " if i == self.unknown else self.pieces[i])
        return "".join(out)

    def _learn(self, chunks: list[str]) -> None:
        """Encodes chunks by the agenda, checks them against the library, and remembers them."""
        ids = [self.encode_chunk(c) for c in chunks]
        # the library puts a mark in front itself; before anything else goes a lone line break
        probe = [c[1:].replace(MARK, " ") if c[0] == MARK and len(c) > 1 else "\n" + c.replace(MARK, " ") for c in chunks]
        lead = self.library.encode("\n")
        for chunk, mine, asked, theirs in zip(chunks, ids, probe, self.library.encode(probe, num_threads=1), strict=True):
            want = lead + mine if asked[:1] == "\n" and chunk[0] != MARK or chunk == MARK else mine
            if want != theirs:
                raise ValueError(f"differs from the library on {chunk!r}: {mine} and {theirs}")
        for c, i in zip(chunks, ids, strict=True):
            self.memory[c] = ",".join(map(str, i))
            spelt = self._spell(i)
            if spelt != c:
                self.respelt[c] = spelt

    def encode_texts(self, texts: list[str]) -> Iterator[tuple[str, int, str]]:
        """(decimal ids joined by commas, number of ids, text decoded from them) per text."""
        memory, respelt = self.memory, self.respelt
        if len(memory) > REMEMBERED:
            memory.clear()
            respelt.clear()
        whole = [self.normalise(t) for t in texts]
        split = [self.chunk.findall(t) for t in whole]
        fresh = [c for c in dict.fromkeys(chain.from_iterable(split)) if c not in memory]
        if fresh:
            self._learn(fresh)
        for i, (text, normal, chunks) in enumerate(zip(texts, whole, split, strict=True)):
            ids = ",".join([memory[c] for c in chunks])
            # each chunk's ids were decoded when it was learned; most spell the chunk itself
            decoded = self._front("".join([respelt.get(c, c) for c in chunks]) if respelt else normal)
            if i % WHOLE_EVERY == 0:
                theirs = self.library.encode(text)
                if ids != ",".join(map(str, theirs)) or decoded != self.library.decode(theirs):
                    raise ValueError("a whole text differs from the library")
            yield ids, ids.count(",") + 1 if ids else 0, decoded
        for c in fresh:
            if len(c) > LONGEST:
                del memory[c]
                respelt.pop(c, None)


def _utf8(run: bytes) -> str:
    out, at = [], 0
    while at < len(run):
        for n in (1, 2, 3, 4):
            try:
                out.append(run[at:at + n].decode("utf-8"))
                break
            except UnicodeDecodeError:
                if n == 4 or at + n >= len(run):
                    n = 1
                    out.append("�")
                    break
        at += n
    return "".join(out)


@lru_cache(maxsize=2)
def load(path: str) -> PieceModel:
    return PieceModel(path)


def _digests(path: str, with_text: bool):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load(path)
        sha = lambda s: hashlib.sha256(s.encode("utf-8", "surrogatepass")).hexdigest()
        for pdf in batches:
            for at in range(0, len(pdf), 512):  # the texts whose chunks are held at once
                part = pdf.iloc[at:at + 512]
                n, a, b, ids, text = [], [], [], [], []
                for joined, count, decoded in model.encode_texts([t or "" for t in part["text"]]):
                    n.append(count)
                    a.append(sha(joined))
                    b.append(sha(decoded))
                    if with_text:
                        ids.append([int(i) for i in joined.split(",")] if joined else [])
                        text.append(decoded)
                out = {"doc_id": part["doc_id"].array, "n_tokens": n, "ids_sha256": a, "decoded_sha256": b}
                yield pd.DataFrame(out | ({"ids": ids, "decoded": text} if with_text else {}))
    return run


def encode_decode(docs: DataFrame, path: str | None = None, with_text: bool = False) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_tokens, ids_sha256,
    decoded_sha256 and, on request, the ids and the decoded text themselves.

    A null text is empty: no ids, empty decoded text. Null ids and repeated rows are rows like
    any other; other columns are ignored; an empty table gives no rows."""
    kinds = dict(doc_id=T.LongType(), n_tokens=T.LongType(), ids_sha256=T.StringType(), decoded_sha256=T.StringType())
    if with_text:
        kinds |= {"ids": T.ArrayType(T.IntegerType()), "decoded": T.StringType()}
    base = docs.select(or_null(docs, "doc_id", "long").alias("doc_id"), or_null(docs, "text", "string").alias("text"))
    return base.mapInPandas(_digests(path or model_path(), with_text), struct_of(**kinds))


def op3_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_decode(read_table(spark, sf_dir, "documents"))
