"""Line deduplication with levelled sorted runs of line hashes.

Documents come in batches, from the largest ids down. A batch's run holds, sorted by line
hash, the number of documents with the line and the largest id among them. Lines that earlier
runs have already settled (enough documents hold them, so their keeper is known and can't
change, ids falling) are anti-joined away; what is left of the run is added to level 0. When a
level holds ``FANOUT`` runs they are merged into one run of the next level, and lines that have
reached the threshold are settled. At the end all runs are merged once more, which gives each
line's keeper. A line is dropped from every document that isn't its keeper.

A line that a third of all documents hold is one row per task before any shuffle, and its join
partition is split at run time. Tables live in the shared checkpoint folder.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdmspark.llm.common import LOWER, UPPER, materialise, or_null, read_table, struct_of

LEAST_CHARS, LEAST_DOCS = 40, 5
BATCHES, FANOUT = 4, 2
#: Stands for a null id: below all others, so such a row keeps a line only among its like.
_NO_ID = -(1 << 63)


def line_hash(line: bytes, least_chars: int = LEAST_CHARS) -> bytes | None:
    """128-bit hash of the line's key (ASCII white space stripped, A-Z lower-cased), or None
    if the key has fewer code points than asked for."""
    key = line.strip()
    if len(key) < least_chars or not (key.isascii() or len(key.decode("utf-8", "surrogatepass")) >= least_chars):
        return None
    return xxhash.xxh3_128_digest(key.lower())


def _lines(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").split(b"\n")


def _entries(least_chars: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            h, doc, batch = [], [], []
            for d, b, text in zip(pdf["doc"], pdf["batch"], pdf["text"], strict=True):
                own = {line_hash(x, least_chars) for x in _lines(text)} - {None}
                h += own
                doc += [d] * len(own)
                batch += [b] * len(own)
            yield pd.DataFrame({"h": h, "doc": doc, "batch": batch}).astype({"doc": "int64", "batch": "int32"})
    return run


class LineRuns:
    """Levels of sorted runs (h, docs, keeper) and the settled lines (h).

    ``add`` takes batches whose ids fall from batch to batch."""

    def __init__(self, spark: SparkSession, least_docs: int = LEAST_DOCS, fanout: int = FANOUT):
        self.spark, self.least_docs, self.fanout = spark, least_docs, fanout
        self.levels: list[list[DataFrame]] = []
        self.settled: list[DataFrame] = []

    def add(self, entries: DataFrame) -> None:
        """Adds a batch's (h, doc) rows, one per document and line."""
        run = entries.groupBy("h").agg(F.count(F.lit(1)).alias("docs"), F.max("doc").alias("keeper"))
        if self.settled:
            known = self.settled[0]
            for more in self.settled[1:]:
                known = known.unionByName(more)
            run = run.join(known, "h", "left_anti")
        self._put(0, materialise(run.sortWithinPartitions("h"), "lines-run"))
        level = 0
        while level < len(self.levels) and len(self.levels[level]) >= self.fanout:
            runs, self.levels[level] = self.levels[level], []
            self._put(level + 1, self._merge(runs))
            level += 1

    def _put(self, level: int, run: DataFrame) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(run)

    def _merge(self, runs: list[DataFrame]) -> DataFrame:
        """One sorted run from several; its lines at the threshold are settled from now on."""
        both = runs[0]
        for r in runs[1:]:
            both = both.unionByName(r)
        merged = materialise(both.groupBy("h").agg(F.sum("docs").alias("docs"), F.max("keeper").alias("keeper"))
                             .sortWithinPartitions("h"), "lines-run")
        self.settled.append(merged.filter(F.col("docs") >= self.least_docs).select("h"))
        return merged

    def finish(self) -> DataFrame:
        """(h, keeper) of the lines that enough documents of all batches hold."""
        runs = [r for level in self.levels for r in level]
        self.levels = [[self._merge(runs) if len(runs) > 1 else runs[0]]]
        return self.levels[0][0].filter(F.col("docs") >= self.least_docs).select("h", "keeper")


def _batch_of(base: DataFrame, batches: int) -> Column:
    """0 for the largest ids, by quantiles of the ids."""
    cut = base.agg(F.percentile_approx("doc", [i / batches for i in range(1, batches)], 10_000).alias("at")).first()["at"]
    out = F.lit(0)
    for x in cut or []:
        out = out + F.when(F.col("doc") <= x, 1).otherwise(0)
    return out.cast("int")


def repeated_lines(base: DataFrame, least_chars: int, least_docs: int, batches: int) -> DataFrame:
    """(doc, h array) of the lines that each document of ``base`` (doc, text) loses."""
    spark = base.sparkSession
    rows = base.withColumn("batch", _batch_of(base, batches))
    kinds = struct_of(h=T.BinaryType(), doc=T.LongType(), batch=T.IntegerType())
    entries = rows.select("doc", "batch", "text").mapInPandas(_entries(least_chars), kinds)
    if not base.groupBy("doc").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").isEmpty():
        entries = entries.distinct()  # rows that share an id are one document
    entries = materialise(entries, "lines-entries")
    runs = LineRuns(spark, least_docs)
    for b in range(batches):
        runs.add(entries.filter(F.col("batch") == b).select("h", "doc"))
    lost = entries.select("h", "doc").join(runs.finish(), "h").filter("doc <> keeper")
    return lost.groupBy("doc").agg(F.collect_list("h").alias("lost"))


def _rebuild(least_chars: int, with_text: bool):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            n, gone, sha, out = [], [], [], []
            for text, lost in zip(pdf["text"], pdf["lost"], strict=True):
                lines = kept = _lines(text)
                if lost is not None and len(lost):
                    drop = {bytes(x) for x in lost}
                    kept = [x for x in lines if line_hash(x, least_chars) not in drop]
                joined = b"\n".join(kept)
                n.append(len(lines))
                gone.append(len(lines) - len(kept))
                sha.append(hashlib.sha256(joined).hexdigest())
                if with_text:
                    out.append(text if len(kept) == len(lines) else joined.decode("utf-8", "surrogatepass"))
            done = pdf.drop(columns=["text", "lost"])
            done["n_lines"], done["n_dropped"], done["kept_sha256"] = n, gone, sha
            if with_text:
                done["kept_text"] = out
            yield done
    return run


def _base(docs: DataFrame) -> DataFrame:
    return docs.select(or_null(docs, "doc_id", "long").alias("doc_id"), or_null(docs, "text", "string").alias("text"),
                       F.coalesce(or_null(docs, "doc_id", "long"), F.lit(_NO_ID)).alias("doc"))


def line_dedup(docs: DataFrame, least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS,
               batches: int = BATCHES, with_text: bool = False) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_lines, n_dropped, kept_sha256 and,
    on request, kept_text.

    A null or empty text is one empty line. Rows with null ids count as one document below all
    others, and rows that repeat an id as one document, each keeping its own lines. A line
    repeated within its keeper stays each time. Other columns are ignored; an empty table gives
    no rows."""
    base = _base(docs)
    lost = repeated_lines(base.select("doc", "text"), least_chars, least_docs, batches)
    kinds = dict(doc_id=T.LongType(), n_lines=T.LongType(), n_dropped=T.LongType(), kept_sha256=T.StringType())
    if with_text:
        kinds["kept_text"] = T.StringType()
    return (base.join(lost, "doc", "left").select("doc_id", "text", "lost")
            .mapInPandas(_rebuild(least_chars, with_text), struct_of(**kinds)))


def without_repeats(docs: DataFrame, least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS) -> DataFrame:
    """``docs`` with repeated lines taken out of ``text``; ``n_chars``, where it is there,
    follows the text of the documents that lost lines. All rows and columns stay."""
    lost = repeated_lines(_base(docs).select("doc", "text"), least_chars, least_docs, BATCHES)
    tag = "__lines"
    while any(c.startswith(tag) for c in docs.columns):
        tag += "_"
    key, gone, new = tag + "key", tag + "lost", tag + "new"

    @F.pandas_udf("string")
    def cut(texts: pd.Series, losts: pd.Series) -> pd.Series:
        out = []
        for text, x in zip(texts, losts, strict=True):
            if x is not None and len(x):
                drop = {bytes(v) for v in x}
                text = b"\n".join(b for b in _lines(text) if line_hash(b, least_chars) not in drop).decode(
                    "utf-8", "surrogatepass")
            out.append(text)
        return pd.Series(out, dtype=object)

    joined = (docs.withColumn(key, F.coalesce(or_null(docs, "doc_id", "long"), F.lit(_NO_ID)))
              .join(lost.select(F.col("doc").alias(key), F.col("lost").alias(gone)), key, "left")
              .withColumn(new, cut(or_null(docs, "text", "string"), F.col(gone))))
    out = []
    for c in docs.columns:
        if c == "text":
            out.append(F.col(new).alias(c))
        elif c == "n_chars":
            kind = docs.schema[c].dataType
            out.append(F.when(F.col(gone).isNull(), F.col(c)).otherwise(F.length(new).cast(kind)).alias(c))
        else:
            out.append(F.col(f"`{c}`"))
    return joined.select(*out)


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(read_table(spark, sf_dir, "documents"))


_STRIP = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

OP2_SQL = f"""
WITH line AS (
    SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS place
    FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)
), keyed AS (
    SELECT *, translate(trim(line, {_STRIP}), '{UPPER}', '{LOWER}') AS key FROM line
), common AS (
    SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= {LEAST_CHARS}
    GROUP BY key HAVING count(DISTINCT doc_id) >= {LEAST_DOCS}
), judged AS (
    SELECT k.*, c.keeper IS NOT NULL AND c.keeper <> k.doc_id AS gone FROM keyed k LEFT JOIN common c ON k.key = c.key
)
SELECT doc_id, count(*)::BIGINT AS n_lines, (count(*) FILTER (WHERE gone))::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""
