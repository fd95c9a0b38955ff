"""Document fingerprints by I-Match with randomised lexicon subsets.

The lexicon holds the terms whose document frequency lies in a band (neither common nor rare;
idf between ``ln 1/HIGH`` and ``ln 1/LOW``). A text's distinct lexicon terms are sorted, and
each of 64 random lexicon subsets that holds any of them hashes those it holds, in order, into
16 bits. Subsets come in four densities (a term falls into one of 16, 64, 256 or 1,024 cells,
of which 16 count), so short and long texts alike have subsets with just a few of their terms,
which survive an edit elsewhere. A text of whose distinct terms fewer than one in ``WIDE`` are in
the band takes all its terms: so a large group of near copies, whose words are all frequent, and a
text of rare words have fingerprints of their terms too, and replacing a third of such a text by
one with many terms in the band leaves it on that side. The likeness of two fingerprints is the share of subsets that
agree among those that either fills.

Main path: DataFrame functions only. Document frequencies are pre-aggregated counts; the
lexicon has at most (mean distinct terms) / LOW entries at any corpus size, and reaches the
expressions as a scalar subquery, a table of hash cells. Fingerprints are row expressions.
``next_rows`` pairs each row with its successor by id with one shuffle of the texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cdmspark.llm.common import materialise, or_null, read_table, words_of

#: The band of document frequencies, as shares of the documents, and its floors for few documents.
LOW, HIGH, LOW_COUNT, HIGH_COUNT = 0.001, 0.02, 2, 10
#: Bits of a term's hash that choose its cell, per density; 16 of the cells are subsets.
CELL_BITS, SUBSETS = (4, 6, 8, 10), 16
TABLE_BITS, TABLE_FROM = 16, sum(CELL_BITS)
EMPTY, WHOLE = "----", "="
#: A text's terms are those in the band if at least one in so many of its distinct terms is.
WIDE = 5
#: Rows of an id range, and the most ranges (their bounds are literals).
RANGE_ROWS, MAX_RANGES = 2000, 10_000
_FIRST = -(1 << 63)


def lexicon(texts: DataFrame) -> Column:
    """Scalar subquery: the terms in the band, as array<array<long>> by hash cell."""
    spark = texts.sparkSession
    total = texts.count()
    terms = texts.select(F.explode(F.array_distinct(words_of(F.lower("text")))).alias("word"))
    band = (terms.groupBy(F.xxhash64("word").alias("term")).agg(F.count(F.lit(1)).alias("df"))
            .filter(F.col("df").between(max(LOW_COUNT, LOW * total), max(HIGH_COUNT, HIGH * total))))
    cells = band.groupBy(_cell("term").alias("id")).agg(F.collect_list("term").alias("terms"))
    every = spark.range(1 << TABLE_BITS).join(cells, "id", "left")
    row = F.sort_array(F.collect_list(F.struct("id", F.coalesce("terms", F.array().cast("array<bigint>")).alias("terms"))))
    return materialise(every.agg(F.transform(row, lambda x: x["terms"]).alias("cells")), "imatch-lexicon").scalar()


def _cell(term: str) -> Column:
    return F.expr(f"shiftrightunsigned({term}, {TABLE_FROM}) & {(1 << TABLE_BITS) - 1}L")


def fingerprint(df: DataFrame, text: str, out: str, cells: Column) -> DataFrame:
    """``df`` with column ``out``: 64 groups of 4 characters, or, for a text without words, a mark
    and a digest of the whole text. Equal texts have equal fingerprints."""
    table, words, terms, t = out + "_cells", out + "_words", out + "_terms", F.col(text)
    hashed = F.transform(words_of(F.lower(t)), lambda w: F.xxhash64(w))
    df = df.withColumn(table, cells)
    known = f"filter({words}, t -> array_contains({table}[int(shiftrightunsigned(t, {TABLE_FROM}) & " \
            f"{(1 << TABLE_BITS) - 1}L)], t))"
    df = df.withColumn(words, F.array_distinct(hashed)).withColumn(terms, F.expr(known)).drop(table)
    own = F.when(F.size(terms) * WIDE < F.size(words), F.col(words)).otherwise(F.col(terms))
    df = df.withColumn(terms, F.sort_array(own)).drop(words)
    parts, at = [], 0
    for bits in CELL_BITS:
        place = f"(shiftrightunsigned(t, {at}) & {(1 << bits) - 1}L)"
        parts.append(
            f"transform(array(filter({terms}, t -> {place} < {SUBSETS}L)), e -> array_join(transform(sequence(0L, {SUBSETS - 1}L),"
            f" i -> transform(array(filter(e, t -> {place} = i)), s -> CASE WHEN size(s) = 0 THEN '{EMPTY}' ELSE "
            f"lpad(hex(xxhash64(s) & 65535L), 4, '0') END)[0]), ''))[0]")
        at += bits
    whole = F.concat(F.lit(WHOLE), F.substring(F.sha2(F.coalesce(t, F.lit("")), 256), 1, 32))
    return df.withColumn(out, F.when(F.size(terms) == 0, whole).otherwise(F.expr(f"concat({', '.join(parts)})"))).drop(terms)


def likeness(a: str, b: str) -> Column:
    """1 for equal fingerprints, 0 where one of two different ones has no term, else the
    agreeing share of the subsets that either fills."""
    n = SUBSETS * len(CELL_BITS)
    x, y = (f"substring({c}, int(4 * i + 1), 4)" for c in (a, b))
    same = F.expr(f"size(filter(sequence(0, {n - 1}), i -> {x} = {y} AND {x} <> '{EMPTY}'))")
    filled = F.expr(f"size(filter(sequence(0, {n - 1}), i -> {x} <> '{EMPTY}' OR {y} <> '{EMPTY}'))")
    return (F.when(F.col(a) == F.col(b), 1.0).when(F.col(a).startswith(WHOLE) | F.col(b).startswith(WHOLE), 0.0)
            .otherwise(same / F.greatest(filled, F.lit(1))).cast("double"))


def _ranges(ids: DataFrame, rows: int) -> list[int]:
    """Bounds that cut the ids into even ranges: range r holds the ids over r of them."""
    n = min(MAX_RANGES, -(-ids.count() // rows))
    if n < 2:
        return []
    cut = ids.agg(F.percentile_approx("id", [i / n for i in range(1, n)], 100 * n).alias("at")).first()["at"]
    return sorted(set(cut))


def _range_of(bounds: list[int]) -> Column:
    """Number of bounds below ``id``, found in two steps of about the bounds' square root."""
    if not bounds:
        return F.lit(0)
    step = max(1, int(len(bounds) ** 0.5))
    fine = [bounds[i:i + step] for i in range(0, len(bounds), step)]
    longs = lambda v: F.array(*[F.lit(x).cast("long") for x in v])
    below = lambda v: F.size(F.filter(v, lambda x: x < F.col("id")))
    coarse = below(longs([f[-1] for f in fine]))
    inner = F.get(F.array(*[longs(f) for f in fine]), coarse)
    # over the last bound there is no inner list, and the last list may be shorter than the step
    return F.least(coarse * step + F.when(inner.isNull(), 0).otherwise(below(inner)), F.lit(len(bounds))).cast("int")


def next_rows(df: DataFrame, columns: list[str], range_rows: int = RANGE_ROWS) -> DataFrame:
    """``df`` (doc_id, text, ...) with ``next_<c>`` for the columns: those of the row that
    follows in descending doc_id, after the last the first. Null ids come last; rows of one
    id are ordered by their text's hash.

    The rows are cut into id ranges, one window each; the first row of a range is also dealt,
    as a ghost, to the range that ends before it, so no window spans the whole table."""
    df = df.withColumn("id", F.coalesce("doc_id", F.lit(_FIRST)))
    bounds = _ranges(df.select("id"), range_rows)
    df = df.withColumn("range", _range_of(bounds))
    heads = {r["range"]: r["head"] for r in df.groupBy("range").agg(F.max("id").alias("head")).collect()}  # per range
    order = sorted(heads)
    to = {r: order[(i + 1) % len(order)] for i, r in enumerate(order)}
    size = len(bounds) + 1
    head = F.get(F.array(*[F.lit(heads.get(r)).cast("long") for r in range(size)]), F.col("range"))
    ghost = F.get(F.array(*[F.lit(to.get(r)).cast("int") for r in range(size)]), F.col("range"))
    places = F.when(F.col("id") == head, F.array(F.struct(F.col("range").alias("at"), F.lit(False).alias("ghost")),
                                                 F.struct(ghost.alias("at"), F.lit(True).alias("ghost")))
                    ).otherwise(F.array(F.struct(F.col("range").alias("at"), F.lit(False).alias("ghost"))))
    w = Window.partitionBy("at").orderBy("ghost", F.desc("id"), "tie")
    dealt = (df.withColumn("place", F.explode(places)).withColumn("tie", F.xxhash64("text"))
             .withColumn("at", F.col("place.at")).withColumn("ghost", F.col("place.ghost")))
    return (dealt.select("*", *[F.lead(c).over(w).alias(f"next_{c}") for c in columns]).filter("not ghost")
            .drop("id", "range", "place", "at", "ghost", "tie"))


def fingerprints(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_chars, fingerprint, the edited
    text's digest and fingerprint (its last third replaced by the start of the next document),
    and the likeness to that and to the next document.

    A null text is empty; all empty texts have one fingerprint. Null ids come last in the
    order; repeated rows are rows like any other; other columns are ignored; an empty table
    gives no rows."""
    base = docs.select(or_null(docs, "doc_id", "long").alias("doc_id"),
                       F.coalesce(or_null(docs, "text", "string"), F.lit("")).alias("text"))
    cells = lexicon(base)
    paired = next_rows(fingerprint(base, "text", "fingerprint", cells), ["text", "fingerprint"])
    moved = F.floor(F.col("n_chars") / 3).cast("int")
    edited = (paired.withColumn("n_chars", F.length("text").cast("long"))
              .withColumn("edited", F.concat(F.substring("text", F.lit(1), F.col("n_chars").cast("int") - moved),
                                             F.substring("next_text", F.lit(1), moved))))
    done = fingerprint(edited.drop("text", "next_text"), "edited", "edited_fingerprint", cells)
    return done.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint",
                       "edited_fingerprint", likeness("fingerprint", "edited_fingerprint").alias("near_edited"),
                       likeness("fingerprint", "next_fingerprint").alias("near_next"))


def op8_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(read_table(spark, sf_dir, "documents"))
