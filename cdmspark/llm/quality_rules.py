"""Quality rules as weak supervision: rules vote or abstain, expectation-maximisation
estimates how each rule votes on good and on bad documents, and a document's posterior
probability of being good replaces all-must-pass filtering.

Main path: DataFrame functions only. Features and votes are columns of one scan; the model
sees a document only as its vote pattern, so what is aggregated are pattern counts, at most
3 ** len(RULES) rows whatever the corpus size. The fit on those counts is a few lines of
arithmetic; its result goes back as literal weights per rule and vote.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cdmspark.llm.common import WS, materialise, or_null, read_table, words_of

SYMBOLS = "#*$%&|<>"
#: Characters that end a sentence or a list item.
ENDS = ".!?:;\"')]…"
#: The hard rules of the base verdict: fewer words fail, as does a larger repeated share.
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
#: Posterior probability of good from which a document is kept.
KEEP_FROM = 0.5
#: Pseudo-documents, as a share of the corpus, that hold each rule's prior votes.
PRIOR_SHARE = 0.02
#: A rule is thought to vote (bad, abstain, good) so on good and on bad documents before any data.
PRIOR_GOOD, PRIOR_BAD = (0.005, 0.395, 0.60), (0.20, 0.45, 0.35)
PRIOR_CLEAN = 0.85
ROUNDS = 50

_F = "__q_"  # prefix of the working columns; made unique against the input's columns


def _per(a: str, b: str) -> Column:
    return F.col(a) / F.greatest(F.col(b), F.lit(1))


def _vote(bad: Column, good: Column) -> Column:
    """-1, 0 (abstain; also where a condition is null) or 1."""
    return F.when(bad, -1).when(good, 1).otherwise(0)


def _rules(p: str) -> dict[str, Column]:
    words, lines = F.col(p + "n_words"), F.col(p + "n_lines")
    symbols, repeat = _per(p + "n_symbols", p + "n_words"), _per(p + "n_repeat_words", p + "n_words")
    again, length = _per(p + "n_dup_lines", p + "n_lines"), _per(p + "word_chars", p + "n_words")
    capitals, bangs = _per(p + "n_capitals", p + "word_chars"), _per(p + "n_bangs", p + "n_words")
    digits, distinct = _per(p + "n_digits", p + "word_chars"), _per(p + "n_distinct", p + "n_words")
    bare, ended = _per(p + "n_bare", p + "n_words"), _per(p + "n_ended", p + "n_lines")
    dense, never = _per(p + "n_symbols", p + "word_chars"), F.lit(False)
    return {
        "symbols": _vote(symbols > 0.25, never),
        "symbol_density": _vote(dense > 0.05, never),
        "bare_words": _vote(bare > 0.2, never),
        "repeats": _vote(repeat > 0.3, never),
        "lines_again": _vote((again > 0.3) & (lines >= 4), never),
        "distinct": _vote(distinct < 0.2, (distinct > 0.5) & (words >= MIN_WORDS)),
        "word_length": _vote((length < 3) | (length > 7), (length >= 4) & (length <= 6.5)),
        "capitals": _vote(capitals > 0.3, never),
        "bangs": _vote(bangs > 0.25, never),
        "digits": _vote(digits > 0.3, never),
        "line_ends": _vote(ended < 0.3, ended >= 0.8),
    }


RULES = ("symbols", "symbol_density", "bare_words", "repeats", "lines_again", "distinct", "word_length", "capitals",
         "bangs", "digits", "line_ends")


def _repeat_words(words: str, n: str, packed: str) -> Column:
    """Words inside 3-word windows that occur twice or more. ``packed`` holds, sorted, each
    window's hash and start as hash * windows + start, so equal windows are neighbours; their
    words are compared before they count."""
    m = f"(`{n}` - 2)"
    same = " AND ".join(f"`{words}`[int(x % {m}) + {i}] = `{words}`[int(y % {m}) + {i}]" for i in range(3))
    pair = f"(x div {m} = y div {m} AND {same})"
    hit = lambda at: f"coalesce(transform(array(get(`{packed}`, k {at})), y -> {pair})[0], false)"
    starts = (f"sort_array(transform(filter(`{packed}`, (x, k) -> {hit('- 1')} OR {hit('+ 1')}), "
              f"x -> coalesce(x % {m}, 0L)))")
    gaps = "transform(q, (x, k) -> least(3L, coalesce(get(q, k + 1) - x, 3L)))"
    return F.expr(f"CASE WHEN `{n}` < 4 THEN 0L ELSE transform(array({starts}), q -> "
                  f"aggregate({gaps}, 0L, (a, x) -> a + x))[0] END")


def with_features(docs: DataFrame, p: str) -> DataFrame:
    """``docs`` with the measured columns under prefix ``p``."""
    text, c = f"{p}text", F.col
    size = lambda x: F.length(x).cast("long")
    out = docs.withColumn(text, F.coalesce(or_null(docs, "text", "string"), F.lit("")))
    out = out.withColumn(p + "words", words_of(c(text))).withColumn(
        p + "lines", F.filter(F.split(text, "\n"), lambda x: F.octet_length(F.btrim(x, F.lit(WS))) > 0))
    out = out.withColumn(p + "n_words", F.size(p + "words").cast("long"))
    m = f"(`{p}n_words` - 2)"
    out = out.withColumn(p + "packed", F.expr(
        f"CASE WHEN `{p}n_words` < 4 THEN array(0L) ELSE sort_array(transform(sequence(0L, {m} - 1), i -> coalesce("
        f"pmod(xxhash64(`{p}words`[int(i)], `{p}words`[int(i) + 1], `{p}words`[int(i) + 2]), "
        f"4611686018427387904 div {m}) * {m} + i, 0L))) END"))
    count = lambda chars: F.regexp_count(c(text), F.lit(f"[{chars}]")).cast("long")
    return (out.withColumn(p + "word_chars", size(F.array_join(p + "words", "")))
            .withColumn(p + "n_symbols", count(SYMBOLS))
            .withColumn(p + "n_dup_lines", (F.size(p + "lines") - F.size(F.array_distinct(p + "lines"))).cast("long"))
            .withColumn(p + "n_repeat_words", _repeat_words(p + "words", p + "n_words", p + "packed"))
            .withColumn(p + "n_lines", F.size(p + "lines").cast("long"))
            .withColumn(p + "n_capitals", count("A-Z"))
            .withColumn(p + "n_bangs", size(c(text)) - size(F.replace(c(text), F.lit("!"), F.lit(""))))
            .withColumn(p + "n_digits", count("0-9"))
            .withColumn(p + "n_bare", F.size(F.filter(p + "words", lambda w: ~w.rlike(r"[\p{L}\p{N}]"))).cast("long"))
            .withColumn(p + "n_ended", F.size(F.filter(p + "lines", lambda x: F.instr(
                F.lit(ENDS), F.substring(F.rtrim(x, F.lit(WS)), -1, 1)) > 0)).cast("long"))
            .withColumn(p + "n_distinct", F.size(F.array_distinct(p + "words")).cast("long"))
            .drop(p + "packed", p + "words", p + "lines", text))


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals", "n_bangs",
            "n_digits", "n_bare", "n_ended", "n_distinct")


def _pattern(p: str) -> Column:
    """Votes as one number, rule j in place j of base 3."""
    out = F.lit(0).cast("long")
    for j, vote in enumerate(_rules(p)[r] for r in RULES):
        out = out + (vote + 1) * F.lit(3**j).cast("long")
    return out


def fit(counts: dict[int, int], rounds: int = ROUNDS) -> tuple[float, list[list[float]]]:
    """(log prior odds of good, log likelihood ratios good/bad by rule and vote + 1) from
    pattern counts. No documents give the priors."""
    total, m = sum(counts.values()), len(RULES)
    votes = {k: [k // 3**j % 3 for j in range(m)] for k in counts}
    clean, good, bad = PRIOR_CLEAN, [PRIOR_GOOD] * m, [PRIOR_BAD] * m
    for _ in range(rounds if total else 0):
        post = {}
        for k, v in votes.items():
            z = math.log(clean / (1 - clean)) + sum(math.log(good[j][x] / bad[j][x]) for j, x in enumerate(v))
            post[k] = 1 / (1 + math.exp(-max(-700.0, min(700.0, z))))
        own = PRIOR_SHARE * total
        g = sum(n * post[k] for k, n in counts.items())
        clean = (g + own * PRIOR_CLEAN) / (total + own)
        good = [tuple((sum(n * post[k] for k, n in counts.items() if votes[k][j] == x) + own * PRIOR_GOOD[x]) / (g + own)
                      for x in range(3)) for j in range(m)]
        bad = [tuple((sum(n * (1 - post[k]) for k, n in counts.items() if votes[k][j] == x) + own * PRIOR_BAD[x])
                     / (total - g + own) for x in range(3)) for j in range(m)]
    return (math.log(clean / (1 - clean)),
            [[math.log(good[j][x] / bad[j][x]) for x in range(3)] for j in range(m)])


def _posterior(p: str, model: tuple[float, list[list[float]]]) -> Column:
    z = F.lit(model[0])
    for vote, w in zip((_rules(p)[r] for r in RULES), model[1], strict=True):
        z = z + F.element_at(F.array(*[F.lit(x) for x in w]), vote + 2)
    return 1 / (1 + F.exp(-z))


def _base_failed(p: str) -> Column:
    words = F.col(p + "n_words")
    return (words < MIN_WORDS) | (100 * F.col(p + "n_repeat_words") > MAX_REPEAT_PERCENT * words)


def learn(measured: DataFrame, p: str) -> tuple[float, list[list[float]]]:
    rows = measured.groupBy(_pattern(p).alias("pattern")).count().collect()  # at most 3 ** len(RULES) rows
    return fit({r["pattern"]: r["count"] for r in rows})


def _prefix(docs: DataFrame) -> str:
    p = _F
    while any(c.lower().startswith(p) for c in docs.columns):
        p += "_"
    return p


def quality(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, the measures, base_failed,
    p_good (posterior) and kept.

    A null or blank text has no words and fails the base rules. Null ids and repeated rows are
    rows like any other; other columns are ignored; an empty table gives no rows."""
    p = _prefix(docs)
    base = docs.select(or_null(docs, "doc_id", "long").alias("doc_id"), or_null(docs, "text", "string").alias("text"))
    measured = materialise(with_features(base, p).drop("text"), "quality")
    post = _posterior(p, learn(measured, p))
    return (measured.withColumn(p + "good", post).withColumn(p + "failed", _base_failed(p))
            .select("doc_id", *[F.col(p + c).alias(c) for c in MEASURES], F.col(p + "failed").alias("base_failed"),
                    F.col(p + "good").alias("p_good"), (~F.col(p + "failed") & (F.col(p + "good") >= KEEP_FROM)).alias("kept")))


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``quality`` keeps, with all their columns and no others. The
    verdict is a row's own given the fitted weights, so no join is needed."""
    p = _prefix(docs)
    # a column that is not deterministic keeps the filter from being pushed below the measures,
    # which would compute each of them once per use
    measured = with_features(docs, p).withColumn(p + "row", F.monotonically_increasing_id())
    kept = ~_base_failed(p) & (_posterior(p, learn(measured, p)) >= KEEP_FROM) & (F.col(p + "row") >= 0)
    return measured.filter(kept).select(*[f"`{c}`" for c in docs.columns])


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(read_table(spark, sf_dir, "documents"))
