import random

import pytest

DOC = "doc_id long, text string, lang string, source string, n_chars long"


def sentence(rng, n):
    words = ["the", "of", "and", "to", "in"] + [f"w{rng.randrange(4000)}" for _ in range(n)]
    return " ".join(rng.choice(words) for _ in range(n))


@pytest.fixture(scope="session")
def corpus():
    """Plain texts, exact copies, near copies in chains, a hot group, shared lines, blanks, a null, long texts."""
    rng = random.Random(5)
    rows, texts = [], []
    for i in range(60):
        texts.append("\n".join(sentence(rng, rng.randrange(4, 40)) for _ in range(rng.randrange(1, 8))))
    base = sentence(rng, 150).split()
    for i in range(40):                       # near copies that drift from one another
        texts.append(" ".join(base))
        base[rng.randrange(len(base))] = f"x{i}"
    hot = sentence(rng, 200)
    for i in range(30):
        w = hot.split()
        for _ in range(rng.randrange(0, 6)):
            w[rng.randrange(len(w))] = f"h{rng.randrange(99)}"
        texts.append(" ".join(w))
    line = "This passage of well over forty characters is shared by many documents."
    texts += [f"{sentence(rng, 12)}\n{line}\n  {line.upper()} \t\n{sentence(rng, 9)}" for _ in range(9)]
    texts += texts[3:9] + ["", "", None, None, " \t\n ", "one", "ONE", "two words", "Two  Words", "three little words"]
    texts += [sentence(rng, 30000), "x" * 50_000, "\n" * 3000]
    order = list(range(len(texts)))
    rng.shuffle(order)
    for k, i in zip(order, range(len(texts))):
        rows.append((k * 3 + 1, texts[i], rng.choice(["en", "de", None]), "src0", len(texts[i] or "")))
    return rows


@pytest.fixture(scope="session")
def docs(spark, corpus):
    return spark.createDataFrame(corpus, DOC).repartition(5)


@pytest.fixture(scope="session")
def odd(spark):
    """Null in every column, repeated rows, a repeated id, and extra columns with clashing names."""
    extra = "key long, node string, n long, kept string, lang_pred string, score double, words string, line string"
    rows = [(1, "a b c d e", "en", "s", 9), (1, "a b c d e", "en", "s", 9), (1, "f g h", None, None, None),
            (None, "a b c d e", "en", "s", 1), (None, None, None, None, None), (2, None, None, "s", None),
            (3, "", "en", "s", 0), (4, "A b c D e", "fr", None, 9), (4, "A b c D e", "fr", None, 9)]
    rows = [(*r, 7, "n", 8, "k", "zz", 0.5, "w", "l") for r in rows]
    return spark.createDataFrame(rows, f"{DOC}, {extra}")


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOC)
