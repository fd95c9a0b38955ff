"""Text normalisation against a plain-Python statement of the same rules."""
import re

from pyspark.sql import functions as F

from cdmspark.functions.text import ABBREVIATIONS, full_process, preprocess_text


def spec(text):
    if text is None or text == "":
        return ""
    t = text.lower()
    for a, full in ABBREVIATIONS:
        t = re.sub(r"\b" + re.escape(a) + r"\b", full, t)
    t = re.sub(r"[^\w\s\-/]", " ", t)
    return re.sub(r"\s+", " ", t).strip()


CASES = [None, "", "ER - chest pain", "Emergency Dept visit", "clinic or lab", "F/U eval, pt hx",
         "ICU/CCU transfer!!", "  multiple   spaces\tand\ttabs  ", "ed ed ed", "bed", "red-ed", "op_ip",
         "Café éd ed", "naïve ER", "x²", "ÉCOLE or", "lab-path rad", "monitoring", "assess&mgmt", "N/A"]


def test_preprocess_matches_spec(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(CASES)], "i int, v string")
    got = {r.i: r.p for r in df.select("i", preprocess_text("v").alias("p")).collect()}
    for i, v in enumerate(CASES):
        assert got[i] == spec(v), (v, got[i], spec(v))


def test_or_expands_everywhere(spark):
    df = spark.createDataFrame([("clinic or lab",)], "v string")
    assert df.select(preprocess_text("v")).first()[0] == "clinic operating room laboratory"


def test_full_process(spark):
    from cdmspark.functions.similarity import clean_py
    vals = ["Blue-Anvil", "  x_y  ", "Ünïcode!!", "a  b"]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    got = [r[0] for r in df.select(full_process("v")).collect()]
    assert got == [clean_py(v) for v in vals]


def test_native_bulk_and_spec_agree_on_random_text(spark):
    import random
    from cdmspark.functions.text import preprocess_text_bulk
    rnd = random.Random(5)
    pieces = [a for a, _ in ABBREVIATIONS] + ["ÉD", "éd", "naïve", "x²", "42", "_", "-", "/", "!!", "(", ")",
                                              "\t", "\xa0", " ", "\n", "  ", "Or", "F/U", "lab-", "ß", "İ"]
    vals = ["".join(rnd.choice(pieces) + rnd.choice(["", " ", ",", "."]) for _ in range(rnd.randint(1, 12)))
            for _ in range(300)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, v string")
    rows = df.select("i", preprocess_text("v").alias("a"), preprocess_text_bulk("v").alias("b")).collect()
    for r in rows:
        assert r.a == r.b == spec(vals[r.i]), (vals[r.i], r.a, r.b, spec(vals[r.i]))
