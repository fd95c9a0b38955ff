"""A user's model as an iterator pandas UDF is a provider like the default one."""
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import functions as F

from cdmspark.operators.embed import embed


def test_iterator_udf_is_a_provider(spark):
    @F.pandas_udf("array<double>")
    def model(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scale = 2.0  # stands for a model, loaded once for all batches
        for s in batches:
            yield s.map(lambda t: [scale * len(t), float(t.count("a"))])
    rows = [("banana",), ("x",), ("",)]
    out = embed(spark.createDataFrame(rows, "t string"), "t", provider=model).collect()
    assert {r.t: r.vec for r in out} == {"banana": [12.0, 3.0], "x": [2.0, 0.0], "": [0.0, 0.0]}


def test_models_by_name(spark):
    """A registered model is loaded once per task, has its own cut-off, and unknown names say so."""
    import numpy as np
    import pytest

    from cdmspark.operators import embed as E
    from cdmspark.operators import mapping as M
    loads = spark.sparkContext.accumulator(0)

    def load():
        loads.add(1)
        return lambda texts: [np.array([len(t), t.count("a"), 1.0]) for t in texts]
    E.register_model("shape", lambda: E.Model(E.loaded_once(load), 0.99))
    try:
        with pytest.raises(ValueError, match="already"):
            E.register_model("shape", lambda: E.Model(E.loaded_once(load), 0.5))
        with pytest.raises(ValueError, match="unknown model"):
            E.model("none")
        assert {"shape", "words", "trigrams"} <= set(E.models())
        df = spark.createDataFrame([(str(i) if i % 7 else None,) for i in range(30_000)], "t string").coalesce(2)
        got = df.select(E.model("shape").provider(df["t"]).alias("v"))
        assert got.where("v IS NULL").count() == df.where("t IS NULL").count()
        loads.value = 0
        got.write.format("noop").mode("overwrite").save()
        assert 1 <= loads.value <= 2                        # once for each task, whatever its batches
        c = spark.createDataFrame([(1, "banana", "D"), (2, "xy", "D")], "concept_id long, concept_name string, domain_id string")
        out = M.map_with_model(spark.createDataFrame([("banana",), ("cabana",), ("qq",), (None,)], "v string"), "v", c, "shape").collect()
        assert {r.v: r.concept_id for r in out} == {"banana": 1, "cabana": 1, "qq": 2, None: None}
    finally:
        del E._MODELS["shape"]


def test_word_model(spark):
    from cdmspark.operators import embed as E
    encode = E._word_model()
    a, b, empty = encode(["red ring red", "red", " "])
    code = sum(ord(x) * i for i, x in enumerate("red", 1)) % E.WORD_DIM
    assert a[code] == 2 and a.sum() == 3 and b.sum() == 1 and empty.sum() == 0
