"""The pipeline end to end against its operators by brute force; edge tables; the catalog."""
import re

import corpus_pipeline as C
from cdmspark.llm import catalog
from cdmspark.llm import quality_rules as Q
from cdmspark.llm.common import materialise
from tests.llm.test_line_dedup import brute as lines
from tests.llm.test_near_dedup import string_set

SF = "/root/testdata/sf0.001"


def test_stages_one_by_one(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    good = materialise(C.STAGES[0][1](spark, docs, SF), "t")
    assert good.columns == docs.columns
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    ids = {r.doc_id for r in good.collect()}
    verdict = {r.doc_id: r for r in Q.quality(docs).collect()}
    judged = [i for i in labels if i in verdict and not verdict[i].base_failed]
    assert sum((i in ids) == (labels[i] == 1) for i in judged) >= 0.95 * len(judged)
    spoken = materialise(C.STAGES[1][1](spark, good, SF), "t")
    assert spoken.columns == docs.columns and spoken.count() >= 0.99 * good.count()
    cut = materialise(C.STAGES[2][1](spark, spoken, SF), "t")
    want = lines([(r.doc_id, r.text) for r in spoken.collect()])
    rows = {r.doc_id: r.text for r in cut.collect()}
    assert rows == {i: v[2] for i, v in want.items()} and cut.columns == docs.columns
    near = materialise(C.STAGES[3][1](spark, cut, SF), "t")
    sets = {i: string_set(t, 5) for i, t in rows.items()}
    comp = {i: i for i in sets}
    changed = True
    pairs = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    while changed:
        changed = False
        for a, b in pairs:
            low = min(comp[a], comp[b])
            changed |= comp[a] != low or comp[b] != low
            comp[a] = comp[b] = low
    assert {r.doc_id for r in near.collect()} == {i for i, c in comp.items() if c == i}
    packed = C.STAGES[4][1](spark, near, SF)
    assert {r.doc_id for r in packed.collect()} == {r.doc_id for r in near.collect()}


def test_run_is_the_stages(spark):
    out = C.run(spark, SF)
    assert "sequence_id" in out.columns and out.count() > 0


def test_edge_tables_pass_every_stage(spark, odd, nothing):
    for docs in (odd, nothing):
        for name, stage in C.STAGES[:-1]:
            out = materialise(stage(spark, docs, SF), "t")
            assert out.columns == docs.columns, name
        C.STAGES[-1][1](spark, docs, SF).count()


def test_one_query_per_operator():
    got = sorted(int(re.match(r"op(\d+)_", n)[1]) for n in catalog.QUERIES)
    assert got == list(range(1, 11))
    assert set(catalog.SQL) <= set(catalog.QUERIES)
