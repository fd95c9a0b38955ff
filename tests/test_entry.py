"""Driver contract: entry() runs on sf0.001; every query has SQL unless stated. The corpus
operators, where installed, have tests of their own."""
import __spark_entry__ as E

ROWS_ONLY = {"map_fuzzy", "map_fuzzy_bucketed"}          # difflib's ratio has no SQL equivalent in DuckDB


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "preceding_visit_occurrence_id" in df.columns


def test_every_query_has_an_oracle():
    q, s = E.queries(), E.oracle_sql()
    corpus = set(E._corpus()[0])
    assert set(q) - set(s) - corpus == ROWS_ONLY
    assert set(s) <= set(q)


def test_queries_run_on_smoke_data(spark):
    from conftest import SF001
    corpus = set(E._corpus()[0])
    for name, fn in E.queries().items():
        if name in ("stream_visit", "stream_visit_state") or name in corpus:
            continue
        df = fn(spark, SF001)
        assert df.columns, name
