"""Line dedup against brute force, against DuckDB, and the defined odd cases."""
import hashlib
from collections import defaultdict

import duckdb

from cdmspark.llm import line_dedup as L

WS = " \t\n\x0b\x0c\r"


def key(line):
    k = line.strip(WS)
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in k)


def brute(rows, chars=40, least=5):
    holders = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= chars:
                holders[key(line)].add(i)
    out = {}
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(key(x)) < chars or len(holders[key(x)]) < least or max(holders[key(x)]) == i]
        out[i] = (len(lines), len(lines) - len(kept), "\n".join(kept))
    return out


def planted(corpus):
    rows = [(r[0], r[1]) for r in corpus]
    # lines met in 4 and 5 documents, with holders in every batch, at the length bound, with two-byte letters
    for n in (3, 4, 5, 6, 11):
        for j in range(n):
            mark = f"line held by {n} " + "é" * (40 - 15 - len(str(n)))
            rows.append((1000 + 37 * j + n, f"own {n} {j}\n\t{mark} \n{mark.upper() if j % 2 else mark}\n{mark[:-1]}"))
    return rows


def test_equals_brute_force(spark, corpus):
    rows = planted(corpus)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    want = brute(rows)
    assert sum(v[1] > 0 for v in want.values()) > 10
    for batches in (1, 4, 7):
        got = {r.doc_id: (r.n_lines, r.n_dropped, r.kept_text or "")
               for r in L.line_dedup(df, batches=batches, with_text=True).collect()}
        assert got == want
    plain = L.line_dedup(df).collect()
    assert {r.doc_id: r.kept_sha256 for r in plain} == {i: hashlib.sha256(v[2].encode()).hexdigest() for i, v in want.items()}


def test_sql_equals_brute_force(corpus):
    rows = planted(corpus)
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar)")
    con.executemany("insert into documents values (?, ?)", rows)
    got = {i: (n, d, s) for i, n, d, s in con.execute(L.OP2_SQL).fetchall()}
    assert got == {i: (n, d, hashlib.sha256(t.encode()).hexdigest()) for i, (n, d, t) in brute(rows).items()}


def test_keeper_is_the_largest_id_over_all_runs(spark):
    # four in the first batches, five in later ones: the lines settle only in a later merge
    line = "a line of text that is certainly longer than forty characters"
    rows = [(i, line if i in (99, 98, 97, 96, 30, 29, 28, 27, 26, 2) else f"t{i}") for i in range(100)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.n_dropped for r in L.line_dedup(df, batches=8).collect()}
    assert {i for i, n in got.items() if n} == {98, 97, 96, 30, 29, 28, 27, 26, 2}


def test_odd_rows(spark, odd, nothing):
    got = L.line_dedup(odd)
    assert got.count() == odd.count() and got.filter("n_dropped > 0 or n_lines <> 1").count() == 0
    assert L.line_dedup(nothing).count() == 0
    line = "a line of text that is certainly longer than forty characters"
    rows = [(None, line), (None, line), (7, line), (7, f"{line}\n{line}"), (1, line), (2, line), (3, line), (4, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = sorted(((r.doc_id, r.n_lines, r.n_dropped) for r in L.line_dedup(df).collect()), key=str)
    assert out == sorted([(None, 1, 1), (None, 1, 1), (7, 1, 0), (7, 2, 0), (1, 1, 1), (2, 1, 1), (3, 1, 1), (4, 1, 0)], key=str)


def test_stage_keeps_rows_and_columns(spark, corpus, docs, odd, nothing):
    out = L.without_repeats(docs)
    assert out.columns == docs.columns
    want = brute([(r[0], r[1]) for r in corpus])
    for r in out.collect():
        assert (r.text or "") == want[r.doc_id][2]
        assert r.n_chars == len(r.text or "")
    assert L.without_repeats(odd).columns == odd.columns and L.without_repeats(odd).count() == odd.count()
    assert L.without_repeats(nothing).count() == 0
