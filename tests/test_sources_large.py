"""Bucketed targets are joined where they lie; JDBC parts cover every row once."""
import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from cdmspark.operators.incremental import new_rows
from cdmspark.plans import jobs
from cdmspark.plans.catalog import P
from cdmspark.sources import relational as R
from cdmspark.sources.bucketed import bucket_count, bucketed_keys
from conftest import SF001


def exchanges_over(plan: str, table: str) -> list[str]:
    """Operators above the scan of ``table`` that move its rows."""
    lines = plan.splitlines()
    at = next(i for i, x in enumerate(lines) if f"FileScan parquet spark_catalog.default.{table}" in x)
    depth, found = re.search(r"\S", re.sub(r"[:+|*() \-\d]", " ", lines[at])).start(), []
    for x in reversed(lines[:at]):
        here = re.search(r"[A-Z]", x).start() if re.search(r"[A-Z]", x) else 0
        if here < depth:
            depth = here
            if "Join" in x:
                break
            found.append(x)
    return [x for x in found if "Exchange" in x]


def test_anti_join_does_not_move_the_target(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        old = spark.range(5000).select((F.col("id") * 2).alias("k"), F.col("id").alias("p"))
        with bucketed_keys(old, ["k"], 5000) as by:
            name = by["k"].select("k")._jdf.queryExecution().analyzed().toString()
            table = re.search(r"bucketed_[0-9a-f]+", name)[0]
            new = spark.range(9990, 10_010).withColumnRenamed("id", "k")
            got = new_rows(new, by["k"], ["k"])
            plan = got._jdf.queryExecution().sparkPlan().toString() and got._jdf.queryExecution().executedPlan().toString()
            assert exchanges_over(plan, table) == [] and "Exchange" in plan
            assert sorted(r.k for r in got.collect()) == [k for k in range(9990, 10_010) if k % 2 or k >= 10_000]
        assert not spark.catalog.tableExists(table)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_bucketed_load_equals_the_plain_one(spark):
    p = P(spark, SF001)
    old = p.existing_visits()
    with bucketed_keys(old, ["visit_occurrence_id", "person_id"], old.count()) as by:
        got = jobs.load_visit(p.t.visit_src(), p.persons(), existing=by["visit_occurrence_id"], seed=by["person_id"]).collect()
    assert sorted(got) == sorted(jobs.load_visit(p.t.visit_src(), p.persons(), existing=old).collect())
    assert bucket_count(spark, 10**9) == 200 and bucket_count(spark, 1) == 8


@pytest.mark.parametrize("seed", range(5))
def test_parts_cover_every_row_once(seed):
    rng = random.Random(seed)
    keys = [rng.randint(-50, 10 ** rng.randint(1, 9)) for _ in range(300)] + [None] * 5
    con = duckdb.connect()
    con.execute("CREATE TABLE t (k BIGINT)")
    con.executemany("INSERT INTO t VALUES (?)", [[k] for k in keys])
    src = R.Source("jdbc:x", "t", "k")
    least, greatest, n = con.execute(R.bounds_query(src)).fetchone()
    assert n == len(keys)
    cuts = R.even_cuts(least, greatest, R.part_count(n, 40))
    counts = [con.execute(f"SELECT count(*) FROM t WHERE {p}").fetchone()[0] for p in R.part_predicates("k", cuts)]
    assert sum(counts) == n and len(counts) <= 8
    quantiles = sorted({int(x) for x in con.execute(R.quantile_query(src, 8)).fetchone()})
    counts = [con.execute(f"SELECT count(*) FROM t WHERE {p}").fetchone()[0] for p in R.part_predicates("k", quantiles)]
    assert sum(counts) == n and max(counts) < 0.3 * n


def test_few_keys_and_options():
    assert R.even_cuts(5, 5, 8) == [] and R.part_predicates("k", []) == ["1 = 1"]
    assert R.even_cuts(0, 3, 100) == [1, 2, 3]
    assert R.part_count(0) == 1 and R.part_count(10**12) == 10_000
    opts = R.jdbc_options(R.Source("u", "t", "k", 500, (("user", "me"),)))
    assert opts["fetchsize"] == "500" and opts["user"] == "me" and opts["pushDownPredicate"] == "true"
    assert "WHERE d > 1" in R.bounds_query(R.Source("u", "t", "k"), "d > 1")
