"""Streaming append: result equals the batch load; a replay adds nothing."""
import uuid

from cdmspark.plans.catalog import P
from cdmspark.plans.roles import SPARK, visit_source
from cdmspark.session import scratch_path
from cdmspark.streaming.incremental_stream import stream_visits, write_snapshot
from conftest import SF001


def test_stream_equals_batch_and_replay_is_idempotent(spark):
    base = scratch_path(spark, f"test_stream/{uuid.uuid4().hex}")
    schema = spark.read.parquet(f"{SF001}/orders.parquet").schema

    def source():
        return (spark.readStream.schema(schema).option("pathGlobFilter", "orders.parquet").parquet(SF001)
                .selectExpr(*visit_source(SPARK)))

    p = P(spark, SF001)
    persons = write_snapshot(p.persons().select("person_id"), f"{base}/persons")
    target = f"{base}/visit"
    stream_visits(spark, source(), persons, target, f"{base}/ck1")
    # a second stream with a fresh checkpoint re-reads the same file: the anti-join skips it all
    stream_visits(spark, source(), persons, target, f"{base}/ck2")
    got = spark.read.parquet(target)
    want = p.visits()
    assert got.count() == want.count()
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_stream_over_several_batches_equals_batch_load(spark):
    """Orders arrive as three files in id order; three micro-batches; the preceding-visit
    seed carries across batches, so the target equals one batch load."""
    from pyspark.sql import functions as F
    base = scratch_path(spark, f"test_stream_multi/{uuid.uuid4().hex}")
    orders = spark.read.parquet(f"{SF001}/orders.parquet")
    cuts = orders.approxQuantile("o_orderkey", [1 / 3, 2 / 3], 0.0)
    parts = [orders.where(F.col("o_orderkey") <= cuts[0]),
             orders.where((F.col("o_orderkey") > cuts[0]) & (F.col("o_orderkey") <= cuts[1])),
             orders.where(F.col("o_orderkey") > cuts[1])]
    inbox = f"{base}/inbox"
    for i, part in enumerate(parts):
        part.coalesce(1).write.mode("overwrite").parquet(f"{base}/staging{i}")
    import glob
    import os
    import shutil
    local = base[len("file:"):] if base.startswith("file:") else base   # test-only local copy
    os.makedirs(f"{local}/inbox", exist_ok=True)
    for i in range(3):
        f = glob.glob(f"{local}/staging{i}/part-*.parquet")[0]
        shutil.copy(f, f"{local}/inbox/orders_{i}.parquet")
    src = (spark.readStream.schema(orders.schema).option("maxFilesPerTrigger", 1).parquet(inbox)
           .selectExpr(*visit_source(SPARK)))
    p = P(spark, SF001)
    persons = write_snapshot(p.persons().select("person_id"), f"{base}/persons")
    q = stream_visits(spark, src, persons, f"{base}/visit", f"{base}/ck")
    assert len(q.recentProgress) >= 3
    got = spark.read.parquet(f"{base}/visit")
    want = p.visits()
    assert got.count() == want.count()
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_a_large_delivery_is_read_by_many_tasks(spark, tmp_dir, monkeypatch):
    """a delivered file has several row groups, so that its rows are not one task's."""
    import glob

    import pyarrow.parquet as pq

    from cdmspark.streaming import incremental_stream as I
    monkeypatch.setattr(I, "scratch_path", lambda *_: tmp_dir)
    spark.range(600_000).selectExpr(
        "id AS o_orderkey", "id % 7 AS o_custkey", "'O' AS o_orderstatus", "rand(3) AS o_totalprice",
        "timestamp_ntz'1997-01-01 00:00:00' AS o_orderdate", "'1-URGENT' AS o_orderpriority").write.parquet(f"{tmp_dir}/orders.parquet")
    people = spark.range(3).withColumnRenamed("id", "person_id")
    got = I.stream_visit_query(spark, tmp_dir, visit_source(SPARK), people, batches=1)
    (file,) = glob.glob(f"{tmp_dir}/delivered/*.parquet")
    assert pq.ParquetFile(file).metadata.num_row_groups > 1
    assert got.count() == sum(i % 7 < 3 and i % 23 != 0 for i in range(600_000))
