"""Files by key range: only those that may hold a key are read; a hot key is spread."""
import os

from pyspark.sql import functions as F

from cdmspark.sources.clustered import files_between, read_clustered, write_clustered


def test_reads_few_files(spark, tmp_dir):
    df = spark.range(10_000).select((F.col("id") * 7919 % 2000).alias("person_id"), F.col("id").alias("start"))
    path = os.path.join(tmp_dir, "t")
    n = write_clustered(df, path, ["person_id", "start"], 10_000, 500)
    assert n >= 15
    got = read_clustered(spark, path, "person_id", 100, 120)
    want = df.where("person_id BETWEEN 100 AND 120")
    assert sorted(got.collect()) == sorted(want.collect())
    assert len(files_between(spark, path, 100, 120)) <= 3
    assert set(got.inputFiles()) <= set(files_between(spark, path, 100, 120))
    assert read_clustered(spark, path, "person_id").count() == 10_000
    assert read_clustered(spark, path, "person_id", high=0).count() == df.where("person_id = 0").count()
    assert read_clustered(spark, path, "person_id", low=99_999).count() == 0


def test_hot_key_is_spread_and_files_are_sorted(spark, tmp_dir):
    df = spark.range(6000).select(F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id")).alias("k"), F.col("id").alias("start"))
    path = os.path.join(tmp_dir, "t")
    write_clustered(df, path, ["k", "start"], 6000, 400)
    files = files_between(spark, path, 5, 5)
    assert len(files) >= 4
    for f in files:
        rows = [tuple(r) for r in spark.read.parquet(f).collect()]
        assert rows == sorted(rows) and len(rows) < 1500
    assert read_clustered(spark, path, "k", 5, 5).count() == 2001        # and id 5 itself


def test_null_keys_and_empty_tables(spark, tmp_dir):
    df = spark.createDataFrame([(None, 1), (3, 2), (4, None)], "k long, v int")
    path = os.path.join(tmp_dir, "t")
    write_clustered(df, path, ["k", "v"], 3, 1)
    assert read_clustered(spark, path, "k").count() == 3 and read_clustered(spark, path, "k", 3, 3).collect() == [(3, 2)]
    write_clustered(df.limit(0), path, ["k"], 0)
    assert read_clustered(spark, path, "k").count() == 0 == read_clustered(spark, path, "k", 1, 2).count()
