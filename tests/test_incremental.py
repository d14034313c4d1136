"""Only new and changed files are computed; files that have gone are no longer read."""

import os

import pytest
from pyspark.sql import functions as F

from textloom.sources import incremental


@pytest.fixture
def folder(spark, tmp_path):
    def put(name, *keys):
        spark.createDataFrame([(k, f"text {k}") for k in keys], "k long, text string").toPandas().to_parquet(tmp_path / "in" / name, index=False)

    (tmp_path / "in").mkdir()
    put("a.parquet", 1, 2)
    put("b.parquet", 3)
    put("c.parquet", 4, 5)
    return tmp_path, put


def test_changed_added_and_removed_files(spark, folder):
    tmp, put = folder
    schema = spark.createDataFrame([], "k long, text string").schema
    read = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def counted(k):
        read.add(1)
        return k

    def table(**kw):
        before = read.value
        rows = incremental.materialize_files(
            spark, f"{tmp}/in", schema, lambda d: d.select(counted("k").alias("k"), F.length("text").alias("n"), "file"), f"{tmp}/out", **kw
        )
        return sorted(r.k for r in rows.collect()), read.value - before

    assert table() == ([1, 2, 3, 4, 5], 5)
    assert table() == ([1, 2, 3, 4, 5], 0)
    put("d.parquet", 6)
    assert table() == ([1, 2, 3, 4, 5, 6], 1)
    put("b.parquet", 30, 31, 32)
    assert table() == ([1, 2, 4, 5, 6, 30, 31, 32], 3)
    os.remove(tmp / "in" / "a.parquet")
    assert table() == ([4, 5, 6, 30, 31, 32], 0)
    assert table(params={"other": 1}) == ([4, 5, 6, 30, 31, 32], 6)
    assert table(params={"other": 1}, checksum=True)[1] == 6
    os.utime(tmp / "in" / "d.parquet", (1, 1))
    assert table(params={"other": 1}, checksum=True)[1] == 1
    assert incremental.read_files(spark, f"{tmp}/out").count() == 6


def test_a_lost_run_leaves_the_old_table(spark, folder):
    tmp, put = folder
    schema = spark.createDataFrame([], "k long, text string").schema
    keep = lambda d: d.select("k", "file")
    incremental.materialize_files(spark, f"{tmp}/in", schema, keep, f"{tmp}/out")
    put("d.parquet", 6)

    @F.udf("long")
    def broken(k):
        raise RuntimeError

    with pytest.raises(Exception):
        incremental.materialize_files(spark, f"{tmp}/in", schema, lambda d: d.select(broken("k").alias("k"), "file"), f"{tmp}/out")
    assert sorted(r.k for r in incremental.read_files(spark, f"{tmp}/out").collect()) == [1, 2, 3, 4, 5]
    assert sorted(r.k for r in incremental.materialize_files(spark, f"{tmp}/in", schema, keep, f"{tmp}/out").collect()) == [1, 2, 3, 4, 5, 6]
