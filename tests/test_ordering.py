import hashlib
import math

import pytest
from pyspark.sql import functions as F

from textloom.operators import ordering
from textloom.operators.skew import attach_group_values


def h(key, seed=42):
    return int(hashlib.md5(f"{seed}:{key}".encode()).hexdigest()[:15], 16)


def numbered(spark, n, parts=3):
    return spark.range(0, n, 1, parts).select((F.col("id") * 7 - 50).alias("k"))


@pytest.mark.parametrize(("n", "tests"), [(1, 1), (9, 1), (10, 1), (11, 2), (101, 11), (0, 0)])
def test_split_sizes(spark, n, tests):
    rows = ordering.train_test_split(numbered(spark, n), 0.1, "k").collect()
    assert sum(r.split == "test" for r in rows) == tests == math.ceil(0.1 * n)
    assert len({r.k for r in rows}) == len(rows) == n
    keys = sorted((r.k for r in rows), key=lambda k: (h(k), k))
    assert {r.k for r in rows if r.split == "test"} == set(keys[:tests])
    parts = ordering.by_split(ordering.train_test_split(numbered(spark, n), 0.1, "k"))
    assert {name: p.count() for name, p in parts.items()} == {"train": n - tests, "test": tests}


@pytest.mark.parametrize("sort_rows", [1, 50])
def test_slices_narrow_down_without_sorting(spark, monkeypatch, sort_rows):
    monkeypatch.setattr(ordering, "SORT_ROWS", sort_rows)
    monkeypatch.setattr(ordering, "PIVOTS", 5)
    df = numbered(spark, 1000)
    keys = sorted(r.k for r in df.collect())
    assert sorted(r.k for r in ordering.head_rows(df, 137, "k").collect()) == keys[:137]
    assert sorted(r.k for r in ordering.head_fraction(df, 0.1234, "k").collect()) == keys[: round(123.4)]
    sample = {r.k for r in ordering.sample_rows(df, 77, "k").collect()}
    assert sample == set(sorted(keys, key=lambda k: (h(k), k))[:77])


def test_slice_of_duplicates_uses_the_next_column(spark, monkeypatch):
    monkeypatch.setattr(ordering, "SORT_ROWS", 10)
    df = spark.range(300).select((F.col("id") % 2).alias("a"), F.col("id").alias("b"))
    key, total = ordering.kth_key(df, ["a", "b"], lambda n: 200)
    rows = sorted((r.a, r.b) for r in df.collect())
    assert total == 300 and key == rows[199]


@pytest.mark.parametrize("n", [0, 5, 1000, 5000])
def test_head_limits(spark, n):
    df = numbered(spark, 1000)
    assert ordering.head_rows(df, n, "k").count() == min(n, 1000)
    assert ordering.sample_rows(df, n, "k").count() == min(n, 1000)


@pytest.mark.parametrize("parts", [1, 4, 17])
def test_row_index_does_not_depend_on_partitions(spark, monkeypatch, parts):
    monkeypatch.setattr(ordering, "ROWS_PER_BUCKET", 10)
    df = numbered(spark, 500).repartition(parts)
    indexed, total = ordering.with_row_index(df, "k")
    got = {r.k: r.row_index for r in indexed.collect()}
    want = {k: i for i, k in enumerate(sorted(got, key=lambda k: (h(k), k)))}
    assert total == 500 and got == want


def test_offsets(spark):
    df = numbered(spark, 200).withColumn("len", F.pmod("k", F.lit(9)))
    placed, total = ordering.with_offset(df, "k", F.col("len"))
    at = 0
    for r in sorted(placed.collect(), key=lambda r: (h(r.k), r.k)):
        assert r.offset == at
        at += r.len
    assert total == at


def test_shuffled_rows_are_globally_ordered(spark, tmp_path):
    out = ordering.shuffle_rows(numbered(spark, 400), "k", 5)
    rows = out.select("k", F.spark_partition_id().alias("p"), F.monotonically_increasing_id().alias("m")).collect()
    keys = [r.k for r in sorted(rows, key=lambda r: r.m)]
    assert keys == sorted(keys, key=lambda k: (h(k), k)) and len({r.p for r in rows}) == 5


def test_batches(spark):
    df = numbered(spark, 35)
    sizes = {r.batch_id: r["count"] for r in ordering.assign_batches(df, "k", 16).groupBy("batch_id").count().collect()}
    assert sizes == {0: 16, 1: 16, 2: 3}
    assert ordering.assign_batches(df, "k", 16, drop_last=True).count() == 32


def test_group_values_reach_hot_and_cold_rows(spark):
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("g"), F.col("id").alias("r")
    )
    rows = rows.unionByName(spark.createDataFrame([(None, -1)], "g long, r long"))
    groups = rows.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.sum("r").alias("s"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = attach_group_values(rows, groups, "g", "n", "r", hot_groups=5).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(got) == 3001
    for r in got:
        if r.g is None:
            assert (r.n, r.s) == (1, -1)
        elif r.g == 0:
            assert (r.n, r.s) == (1000, sum(range(0, 3000, 3)))
        else:
            assert (r.n, r.s) == (1, r.r)


@pytest.mark.parametrize("hot_groups", [1, 2, 5, 100])
def test_repeated_group_keys_lose_no_row(spark, hot_groups):
    rows = spark.createDataFrame([(g, i) for g in (1, 2, None) for i in range(10)], "g long, r long")
    groups = spark.createDataFrame([(1, 10, "a"), (1, 10, "b"), (2, 10, "c"), (2, 10, "d"), (None, 10, "e")], "g long, n long, v string")
    got = attach_group_values(rows, groups, "g", "n", "r", hot_groups=hot_groups).collect()
    assert sorted((r.g or 0, r.r, r.v) for r in got) == sorted(
        (g or 0, i, v) for g, vs in ((1, "ab"), (2, "cd"), (None, "e")) for i in range(10) for v in vs
    )


def any_keys(spark):
    wide = [None, -(2**63), 2**63 - 1, *[h(i) * 8 - 2**62 for i in range(300)]]
    rows = [(k, None if k is None else f"{'same long beginning' * 3}{k}", None if k is None else k / 7) for k in wide]
    return spark.createDataFrame(rows, "i long, s string, d double")


@pytest.mark.parametrize("column", ["i", "s", "d"])
@pytest.mark.parametrize("n", [1, 2, 150, 302, 303])
def test_slices_of_any_key_do_not_depend_on_the_sort_limit(spark, monkeypatch, column, n):
    df = any_keys(spark)
    order = sorted((r[column] for r in df.collect()), key=lambda v: (v is not None, v))
    for limit in (10, 100_000):
        monkeypatch.setattr(ordering, "SORT_ROWS", limit)
        got = [r[column] for r in ordering.head_rows(df, n, column).collect()]
        assert sorted(got, key=lambda v: (v is not None, v)) == order[:n]


def test_ties_at_the_end_of_a_slice_come_together(spark, monkeypatch):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"))
    for limit in (10, 100_000):
        monkeypatch.setattr(ordering, "SORT_ROWS", limit)
        assert ordering.head_rows(df, 400, "k").count() == 667


def test_no_sort_grows_with_the_rows_asked_for(spark, monkeypatch):
    monkeypatch.setattr(ordering, "SORT_ROWS", 10)
    seen = []
    limit = type(spark.range(1)).limit
    monkeypatch.setattr(type(spark.range(1)), "limit", lambda self, n: seen.append(n) or limit(self, n))
    df = spark.range(2000).select(F.col("id").cast("string").alias("k"))
    assert ordering.head_fraction(df, 0.5, "k").count() == 1000
    assert max(seen) <= 64 * ordering.PIVOTS


@pytest.mark.parametrize("common", [0, 500, 10**6])
def test_one_value_on_nearly_all_rows(spark, monkeypatch, common):
    """The smallest, a middle and the largest value repeat; the rank falls on, before and behind it."""
    monkeypatch.setattr(ordering, "SORT_ROWS", 20)
    values = [common] * 2000 + list(range(1, 990, 9))
    df = spark.createDataFrame([(v,) for v in values], "k long").repartition(3)
    ordered = sorted(values)
    for k in (1, 50, 60, 1000, 2000, 2060, 2109, 2110):
        key, total = ordering.kth_key(df, ["k"], lambda n: k)
        assert total == len(values) and key == (ordered[k - 1],)
    assert ordering.kth_key(df, ["k"], lambda n: n + 1)[0] is None


def test_shards_follow_the_input_files(spark, tmp_path):
    path = str(tmp_path / "rows")
    numbered(spark, 5000, parts=4).write.parquet(path)
    df = spark.read.parquet(path)
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    size = sum(f.stat().st_size for f in (tmp_path / "rows").glob("*.parquet"))
    assert ordering.shard_count(df, size // 20) == 21 and ordering.shard_count(df) == least
    assert ordering.shard_count(numbered(spark, 10)) == least
    assert ordering.shuffle_rows(df, "k").rdd.getNumPartitions() == least
