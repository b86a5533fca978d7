"""Data-driven splits against plain windows, with one key, one value or all rows alike."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerline.operators import splits
from ledgerline.operators.splits import range_splits, split_asof, split_windows

SCHEMA = "k string, v double, id long, x decimal(18,2)"


def rows(n, seed=1):
    """Nearly all rows in one key, half of them with one value; NULL keys, values and amounts."""
    r = random.Random(seed)
    out = []
    for i in range(n):
        k = "hot" if i % 50 else r.choice(["a", "b", None])
        v = 5.0 if r.random() < 0.5 else r.choice([None, float("nan"), 1.0, 2.0, 7.0, 9.5])
        out.append((k, v, i, None if r.random() < 0.1 else r.randrange(1000)))
    return [(k, v, i, None if x is None else __import__("decimal").Decimal(x) / 4) for k, v, i, x in out]


def plain(df, keys, descending):
    d = F.desc("v") if descending else F.asc("v")
    w, v = Window.partitionBy(*keys).orderBy(d, "id"), Window.partitionBy(*keys).orderBy(d)
    return df.select(
        *df.columns, F.row_number().over(w).alias("row_num"), F.rank().over(v).alias("rank_val"),
        F.dense_rank().over(v).alias("dense_rank_val"),
        F.sum("x").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("running_total"),
        F.lag("x").over(w).alias("prev_value"), F.lead("x").over(w).alias("next_value"),
    )


def text(df):
    return sorted(map(str, df.orderBy("id").collect()))


@pytest.mark.parametrize("keys,descending", [(["k"], False), (["k"], True), ([], False)])
def test_windows_equal_plain_ones(spark, folder, keys, descending):
    df = spark.createDataFrame(rows(1500), SCHEMA).repartition(4)
    got = split_windows(df, keys, "v", ["id"], f"{folder}/w", descending=descending, running="x", neighbours="x", rows_per_split=60)
    assert text(got) == text(plain(df, keys, descending))


def test_one_value_is_cut_into_bounded_ranges(spark, folder):
    df = spark.range(20000).selectExpr("'hot' AS k", "1.0D AS v", "7 AS id")
    parts = range_splits(df, [F.asc("k"), F.asc("v"), F.asc("id")], f"{folder}/p", 500)
    sizes = [r.n for r in parts.groupBy("_blk").agg(F.count(F.lit(1)).alias("n")).collect()]
    assert sum(sizes) == 20000 and max(sizes) <= 1500


def test_empty(spark, folder):
    df = spark.createDataFrame([], SCHEMA)
    assert split_windows(df, ["k"], "v", ["id"], f"{folder}/w", running="x").count() == 0
    right = spark.createDataFrame([], "k string, t timestamp, p double")
    left = spark.createDataFrame([("a", dt.datetime(2024, 1, 1), 1)], "k string, t timestamp, id long")
    assert [tuple(r) for r in split_asof(left, right, ["k"], "t", "t", ["p"], f"{folder}/a").collect()] == [
        ("a", dt.datetime(2024, 1, 1), 1, None, None)]


def test_asof_equals_brute_force(spark, folder):
    r = random.Random(3)
    day = dt.datetime(2024, 1, 1)

    def some(n, value):
        return [
            (r.choice(["hot"] * 30 + ["a", None]), None if r.random() < 0.03 else day + dt.timedelta(minutes=r.randrange(400)), value(i))
            for i in range(n)
        ]

    left, right = some(900, int), some(120, lambda i: None if i % 9 == 0 else float(r.randrange(50)))
    # Far from any left row of its range: the state has to cross many ranges.
    right.append(("a", day - dt.timedelta(days=90), 1.0))
    got = split_asof(
        spark.createDataFrame(left, "k string, t timestamp, id long"), spark.createDataFrame(right, "k string, t timestamp, p double"),
        ["k"], "t", "t", ["p"], f"{folder}/a", rows_per_split=40)

    def best(k, t):
        found = [(u, p is not None, p or 0) for j, u, p in right if None not in (k, t, j, u) and j == k and u <= t]
        return None if not found else (max(found)[2] if max(found)[1] else None, max(found)[0])

    want = {i: best(k, t) or (None, None) for k, t, i in left}
    assert {x.id: (x.p, x.t_matched) for x in got.collect()} == want


def test_a_task_gets_one_range(spark, folder):
    """Ranges that meet in one task would be sorted together, however small each is."""
    df = spark.range(3000).selectExpr("'hot' AS k", "1.0D AS v", "id")
    parts = range_splits(df, [F.asc("k"), F.asc("v"), F.asc("id")], f"{folder}/p", 100)
    met = splits._one_by_one(parts).groupBy(F.spark_partition_id().alias("task")).agg(F.count_distinct("_blk").alias("n")).collect()
    assert len(met) == parts.select("_blk").distinct().count() and {r.n for r in met} == {1}
    assert splits.ROWS_PER_SPLIT <= 1_000_000
