"""Windows and as-of joins cut by the data's own order, for groups whose shape is not known beforehand.

All rows are range-partitioned on the whole order (keys, order, ties): Spark samples its quantiles, so a key, or
a single value, that holds nearly all rows is cut into as many ranges as its rows need, and small keys share one.
A boundary cuts one key at most. So the rows that carry the state of cut keys from range to range are at most two
for each range, and only cut keys are read again to make them.

Sampled cuts may come out differently when computed again, so the ranges are written once, to ``path``. Column names
that begin with an underscore are reserved.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows aimed at for one range; a task that ranks one sorts it and holds it once more for each window.
ROWS_PER_SPLIT = 1_000_000
#: Beyond this many ranges Spark's sample (a million rows) has few points for each; ranges grow instead.
MAX_SPLITS = 10_000


def range_splits(df: DataFrame, order: Sequence[Column], path: str, rows_per_split: int = ROWS_PER_SPLIT) -> DataFrame:
    """``df`` written to ``path`` with ``_blk``, the number of its range in ``order``.

    Rows that are equal in ``order`` may lie on both sides of a cut. ``df`` is evaluated three times (count, sample,
    write), so write it first if it is expensive to compute.
    """
    spark = df.sparkSession
    wanted = max(spark.sparkContext.defaultParallelism, math.ceil(df.count() / rows_per_split))
    cut = df.repartitionByRange(min(wanted, MAX_SPLITS), *order, F.rand(0))
    cut.withColumn("_blk", F.spark_partition_id()).write.parquet(path)
    return spark.read.parquet(path)


def _one_by_one(parts: DataFrame) -> DataFrame:
    """Dealt by the number of the range, so that a task sorts one range; by a hash of it, several would meet in one."""
    last = parts.agg(F.max("_blk")).first()[0]
    return parts.repartitionByRange((last or 0) + 1, "_blk")


def _cut_keys(parts: DataFrame) -> DataFrame:
    """Keys that lie in several ranges: such a key is the first or the last one of each of them."""
    ends = parts.groupBy("_blk").agg(F.min("_k").alias("lo"), F.max("_k").alias("hi"))
    keys = ends.select(F.explode(F.array_distinct(F.array("lo", "hi"))).alias("_k"))
    return keys.groupBy("_k").agg(F.count(F.lit(1)).alias("_in")).where("_in > 1").select("_k")


def _key(keys: Sequence[str]) -> Column:
    """The keys as a struct that is never NULL itself and whose NULL fields are equal."""
    return F.struct(*keys) if keys else F.struct(F.lit(0).alias("none"))


def split_windows(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    tie: Sequence[str],
    path: str,
    *,
    descending: bool = False,
    running: str | None = None,
    neighbours: str | None = None,
    rows_per_split: int = ROWS_PER_SPLIT,
) -> DataFrame:
    """Adds ``row_num``, ``rank_val``, ``dense_rank_val`` and, on demand, ``running_total`` of one column and
    ``prev_value`` / ``next_value`` of another, per ``keys`` in the order of ``order``, then ``tie``.

    The results are those of plain windows; NULLs sort and group as there. Rows that tie on everything are numbered
    in any order. An empty frame gives no rows.
    """
    direction = F.desc if descending else F.asc
    sort = [direction(order), *[F.asc(c) for c in tie]]
    parts = range_splits(df, [*[F.asc(k) for k in keys], *sort], path, rows_per_split).withColumn("_k", _key(keys))
    inside = Window.partitionBy("_k", "_blk").orderBy(*sort)
    by_value = Window.partitionBy("_k", "_blk").orderBy(direction(order))
    cols = {"_rn": F.row_number().over(inside), "_rk": F.rank().over(by_value), "_dr": F.dense_rank().over(by_value)}
    if running:
        cols["_run"] = F.sum(running).over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    if neighbours:
        cols |= {"_lag": F.lag(neighbours).over(inside), "_lead": F.lead(neighbours).over(inside)}
    state = _carried(parts.join(F.broadcast(_cut_keys(parts)), "_k", "left_semi"), order, tie, descending, running, neighbours)

    j = _one_by_one(parts).withColumns(cols).join(F.broadcast(state), ["_k", "_blk"], "left")
    n0, d0 = F.coalesce("_n0", F.lit(0)), F.coalesce("_d0", F.lit(0))
    out = {
        "row_num": F.col("_rn") + n0,
        # The first value of the range may have begun in an earlier one.
        "rank_val": F.when((F.col("_rk") == 1) & F.col("_goes_on"), F.col("_head_rank")).otherwise(F.col("_rk") + n0),
        "dense_rank_val": F.col("_dr") + d0,
    }
    if running:
        none = F.col("_run").isNull() & F.col("_s0").isNull()
        out["running_total"] = F.when(~none, F.coalesce("_run", F.lit(0)) + F.coalesce("_s0", F.lit(0)))
    if neighbours:
        out["prev_value"] = F.when(F.col("_rn") == 1, F.col("_prev")).otherwise(F.col("_lag"))
        out["next_value"] = F.when(F.col("_rn") == F.col("_n"), F.col("_next")).otherwise(F.col("_lead"))
    return j.select(*df.columns, *[e.alias(n) for n, e in out.items()])


def _carried(
    rows: DataFrame, order: str, tie: Sequence[str], descending: bool, running: str | None, neighbours: str | None
) -> DataFrame:
    """One row per cut key and range: what the ranges before it hand on."""
    value = F.struct(F.col(order).alias("v"))
    first, last = (F.max, F.min) if descending else (F.min, F.max)
    first_by, last_by = (F.max_by, F.min_by) if descending else (F.min_by, F.max_by)
    # Counted per value before the ranges are summed up, so that a task combines first.
    per_value = [F.count(F.lit(1)).alias("_n")]
    per_range = [
        F.sum("_n").alias("_n"), F.count(F.lit(1)).alias("_d"), first(value).alias("_first"), last(value).alias("_last"),
        last_by("_n", value).alias("_tail"),
    ]
    if running:
        per_value.append(F.sum(running).alias("_s"))
        per_range.append(F.sum("_s").alias("_s"))
    if neighbours:
        at = F.struct(*tie)
        per_value += [F.min_by(neighbours, at).alias("_lo"), F.max_by(neighbours, at).alias("_hi")]
        per_range += [first_by("_lo", value).alias("_lo"), last_by("_hi", value).alias("_hi")]
    ranges = rows.groupBy("_k", "_blk", order).agg(*per_value).groupBy("_k", "_blk").agg(*per_range)

    chain = Window.partitionBy("_k").orderBy("_blk")
    before, upto = chain.rowsBetween(Window.unboundedPreceding, -1), chain.rowsBetween(Window.unboundedPreceding, 0)
    ended = F.lag("_last").over(chain)
    ranges = ranges.withColumns({
        "_goes_on": ended.isNotNull() & F.col("_first").eqNullSafe(ended),
        "_n0": F.coalesce(F.sum("_n").over(before), F.lit(0)),
    })
    # Rank of the value at the end of a range; a range that goes on with one value only leaves it as it was.
    own = F.when(~(F.col("_goes_on") & (F.col("_d") == 1)), F.col("_n0") + F.col("_n") - F.col("_tail") + 1)
    ranges = ranges.withColumn("_tail_rank", F.last(own, ignorenulls=True).over(upto))
    carry = {
        "_head_rank": F.lag("_tail_rank").over(chain),
        "_d0": F.coalesce(F.sum("_d").over(before), F.lit(0)) - F.sum(F.col("_goes_on").cast("int")).over(upto),
    }
    if running:
        carry["_s0"] = F.sum("_s").over(before)
    if neighbours:
        carry |= {"_prev": F.lag("_hi").over(chain), "_next": F.lead("_lo").over(chain)}
    return ranges.select("_k", "_blk", "_n", "_n0", "_goes_on", *[e.alias(n) for n, e in carry.items()])


def split_asof(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[str],
    left_ts: str,
    right_ts: str,
    values: Sequence[str],
    path: str,
    *,
    rows_per_split: int = ROWS_PER_SPLIT,
) -> DataFrame:
    """Left rows plus ``values`` of the latest right row of the same key not after ``left_ts``, and its time as
    ``<right_ts>_matched``.

    Unlike ``joins.asof_join`` it needs no bucket length: both sides are cut together by their sampled order. Right
    rows of the same key and time are ranked by their values. NULL keys and times match nothing; every left row stays.
    """
    right = right.dropna(subset=[*by, right_ts])
    payload = F.struct(F.col(right_ts).cast("timestamp").alias("_at"), *values)
    kind = right.select(payload.alias("x")).schema["x"].dataType
    row_kind = left.select(F.struct(*left.columns).alias("x")).schema["x"].dataType
    key = _key(by).alias("_k")
    r = right.select(
        key, F.col(right_ts).cast("timestamp").alias("_ts"), F.lit(0).alias("_side"), payload.alias("_right"),
        F.lit(None).cast(row_kind).alias("_left"),
    )
    mine = left.select(
        key, F.col(left_ts).cast("timestamp").alias("_ts"), F.lit(1).alias("_side"), F.lit(None).cast(kind).alias("_right"),
        F.struct(*left.columns).alias("_left"),
    )
    order = ["_k", "_ts", "_side", "_right"]
    parts = range_splits(mine.unionByName(r), [F.asc(c) for c in order], path, rows_per_split)
    inside = Window.partitionBy("_k", "_blk").orderBy(*order[1:]).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    near = _one_by_one(parts).withColumn("_near", F.last("_right", ignorenulls=True).over(inside)).where("_side = 1")

    cut = parts.select("_k", "_blk", "_right").join(F.broadcast(_cut_keys(parts.select("_k", "_blk"))), "_k", "left_semi")
    before = Window.partitionBy("_k").orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    far = cut.groupBy("_k", "_blk").agg(F.max("_right").alias("_top")).select(
        "_k", "_blk", F.last("_top", ignorenulls=True).over(before).alias("_far"))
    j = near.join(F.broadcast(far), ["_k", "_blk"], "left")
    hit = F.coalesce("_near", "_far")
    return j.select("_left.*", *[hit[v].alias(v) for v in values], hit["_at"].alias(f"{right_ts}_matched"))
