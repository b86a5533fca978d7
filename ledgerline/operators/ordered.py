"""Window functions over groups of any size.

A plain window puts each group into one task. Here a group is cut into blocks by a monotone
function of the ordering column (a month, a price band). A window runs inside each block, one
small aggregate row per (group, block) carries the state across blocks, and both are joined on
(group, block). The large side is shuffled once, on (group, block), so a hot group is spread over
as many tasks as it has blocks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _group(keys: Sequence[str]) -> Column:
    """The keys as one struct: never NULL itself, and NULL fields compare as equal, so windows,
    aggregates and joins on it share one shuffle and keep groups with NULL keys."""
    return F.struct(*keys) if keys else F.lit(0)


def ordered_functions(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    tie: Sequence[str],
    block: Column,
    *,
    descending: bool = False,
    running: str | None = None,
    neighbours: str | None = None,
) -> DataFrame:
    """Adds ``row_num``, ``rank_val``, ``dense_rank_val`` and, on demand, ``running_total`` of one
    column and ``prev_value`` / ``next_value`` of another, per ``keys`` in the order of ``order``.

    Rows that tie on ``order`` are numbered by ``tie``, which must make the order total. ``block``
    must grow with ``order`` and never split equal values. NULLs sort as in a plain window.
    """
    keys = list(keys)
    direction = (lambda c: F.desc(c)) if descending else (lambda c: F.asc(c))
    df = df.withColumns({"_k": _group(keys), "_blk": F.struct(block.alias("b"))})
    sort = [direction(order), *[F.asc(c) for c in tie]]
    inside = Window.partitionBy("_k", "_blk").orderBy(*sort)
    by_value = Window.partitionBy("_k", "_blk").orderBy(direction(order))
    cols = {
        "_rn": F.row_number().over(inside),
        "_rk": F.rank().over(by_value),
        "_dr": F.dense_rank().over(by_value),
    }
    if running:
        cols["_run"] = F.sum(running).over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    if neighbours:
        cols["_lag"] = F.lag(neighbours).over(inside)
        cols["_lead"] = F.lead(neighbours).over(inside)
    local = df.withColumns(cols)

    # Distinct order values are counted in two steps: a count over values would need an expand.
    per_value = [F.count(F.lit(1)).alias("_n")]
    if running:
        per_value.append(F.sum(running).alias("_s"))
    if neighbours:
        pos = F.struct(*tie)
        per_value += [
            F.min_by(neighbours, pos).alias("_lo"),
            F.max_by(neighbours, pos).alias("_hi"),
        ]
    values = df.groupBy("_k", "_blk", order).agg(*per_value)
    # The first value of a block in scan order is the largest one when the order is descending.
    at_start, at_end = (F.max_by, F.min_by) if descending else (F.min_by, F.max_by)
    totals = [F.sum("_n").alias("_n"), F.count(F.lit(1)).alias("_d")]
    if running:
        totals.append(F.sum("_s").alias("_s"))
    if neighbours:
        totals += [at_start("_lo", F.struct(order)).alias("_lo"), at_end("_hi", F.struct(order)).alias("_hi")]
    blocks = values.groupBy("_k", "_blk").agg(*totals)

    chain = Window.partitionBy("_k").orderBy(direction("_blk"))
    before = chain.rowsBetween(Window.unboundedPreceding, -1)
    carry = [
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n0"),
        F.coalesce(F.sum("_d").over(before), F.lit(0)).alias("_d0"),
        F.col("_n").alias("_size"),
    ]
    if running:
        carry.append(F.sum("_s").over(before).alias("_s0"))
    if neighbours:
        carry += [F.lag("_hi").over(chain).alias("_prev"), F.lead("_lo").over(chain).alias("_next")]
    state = blocks.select("_k", "_blk", *carry)

    j = local.join(state, ["_k", "_blk"])
    out = {
        "row_num": F.col("_rn") + F.col("_n0"),
        "rank_val": F.col("_rk") + F.col("_n0"),
        "dense_rank_val": F.col("_dr") + F.col("_d0"),
    }
    if running:
        # A sum over NULLs only is NULL, as in a plain window.
        out["running_total"] = F.when(
            F.col("_run").isNull() & F.col("_s0").isNull(), F.lit(None)
        ).otherwise(F.coalesce(F.col("_run"), F.lit(0)) + F.coalesce(F.col("_s0"), F.lit(0)))
    if neighbours:
        out["prev_value"] = F.when(F.col("_rn") == 1, F.col("_prev")).otherwise(F.col("_lag"))
        out["next_value"] = F.when(F.col("_rn") == F.col("_size"), F.col("_next")).otherwise(F.col("_lead"))
    plain = [c for c in df.columns if c not in ("_k", "_blk")]
    return j.select(*plain, *[e.alias(n) for n, e in out.items()])


def exact_percentile(df: DataFrame, keys: Sequence[str], value: str, share: float, block: Column, out: str) -> DataFrame:
    """Continuous percentile per key, exact, with no group held in memory.

    Counts per (key, value) are combined before the shuffle; the running count finds the two
    values around the wanted position.
    """
    keys = list(keys)
    hist = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_c"))
    run = ordered_functions(hist, keys, value, [value], block, running="_c").withColumn("_k", _group(keys))
    total = hist.groupBy(_group(keys).alias("_k")).agg(F.sum("_c").alias("_total"))
    pos = (F.col("_total") - 1) * F.lit(float(share))
    upto, after = F.col("running_total") - F.col("_c"), F.col("running_total")
    hit = run.join(total, "_k").select(
        *keys,
        F.col(value).alias("_v"),
        ((upto <= F.floor(pos)) & (F.floor(pos) < after)).alias("_is_lo"),
        ((upto <= F.ceil(pos)) & (F.ceil(pos) < after)).alias("_is_hi"),
        (pos - F.floor(pos)).alias("_f"),
    )
    ends = hit.filter("_is_lo OR _is_hi").groupBy(*keys).agg(
        F.max(F.when(F.col("_is_lo"), F.col("_v"))).alias("_lo"),
        F.max(F.when(F.col("_is_hi"), F.col("_v"))).alias("_hi"),
        F.max("_f").alias("_f"),
    )
    return ends.select(*keys, (F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("_f")).alias(out))
