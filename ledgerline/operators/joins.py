"""Joins on time: price periods, as-of lookup, latest row per key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.calc import bounded_rows
from ledgerline.operators.merge import dedup_latest
from ledgerline.operators.ordered import ordered_functions

BROADCAST_ROWS = 100_000

# Times are counted in microseconds from year 1; 59 binary digits reach beyond year 9999.
_BITS = 59
_YEAR_ONE = -62_135_596_800_000_000
_FAR = 2**_BITS - 1


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> tuple[DataFrame, bool]:
    """Hint a broadcast only after counting; otherwise leave the side to a shuffle join."""
    if bounded_rows(df, max_rows) is None:
        return df, False
    return F.broadcast(df), True


def lookup_latest(
    left: DataFrame, right: DataFrame, key: str, latest_by: Sequence[str], values: Sequence[str]
) -> DataFrame:
    """Left rows plus the newest right row of their key; ties go to the largest values."""
    order = list(dict.fromkeys([*latest_by, *values]))
    newest = dedup_latest(right.select(key, *order), [key], [F.desc(c) for c in order])
    return left.join(newest.select(key, *values), key, "left")


def _micros(col: Column) -> Column:
    return F.unix_micros(col.cast("timestamp")) - F.lit(_YEAR_ONE)


def _stamp(micros: Column) -> Column:
    return F.timestamp_micros(micros + F.lit(_YEAR_ONE))


def _segments(p: DataFrame, keys: list[str], bounded: bool) -> DataFrame:
    """Disjoint segments ``[_b, next_value)`` of the periods ``[_s, _e)``, with the winning ``_w``."""
    bounds = p.select(*keys, F.explode(F.array("_s", "_e")).alias("_b")).distinct()
    odd = [F.when(F.col("_lo") % 2 == 1, F.col("_lo")), F.when(F.col("_hi") % 2 == 1, F.col("_hi") - 1)]
    levels = F.explode(F.sequence(F.lit(0), F.lit(_BITS - 1)))
    blocks = (
        p.withColumn("_i", levels)
        .withColumns(
            {
                "_lo": F.expr("shiftright(_s + shiftleft(1L, _i) - 1, _i)"),
                "_hi": F.expr("shiftright(_e, _i)"),
            }
        )
        .filter("_lo < _hi")
        .select(*keys, "_i", "_s", "_v", F.explode(F.array_compact(F.array(*odd))).alias("_blk"))
        .groupBy(*keys, "_i", "_blk")
        .agg(F.max(F.struct("_s", "_v")).alias("_w"))
    )
    probes = bounds.withColumn("_i", levels).withColumn("_blk", F.expr("shiftright(_b, _i)"))
    winner = probes.join(blocks, [*keys, "_i", "_blk"], "left").groupBy(*keys, "_b").agg(F.max("_w").alias("_w"))
    if bounded:
        seg = winner.withColumn("next_value", F.lead("_b").over(Window.partitionBy(*keys).orderBy("_b")))
    else:
        seg = ordered_functions(winner, keys, "_b", ["_b"], F.shiftright("_b", 45), neighbours="_b")
    return seg.filter("_w IS NOT NULL")


def _periods(prices: DataFrame, keys: list[str], start: str, end: str, values: Sequence[str]) -> DataFrame:
    p = prices.select(
        *keys,
        _micros(F.col(start)).alias("_s"),
        F.coalesce(_micros(F.col(end)), F.lit(_FAR)).alias("_e"),
        F.struct(*values).alias("_v"),
    )
    return p.filter("_s < _e").dropna(subset=keys)


def validity_segments(
    prices: DataFrame, keys: Sequence[str], start: str, end: str, values: Sequence[str], bounded: bool = False
) -> DataFrame:
    """Disjoint validity periods: at any instant the covering row with the latest start counts.

    Input periods are half open, an empty end means open, and they may overlap or nest. Every
    period is cut into aligned power-of-two blocks (at most two per level); of each block only the
    latest start is kept, and each period boundary looks up its own block on every level. So a
    key whose periods all overlap costs no more than one whose periods do not.

    ``bounded`` says that the whole list was counted and is small; the boundaries of a key are then
    chained by a plain window, else block by block. Returns the keys, ``_from``, ``_to`` (NULL when
    open) and the values.
    """
    keys = list(keys)
    return _segments(_periods(prices, keys, start, end, values), keys, bounded).select(
        *keys,
        _stamp(F.col("_b")).alias("_from"),
        F.when(F.col("next_value") < _FAR, _stamp(F.col("next_value"))).alias("_to"),
        "_w._v.*",
    )


def price_lookup(
    usage: DataFrame,
    prices: DataFrame,
    keys: Mapping[str, str],
    at: str,
    start: str,
    end: str,
    values: Sequence[str],
    max_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Each usage row with the values of the price valid at its time, exactly once.

    ``keys`` maps usage columns to price columns. Segments are spread over time buckets and joined
    on the keys plus the bucket, so a row meets the few segments of its bucket and not all of its
    key. The bucket width follows from the price list: about as many (key, bucket) pairs as the list
    has rows. Usage after the last price boundary belongs to the last bucket, where every
    open segment is present.

    A price list of at most ``max_rows`` is broadcast and the usage side is not shuffled at all;
    a larger one is shuffled on keys and bucket, which spreads a hot key over time.
    """
    names = list(keys.values())
    p = _periods(prices, names, start, end, values)
    size = p.agg(
        F.count(F.lit(1)).alias("n"),
        F.min("_s").alias("first"),
        F.max(F.greatest("_s", F.when(F.col("_e") < _FAR, F.col("_e")))).alias("last"),
        F.approx_count_distinct(F.struct(*names)).alias("keys"),
    ).first()
    if not size.n:
        kinds = prices.select(*values).schema
        return usage.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in kinds.fields])
    per_key = max(1, max(4 * size.n, 1 << 16) // size.keys)
    bits = max(0, (size.last - size.first) // per_key).bit_length()
    small = size.n <= max_rows
    seg = _segments(p, names, small).withColumnsRenamed({v: f"_p_{v}" for v in names})
    until = F.least(F.col("next_value") - 1, F.lit(size.last))
    seg = seg.select(
        *[f"_p_{v}" for v in names],
        "_b",
        F.col("next_value").alias("_n"),
        F.explode(F.sequence(F.shiftright("_b", bits), F.shiftright(until, bits))).alias("_pb"),
        "_w._v.*",
    )
    t = _micros(F.col(at))
    u = usage.withColumns({"_t": t, "_ub": F.shiftright(F.least(t, F.lit(size.last)), bits)})
    on = (F.col("_ub") == F.col("_pb")) & (F.col("_b") <= F.col("_t")) & (F.col("_t") < F.col("_n"))
    for mine, theirs in keys.items():
        on = on & (F.col(mine) == F.col(f"_p_{theirs}"))
    return u.join(F.broadcast(seg) if small else seg, on, "left").select(*usage.columns, *values)


def asof_join(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[str],
    left_ts: str,
    right_ts: str,
    values: Sequence[str],
    bucket_seconds: int = 30 * 86400,
) -> DataFrame:
    """Left rows plus the values of the latest right row of the same key not after ``left_ts``.

    Keys are cut into time buckets: a window inside each bucket, plus one carried row per bucket.
    Both use one shuffle on (key, bucket), so a hot key is spread over its buckets. Right rows with
    the same key and time are ranked by their values; NULL keys match nothing. The left side is
    evaluated twice (once for its buckets), so write it first if it is expensive to compute.
    """
    right = right.dropna(subset=[*by, right_ts])
    payload = F.struct(F.col(right_ts).cast("timestamp").alias("_at"), *values)
    kind = right.select(payload.alias("x")).schema["x"].dataType
    row_kind = left.select(F.struct(*left.columns).alias("x")).schema["x"].dataType
    key = F.struct(*by).alias("_k")

    def stamp(c: str) -> Column:
        return F.col(c).cast("timestamp")

    def bucket(c: str) -> Column:
        return F.floor(F.unix_seconds(stamp(c)) / bucket_seconds)

    r = right.select(
        key, bucket(right_ts).alias("_b"), stamp(right_ts).alias("_ts"), F.lit(0).alias("_side"),
        payload.alias("_right"), F.lit(None).cast(row_kind).alias("_left"),
    )
    lft = left.select(
        key, bucket(left_ts).alias("_b"), stamp(left_ts).alias("_ts"), F.lit(1).alias("_side"),
        F.lit(None).cast(kind).alias("_right"), F.struct(*left.columns).alias("_left"),
    )
    both = lft.unionByName(r)
    inside = Window.partitionBy("_k", "_b").orderBy("_ts", "_side", "_right").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    local = both.withColumn("_near", F.last("_right", ignorenulls=True).over(inside)).filter("_side = 1")
    chain = Window.partitionBy("_k").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        both.groupBy("_k", "_b")
        .agg(F.max("_right").alias("_last"))
        .select("_k", "_b", F.last("_last", ignorenulls=True).over(chain).alias("_far"))
        .filter("_far IS NOT NULL")
    )
    hit = F.coalesce("_near", "_far")
    # A left row without a time sits in a NULL bucket and must not match.
    hit = F.when(F.col("_ts").isNotNull(), hit)
    j = local.join(carried, ["_k", "_b"], "left")
    return j.select("_left.*", *[hit[v].alias(v) for v in values], hit["_at"].alias(f"{right_ts}_matched"))
