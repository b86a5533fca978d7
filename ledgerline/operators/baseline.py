"""Rolling baselines, period changes and spike rules over daily aggregates.

All windows here run over rows that are already one per key and day (or month), so a group is no
longer than the calendar, however many records went into it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.calc import change_pct, joined_key, money, percent


def daily_totals(df: DataFrame, keys: Sequence[str], date: str, measure: str, carry: Sequence[str] = ()) -> DataFrame:
    """One row per key and day: the measure summed, ``carry`` columns by their largest value."""
    return (
        df.dropna(subset=[*keys, date])
        .groupBy(*keys, date)
        .agg(money(F.sum(measure)).alias("actual_value"), *[F.max(c).alias(c) for c in carry])
    )


def rolling_baseline(df: DataFrame, keys: Sequence[str], date: str, measure: str, days: int = 7) -> DataFrame:
    """Mean of the present days among the ``days`` before each day, the day itself excluded."""
    w = Window.partitionBy(*keys).orderBy(F.unix_date(date)).rangeBetween(-days, -1)
    total = F.sum(measure).over(w).cast("double")
    return df.withColumn("baseline_value", total / F.nullif(F.count(measure).over(w), F.lit(0)))


def severity(actual: Column, baseline: Column, levels: Sequence[float]) -> Column:
    medium, high, critical = levels
    return (
        F.when(actual > baseline * critical, "Critical").when(actual > baseline * high, "High").when(
            actual > baseline * medium, "Medium"
        )
    )


def spike(
    df: DataFrame,
    keys: Sequence[str],
    date: str,
    measure: str,
    *,
    anomaly_type: str,
    metric: str,
    days: int = 7,
    levels: Sequence[float] = (1.25, 1.5, 2.0),
    carry: Sequence[str] = (),
) -> DataFrame:
    """Days whose total exceeds the rolling baseline by the first level or more."""
    daily = daily_totals(df, keys, date, measure, carry)
    b = rolling_baseline(daily, keys, date, "actual_value", days)
    actual, base = F.col("actual_value").cast("double"), F.col("baseline_value")
    hits = b.filter((base > 0) & (actual > base * levels[0]))
    return hits.select(
        joined_key(F.col(date), *keys, F.lit(anomaly_type)).alias("anomaly_id"),
        F.col(date).alias("detection_date"),
        *keys,
        *carry,
        F.lit(anomaly_type).alias("anomaly_type"),
        F.lit(metric).alias("metric"),
        "baseline_value",
        "actual_value",
        percent((actual - base) / base).alias("deviation_percentage"),
        severity(actual, base, levels).alias("severity"),
        F.lit("Open").alias("status"),
    )


def period_change(
    df: DataFrame, keys: Sequence[str], period: str, measure: str, previous: str, change: str | None, pct: str
) -> DataFrame:
    """Value of the previous present period per key, the difference and the percent change."""
    w = Window.partitionBy(*keys).orderBy(period)
    out = df.withColumn(previous, F.lag(measure).over(w))
    if change:
        out = out.withColumn(change, F.col(measure) - F.coalesce(F.col(previous), F.lit(0).cast("decimal(28,6)")))
    return out.withColumn(pct, change_pct(F.col(measure), F.col(previous)))


def off_pattern(
    df: DataFrame,
    keys: Sequence[str],
    date: str,
    measure: str,
    off: Column,
    *,
    anomaly_type: str,
    metric: str,
    levels: Sequence[float] = (1.25, 1.5, 2.0),
) -> DataFrame:
    """Days whose total inside the ``off`` hours exceeds the key's mean regular day.

    Used for weekends and for hours outside working time: the baseline is the mean, per key, of
    the daily totals of all rows that are not ``off``.
    """
    daily = (
        df.dropna(subset=[*keys, date])
        .groupBy(*keys, date)
        .agg(
            money(F.sum(F.when(off, F.col(measure)))).alias("actual_value"),
            money(F.sum(F.when(~off, F.col(measure)))).alias("_regular"),
        )
    )
    base = daily.groupBy(*keys).agg(
        (F.sum("_regular").cast("double") / F.nullif(F.count("_regular"), F.lit(0))).alias("baseline_value")
    )
    j = daily.join(base, list(keys))
    actual, b = F.col("actual_value").cast("double"), F.col("baseline_value")
    return j.filter((b > 0) & (actual > b * levels[0])).select(
        joined_key(F.col(date), *keys, F.lit(anomaly_type)).alias("anomaly_id"),
        F.col(date).alias("detection_date"),
        *keys,
        F.lit(anomaly_type).alias("anomaly_type"),
        F.lit(metric).alias("metric"),
        "baseline_value",
        "actual_value",
        percent((actual - b) / b).alias("deviation_percentage"),
        severity(actual, b, levels).alias("severity"),
        F.lit("Open").alias("status"),
    )
