"""Stored states per day that unite to distinct counts and quantiles of any period, without the fact."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Largest relative error of a quantile, and the step from one bucket of values to the next that it allows.
ERROR = 0.01
STEP = (1 + ERROR) / (1 - ERROR)
#: Added to the bucket number, so that every positive double has a positive one.
OFFSET = 40_000
#: Binary logarithm of the registers of a distinct count: a standard error of 0.8 %.
REGISTERS = 14


def value_bucket(x: Column) -> Column:
    """Buckets of equal relative width, in the order of the values: negative, zero, positive; NULL for no finite value."""
    x = x.cast("double")
    size = (F.ceil(F.log(F.abs(x)) / F.lit(math.log(STEP))) + OFFSET).cast("int")
    finite = x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.when(finite & (x == 0), 0).when(finite, F.when(x < 0, -size).otherwise(size))


def bucket_value(bucket: Column) -> Column:
    """A value that is within ERROR of every value of the bucket."""
    size = F.pow(F.lit(STEP), F.abs(bucket) - OFFSET) * F.lit(2 / (1 + STEP))
    return F.when(bucket == 0, 0.0).when(bucket < 0, -size).otherwise(size)


@dataclass(frozen=True)
class DayStates:
    """States of a fact per day and ``keys``: distinct values of ``counted``, distribution of ``measure``.

    Two folders partitioned by ``day``. A day and key has one sketch of fixed size and at most one row per bucket that
    occurs, however many records it has.
    """

    spark: SparkSession
    path: str
    day: str
    keys: Sequence[str]
    counted: str
    measure: str

    def refresh(self, fact: DataFrame, days: DataFrame | None = None) -> None:
        """Compute the states of ``days`` (one column, the touched days; all if None) anew; other days stay as they are.

        A touched day that has no record any more loses its states. Rows without a day are left out.
        """
        rows = fact.where(F.col(self.day).isNotNull())
        if days is not None:
            days = days.select(F.col(days.columns[0]).alias(self.day)).where(F.col(self.day).isNotNull()).distinct()
            rows = rows.join(days, self.day, "left_semi")
        by = [self.day, *self.keys]
        distinct = rows.groupBy(*by).agg(F.hll_sketch_agg(self.counted, REGISTERS).alias("state"))
        bucket = value_bucket(F.col(self.measure))
        spread = rows.select(*by, bucket.alias("bucket")).where("bucket IS NOT NULL").groupBy(*by, "bucket").agg(F.count(F.lit(1)).alias("n"))
        for name, states in (("distinct", distinct), ("spread", spread)):
            if days is not None:
                # A row without a state takes the place of a day that became empty.
                gone = days.join(states.select(self.day), self.day, "left_anti")
                blank = [F.lit(None).cast(f.dataType).alias(f.name) for f in states.schema.fields[1:]]
                states = states.unionByName(gone.select(self.day, *blank))
            mode = "static" if days is None else "dynamic"
            states.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy(self.day).parquet(f"{self.path}/{name}")

    def states(self, name: str, period: Column | None = None) -> DataFrame:
        """The stored rows of the days that ``period``, a condition on the day, admits."""
        out = self.spark.read.parquet(f"{self.path}/{name}")
        out = out.where(F.col("state" if name == "distinct" else "n").isNotNull())
        return out if period is None else out.where(period)

    def distinct(self, by: Sequence[Column], period: Column | None = None) -> DataFrame:
        """Estimated number of distinct values for each group of days and keys."""
        return self.states("distinct", period).groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg("state")).alias("values"))

    def quantiles(self, by: Sequence[Column], shares: Sequence[float], period: Column | None = None) -> DataFrame:
        """For each group of days and keys and each share: the value of rank ceil(share * n), within ERROR of it."""
        united = self.states("spread", period).groupBy(*by, "bucket").agg(F.sum("n").alias("n"))
        group = [c for c in united.columns if c not in ("bucket", "n")]
        # At most one row per bucket, so a group is bounded whatever it counts.
        w = Window.partitionBy(*group)
        upto = w.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        ranked = united.withColumn("upto", F.sum("n").over(upto)).withColumn("total", F.sum("n").over(w))
        ranked = ranked.withColumn("share", F.explode(F.lit([float(s) for s in shares])))
        rank = F.greatest(F.ceil(F.col("share") * F.col("total")), F.lit(1))
        at = ranked.where((F.col("upto") >= rank) & (F.col("upto") - F.col("n") < rank))
        return at.select(*group, "share", bucket_value(F.col("bucket")).alias("value"), F.col("total").alias("n"))
