"""File layout: range clustering and Z-order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_BITS = 8


def cluster_rewrite(df: DataFrame, cols: Sequence[str], files: int) -> DataFrame:
    """Order rows for data skipping on ``cols``: each file then covers a narrow range."""
    return df.repartitionByRange(files, *cols).sortWithinPartitions(*cols)


def _bucket(col: str, cuts: Sequence[float]) -> Column:
    """Number of cut points at or below the value; NULL goes first."""
    points = F.array(*[F.lit(float(c)) for c in cuts])
    return F.coalesce(F.size(F.filter(points, lambda p: p <= F.col(col).cast("double"))), F.lit(0)).cast("long")


def zorder_value(df: DataFrame, cols: Sequence[str]) -> Column:
    """Interleaved bits of the columns' quantile buckets.

    The cut points are a fixed number of approximate quantiles, so what reaches the driver does
    not grow with the data.
    """
    shares = [i / 2**_BITS for i in range(1, 2**_BITS)]
    found = df.agg(*[F.percentile_approx(F.col(c).cast("double"), shares, 10000).alias(c) for c in cols]).first()
    z = F.lit(0).cast("long")
    for i, c in enumerate(cols):
        cuts = sorted(set(found[c] or []))
        b = _bucket(c, cuts) if cuts else F.lit(0).cast("long")
        for bit in range(_BITS):
            z = z.bitwiseOR(F.shiftleft(F.shiftright(b, bit).bitwiseAND(F.lit(1)), bit * len(cols) + i))
    return z


def zorder_rewrite(df: DataFrame, cols: Sequence[str], files: int) -> DataFrame:
    """Order rows along a Z curve over several numeric columns."""
    return (
        df.withColumn("_z", zorder_value(df, cols))
        .repartitionByRange(files, "_z", *cols)
        .sortWithinPartitions("_z")
        .drop("_z")
    )
