"""Incremental scans driven by a stored high-water mark."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.sources.tables import Lake

TABLE = "meta/pipeline_watermarks"
# Fixed value: where the first load begins.
FIRST = "2020-01-01 00:00:00"


def read_watermark(lake: Lake, pipeline: str, table: str, first: str = FIRST) -> str:
    """The stored mark as text in the session time zone."""
    if not lake.exists(TABLE):
        return first
    hit = lake.read(TABLE).filter((F.col("pipeline_name") == pipeline) & (F.col("table_name") == table))
    return hit.agg(F.max("last_watermark").cast("string")).first()[0] or first


def incremental_scan(src: DataFrame, column: str, watermark: str, lookback_days: int = 0) -> DataFrame:
    """Rows after the mark. With a lookback, rows that came late are read again; the keyed upsert
    that follows absorbs the overlap. The filter is on the bare column, so Parquet skips row groups
    by their statistics."""
    since = F.lit(watermark).cast(src.schema[column].dataType)
    if lookback_days:
        return src.filter(F.col(column) > since - F.make_dt_interval(F.lit(lookback_days)))
    return src.filter(F.col(column) > since)


def advance_watermark(lake: Lake, pipeline: str, table: str, column: str, value: str | None, now: dt.datetime) -> None:
    """Store the largest value of a batch; the mark never moves back."""
    if value is None:
        return
    row = lake.spark.createDataFrame(
        [(pipeline, table, column, value, now)],
        "pipeline_name STRING, table_name STRING, watermark_column STRING, last_watermark STRING, updated_at TIMESTAMP",
    ).select(
        "pipeline_name",
        "table_name",
        "watermark_column",
        F.col("last_watermark").cast("timestamp"),
        F.col("updated_at").cast("date").alias("last_run_date"),
        "updated_at",
    )
    lake.merge(
        TABLE,
        row,
        ["pipeline_name", "table_name"],
        update={
            "watermark_column": lambda t, s: s("watermark_column"),
            "last_watermark": lambda t, s: F.greatest(t("last_watermark"), s("last_watermark")),
            "last_run_date": lambda t, s: s("last_run_date"),
            "updated_at": lambda t, s: s("updated_at"),
        },
    )


def full_scan(src: DataFrame, tag: str, column: str = "price_source") -> DataFrame:
    return src.withColumn(column, F.lit(tag))
