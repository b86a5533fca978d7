"""Event-time streams: JSON messages, windows, late rows, de-duplication, upserts."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.operators.merge import dedup_latest
from ledgerline.operators.quality import expect
from ledgerline.sources.tables import Lake, upsert_partitions
from ledgerline.streaming.ingest import append_once, run_available


def parse_json_stream(stream: DataFrame, schema: T.StructType, column: str = "value") -> DataFrame:
    """Message bytes to columns."""
    return stream.select(F.from_json(F.col(column).cast("string"), schema).alias("data")).select("data.*")


def windowed_counts(stream: DataFrame, ts: str, width: str, delay: str, keys: Sequence[str]) -> DataFrame:
    """Events per tumbling event-time window and key."""
    s = stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)
    return (
        s.groupBy(F.window(ts, width).alias("w"), *keys)
        .agg(F.count(F.lit(1)).alias("event_count"))
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *keys, "event_count")
    )


def batch_counts(df: DataFrame, ts: str, width: str, keys: Sequence[str]) -> DataFrame:
    """The same windows over a bounded table."""
    d = df.withColumn(ts, F.col(ts).cast("timestamp"))
    return (
        d.groupBy(F.window(ts, width).alias("w"), *keys)
        .agg(F.count(F.lit(1)).alias("event_count"))
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *keys, "event_count")
    )


def merge_batches(lake: Lake, name: str, keys: Sequence[str], unique: bool = True, order_by: Sequence[Column] = ()) -> Callable:
    """A batch writer that upserts; writing a batch twice changes nothing."""

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch if unique else dedup_latest(batch, keys, order_by)
        lake.merge(name, rows, keys, unique_source=True)

    return write


def merge_partitions(path: str, keys: Sequence[str], partition: str) -> Callable:
    """A batch writer that upserts into a partitioned folder: a batch rewrites the partitions it
    touches, so its cost does not grow with the table."""

    def write(batch: DataFrame, batch_id: int) -> None:
        upsert_partitions(batch.sparkSession, path, batch, keys, partition, unique_source=True)

    return write


def unique_events(stream: DataFrame, ts: str, delay: str, key: str) -> DataFrame:
    """First event per key; state is dropped once the watermark has passed."""
    return stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])


def dropped_by_watermark(query) -> int:
    """Late rows that Spark reports in the progress entries it still holds.

    A sign, not a count: entries of old batches are gone, and rows are counted after partial aggregation. Correct
    late windows with ``correct_windows`` whatever this says.
    """
    return sum(
        int(op["numRowsDroppedByWatermark"]) for p in query.recentProgress for op in p["stateOperators"]
    )


def correct_windows(lake: Lake, name: str, bronze: DataFrame, late: DataFrame, ts: str, width: str, keys: Sequence[str]) -> dict:
    """Recount from bronze the windows that late rows belong to, and upsert them.

    Bronze is read between the first and the last touched window only.
    """
    w = F.window(F.col(ts).cast("timestamp"), width)
    hit = late.select(w["start"].alias("_w"), *keys).distinct()
    kind = bronze.schema[ts].dataType
    lo, hi = late.agg(F.min(w["start"]).cast("string"), F.max(w["end"]).cast("string")).first()
    part = bronze.filter((F.col(ts) >= F.lit(lo).cast(kind)) & (F.col(ts) < F.lit(hi).cast(kind)))
    fresh = batch_counts(part, ts, width, keys).alias("f")
    on = F.col("f.window_start") == F.col("h._w")
    for k in keys:
        on = on & F.col(f"f.{k}").eqNullSafe(F.col(f"h.{k}"))
    return lake.merge(name, fresh.join(hit.alias("h"), on, "left_semi"), ["window_start", *keys], unique_source=True)


def layered_batch(
    lake: Lake,
    *,
    bronze: str,
    silver: str,
    gold: str,
    key: str,
    rules: Mapping[str, Column],
    group: Sequence[str],
    aggregates: Sequence[Column],
) -> Callable[[DataFrame, int], None]:
    """A batch writer for three layers: raw rows, valid rows once per key, aggregates.

    Gold is recomputed for the groups of the batch only.
    """
    raw = append_once(lake, bronze, f"stream {bronze}")

    def write(batch: DataFrame, batch_id: int) -> None:
        raw(batch, batch_id)
        kept, _ = expect(batch, rules)
        rows = dedup_latest(kept, [key], [F.desc(c) for c in kept.columns if c != key])
        lake.insert_missing(silver, rows, [key])
        touched = kept.select(*group).distinct().alias("t")
        on = None
        for g in group:
            same = F.col(f"s.{g}").eqNullSafe(F.col(f"t.{g}"))
            on = same if on is None else on & same
        part = lake.read(silver).alias("s").join(touched, on, "left_semi")
        lake.merge(gold, part.groupBy(*group).agg(*aggregates), list(group), unique_source=True)

    return write


def replay(lake_stream: Callable[[], DataFrame], slices: Sequence[DataFrame], landing: str, run: Callable[[DataFrame], object]) -> list:
    """Land slices one after the other and run the stream to its end after each."""
    out = []
    for part in slices:
        part.write.mode("append").parquet(landing)
        out.append(run(lake_stream()))
    return out

