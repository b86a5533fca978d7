"""Streams, replayed from events in time order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.catalog.registry import DATE, TS, Inputs, query
from ledgerline.streaming import events as ev
from ledgerline.streaming import ingest

_WINDOW = "time_bucket(INTERVAL 1 HOUR, ts)"
_COUNTS = f"""SELECT {TS(_WINDOW)} AS window_start, {TS(_WINDOW + ' + INTERVAL 1 HOUR')} AS window_end, event_type, COUNT(*) AS event_count
FROM events GROUP BY ALL"""


def _slices(df: DataFrame) -> list[DataFrame]:
    """Thirds of the time that the events span; the first and the last are open, so every event is in one."""
    at = F.col("ts").cast("timestamp").cast("double")
    low, high = df.agg(F.min(at), F.max(at)).first()
    third = (high - low) / 3 if low is not None else 0.0
    part = F.when(at >= F.lit((low or 0.0) + 2 * third), 2).when(at >= F.lit((low or 0.0) + third), 1).otherwise(0)
    return [df.filter(part == k) for k in range(3)]


def _source(i: Inputs, df: DataFrame, landing: str):
    # An empty append creates the folder, so the stream can start before the first slice.
    df.limit(0).write.mode("append").parquet(landing)
    return lambda: i.spark.readStream.schema(df.schema).parquet(landing)


@query("stream_tumbling", _COUNTS)
def _(i: Inputs) -> DataFrame:
    """Update mode, restarted after each slice: the final state equals the batch count."""
    work, e = i.folder("stream"), i.table("events")
    write = ev.merge_partitions(f"{work}/counts", ["window_start", "window_end", "event_type"], "day")
    make = _source(i, e, f"{work}/in")
    counts = lambda: ev.windowed_counts(make(), "ts", "1 hour", "2 minutes", ["event_type"])
    ev.replay(lambda: counts().withColumn("day", F.col("window_start").cast("date")), _slices(e), f"{work}/in",
              lambda s: ev.run_available(s, f"{work}/state", write, "update"))
    return i.spark.read.parquet(f"{work}/counts").drop("day")


@query("stream_closed_windows", f"""SELECT * FROM ({_COUNTS}) WHERE window_end <= (SELECT {TS("MAX(ts) - INTERVAL 2 MINUTE")} FROM events)""")
def _(i: Inputs) -> DataFrame:
    """Append mode: a window appears once the watermark has passed its end."""
    lake, work, e = i.lake(), i.folder("stream"), i.table("events")
    write = ingest.append_once(lake, "gold/closed", "stream closed")
    make = _source(i, e, f"{work}/in")
    ev.replay(lambda: ev.windowed_counts(make(), "ts", "1 hour", "2 minutes", ["event_type"]), _slices(e), f"{work}/in",
              lambda s: ev.run_available(s, f"{work}/state", write, "append"))
    return lake.read("gold/closed")


@query("stream_dedup", "SELECT event_type, COUNT(*) AS n, ROUND(SUM(value), 4) AS total FROM events GROUP BY 1")
def _(i: Inputs) -> DataFrame:
    """Every event is delivered twice within a slice; each key passes once."""
    lake, work, e = i.lake(), i.folder("stream"), i.table("events")
    write = ingest.append_once(lake, "silver/events", "stream events")
    make = _source(i, e, f"{work}/in")
    ev.replay(lambda: ev.unique_events(make(), "ts", "2 minutes", "event_id"), _slices(e.unionByName(e)), f"{work}/in",
              lambda s: ev.run_available(s, f"{work}/state", write))
    return lake.read("silver/events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"))


@query("stream_upsert", f"""SELECT user_id, event_id, event_type, {TS('ts')} AS ts FROM events
QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def _(i: Inputs) -> DataFrame:
    """Newest event per user, kept up to date batch by batch."""
    lake, work, e = i.lake(), i.folder("stream"), i.table("events").select("user_id", "event_id", "event_type", "ts")
    write = ev.merge_batches(lake, "silver/last", ["user_id"], unique=False, order_by=[F.desc("ts"), F.desc("event_id")])
    make = _source(i, e, f"{work}/in")
    ev.replay(make, _slices(e), f"{work}/in", lambda s: ev.run_available(s, f"{work}/state", write))
    return lake.read("silver/last")


@query("stream_json", "SELECT event_type, user_id, COUNT(*) AS n FROM events GROUP BY 1, 2")
def _(i: Inputs) -> DataFrame:
    """Messages are bytes of JSON; they are parsed and counted per user."""
    from pyspark.sql import types as T

    lake, work = i.lake(), i.folder("stream")
    e = i.table("events")
    msg = e.select("ts", F.to_json(F.struct("event_type", "user_id")).cast("binary").alias("value"))
    schema = T.StructType([T.StructField("event_type", T.StringType()), T.StructField("user_id", T.IntegerType())])
    make = _source(i, msg, f"{work}/in")
    write = ingest.append_once(lake, "bronze/messages", "stream messages")
    ev.replay(lambda: ev.parse_json_stream(make(), schema), _slices(msg), f"{work}/in",
              lambda s: ev.run_available(s, f"{work}/state", write))
    return lake.read("bronze/messages").groupBy("event_type", F.col("user_id").cast("long").alias("user_id")).agg(F.count(F.lit(1)).alias("n"))


@query("stream_late_corrected", _COUNTS)
def _(i: Inputs) -> DataFrame:
    """The middle slice comes last and falls behind the watermark; its windows are recounted."""
    lake, work, e = i.lake(), i.folder("stream"), i.table("events")
    name, keys = "gold/counts", ["window_start", "window_end", "event_type"]
    write = ev.merge_batches(lake, name, keys)
    first, late, last = _slices(e)
    make = _source(i, e, f"{work}/in")
    ev.replay(lambda: ev.windowed_counts(make(), "ts", "1 hour", "2 minutes", ["event_type"]), [first, last, late], f"{work}/in",
              lambda s: ev.run_available(s, f"{work}/state", write, "update"))
    # Whether or not Spark reports dropped rows: its progress entries are kept for the last batches only.
    ev.correct_windows(lake, name, i.spark.read.parquet(f"{work}/in"), late, "ts", "1 hour", ["event_type"])
    return lake.read(name)


@query("stream_layers", """SELECT event_type, COUNT(*) AS headcount, ROUND(AVG(value), 4) AS avg_value FROM events
WHERE value > 5 AND user_id IS NOT NULL GROUP BY 1""")
def _(i: Inputs) -> DataFrame:
    """Raw, valid and aggregated tables fed by one stream."""
    lake, work, e = i.lake(), i.folder("stream"), i.table("events")
    write = ev.layered_batch(
        lake, bronze="bronze/events", silver="silver/events", gold="gold/by_type", key="event_id",
        rules={"valid_value": F.col("value") > 5, "has_user": F.col("user_id").isNotNull()}, group=["event_type"],
        aggregates=[F.count(F.lit(1)).alias("headcount"), F.round(F.avg("value"), 4).alias("avg_value")])
    make = _source(i, e, f"{work}/in")
    ev.replay(make, _slices(e), f"{work}/in", lambda s: ev.run_available(s, f"{work}/state", write))
    return lake.read("gold/by_type")


#: The first third of the time that the events span, as in ``_slices``.
_LOW, _THIRD = "(SELECT MIN(epoch(ts)) FROM events)", "(SELECT (MAX(epoch(ts)) - MIN(epoch(ts))) / 3 FROM events)"
_LATER = f"epoch(ts) >= {_LOW} + {_THIRD}"


@query("file_ingest", f"""SELECT event_type, COUNT(*) AS n, COUNT(*) FILTER (later) AS with_value,
  ROUND(SUM(value) FILTER (later), 4) AS total FROM (SELECT *, {_LATER} AS later FROM events) GROUP BY 1""")
def _(i: Inputs) -> DataFrame:
    """CSV files, the later ones with a new column; a run without new files adds nothing."""
    lake, work = i.lake(), i.folder("stream")
    first, *rest = _slices(i.table("events"))
    src = f"{work}/csv"
    for k, part in enumerate([first, *rest]):
        cols = ["event_id", "user_id", "event_type"] + (["value"] if k else [])
        part.select(*cols).write.mode("append").option("header", True).csv(src)
        ingest.ingest_stream(lake, "bronze/csv_events", "csv", src, f"{work}/state")
    ingest.ingest_stream(lake, "bronze/csv_events", "csv", src, f"{work}/state")
    return lake.read("bronze/csv_events").groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.count("value").alias("with_value"), F.round(F.sum("value"), 4).alias("total"))


@query("drifted_csv", f"""SELECT event_type, COUNT(*) AS n, COUNT(*) FILTER (part = 2) AS texts, 0 AS missing,
  ROUND(SUM(CASE part WHEN 0 THEN event_id WHEN 1 THEN value END), 3) AS total
FROM (SELECT *, CASE WHEN epoch(ts) >= {_LOW} + 2 * {_THIRD} THEN 2 WHEN epoch(ts) >= {_LOW} + {_THIRD} THEN 1 ELSE 0 END AS part FROM events) GROUP BY 1""")
def _(i: Inputs) -> DataFrame:
    """One column holds whole numbers in the first files, then fractions, then text: no value is lost on the way."""
    lake, work = i.lake(), i.folder("stream")
    reading = [F.col("event_id").cast("string"), F.col("value").cast("string"), F.concat(F.lit("state "), "event_type")]
    for part, column in zip(_slices(i.table("events")), reading):
        part.select("event_type", column.alias("reading")).write.mode("append").option("header", True).csv(f"{work}/csv")
        ingest.ingest_stream(lake, "bronze/drifted", "csv", f"{work}/csv", f"{work}/state")
    number = F.col("reading").try_cast("double")
    return lake.read("bronze/drifted").groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(number.isNull()).alias("texts"),
        F.count_if(F.col("reading").isNull() | F.col("_rescued").isNotNull()).alias("missing"), F.round(F.sum(number), 3).alias("total"))
