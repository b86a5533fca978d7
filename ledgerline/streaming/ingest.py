"""Incremental file ingest: each file once, schema grows with the files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.sources.drift import as_text, settle, typed
from ledgerline.sources.files import format_options, resolve_schema, store_schema
from ledgerline.sources.tables import Lake


def file_stream(spark: SparkSession, fmt: str, src: str, schema: T.StructType) -> DataFrame:
    return spark.readStream.schema(schema).options(**format_options(fmt)).format(fmt).load(src)


def append_once(lake: Lake, name: str, stream_id: str) -> Callable[[DataFrame, int], None]:
    """A batch writer that skips a batch it already committed: the batch number is stored in the
    same history row that makes the data visible."""

    def write(batch: DataFrame, batch_id: int) -> None:
        if lake.exists(name):
            done = lake.history(name).filter(F.col("operation") == stream_id).agg(F.max(F.col("metrics")["batch"])).first()[0]
            if done is not None and done >= batch_id:
                return
        lake.commit(name, batch, stream_id, keep=True, metrics={"batch": batch_id})

    return write


def run_available(stream: DataFrame, checkpoint: str, write: Callable[[DataFrame, int], None], mode: str = "append"):
    """Process what has arrived, then stop. The checkpoint lets the next run go on from there."""
    query = (
        stream.writeStream.outputMode(mode)
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def ingest_stream(lake: Lake, name: str, fmt: str, src: str, state: str) -> None:
    """Load new files of ``src`` into a table; ``state`` holds the schema store and checkpoint.

    The schema is resolved before each run, so columns of new files join the table, and columns whose
    values have outgrown their type are widened there. Text formats are read as text and typed here:
    what arrives between the two and does not fit is kept in ``_rescued``.
    """
    schema = resolve_schema(lake.spark, fmt, src, f"{state}/schema")
    if fmt not in ("csv", "json"):
        stream = file_stream(lake.spark, fmt, src, schema).select("*", F.col("_metadata.file_path").alias("_source_file"))
    else:
        # No value of a column has been seen yet: text holds whatever comes first.
        schema = T.StructType([T.StructField(f.name, T.StringType() if isinstance(f.dataType, T.NullType) else f.dataType, True) for f in schema.fields])
        settled = settle(lake, name, schema)
        if settled != schema:
            store_schema(lake.spark, f"{state}/schema", settled)
        stream = file_stream(lake.spark, fmt, src, as_text(settled)).select("*", F.col("_metadata.file_path").alias("_source_file"))
        stream = typed(stream, settled)
    run_available(stream, f"{state}/checkpoint", append_once(lake, name, f"stream {name}"))
